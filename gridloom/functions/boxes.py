"""Nearest rectangles by a packed tree of boxes, on NumPy arrays."""

from __future__ import annotations

import numpy as np

FAN = 16
#: Pairs of a rectangle and a box that one step compares.
STEP = 1 << 16
FAR = 1 << 31  # beyond all integers


def corners_of(table) -> np.ndarray:
    """min_row, min_col, max_row, max_col as rows of an array; a missing one is
    open, as the distance in Spark and SQL leaves its gap out."""
    open_ends = {"min_row": -FAR, "min_col": -FAR, "max_row": FAR, "max_col": FAR}
    return np.stack([table.column(n).cast("int64").fill_null(x).to_numpy() for n, x in open_ends.items()])


class Boxes:
    """Rectangles (4 x n, in the order of their rank in ties), packed into
    leaves and levels of FAN by row, then column. A level has the corners of
    each box and the least rank in it."""

    def __init__(self, corners: np.ndarray):
        n = self.n = corners.shape[1]
        slab = FAN * max(1, int(np.ceil(np.sqrt(n / FAN))))
        order = np.argsort(corners[0], kind="stable")
        order = order[np.lexsort((corners[1][order], np.arange(n) // slab))]
        box = np.concatenate((corners[:, order], order[None]))
        self.levels = [box]
        while box.shape[1] > FAN:
            starts = np.arange(0, box.shape[1], FAN)
            least = np.minimum.reduceat(box[[0, 1, 4]], starts, axis=1)
            most = np.maximum.reduceat(box[[2, 3]], starts, axis=1)
            box = np.stack((least[0], least[1], most[0], most[1], least[2]))
            self.levels.append(box)

    def keys(self, level: int, ours: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Distance and rank in one number: exact for a rectangle, and for a
        box no more than that of any rectangle in it."""
        r1, c1, r2, c2, rank = self.levels[level][:, node]
        rows = np.maximum(0, np.maximum(r1 - ours[2], ours[0] - r2))
        cols = np.maximum(0, np.maximum(c1 - ours[3], ours[1] - c2))
        return (rows + cols) * self.n + rank

    def below(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of the nodes of a level, and whose they are."""
        child = (node[:, None] * FAN + np.arange(FAN)).ravel()
        whose = np.repeat(np.arange(len(node)), FAN)
        real = child < self.levels[level - 1].shape[1]
        return child[real], whose[real]

    def nearest(self, ours: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and distance of the nearest rectangle for each of ``ours``."""
        best = np.full(ours.shape[1], np.iinfo(np.int64).max)
        top = len(self.levels) - 1
        roots = np.arange(self.levels[top].shape[1])
        step = max(1, STEP // FAN)
        for lo in range(0, len(best), step):
            mine = np.arange(lo, min(lo + step, len(best)))
            todo = [(top, np.repeat(mine, len(roots)), np.tile(roots, len(mine)))]
            # first down to one good rectangle each, which spares most boxes
            node = None
            for level in range(top, -1, -1):
                child, whose = (np.tile(roots, len(mine)), np.repeat(np.arange(len(mine)), len(roots))) if node is None else self.below(level + 1, node)
                key = self.keys(level, ours[:, mine[whose]], child)
                order = np.lexsort((key, whose))
                first = order[np.concatenate(([True], np.diff(whose[order]) > 0))]
                node = child[first]
            best[mine] = key[first]
            while todo:
                level, query, node = todo.pop()
                if len(query) > STEP:
                    todo += [(level, query[k : k + STEP], node[k : k + STEP]) for k in range(0, len(query), STEP)]
                    continue
                key = self.keys(level, ours[:, query], node)
                if level == 0:
                    np.minimum.at(best, query, key)
                    continue
                near = key < best[query]
                child, whose = self.below(level, node[near])
                todo.append((level - 1, query[near][whose], child))
        return best % self.n, best // self.n
