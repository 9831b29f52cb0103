"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree in one of
``radius + 1`` bit blocks (pigeonhole), so equal blocks bring all links
together; with many fingerprints, keys of several blocks keep the buckets
small. Inside a bucket, 64 fingerprints are stored as 64 vertical bit planes;
carry-save counters add the planes of the difference to a query, and blocks of
64 are abandoned once all lanes exceed the radius. A bucket emits spanning
links only, one fewer than its linked fingerprints. Buckets over ``hot`` rows
are split again by the blocks of their remaining bits; what is left large is
dense and is searched breadth-first, so that linked fingerprints leave the
planes. Components come from alternating stars.

Defined results: null, empty and white-space texts have fingerprint zero and
are linked like any other; documents with equal fingerprints share one node,
however many; a null doc_id never names a component that has another id;
repeated rows are returned as often as they came; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_of, trimmed, written
from .components import connected_components

SHINGLE, RADIUS, SEED = 4, 4, 42
HOT = 4096
PAIRS = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        a, b = starts[k : min(n, k + (1 << 15))].tolist(), ends[k + width - 1 : min(n, k + (1 << 15)) + width - 1].tolist()
        h = np.fromiter([xxh64_intdigest(joined[i:j], seed) for i, j in zip(a, b, strict=True)], np.uint64, len(a))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` (all where None) and fp, a signed long."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "fp"]

    def run(batches):
        for batch in batches:
            made = np.array([fingerprint(x, shingle) for x in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(made)], names=[*batch.schema.names[1:], "fp"])

    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(lambda batches: trimmed(run(batches)), docs.select(*keep).schema.add("fp", T.LongType()))


def _planes(fps: np.ndarray) -> np.ndarray:
    """A row of bit planes for each bit, 64 fingerprints to a word. ``fps`` has
    one word for each fingerprint, or rows of several."""
    fps = fps.reshape(len(fps), -1)
    padded = np.zeros((-(-len(fps) // 64) * 64, fps.shape[1]), np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def near(planes: np.ndarray, blocks: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a block of 64 and a query: the pairs that stay, and their
    lanes within the radius as a bit mask. Counters have as many bits as the
    radius; a lane whose counter runs over is marked."""
    alive, queries = np.arange(len(blocks)), queries.reshape(len(queries), -1)
    counters = [np.zeros(len(blocks), np.uint64) for _ in range(radius.bit_length())]
    over, one = np.zeros(len(blocks), np.uint64), np.uint64(1)
    for j in range(0, len(planes), 2):
        b, q = blocks[alive], queries[alive, j // 64]
        x = planes[j][b] ^ (np.uint64(0) - ((q >> np.uint64(j % 64)) & one))
        y = planes[j + 1][b] ^ (np.uint64(0) - ((q >> np.uint64((j + 1) % 64)) & one))
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for k in range(1, len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if j % 8 == 6:
            stay = np.flatnonzero(~(over | _above(counters, radius)))
            if len(stay) < 0.8 * len(alive):
                alive, over, counters = alive[stay], over[stay], [c[stay] for c in counters]
    return alive, ~(over | _above(counters, radius))


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over the radius, compared from the highest bit."""
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def _lanes(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, lane) of the set bits."""
    rows = np.flatnonzero(mask)
    bits = np.unpackbits(mask[rows].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(bits)
    return rows[at], lane


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of a and b; labels are smallest members."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def links(fps: np.ndarray, bounds: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the buckets fps[bounds[k]:bounds[k + 1]]."""
    label = linked(fps, bounds, radius)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[label[moved]], fps[moved]


def linked(fps: np.ndarray, bounds: np.ndarray, radius: int) -> np.ndarray:
    """For each place, the first place of its class within its bucket."""
    label = np.arange(len(fps))
    sizes = np.diff(bounds)
    small = np.flatnonzero((sizes > 1) & (sizes <= HOT))
    # lanes of one block belong to one bucket: each bucket begins a new block
    per = -(-sizes[small] // 64)
    first = np.concatenate(([0], np.cumsum(per)))
    if len(small):
        padded = np.zeros((int(first[-1]) * 64, *fps.shape[1:]), np.uint64)
        origin = np.full(len(padded), -1)
        rows = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in small])
        slot = np.concatenate([np.arange(sizes[k]) + first[i] * 64 for i, k in enumerate(small)])
        padded[slot], origin[slot] = fps[rows], rows
        planes = _planes(padded)
        reps = np.repeat(per, sizes[small])
        query = np.repeat(rows, reps)
        block = np.concatenate([np.tile(np.arange(first[i], first[i + 1]), sizes[k]) for i, k in enumerate(small)])
        for k in range(0, len(query), PAIRS):
            q = query[k : k + PAIRS]
            alive, mask = near(planes, block[k : k + PAIRS], fps[q], radius)
            at, lane = _lanes(mask)
            other = origin[block[k : k + PAIRS][alive[at]] * 64 + lane]
            mine = q[alive[at]]
            ok = other > mine
            _union(label, mine[ok], other[ok])
    for k in np.flatnonzero(sizes > HOT):
        _dense(fps, int(bounds[k]), int(bounds[k + 1]), label, radius)
    return label


def _dense(fps: np.ndarray, lo: int, hi: int, label: np.ndarray, radius: int) -> None:
    """Breadth-first over one large bucket; what is reached leaves the planes."""
    left = np.arange(lo, hi)
    while len(left):
        root, frontier, left = left[0], left[:1], left[1:]
        label[root] = root
        while len(frontier) and len(left):
            width = -(-len(left) // 64)
            take, frontier = frontier[: max(1, PAIRS // width)], frontier[max(1, PAIRS // width) :]
            planes = _planes(fps[left])
            found = np.zeros(width * 64, bool)
            for k in range(0, width, PAIRS):
                span = np.arange(k, min(width, k + PAIRS))
                blocks, queries = np.tile(span, len(take)), np.repeat(fps[take], len(span), axis=0)
                alive, mask = near(planes, blocks, queries, radius)
                at, lane = _lanes(mask)
                found[blocks[alive[at]] * 64 + lane] = True
            got = left[found[: len(left)]]
            label[got] = root
            left = left[~found[: len(left)]]
            frontier = np.concatenate((frontier, got))


def _spans(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal runs of the given bit positions."""
    return [sum(1 << int(b) for b in run) for run in np.array_split(bits, parts)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _block_masks(rows: int, radius: int) -> list[int]:
    """Keys of the fewest blocks that leave mean buckets of 1,000 at most."""
    for blocks in range(radius + 1, radius + 4):
        spans = _spans(list(range(64)), blocks)
        if rows >> int(64 * (blocks - radius) / blocks) < 1000:
            break
    return [sum(c) for c in combinations(spans, blocks - radius)]


def _bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """rows: mask, value, fp. Streams sorted buckets through links()."""

    def run(batches):
        held = [np.empty(0, np.int64)] * 3

        def solve(cols, final):
            mask, value, fp = cols
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            end = len(fp) if final else (int(cut[-1]) if len(cut) else 0)
            bounds = np.concatenate(([0], cut[cut < end], [end])) if end else np.zeros(1, np.int64)
            a, b = links(fp[:end].view(np.uint64), bounds, radius) if end else (fp[:0], fp[:0])
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]), [c[end:] for c in cols]

        for batch in batches:
            held = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns, strict=True)]
            if len(held[0]) >= 50_000:
                out, held = solve(held, False)
                yield out
        if len(held[0]):
            yield solve(held, True)[0]

    keyed = rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return keyed.select("mask", "value", "fp").mapInArrow(lambda batches: trimmed(run(batches)), "a long, b long")


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT, levels: int = 2) -> DataFrame:
    """Spanning links (a, b) among the distinct fingerprints of ``fps``."""
    masks = _block_masks(fps.count(), radius)
    value = lambda: F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    rows = fps.select(F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fp").select("mask", value(), "fp")
    found = None
    for level in range(levels + 1):
        big = rows.groupBy("mask", "value").count().where(F.col("count") > hot).select("mask", "value")
        if level == levels or big.isEmpty():
            part = _bucket_links(rows, radius)
            return part if found is None else found.union(part)
        big = written(big, "hot")
        part = _bucket_links(rows.join(big, ["mask", "value"], "left_anti"), radius)
        found = part if found is None else found.union(part)
        finer = {m: [m | s for s in _spans([b for b in range(64) if not m >> b & 1], radius + 1)] for m in masks}
        pick = F.lit(None).cast("array<bigint>")
        for m, subs in finer.items():
            pick = F.when(F.col("mask") == F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in subs])).otherwise(pick)
        rows = rows.join(big, ["mask", "value"], "left_semi").select(F.explode(pick).alias("mask"), "fp").select("mask", value(), "fp").distinct()
        masks = sorted({s for subs in finer.values() for s in subs})
    return found


def label_fingerprints(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id, rep_fp): the class of each distinct fingerprint
    of ``marked`` (doc_id, fp), and the fingerprint of the row that names it."""
    fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fps")
    return _named(fps, connected_components(fingerprint_links(fps.select("fp"), radius)))


def label_nodes(marked: DataFrame, links: DataFrame) -> DataFrame:
    """The same, of nodes ``fp`` with links of their own."""
    return _named(written(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fps"), connected_components(links))


def _named(fps: DataFrame, stars: DataFrame) -> DataFrame:
    rooted = fps.join(stars, fps["fp"] == stars["a"], "left").select("fp", "rep", F.coalesce("b", "fp").alias("root"))
    named = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("rep"), F.col("fp").alias("fp")))
    roots = rooted.groupBy("root").agg(named.alias("least")).select("root", F.col("least.rep").alias("component_id"), F.col("least.fp").alias("rep_fp"))
    return rooted.join(roots, "root").select("fp", "component_id", "rep_fp")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    marked = written(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), keep=["doc_id"], shingle=shingle), "marked")
    labels = label_fingerprints(marked, radius)
    return marked.join(labels, "fp", "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component stays: that with the smallest doc_id."""
    hashed = with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), text_mark(text).alias("mark"), F.col(text).alias("text")), keep=["doc_id", "mark"], shingle=shingle)
    marked = written(hashed, "marked")
    return keep_first(docs, marked, label_fingerprints(marked, radius), doc_id, text)


def text_mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def keep_first(docs: DataFrame, marked: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that name their component. ``marked`` has doc_id,
    fp and mark (text_mark) of all rows. Where rows share the id, that of the
    smallest mark stays; of rows that repeat both, one."""
    columns = docs.columns
    named = marked.join(labels, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("rep_fp")))
    keepers = named.groupBy("doc_id", "mark").agg(F.count("*").alias("times")).groupBy("doc_id").agg(F.min_by("times", "mark").alias("__times"), F.min("mark").alias("__mark")).withColumnRenamed("doc_id", "__id")
    rows = docs.withColumn("__own", text_mark(text))
    kept = rows.join(keepers, rows[doc_id].cast("long").eqNullSafe(keepers["__id"]) & (rows["__own"] == keepers["__mark"]))
    single, several = kept.where("__times = 1"), kept.where("__times > 1").dropDuplicates(["__id", "__mark"])
    return single.union(several).select(*[F.col(f"`{c}`") for c in columns])
