"""Near copies by shingle similarity: the wide form of the SimHash operator.

Two documents are linked when the Jaccard similarity of their sets of five-word
shingles is 0.8 or more. A 64-bit fingerprint differs in about 10 bits there,
so this form has WORDS of 64 bits and a radius that such pairs keep to (at 0.8
about 19 of 128 bits differ, and RADIUS is over four deviations more). No runs
of bits are selective at that distance, so buckets come from BANDS bands of
ROWS minimum hashes each: a pair of similarity s shares one with probability
1 - (1 - s**ROWS)**BANDS, 0.9993 at 0.8.

1. In each bucket the bit-sliced comparison proposes spanning links. A bucket
   over HOT members is not searched by one task: all its members are proposed.
   Proposals form groups, of which the true components are parts.
2. Groups are cut into blocks of bounded size. In each block, and then in each
   pair of blocks that is not yet one component, all sets are compared exactly:
   products of 0/1 matrices count common shingles. A block returns spanning
   links only, so a group of n copies never becomes n * n rows.

Defined results: texts of fewer words than a shingle have one shingle, all
their words; null, empty and white-space texts are copies of each other; very
long texts are compared whole; of equal rows one stays; of rows that share the
id that names a component, the one with the smallest hash of its text stays; an
empty table gives an empty table; other columns are passed on, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sliced, texts_of, trimmed, written
from .components import connected_components
from .simhash import HOT, _union, keep_first, label_nodes, linked, text_mark

SHINGLE, SEED = 5, 42
PERCENT = 80
BANDS, ROWS = 24, 6
MINIMA = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64) | np.uint64(1)
WORDS, RADIUS = 2, 38
#: Members and shingles of a block, about.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 20
COLUMNS = 4096


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles' hashes in order."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1]
    spans = zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((xxh64_intdigest(joined[i:j], SEED) for i, j in spans), np.uint64, len(starts)))


def node_of(found: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(found.tobytes(), SEED)


def bands_of(found: np.ndarray) -> np.ndarray:
    """A key for each band of minimum hashes."""
    low = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for k in range(0, len(found), 2048):
        np.minimum(low, (found[k : k + 2048, None] * MINIMA[0] + MINIMA[1]).min(axis=0), out=low)
    low ^= low >> np.uint64(29)
    low *= MINIMA[0]
    return low.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """WORDS words: a bit is 1 if set in over half the shingles' hashes."""
    counts = np.zeros(64 * WORDS, np.int64)
    for k in range(0, len(found), 1 << 14):
        h = np.empty((len(found[k : k + (1 << 14)]), WORDS), np.uint64)
        h[:, 0] = found[k : k + (1 << 14)]
        for w in range(1, WORDS):
            x = h[:, w - 1] * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(31)
            h[:, w] = x * np.uint64(0x94D049BB133111EB)
        counts += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(found), bitorder="little").view(np.uint64)


def with_marks(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep``, fp (the node: equal sets have one), n (shingles),
    bands and the words of the wide fingerprint."""

    def run(batches):
        for batch in sliced(batches):
            sets = [shingles(t) for t in texts_of(batch)]
            wide = np.array([wide_fingerprint(s) for s in sets], np.uint64).reshape(-1, WORDS).view(np.int64)
            columns = [pa.array(np.array([node_of(s) for s in sets], np.uint64).view(np.int64)), pa.array([len(s) for s in sets], pa.int64()), pa.array([bands_of(s).view(np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns, *[pa.array(wide[:, w].copy()) for w in range(WORDS)]], names=[f.name for f in schema])

    schema = docs.select(*keep).schema.add("fp", T.LongType()).add("n", T.LongType()).add("bands", T.ArrayType(T.LongType()))
    for w in range(WORDS):
        schema = schema.add(f"s{w}", T.LongType())
    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(lambda batches: trimmed(run(batches)), schema)


def _with_sets(docs: DataFrame) -> DataFrame:
    """fp and shingles of ``docs`` (text)."""

    def run(batches):
        for batch in sliced(batches, 128):
            sets = [shingles(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([node_of(s) for s in sets], np.uint64).view(np.int64)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["fp", "shingles"])

    return docs.select("text").mapInArrow(lambda batches: trimmed(run(batches)), "fp long, shingles array<bigint>")


def _runs(batches, keys: int, solve, rows: int):
    """Streams sorted rows through ``solve(columns, bounds)``, some runs of equal
    keys (the first columns) at a time."""
    held: pa.Table | None = None

    def done(table: pa.Table, final: bool):
        marks = np.zeros(max(0, table.num_rows - 1), bool)
        for c in range(keys):
            v = table.column(c).to_numpy()
            marks |= v[1:] != v[:-1]
        cut = np.flatnonzero(marks) + 1
        end = table.num_rows if final else (int(cut[-1]) if len(cut) else 0)
        return (solve(table.slice(0, end), np.concatenate(([0], cut[cut < end], [end]))) if end else None), table.slice(end)

    for batch in batches:
        one = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, one]).combine_chunks() if held is not None and held.num_rows else one
        if held.num_rows >= rows:
            out, held = done(held, False)
            if out is not None:
                yield out
    if held is not None and held.num_rows:
        yield done(held, True)[0]


def _links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], names=["a", "b"])


def proposals(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (a, b) that span each bucket's classes of fingerprints within the
    radius. ``nodes`` has fp, bands and the fingerprint's words."""
    words = [f"s{w}" for w in range(WORDS)]
    rows = nodes.select(F.posexplode("bands").alias("band", "key"), "fp", *words)
    buckets = rows.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("fp").alias("least")).where("size > 1")
    members = written(rows.join(buckets, ["band", "key"]), "buckets")

    def solve(table, bounds):
        fps = np.column_stack([table.column(w).to_numpy().view(np.uint64) for w in words])
        label, fp = linked(fps, bounds, RADIUS), table.column("fp").to_numpy()
        moved = np.flatnonzero(label != np.arange(len(label)))
        return _links(fp[label[moved]], fp[moved])

    searched = members.where(F.col("size") <= hot).repartition("band", "key").sortWithinPartitions("band", "key", "fp").select("band", "key", "fp", *words)
    found = searched.mapInArrow(lambda batches: trimmed(_runs(batches, 2, solve, 50_000)), "a long, b long")
    return found.union(members.where((F.col("size") > hot) & (F.col("fp") != F.col("least"))).select("least", "fp")).distinct()


def similar(sets: list[np.ndarray], sides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose sets are similar enough; with ``sides``, only
    pairs across the two sides."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.empty(0, bool)
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1 if len(flat) else new
    column, owner = np.unique(group[shared], return_inverse=True)[1], owner[shared]
    left = np.arange(len(sets)) if sides is None else np.flatnonzero(sides == 0)
    right = left if sides is None else np.flatnonzero(sides == 1)
    both = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        both += part[left] @ part[right].T
    either = sizes[left][:, None] + sizes[right][None] - both
    x, y = np.nonzero(100 * both >= PERCENT * either)
    x, y = left[x], right[y]
    keep = x < y if sides is None else np.ones(len(x), bool)
    return x[keep], y[keep]


def _verified(blocks: DataFrame) -> DataFrame:
    """Spanning links of each run of (root, i, j): rows have side, fp and
    shingles; i = j where a block is compared with itself."""

    def solve(table, bounds):
        fp, side = table.column("fp").to_numpy(), table.column("side").to_numpy()
        lists, out = table.column("shingles").combine_chunks(), ([], [])
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo > 1:
                sets = [flat[at[k] : at[k + 1]] for k in range(lo, hi)]
                label = np.arange(hi - lo)
                _union(label, *similar(sets, side[lo:hi] if side[lo:hi].any() else None))
                moved = np.flatnonzero(label != np.arange(hi - lo))
                out[0].append(fp[lo + label[moved]])
                out[1].append(fp[lo + moved])
        return _links(*[np.concatenate([np.empty(0, np.int64), *o]) for o in out])

    keyed = blocks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "side", "fp").select("root", "i", "j", "side", "fp", "shingles")
    return keyed.mapInArrow(lambda batches: trimmed(_runs(sliced(batches, 256), 3, solve, BLOCK_NODES)), "a long, b long")


def similar_links(marked: DataFrame, docs: DataFrame, doc_id: str, text: str, hot: int = HOT, block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Verified links (a, b) that span the components. ``marked`` has with_marks
    of all ``docs``, with their doc_id and mark."""
    c = F.col
    first = [F.first(x).alias(x) for x in ("n", "bands", *[f"s{w}" for w in range(WORDS)])]
    nodes = marked.groupBy("fp").agg(F.min(F.struct("doc_id", "mark")).alias("rep"), *first)
    groups = connected_components(proposals(nodes, hot)).toDF("fp", "root")
    every = groups.union(groups.select(c("root").alias("fp"), "root").distinct()).join(nodes.select("fp", "n", "rep"), "fp")
    every = written(every, "groups")
    sizes = every.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_shingles), F.lit(1)).cast("int").alias("blocks"))
    dealt = every.join(sizes, "root").select("root", F.pmod(F.xxhash64("fp"), c("blocks")).cast("int").alias("block"), "blocks", "fp")
    # the sets of all members, from one document of each
    wanted = every.select("rep.*").distinct().toDF("__id", "__mark")
    some = docs.select(c(doc_id).cast("long").alias("id"), text_mark(text).alias("mark"), c(text).cast("string").alias("text"))
    some = some.join(wanted, some["id"].eqNullSafe(wanted["__id"]) & (some["mark"] == wanted["__mark"]), "left_semi")
    sets = written(_with_sets(some).dropDuplicates(["fp"]).join(dealt, "fp"), "sets")
    own = written(_verified(sets.select("root", c("block").alias("i"), c("block").alias("j"), F.lit(0).alias("side"), "fp", "shingles")), "links")
    parts = sets.where("blocks > 1").select("root", "block", "fp")
    if parts.isEmpty():
        return own
    joined = parts.join(connected_components(own).toDF("fp", "low"), "fp", "left").groupBy("root", "block").agg(F.min(F.coalesce("low", "fp")).alias("lo"), F.max(F.coalesce("low", "fp")).alias("hi"))
    joined = written(joined, "blocks")
    pairs = joined.toDF("root", "i", "lo", "hi").join(joined.toDF("root", "j", "lo2", "hi2"), "root").where("i < j and not (lo = hi and lo2 = hi2 and lo = lo2)").select("root", "i", "j")
    pairs = written(pairs, "pairs")
    side = lambda k, at: sets.withColumnRenamed("block", at).join(pairs, ["root", at]).select("root", "i", "j", F.lit(k).alias("side"), "fp", "shingles")
    return own.union(_verified(side(0, "i").union(side(1, "j"))))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of similar documents stays: that with the
    smallest doc_id."""
    plain = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"), text_mark(text).alias("mark"))
    marked = written(with_marks(plain, "text", ["doc_id", "mark"]), "marked")
    labels = label_nodes(marked, similar_links(marked, docs, doc_id, text))
    return keep_first(docs, marked, labels, doc_id, text)
