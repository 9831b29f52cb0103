"""Substring deduplication with difference-cover anchors.

A window of ``window`` words is removed where the same words also start in a
document with a smaller id. Comparing every window of the corpus would shuffle
one hash per word. Instead, only positions whose residue modulo ``period`` is
in a difference cover carry an anchor, a hash of ``window - period + 1`` words:
for two equal windows at any two positions there is an offset below the period
at which both have an anchor, and these anchors are equal. So:

1. every chunk of documents asks which of its anchors occur in a second
   document; the answer is one bit for each distinct anchor;
2. the windows around such anchors are extended to their full length, and each
   chunk asks, with a 96-bit hash of all their words, whether a smaller
   document holds them; again the answer is one bit for each distinct window;
3. words under a window with a smaller holder are removed.

A false anchor match only costs an extension. Within a chunk the smallest
holder is known, so each distinct key is sent once per chunk.

Defined results: null and empty texts have no words; texts shorter than a
window lose none; a null doc_id counts as larger than any other and rows with
equal doc_ids never remove words of each other; windows repeated inside one
document stay; extra columns are ignored; very long texts are one document of
their chunk, all of their windows compared; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import answered, asked, chunk_count, dealt

WINDOW = 50
U = np.uint64
BYTE_BASES = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))
WORD_BASES = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))
LAST = np.iinfo(np.int64).max


@cache
def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set whose differences cover all residues modulo ``period``."""
    size = 1
    while size * (size - 1) + 1 < period:
        size += 1
    while True:
        for rest in combinations(range(2, period), size - 2) if size > 2 else [()]:
            cover = (0, 1, *rest)[:size] if period > 1 else (0,)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
        size += 1


def period_for(window: int) -> int:
    """Of the periods with a perfect cover, the largest that leaves anchors of
    a third of the window at least."""
    return max(p for p in (1, 3, 7, 13, 21, 31) if p == 1 or 3 * (window - p + 1) >= window)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, in place."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class _Powers:
    """Powers of odd bases modulo 2**64, grown as needed."""

    def __init__(self):
        self.held: dict[int, np.ndarray] = {}

    def of(self, base, n: int) -> np.ndarray:
        base = int(base)
        if len(self.held.get(base, ())) < n:
            size = max(n, 1 << 16)
            out = np.full(size, base, np.uint64)
            out[0] = 1
            self.held[base] = np.multiply.accumulate(out)
        return self.held[base][:n]


POWERS = _Powers()


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Polynomial hashes of values[starts:ends] from one running sum."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * POWERS.of(base, len(values)), out=total[1:])
    out = total[ends] - total[starts]
    out *= POWERS.of(_inverse(int(base)), len(values) + 1)[starts]
    return _mixed(out)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each word. The words are hashed whole by XXH3, not
    by a polynomial, which structured words could make collide."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2)


class Chunk:
    """Word hashes of a chunk's documents, ordered by (doc_id, text)."""

    def __init__(self, table: pa.Table):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k] is None, texts[k] or ""))
        self.ids = [ids[k] for k in order]
        self.rank = np.array([LAST if x is None else x for x in self.ids], np.int64)
        self.texts = [(texts[k] or "").encode("utf-8", "surrogatepass") for k in order]
        self.counts = np.zeros(len(order), np.int64)
        parts = [np.empty((0, 2), np.uint64)]
        for k, text in enumerate(self.texts):
            parts.append(word_hashes(text.split()))
            self.counts[k] = len(parts[-1])
        self.hashes = list(np.concatenate(parts).T.copy())
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.doc = np.repeat(np.arange(len(order)), self.counts)
        self.n = int(self.first[-1])

    def whole(self, at: np.ndarray, width: int) -> np.ndarray:
        """Those word positions whose window stays in its document."""
        return at[at + width <= self.first[1:][self.doc[at]]]

    def window_hash(self, at: np.ndarray, width: int, which: int) -> np.ndarray:
        return sums(self.hashes[which], at, at + width, WORD_BASES[which]) if len(at) else np.empty(0, np.uint64)

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors."""
        period = period_for(window)
        chosen = np.zeros(period, bool)
        chosen[list(difference_cover(period))] = True
        place = np.arange(self.n) - self.first[self.doc]
        at = self.whole(np.flatnonzero(chosen[place % period]), window - period + 1)
        return at, self.window_hash(at, window - period + 1, 0)

    def candidates(self, window: int, at: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of windows that hold a shared anchor."""
        marks = np.zeros(self.n + 1, np.int64)
        np.add.at(marks, at[shared] + 1, 1)
        total = np.cumsum(marks)
        starts = self.whole(np.arange(self.n), window)
        return starts[total[starts + period_for(window)] > total[starts]]


def _bits(table: pa.Table, stage: int) -> dict[int, bytes]:
    """The answers' blobs of one stage by bucket."""
    return {b: x for s, b, x in zip(table.column("stage").to_pylist(), table.column("bucket").to_pylist(), table.column("blob").to_pylist(), strict=True) if s == stage}


def _unpacked(blobs: dict[int, bytes], buckets: np.ndarray) -> np.ndarray:
    """One flag for each entry; ``buckets`` is sorted."""
    out = np.zeros(len(buckets), bool)
    for b, lo, hi in _runs(buckets):
        out[lo:hi] = np.unpackbits(np.frombuffer(blobs[b], np.uint8), count=hi - lo, bitorder="little")
    return out


def _runs(keys: np.ndarray):
    cut = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else [0]
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        yield int(keys[lo]), int(lo), int(hi)


def _bucket(high: np.ndarray, buckets: int) -> np.ndarray:
    return ((high >> U(40)) * U(buckets)) >> U(24)


class _Anchors:
    """Stage 1: distinct anchors of a chunk, sorted; 32 bits go out within the
    bucket (a false match only costs an extension)."""

    def __init__(self, chunk: Chunk, window: int, buckets: int):
        self.at, h = chunk.anchors(window)
        self.keys, self.back = np.unique(h, return_inverse=True)
        doc = chunk.rank[chunk.doc[self.at]]
        low, high = np.full(len(self.keys), LAST), np.full(len(self.keys), -LAST - 1)
        np.minimum.at(low, self.back, doc)
        np.maximum.at(high, self.back, doc)
        self.several = low != high
        self.bucket = _bucket(self.keys, buckets)

    def blobs(self):
        for b, lo, hi in _runs(self.bucket):
            yield b, (self.keys[lo:hi] & U(0xFFFFFFFF)).astype("<u4").tobytes() + np.packbits(self.several[lo:hi]).tobytes() + (hi - lo).to_bytes(4, "little")


def answer_anchors(key, table):
    """One bit for each anchor: does a second document hold it?"""
    chunks, blobs = table.column("chunk").to_pylist(), table.column("blob").to_pylist()
    sizes = [int.from_bytes(x[-4:], "little") for x in blobs]
    keys = np.concatenate([np.frombuffer(x, "<u4", n) for x, n in zip(blobs, sizes, strict=True)])
    several = np.concatenate([np.unpackbits(np.frombuffer(x[4 * n : -4], np.uint8), count=n) for x, n in zip(blobs, sizes, strict=True)])
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    first = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
    group = np.cumsum(first) - 1
    size = np.bincount(group)
    any_ = np.bincount(group, weights=several[order]) > 0
    shared = np.zeros(len(keys), bool)
    shared[order] = ((size > 1) | any_)[group]
    return _answers(key, chunks, sizes, shared)


class _Windows:
    """Stage 2: distinct candidate windows of a chunk by 96-bit hash, sorted,
    each with its smallest document here."""

    def __init__(self, chunk: Chunk, window: int, buckets: int, anchors: _Anchors, shared: np.ndarray):
        self.starts = chunk.candidates(window, anchors.at, shared[anchors.back])
        h = np.empty(len(self.starts), [("a", np.uint64), ("b", np.uint32)])
        h["a"] = chunk.window_hash(self.starts, window, 0)
        h["b"] = (chunk.window_hash(self.starts, window, 1) >> U(32)).astype(np.uint32)
        order = np.lexsort((h["b"], h["a"]))
        sorted_ = h[order]
        first = np.concatenate(([True], sorted_[1:] != sorted_[:-1])) if len(h) else np.empty(0, bool)
        self.keys = sorted_[first]
        self.back = np.empty(len(h), np.int64)
        self.back[order] = np.cumsum(first) - 1
        self.doc = chunk.rank[chunk.doc[self.starts]]
        self.least = np.full(len(self.keys), LAST)
        np.minimum.at(self.least, self.back, self.doc)
        self.bucket = _bucket(self.keys["a"], buckets)

    def blobs(self):
        for b, lo, hi in _runs(self.bucket):
            yield b, self.keys["a"][lo:hi].astype("<u8").tobytes() + self.keys["b"][lo:hi].astype("<u4").tobytes() + self.least[lo:hi].astype("<i8").tobytes() + (hi - lo).to_bytes(4, "little")


def answer_windows(key, table):
    """One bit for each window: does a smaller document than the asking chunk's
    smallest hold it?"""
    chunks, blobs = table.column("chunk").to_pylist(), table.column("blob").to_pylist()
    sizes = [int.from_bytes(x[-4:], "little") for x in blobs]
    part = lambda kind, skip, width: np.concatenate([np.frombuffer(x, kind, n, offset=skip * n) for x, n in zip(blobs, sizes, strict=True)])
    a, b, least = part("<u8", 0, 8), part("<u4", 8, 4), part("<i8", 12, 8)
    order = np.lexsort((least, b, a))
    x, y = a[order], b[order]
    first = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    group = np.cumsum(first) - 1
    smallest = least[order][first]
    held = np.zeros(len(a), bool)
    held[order] = smallest[group] < least[order]
    return _answers(key, chunks, sizes, held)


def _answers(key, chunks, sizes, flags: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    out = [np.packbits(flags[e - n : e], bitorder="little").tobytes() for n, e in zip(sizes, ends, strict=True)]
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(chunks), pa.int32()), "blob": pa.array(out, pa.binary())})


def _questions(chunk: int, blobs) -> pa.Table:
    rows = list(blobs)
    return pa.table({"chunk": pa.array([chunk] * len(rows), pa.int32()), "bucket": pa.array([b for b, _ in rows], pa.int32()), "blob": pa.array([x for _, x in rows], pa.binary())})


def removed_spans(docs: DataFrame, doc_id: str, text: str, window: int, finish, schema: str) -> DataFrame:
    """Runs both stages; ``finish(chunk, removed)`` makes each chunk's table
    from the flags of its words."""
    chunks = chunk_count(docs, text)
    buckets = max(8, chunks // 8)
    rows = dealt(docs, chunks, doc_id, text)

    def ask_anchors(key, table):
        return _questions(key[0].as_py(), _Anchors(Chunk(table), window, buckets).blobs())

    def ask_windows(key, table, answers):
        chunk = Chunk(table)
        anchors = _Anchors(chunk, window, buckets)
        shared = _unpacked(_bits(answers, 1), anchors.bucket)
        return _questions(key[0].as_py(), _Windows(chunk, window, buckets, anchors, shared).blobs())

    def last(key, table, answers):
        chunk = Chunk(table)
        anchors = _Anchors(chunk, window, buckets)
        windows = _Windows(chunk, window, buckets, anchors, _unpacked(_bits(answers, 1), anchors.bucket))
        held = _unpacked(_bits(answers, 2), windows.bucket)[windows.back] | (windows.doc > windows.least[windows.back])
        cover = np.zeros(chunk.n + window + 1, np.int64)
        np.add.at(cover, windows.starts[held], 1)
        np.add.at(cover, windows.starts[held] + window, -1)
        return finish(chunk, np.cumsum(cover)[: chunk.n] > 0)

    staged = lambda df, k: df.select("chunk", F.lit(k).alias("stage"), "bucket", "blob")
    text_of = rows.groupBy("chunk")
    first = staged(answered(asked(rows, ask_anchors), answer_anchors), 1)
    questions = text_of.cogroup(first.groupBy("chunk")).applyInArrow(ask_windows, "chunk int, bucket int, blob binary")
    both = first.union(staged(answered(questions, answer_windows), 2))
    return text_of.cogroup(both.groupBy("chunk")).applyInArrow(last, schema)


def _words(text: bytes, gone: np.ndarray) -> list[bytes]:
    words = text.split()
    return [w for w, x in zip(words, gone.tolist(), strict=True) if not x] if gone.any() else words


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text (null where no word
    was removed and the text stays as it is) and the XXH64 of the text given."""

    def finish(chunk: Chunk, gone: np.ndarray) -> pa.Table:
        from xxhash import xxh64

        removed, digest, kept = [], [], []
        source = [np.uint64(xxh64(t, seed=42).intdigest()).astype(np.int64) for t in chunk.texts]
        for k, text in enumerate(chunk.texts):
            flags = gone[chunk.first[k] : chunk.first[k + 1]]
            left = b" ".join(_words(text, flags))
            removed.append(int(flags.sum()))
            digest.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode("utf-8", "surrogatepass") if removed[-1] else None)
        return pa.table({"doc_id": pa.array(chunk.ids, pa.int64()), "n_words": pa.array(chunk.counts), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string()), "kept_text": pa.array(kept, pa.string()), "source_hash": pa.array(source, pa.int64())})

    return removed_spans(docs, doc_id, text, window, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, source_hash long")


def rewrite_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated words. Texts that lose none stay as they
    are; others become their kept words, joined by one space, and n_chars (if
    there) follows; documents that lose all words go. Rows are matched to their
    spans by a row number of equal (doc_id, text), so repeats stay apart."""
    columns = docs.columns
    found = substring_dedup(docs, doc_id, text, window).where("n_removed > 0")
    # rows with one doc_id and one text have one result; the text itself is not compared
    key = lambda t: F.xxhash64(F.coalesce(t, F.lit("")))
    spans = found.select(F.col("doc_id").alias("__id"), F.col("source_hash").alias("__hash"), F.col("kept_text").alias("__kept")).dropDuplicates(["__id", "__hash"])
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("__id"), key(F.col(text)).alias("__hash"))
    joined = rows.join(spans, rows["__id"].eqNullSafe(spans["__id"]) & (rows["__hash"] == spans["__hash"]), "left").where("__kept is null or __kept <> ''")
    new = {c: F.col("row")[c] for c in columns}
    new[text] = F.coalesce("__kept", new[text])
    if n_chars in new:
        new[n_chars] = F.when(F.col("__kept").isNotNull(), F.char_length("__kept")).otherwise(new[n_chars]).cast(docs.schema[n_chars].dataType)
    return joined.select(*[v.alias(c) for c, v in new.items()])
