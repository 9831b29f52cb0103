"""Benchmark decontamination by Wu-Manber multi-pattern search.

The symbols are words, the patterns are the benchmark's word windows. For each
pattern length a shift table over blocks of two words tells how far the search
may jump; where the shift is zero, the hash of a longer suffix selects the few
patterns to test, and comparing all words confirms an occurrence.

Documents are scanned where they are read: there is no shuffle. Only the
benchmark is sent to the executors, in blocks of at most ``block_words`` words
(a fixed bound), with one pass over the documents for each block.

Defined results: null or empty text has no words and is never contaminated;
a null or empty benchmark item has no window; an empty benchmark leaves every
document clean; items with the same id count once; repeated documents are
scanned each for itself; very long texts are scanned whole, a few documents at
a time; columns named like the results are replaced, others are passed on.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, sliced, texts_of, trimmed

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
BLOCK_WORDS = 2_000_000
SUFFIX = 4


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8; bytes over 0x7F are word bytes."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class WuManber:
    """Patterns of one length: shift table over word blocks, suffix buckets."""

    def __init__(self, patterns: dict[tuple, list[int]], length: int):
        self.length = length
        self.block = min(2, length)
        self.suffix = min(SUFFIX, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple[tuple, list[int]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets[pattern[length - self.suffix :]].append((pattern, items))

    def search(self, words: list[bytes]):
        """Yields (start, items) of each occurrence."""
        shift, far, block, suffix, length, buckets = self.shift.get, self.far, self.block, self.suffix, self.length, self.buckets
        end, n = length, len(words)
        while end <= n:
            jump = shift(tuple(words[end - block : end]), far)
            if jump:
                end += jump
                continue
            for pattern, items in buckets.get(tuple(words[end - suffix : end]), ()):
                if tuple(words[end - length : end]) == pattern:
                    yield end - length, items
            end += 1


def searchers(items: list[tuple[str, list[bytes]]], window: int) -> tuple[list[WuManber], list[str]]:
    by_length: dict[int, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
    names = sorted({name for name, _ in items})
    place = {name: k for k, name in enumerate(names)}
    for name, words in items:
        size = min(window, len(words))
        for start in range(len(words) - size + 1 if size else 0):
            found = by_length[size][tuple(words[start : start + size])]
            if place[name] not in found:
                found.append(place[name])
    return [WuManber(p, n) for n, p in sorted(by_length.items())], names


#: The search tables that this worker has built last, by their block's name.
_BUILT: dict[str, tuple[list[WuManber], list[str]]] = {}


def _scan(items: list[tuple[str, list[bytes]]], window: int, text_at: int, out_schema: pa.Schema):
    block = uuid.uuid4().hex

    def run(batches):
        if block not in _BUILT:
            _BUILT.clear()
            _BUILT[block] = searchers(items, window)
        found, names = _BUILT[block]
        for batch in sliced(batches, 256):
            n_words, starts, ends, hit_items = [], [], [], []
            for text in texts_of(batch, text_at):
                words, spans, hit = words_of(text), [], set()
                for searcher in found:
                    for start, which in searcher.search(words):
                        spans.append((start, start + searcher.length))
                        hit.update(which)
                merged: list[list[int]] = []
                for a, b in sorted(spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                n_words.append(len(words))
                starts.append([a for a, _ in merged])
                ends.append([b for _, b in merged])
                hit_items.append([names[k] for k in sorted(hit)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(hit_items, pa.list_(pa.string()))],
                schema=out_schema,
            )

    return run


def _fold():
    """Joins the passes' spans; a single pass's spans are already apart."""

    def covered(starts: list[int], ends: list[int]) -> int:
        total, last = 0, 0
        for a, b in sorted(zip(starts, ends, strict=True)):
            total += max(0, b - max(a, last))
            last = max(last, b)
        return total

    def run(batches):
        for batch in batches:
            n_hit, n_items, digest = [], [], []
            for starts, ends, items in zip(*(batch.column(batch.num_columns - k).to_pylist() for k in (3, 2, 1)), strict=True):
                names = sorted(set(items))
                n_hit.append(covered(starts, ends))
                n_items.append(len(names))
                digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-4], batch.column(batch.num_columns - 4), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digest, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_()), *batch.columns[-3:]],
                names=[*batch.schema.names[:-4], "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_starts", "hit_ends", "hit_items"],
            )

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all where None) with n_words, n_hit,
    n_items, items_sha256, contaminated, and the hit spans in words and items'
    ids. Columns of the same names in ``docs`` are replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema

    added = "n_words n_hit n_items items_sha256 contaminated hit_starts hit_ends hit_items".split()
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).where("id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))  # a word and its gap take two bytes at least
    part: Column = F.pmod(F.xxhash64("id"), F.lit(blocks))
    work, text_at = beside(docs, text, keep)
    out = docs.select(*keep).schema
    for c, kind in zip(added, ("long", "long", "long", "string", "boolean", "array<bigint>", "array<bigint>", "array<string>"), strict=True):
        out = out.add(c, kind if "<" not in kind else _array(kind))
    for block in range(blocks):
        rows = items.where(part == block).toLocalIterator()
        own = [(r["id"], words_of(r["text"])) for r in rows]
        schema = work.limit(0)
        for c, kind in (("__n", "bigint"), ("__a", "array<bigint>"), ("__b", "array<bigint>"), ("__i", "array<string>")):
            schema = schema.withColumn(f"{c}{block}", F.lit(None).cast(kind))
        scan = _scan(own, window, text_at, to_arrow_schema(schema.schema))
        if blocks == 1:  # the usual case: one pass
            fold = _fold()
            width = len(keep)
            return work.mapInArrow(lambda batches: trimmed(fold(_kept(scan(batches), width))), out)
        work = work.mapInArrow(scan, schema.schema)
    joined = lambda c: F.flatten(F.array(*[F.col(f"{c}{k}") for k in range(blocks)])).alias(c)
    work = work.select(*keep, F.col("__n0").alias("__n"), joined("__a"), joined("__b"), joined("__i"))
    return work.mapInArrow(_fold(), out)


def _kept(batches, width: int):
    """The first ``width`` columns and the four that a pass adds."""
    for batch in batches:
        columns = [*range(width), *range(batch.num_columns - 4, batch.num_columns)]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in columns], names=[batch.schema.names[k] for k in columns])


def _array(kind: str):
    from pyspark.sql import types as T

    return T.ArrayType(T.LongType() if "bigint" in kind else T.StringType())
