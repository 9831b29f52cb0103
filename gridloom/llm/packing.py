"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are tokenized where they are read and cut only where longer than a
sequence. Pieces are dealt to shards of bounded size; every shard is packed on
several islands, each with a population of packings. The first individual of
an island is best-fit decreasing, others are perturbed. A crossover injects
whole well-filled bins of one parent into another, removes the bins that hold
the same pieces, and best-fits the displaced ones. Between epochs the elites
migrate along the ring of islands, and the best packing of all is used.

Defined results: null and empty texts are their end token alone; repeated rows
are pieces of their own; an empty table gives an empty result; extra columns
are ignored; very long texts are tokenized whole and cut afterwards; pieces of
one length are interchangeable, ties follow ids. A shard whose packing meets
the lower bound stops early.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of, trimmed, written

CAPACITY = 2048
END_ID = 0
SHARD_ITEMS = 8192
ISLANDS, POPULATION, EPOCHS, GENERATIONS = 4, 6, 2, 12
WELL_FILLED = 0.98
#: Pretokenization pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, digits and spaces that Unicode has named alike for ten years; a
#: text with any other character goes to the tokenizer itself.
UNSETTLED = re.compile("[^\\u0000-\\u052F\\u2000-\\u206F\\u20A0-\\u20BD\\u3000-\\u30FF\\u4E00-\\u9FCC\\uAC00-\\uD7A3\\uFF00-\\uFFEF]")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE spells bytes as letters: printable Latin-1 bytes as
    themselves, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def merge_ranks(tokenizer: dict) -> dict[bytes, int] | None:
    """Ids of the vocabulary's byte strings, if ids also rank the merges: bytes
    come first, then one id for each merge in order. None for other files."""
    model, steps = tokenizer["model"], tokenizer.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or steps.get("type") != "ByteLevel" or steps.get("add_prefix_space") or not steps.get("use_regex", True) or tokenizer.get("normalizer"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    spelled = {letter: byte for byte, letter in _byte_letters().items()}
    added = {t["content"] for t in tokenizer.get("added_tokens", ())}
    return {bytes(spelled[x] for x in token): k for token, k in model["vocab"].items() if token not in added}


class Tokens:
    """Ids of texts, little-endian 32-bit, as ``tokenizers`` gives them for the
    file with add_special_tokens=False.

    A byte-level vocabulary is run by the faster rank-based library on ranks
    made from the same file. Texts that contain an added token (which that
    library does not know) or a character whose Unicode class is not settled,
    and files of other kinds, go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        ranks = merge_ranks(json.loads(self.whole.to_str()))
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.fast or UNSETTLED.search(text) or any(t in text for t in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=1)
def tokens(path: str) -> Tokens:
    """One per worker."""
    return Tokens(path)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *[(k, capacity) for k in range(first, total, capacity)]]


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, a random salt, and ids where
    asked for, little-endian."""

    def run(batches):
        encode, end = tokens(tokenizer).encode, END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch, 1), strict=True):
                ids = encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((key, k, start, length, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    out = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(lambda batches: trimmed(run(batches)), schema).withColumn("salt", (F.rand(7) * (1 << 30)).cast("int"))
    return out if with_ids else out.drop("ids")


class Bins:
    """Open bins by the room that is left; best fit is one bit scan."""

    def __init__(self, capacity: int):
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask, self.count, self.capacity = 0, 0, capacity

    def open(self, room: int, name: int) -> None:
        self.rooms[room].append(name)
        self.mask |= 1 << room

    def put(self, length: int) -> int:
        fits = self.mask >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            name = self.rooms[room].pop()
            if not self.rooms[room]:
                self.mask &= ~(1 << room)
        else:
            room, name = self.capacity, self.count
            self.count += 1
        if room > length:
            self.open(room - length, name)
        return name


def best_fit(lengths: list[int], order, capacity: int) -> np.ndarray:
    bins, out = Bins(capacity), np.empty(len(lengths), np.int32)
    for k in order:
        out[k] = bins.put(lengths[k])
    return out


def fitness(lengths: np.ndarray, where: np.ndarray, capacity: int) -> tuple[int, float]:
    fill = np.bincount(where, weights=lengths)
    fill = fill[fill > 0]
    return -len(fill), float(np.square(fill / capacity).mean()) if len(fill) else 0.0


def crossover(lengths: np.ndarray, a: np.ndarray, b: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Whole well-filled bins of b go into a; displaced pieces are best-fitted,
    together with those of a's emptiest bins."""
    fill_b = np.bincount(b, weights=lengths)
    good = np.flatnonzero(fill_b >= WELL_FILLED * capacity)
    if not len(good):
        good = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.75))
    start = rng.integers(0, len(good))
    chosen = good[start : start + max(1, len(good) // 4)]
    injected = np.isin(b, chosen)
    fill_a = np.bincount(a, weights=lengths)
    poor = np.argsort(fill_a, kind="stable")[: max(2, len(fill_a) // 50)]
    gone = np.union1d(np.unique(a[injected]), poor)
    displaced = np.isin(a, gone) & ~injected
    stay = ~injected & ~displaced
    out = np.full(len(a), -1, np.int32)
    kept, at = np.unique(a[stay], return_inverse=True)
    out[stay] = at
    _, at = np.unique(b[injected], return_inverse=True)
    out[injected] = at + len(kept)
    fill = np.bincount(out[out >= 0], weights=lengths[out >= 0]).astype(int)
    bins = Bins(capacity)
    bins.count = len(fill)
    for name in np.flatnonzero(fill < capacity).tolist():
        bins.open(capacity - int(fill[name]), name)
    for k in np.flatnonzero(displaced).tolist():  # pieces are sorted by falling length
        out[k] = bins.put(int(lengths[k]))
    return out


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, seed: list[int], generations: int = GENERATIONS, size: int = POPULATION) -> list[np.ndarray]:
    """One epoch on one island; the best packing comes first."""
    rng, n = np.random.default_rng(seed), len(lengths)
    bound = -(-int(lengths.sum()) // capacity)
    score = lambda x: fitness(lengths, x, capacity)
    plain = lengths.tolist()
    if not population:
        population = [best_fit(plain, range(n), capacity)]
    if -score(population[0])[0] == bound:
        return population[:1]
    while len(population) < size:
        noisy = np.argsort(-(lengths * rng.uniform(0.8, 1.2, n)), kind="stable")
        population.append(best_fit(plain, noisy.tolist(), capacity))
    for _ in range(generations):
        a, b = rng.choice(len(population), 2, replace=False)
        population.append(crossover(lengths, population[a], population[b], capacity, rng))
        population = sorted(population, key=score, reverse=True)[:size]
        if -score(population[0])[0] == bound:
            break
    return population


def _ordered(table: pa.Table) -> pa.Table:
    """Pieces by falling length; rows equal in all keys are interchangeable."""
    return table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("salt", "ascending"), ("ids_crc32", "ascending")])


def pack(items: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces."""
    shards = max(1, -(-items.count() // shard_items))
    items = items.withColumn("shard", F.pmod(F.col("salt"), F.lit(shards)))
    state_schema = "shard int, island int, lengths binary, packing binary"

    def state(shard: int, island: int, lengths: np.ndarray, population: list[np.ndarray]) -> dict:
        return {"shard": shard, "island": island, "lengths": lengths.astype("<i4").tobytes(), "packing": b"".join(p.astype("<i4").tobytes() for p in population)}

    kinds = pa.schema([("shard", pa.int32()), ("island", pa.int32()), ("lengths", pa.binary()), ("packing", pa.binary())])

    def settle(key, table):
        lengths = _ordered(table).column("length").to_numpy()
        return pa.Table.from_pylist([state(key[0].as_py(), k, lengths, []) for k in range(islands)], schema=kinds)

    def epoch(number):
        def run(key, table):
            shard, island = key[0].as_py(), key[1].as_py()
            lengths, blobs = np.frombuffer(table.column("lengths")[0].as_py(), "<i4").astype(np.int64), sorted(table.column("packing").to_pylist(), key=lambda b: (-len(b), b))
            population = [np.frombuffer(b, "<i4").copy() for blob in blobs for b in (blob[k : k + 4 * len(lengths)] for k in range(0, len(blob), 4 * len(lengths)))] if len(lengths) else []
            population = sorted(population, key=lambda x: fitness(lengths, x, capacity), reverse=True)
            population = evolve(lengths, population, capacity, [shard, island, number])
            rows = [state(shard, island, lengths, population)]
            if number + 1 < epochs and islands > 1:
                rows.append(state(shard, (island + 1) % islands, lengths, population[:1]))
            return pa.Table.from_pylist(rows, schema=kinds)

        return run

    def place(key, table, states):
        table = _ordered(table)
        lengths = table.column("length").to_numpy()
        best = max((np.frombuffer(b[: 4 * len(lengths)], "<i4") for b in states.sort_by("island").column("packing").to_pylist()), key=lambda x: fitness(lengths, x, capacity))
        order = np.argsort(best, kind="stable")
        ends = np.cumsum(lengths[order])
        begin = ends - lengths[order]
        first = np.concatenate(([True], np.diff(best[order]) != 0))
        offset = np.empty(len(order), np.int64)
        offset[order] = begin - np.maximum.accumulate(np.where(first, begin, 0))
        _, number = np.unique(best, return_inverse=True)
        sequence = (np.int64(key[0].as_py()) << 32) + number
        return table.drop_columns(["salt", "shard"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    states = items.select("shard", "doc_id", "piece", "salt", "ids_crc32", "length").groupBy("shard").applyInArrow(settle, state_schema)
    for number in range(epochs):
        states = states.groupBy("shard", "island").applyInArrow(epoch(number), state_schema)
    schema = items.drop("salt", "shard").schema.add("sequence_id", "long").add("offset", "long")
    return items.groupBy("shard").cogroup(states.groupBy("shard")).applyInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    return pack(written(pieces(docs, tokenizer, doc_id, text, capacity, with_ids), "pieces"), capacity)
