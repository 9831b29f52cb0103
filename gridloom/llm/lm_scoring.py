"""Language-model scores by logistic context mixing.

The text is coded bit by bit along a Huffman tree of its bytes. For each bit,
several predictors look up hashed contexts (one, two, three and five bytes, and
the word so far) in tables of counts; a gate, chosen by how sure the two longest contexts
are, selects the weights that mix them in the logistic domain; and each
document refines the weights online, block by block, as it is coded. A last gate mixes in, word by word,
the probability by exact word counts. The score
is the log-probability of the lower-cased words, joined by one space, with an
end symbol; ``bits_per_byte`` follows from it.

A predictor's input for a byte depends on the byte and its context alone, and
texts repeat these. So equal bytes with equal contexts, within POOL bytes, are
counted, looked up and weighed as one; only the mixing goes bit by bit.

The tables count all training documents. Counts are summed within each task,
and merged slice by slice in a tree; the merged tables have a size of ``bits``
that grows with the text up to a bound, and only they are sent to all tasks.
The weights are learned from all training documents too: a few of them, before
they are counted, give weights to start from, and a Newton step over every bit
of all, each predicted from the counts without itself, gives the final ones. The unigram base needs exact counts of all words:
chunks ask for their distinct words by hash bucket, in packed form.

Defined results: null and empty texts are the end token alone; a null doc_id
counts as empty text in the fold; repeated rows score alike; with no training
document all counts are zero and every bit costs one bit; an empty table gives
an empty one; very long texts are coded whole, piece after piece, with weights
and contexts carried over; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, text_bytes, texts_of, trimmed, written
from .exchange import answered, asked, chunk_count, dealt

FOLDS, HELD_OUT = 7, 2
END = 0xFF  # never a byte of UTF-8
PREDICTORS = 5
GATES = 16
SLICES = 16
BITS = (18, 22)
MIX_DOCS, MIX_BYTES = 2000, 3 << 18
BLOCK = 512
#: Bytes of a piece, and of the word so far that it may carry over. Blocks of
#: steps also end where a document's piece does.
PIECE, WORD = 1 << 18, 1 << 16
#: Bytes among which equal situations are found; documents and bytes that are
#: coded together.
POOL = 1 << 21
TOGETHER = (96, 1 << 19)
RATE = 0.03
WORD_WEIGHT, WORD_TRUST = 0.4, 20.0
PAD = 8
U32 = np.uint32
HASHES = (U32(0x9E3779B1), U32(0x85EBCA77), U32(0xC2B2AE3D), U32(0x27D4EB2F), U32(0x165667B1))
SHARP = 15.0  # steps of a stored logit


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def coded_bytes(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b" ".join(words) + bytes([END]), np.uint8)


class Code:
    """Huffman paths of the 256 bytes: inner nodes and the bit taken at each."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        children, node = {}, 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children[node] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], node, node))
            node += 1
        paths: dict[int, list[tuple[int, int]]] = {}
        todo = [(node - 1, [])]
        while todo:
            at, path = todo.pop()
            if at < 256:
                paths[at] = path
            else:
                for bit, child in enumerate(children[at]):
                    todo.append((child, [*path, (at - 256, bit)]))
        self.length = np.array([len(paths[s]) for s in range(256)])
        self.first = np.concatenate(([0], np.cumsum(self.length)))
        flat = [x for s in range(256) for x in paths[s]]
        self.nodes = np.array([x[0] for x in flat], np.uint32)
        self.bits = np.array([x[1] for x in flat], np.uint8)
        self.hashes = NODE_HASHES[self.nodes]


def nearby(data: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, in one number."""
    x = data.astype(np.uint32)
    for k in (1, 2):  # pairs, then pairs of pairs
        x[k:] |= x[:-k] << U32(8 * k)
    return x


def contexts(data: np.ndarray) -> list[np.ndarray]:
    """A 32-bit context for each byte from those before it, PREDICTORS of them.
    ``data`` begins with PAD zeros, and documents in it are PAD zeros apart."""
    x = data.astype(np.uint32)
    four = np.concatenate((np.zeros(1, np.uint32), nearby(data)[:-1]))
    o5 = four * U32(0x9E3779B1)
    o5[5:] ^= x[:-5] * U32(0x85EBCA6B)
    # hash of the word so far: a running sum over the bytes since the last gap
    gap = (data == 0x20) | (data == 0)
    place = np.arange(len(x), dtype=np.int32)
    start = np.zeros(len(x), np.int32)
    np.maximum.accumulate((place[:-1] + np.int32(1)) * gap[:-1], out=start[1:])
    age = (place - start).astype(np.uint32)
    term = (x + U32(1)) * (np.minimum(age, U32(1 << 16)) * U32(0xCC9E2D51) + U32(0x1B873593) ^ x << U32(7))
    total = np.concatenate((np.zeros(1, np.uint32), np.cumsum(term, dtype=np.uint32)))
    word = total[:-1] - total.take(start) + age * U32(0x2545F491)
    return [*_near_contexts(four), o5, word]


def _near_contexts(x: np.ndarray) -> list[np.ndarray]:
    """Those of the last one, two and three bytes in ``x``."""
    return [x & U32(0xFF), x & U32(0xFFFF), (x & U32(0xFFFFFF)) * U32(0x85EBCA6B)]


def mixed(x: np.ndarray, salt: np.uint32) -> np.ndarray:
    """32-bit finalizer."""
    x = x * salt
    x ^= x >> U32(15)
    x *= U32(0x2C1B3C6D)
    x ^= x >> U32(13)
    return x


NODE_HASHES = mixed(np.arange(1, 257, dtype=np.uint32), U32(0x5BD1E995))


def slots(context: np.ndarray, node: np.ndarray, which: int, bits: int) -> np.ndarray:
    """Table slots of hashed contexts and hashed nodes."""
    h = np.add(context, node, out=context)
    h ^= h >> U32(15)
    h *= HASHES[which]
    h >>= U32(32 - bits)
    return h.view(np.int32)


class Pieces:
    """Coded documents in pieces: up to ``count`` of them and about ``room``
    bytes, or PIECE. One of more than PIECE bytes is spread over pieces of its
    own, each after ``lead`` bytes of context: those since its word began (WORD
    at most), PAD at least."""

    def __init__(self, docs: list[np.ndarray], count: int = 1 << 30, room: int = 0):
        self.docs, self.count, self.room = docs, count, room

    def __iter__(self):
        held, size, room = [], 0, max(PIECE, self.room)
        for k, doc in enumerate(self.docs):
            if len(doc) > PIECE:
                for lo in range(0, len(doc), PIECE):
                    yield [(k, *self.piece(doc, lo))]
                continue
            if held and (len(held) == self.count or size + len(doc) > room):
                yield held
                held, size = [], 0
            held.append((k, np.concatenate((np.zeros(PAD, np.uint8), doc)), PAD))
            size += len(doc) + PAD
        if held:
            yield held

    @staticmethod
    def piece(doc: np.ndarray, lo: int) -> tuple[np.ndarray, int]:
        before = doc[max(0, lo - WORD) : lo]
        gaps = np.flatnonzero(before == 0x20)
        begin = min(len(before) - int(gaps[-1]) if len(gaps) else len(before), len(before))
        before = before[len(before) - max(begin, min(PAD, len(before))) :]
        pad = np.zeros(max(0, PAD - len(before)), np.uint8)
        return np.concatenate((pad, before, doc[lo : lo + PIECE])), len(pad) + len(before)


def pools(docs: list[np.ndarray], count: int = 1 << 30, room: int = 0):
    """The docs' pieces, some at a time: POOL bytes, or a piece over that."""
    held, size = [], 0
    for parts in Pieces(docs, count, room):
        more = sum(len(d) for _, d, _ in parts)
        if held and size + more > POOL:
            yield held
            held, size = [], 0
        held.append(parts)
        size += more
    if held:
        yield held


def _joined(parts: list[tuple[int, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The parts' bytes, and the places of those that are not lead."""
    data = np.concatenate([d for _, d, _ in parts])
    real = np.ones(len(data), bool)
    start = 0
    for _, d, lead in parts:
        real[start : start + lead] = False
        start += len(d)
    return data, np.flatnonzero(real)


def _keys(pieces: list[list[tuple[int, np.ndarray, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Of every byte that is not lead: itself with the three before it, and its
    last two contexts, the word's above. That is all that any predictor sees."""
    near, far = [], []
    for parts in pieces:
        data, byte = _joined(parts)
        near.append(nearby(data).take(byte))
        *_, five, word = contexts(data)
        both = word.take(byte).astype(np.uint64)
        both <<= np.uint64(32)
        both |= five.take(byte)
        far.append(both)
    return np.concatenate(near), np.concatenate(far)


def _hashed(near: np.ndarray, far: np.ndarray) -> np.ndarray:
    key = far * np.uint64(0x9E3779B97F4A7C15)
    key ^= near * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return key


class Steps:
    """The bit decisions of one piece."""

    def __init__(self, parts: list[tuple[int, np.ndarray, int]], code: Code):
        data, byte = _joined(parts)
        self._decide(data[byte], dict(enumerate(c.take(byte) for c in contexts(data))), code)

    def _decide(self, symbol: np.ndarray, context: dict[int, np.ndarray], code: Code) -> None:
        """The decisions at these bytes, for predictors with these contexts."""
        self.count = code.length[symbol]
        self.begin = np.cumsum(self.count) - self.count
        at = np.arange(int(self.count.sum())) + np.repeat(code.first[symbol] - self.begin, self.count)
        self.byte = np.repeat(np.arange(len(symbol)), self.count)  # of the type of an index, which spares casts
        self.node, self.bit = code.hashes[at], code.bits[at]
        self.context = {k: mixed(c, HASHES[-1 - k]) for k, c in context.items()}

    def slots(self, which: int, bits: int) -> np.ndarray:
        return slots(self.context[which].take(self.byte), self.node, which, bits)


class Distinct(Steps):
    """Those at the distinct ones of some bytes with one context, which occur
    ``times`` each. ``key`` holds the context above the byte."""

    def __init__(self, key: np.ndarray, predictors: range, code: Code):
        key.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        self.times = np.diff(first, append=len(key))
        key = key.take(first)
        context = (key >> key.dtype.type(8)).astype(np.uint32)
        found = _near_contexts(context) if predictors[0] == 0 else [context]
        self._decide(key.astype(np.uint8), dict(zip(predictors, found, strict=True)), code)


class Situations(Steps):
    """Those at the distinct situations in some pieces: a byte and the contexts
    of all predictors. ``times`` says how often each occurs, and ``which`` the
    situation of every byte, by number. Equal ones are brought together by hash
    and then compared as they are: different ones of one hash stay different."""

    def __init__(self, pieces: list[list[tuple[int, np.ndarray, int]]], code: Code, which: bool = False):
        near, far = _keys(pieces)
        key = _hashed(near, far)
        low = np.uint64(len(near).bit_length())
        key >>= low
        key <<= low
        key |= np.arange(len(near), dtype=np.uint64)
        key.sort()
        key &= (np.uint64(1) << low) - np.uint64(1)
        place = key.view(np.int64)
        near, far = near.take(place), far.take(place)
        new = np.ones(len(near), bool)
        np.not_equal(near[1:], near[:-1], out=new[1:])
        new[1:] |= far[1:] != far[:-1]
        first = np.flatnonzero(new)
        self.times = np.diff(first, append=len(near))
        if which:
            self.which = np.empty(len(near), np.int32)
            self.which[place] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        near, far = near.take(first), far.take(first)
        del key, place, new
        found = [*_near_contexts(near >> U32(8)), far.astype(np.uint32), (far >> np.uint64(32)).astype(np.uint32)]
        self._decide(near.astype(np.uint8), dict(enumerate(found)), code)


def count_tables(docs: list[np.ndarray], code: Code, bits: int, into: np.ndarray, times: int = 1) -> None:
    """Adds the docs' (zeros, ones) to ``into``: PREDICTORS x 2**bits x 2.
    Equal bytes with equal contexts are added as one."""
    for pieces in pools(docs):
        near, far = _keys(pieces)
        symbol = near.astype(np.uint8)
        for predictors in (range(3), range(3, 4), range(4, 5)):
            if predictors[0] < 3:
                key = near
            else:
                key = (far >> np.uint64(32) if predictors[0] == 4 else far & np.uint64(0xFFFFFFFF)) << np.uint64(8)
                key |= symbol
            seen = Distinct(key, predictors, code)
            occurs = (seen.times * times).astype(np.uint32).take(seen.byte)
            for k in predictors:
                np.add.at(into[k], seen.slots(k, bits) * 2 + seen.bit, occurs)


def logits(counts: np.ndarray) -> np.ndarray:
    """Stored logits of (zeros, ones) pairs, 8 bits each."""
    zeros, ones = counts[0::2].astype(float), counts[1::2].astype(float)
    return np.clip(np.rint(np.log((ones + 0.4) / (zeros + 0.4)) * SHARP), -127, 127).astype(np.int8)


def stored(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of logits from tables of (zeros, ones); and the same with both
    counts, up to 15, above the logit's byte."""
    tables = np.empty((len(counts), counts.shape[1] // 2), np.int8)
    known = np.empty(tables.shape, np.uint16)
    for k, row in enumerate(counts):
        for lo in range(0, len(row), 1 << 18):
            part, at = row[lo : lo + (1 << 18)], slice(lo // 2, lo // 2 + (1 << 17))
            low = np.minimum(part, 15).astype(np.uint16)
            tables[k, at] = logits(part)
            known[k, at] = tables[k, at].view(np.uint8) | low[0::2] << 8 | low[1::2] << 12
    return tables, known


def _without() -> np.ndarray:
    """By bit and number in ``known``: the stored logit when that bit is not
    counted. Counts from 15 on change it by less than one; beside one of them
    the logit is right to one step, and otherwise exact."""
    number, bit = np.arange(1 << 17) & 0xFFFF, np.arange(1 << 17) >> 16
    own = np.where(bit == 1, number >> 12, number >> 8 & 15)
    change = np.log((np.maximum(own, 1) + 0.4) / (np.maximum(own, 1) - 0.6)) * SHARP
    change = np.where((own == 0) | (own == 15), 0, np.rint(np.where(bit == 1, -change, change)))
    zeros, ones = number >> 8 & 15, number >> 12
    exact = logits(np.stack([np.maximum(zeros - (bit == 0), 0), np.maximum(ones - (bit == 1), 0)], axis=1).ravel())
    rough = np.clip((number & 0xFF).astype(np.uint8).view(np.int8) + change, -127, 127).astype(np.int8)
    return np.where((zeros < 15) & (ones < 15), exact, rough)


WITHOUT = _without()

#: How sure a stored logit is, 0 to 3, by its byte.
LEVELS = np.searchsorted((3, 25, 60), np.abs(np.arange(256, dtype=np.uint8).view(np.int8).astype(int)), side="right").astype(np.int32)


class Mixer:
    def __init__(self, tables: np.ndarray, bits: int, code: Code, weights: np.ndarray | None = None):
        self.tables, self.bits, self.code = tables, bits, code
        self.weights = np.full((GATES, PREDICTORS), 0.3, np.float32) if weights is None else weights

    def inputs(self, steps: Steps) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tables[k].take(steps.slots(k, self.bits)) for k in range(PREDICTORS)]
        x = np.empty((len(steps.bit), PREDICTORS), np.float32, order="F")
        for k, one in enumerate(found):
            np.multiply(one, np.float32(1 / SHARP), out=x[:, k])
        return x, _gate(found)

    def evidence(self, docs: list[np.ndarray], known: np.ndarray) -> np.ndarray:
        """Gradient and curvature of the docs' log-probability by gate, as
        GATES x (PREDICTORS + PREDICTORS**2). The docs are counted in
        ``known``; each bit is predicted from the counts without itself."""
        out = np.zeros((GATES, PREDICTORS + PREDICTORS**2))
        for pieces in pools(docs):
            seen = Situations(pieces, self.code)
            high = seen.bit.astype(np.int32) << 16
            found = [WITHOUT.take(known[k].take(seen.slots(k, self.bits)) | high) for k in range(PREDICTORS)]
            gate = _gate(found).astype(np.uint8)
            order = np.argsort(gate, kind="stable")
            x = np.stack([one.take(order) for one in found]) * np.float32(1 / SHARP)
            bits, times = seen.bit.take(order), seen.times.astype(np.float32).take(seen.byte.take(order))
            ends = np.cumsum(np.bincount(gate, minlength=GATES))
            for g, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
                a, n = x[:, lo:hi], times[lo:hi]
                p = _sigmoid(self.weights[g] @ a)
                out[g, :PREDICTORS] += a @ (n * (bits[lo:hi] - p))
                out[g, PREDICTORS:] += ((a * (n * p * (1 - p))) @ a.T).ravel()
        return out

    def improve(self, evidence: np.ndarray) -> None:
        """A Newton step."""
        curve = evidence[:, PREDICTORS:].reshape(GATES, PREDICTORS, PREDICTORS)
        step = np.linalg.solve(curve + np.eye(PREDICTORS), evidence[:, :PREDICTORS, None])[:, :, 0]
        self.weights = (self.weights + np.clip(step, -1, 1)).astype(np.float32)

    def fit(self, docs: list[np.ndarray], rounds: int = 6) -> None:
        """First weights: Newton steps for each gate on unseen documents."""
        got = [(*self.inputs(s), s.bit) for s in (Steps(p, self.code) for p in Pieces(docs))]
        for _ in range(rounds if got else 0):
            grad, curve = np.zeros((GATES, PREDICTORS)), np.zeros((GATES, PREDICTORS, PREDICTORS))
            for x, gate, bit in got:
                p = _sigmoid((x * self.weights[gate]).sum(axis=1))
                for g in range(GATES):
                    own = gate == g
                    a, q = x[own], p[own]
                    grad[g] += a.T @ (bit[own] - q)
                    curve[g] += (a * (q * (1 - q))[:, None]).T @ a
            step = np.linalg.solve(curve + np.eye(PREDICTORS), grad[:, :, None])[:, :, 0]
            self.weights = (self.weights + np.clip(step, -1, 1)).astype(np.float32)

    def byte_nats(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """The cost in nats of every byte of every document. The inputs are
        looked up once for each distinct situation. Documents of like length
        share a piece, so that few blocks are coded alone."""
        out: list[list[np.ndarray]] = [[] for _ in docs]
        order = sorted(range(len(docs)), key=lambda k: len(docs[k]))
        carried: tuple[int, np.ndarray] | None = None
        for pieces in pools([docs[k] for k in order], *TOGETHER):
            seen = Situations(pieces, self.code, which=True)
            packed, done = self._packed(seen), 0
            for parts in pieces:
                weights = np.repeat(self.weights[None], len(parts), axis=0)
                if len(parts) == 1 and carried and carried[0] == parts[0][0]:
                    weights = carried[1]
                ends = np.cumsum([len(d) - lead for _, d, lead in parts])
                which = seen.which[done : done + ends[-1]]
                done += ends[-1]
                cost = self._code(packed, seen.begin.take(which), seen.count.take(which), ends, weights)
                for (k, _, _), one in zip(parts, np.split(cost, ends[:-1]), strict=True):
                    out[order[k]].append(one)
                carried = (parts[0][0], weights) if len(parts) == 1 else None
        return [np.concatenate(x) for x in out]

    def log10_probability(self, docs: list[np.ndarray]) -> np.ndarray:
        return np.array([-x.sum() for x in self.byte_nats(docs)]) / np.log(10)

    def _packed(self, steps: Steps) -> np.ndarray:
        """For each step one number of eight bytes: the stored logits against
        its bit, and the gate."""
        found = [self.tables[k].take(steps.slots(k, self.bits)) for k in range(PREDICTORS)]
        against = 1 - 2 * steps.bit.astype(np.int8)
        out = np.zeros((len(against), 8), np.int8)
        for k, one in enumerate(found):
            np.multiply(one, against, out=out[:, k])
        out[:, PREDICTORS] = _gate(found)
        return out.view(np.int64).ravel()

    def _code(self, packed: np.ndarray, first: np.ndarray, count: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Nats for each byte, whose steps are ``count`` in ``packed`` from
        ``first`` on; the parts end at ``ends``, and their weights follow their
        own blocks. All parts take their next block together."""
        begin = np.cumsum(count) - count
        place = np.arange(int(count.sum()), dtype=np.int32) + np.repeat((first - begin).astype(np.int32), count)
        after = (begin + count)[ends - 1].tolist()
        before = [0, *after[:-1]]
        size = len(ends) * GATES
        flat = weights.reshape(size, PREDICTORS).T / np.float32(SHARP)
        nats = np.empty(len(place), np.float32)
        for lo in range(0, max(b - a for a, b in zip(before, after, strict=True)), BLOCK):
            own = [(k, slice(a + lo, min(b, a + lo + BLOCK))) for k, (a, b) in enumerate(zip(before, after, strict=True)) if a + lo < b]
            long = [at.stop - at.start for _, at in own]
            step = packed.take(np.concatenate([place[at] for _, at in own])).view(np.int8).reshape(-1, 8)
            k = np.repeat(np.array([k for k, _ in own]) * GATES, long)
            k += step[:, PREDICTORS]
            x = step.T[:PREDICTORS].astype(np.float32, order="C")
            z = x[0] * flat[0].take(k)
            for j in range(1, PREDICTORS):
                z += x[j] * flat[j].take(k)
            odds = np.exp(np.clip(z, -60, 60, out=z), out=z)  # against the bit
            cost, done = np.log1p(odds), 0
            for _, at in own:
                nats[at] = cost[done : (done := done + at.stop - at.start)]
            if any(b - a > lo + BLOCK for a, b in zip(before, after, strict=True)):
                odds /= 1 + odds
                rate = RATE / SHARP**2 / np.sqrt(np.bincount(k, minlength=size) + 1.0)
                for j in range(PREDICTORS):
                    flat[j] -= rate * np.bincount(k, weights=np.multiply(x[j], odds, out=x[j]), minlength=size)
        weights.reshape(size, PREDICTORS)[:] = flat.T * np.float32(SHARP)
        return np.add.reduceat(nats, begin).astype(float)


def word_log10(nats: np.ndarray, words: list[bytes], counts: np.ndarray, total: int, ends: int) -> float:
    """log10 of one text's probability."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return float(words_log10([nats], np.array([len(words)]), sizes, counts, total, ends)[0])


def words_log10(nats: list[np.ndarray], n_words: np.ndarray, sizes: np.ndarray, counts: np.ndarray, total: int, ends: int) -> np.ndarray:
    """log10 of the texts' probabilities; ``sizes`` and ``counts`` are those of
    all their words. For every word with the byte after it
    (a space or the end), a last gate mixes the bit predictors' probability
    with that of the exact training counts. Its weight begins at WORD_WEIGHT
    and follows the words of the document that are already coded. All of it is
    in logarithms, so a long word costs what it costs."""
    out = np.array([-x.sum() for x in nats], float)
    some = np.flatnonzero(n_words)
    if not len(some) or total <= ends or not ends:
        return out / np.log(10)
    size = sizes + 1
    coded = -np.add.reduceat(np.concatenate([nats[k] for k in some]).astype(float), np.cumsum(size) - size)
    n = n_words[some]
    first = np.cumsum(n) - n
    stop = ends / total
    exact = counts / (total - ends) * (1 - stop)
    exact[first + n - 1] *= stop / (1 - stop)
    with np.errstate(divide="ignore"):
        exact = np.log(exact)  # -inf: an unknown word
    against = np.log(1 - WORD_WEIGHT) + coded - np.log(WORD_WEIGHT) - exact
    posterior = np.exp(-(np.maximum(against, 0) + np.log1p(np.exp(-np.abs(against)))))
    weight = np.full(len(coded), WORD_WEIGHT * WORD_TRUST)
    for lo, k in zip(first.tolist(), n.tolist(), strict=True):
        weight[lo + 1 : lo + k] += np.cumsum(posterior[lo : lo + k - 1])
    weight /= WORD_TRUST + np.arange(len(coded)) - np.repeat(first, n)
    weight = np.clip(weight, 0.02, 0.98)
    a, b = np.log(weight) + exact, np.log1p(-weight) + coded
    out[some] = np.add.reduceat(np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b))), first)
    return out / np.log(10)


def _gate(found: list[np.ndarray]) -> np.ndarray:
    """By how sure the two longest contexts' stored logits are."""
    return LEVELS[found[-2].view(np.uint8)] * 4 + LEVELS[found[-1].view(np.uint8)]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _byte_counts(rows: DataFrame) -> np.ndarray:
    def run(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in texts_of(batch):
                total += np.bincount(coded_bytes(words_of(text)), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    sums = rows.select("text").mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(256, np.int64)
    for r in sums:
        out[r["byte"]] = r["n"]
    return out


def _pooled(batches):
    """The coded texts of the batches, about POOL bytes at a time."""
    docs, size = [], 0
    for batch in batches:
        for text in texts_of(batch):
            docs.append(coded_bytes(words_of(text)))
            size += len(docs[-1])
            if size >= POOL:
                yield docs
                docs, size = [], 0
    if docs:
        yield docs


def _squeezed(counts: np.ndarray) -> bytes:
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(counts, "<u4"), asbytes=True)


def _restored(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(blob, 4 * width), "<u4")


def _merged_tables(rows: DataFrame, code: Code, bits: int) -> np.ndarray:
    """The predictors' tables of counts, merged slice by slice: PREDICTORS x
    2**bits, zeros in the lower and ones in the upper half of a number."""
    width = (2 << bits) // SLICES

    def run(batches):
        from pyspark import TaskContext

        total, some = np.zeros((PREDICTORS, 2 << bits), np.uint32), False
        for docs in _pooled(batches):
            count_tables(docs, code, bits, total)
            some = True
        if some:
            task = TaskContext.get().partitionId()
            for k in range(PREDICTORS):
                parts = [_squeezed(total[k, s * width : (s + 1) * width]) for s in range(SLICES)]
                yield pa.RecordBatch.from_arrays([pa.array([k * SLICES + s for s in range(SLICES)], pa.int32()), pa.array([task] * SLICES, pa.int32()), pa.array(parts, pa.binary())], names=["slice", "task", "blob"])

    def merge(key, table):
        total = 0
        for blob in table.column("blob"):
            total = total + _restored(blob.as_py(), width).astype(np.uint64)
        out = _squeezed(np.minimum(total, (1 << 32) - 1).astype(np.uint32))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "blob": pa.array([out], pa.binary())})

    schema = "slice int, task int, blob binary"
    level = written(rows.select("text").mapInArrow(lambda batches: trimmed(run(batches)), schema), "tables")
    tasks = (level.agg(F.max("task")).first()[0] or 0) + 1
    while tasks > 1:
        tasks = -(-tasks // 32)
        level = level.withColumn("task", F.pmod("task", F.lit(tasks))).groupBy("slice", "task").applyInArrow(merge, schema)
    counts = np.zeros((PREDICTORS, SLICES, width), "<u4")
    for r in level.toLocalIterator():
        counts[r["slice"] // SLICES, r["slice"] % SLICES] = _restored(r["blob"], width)
    return counts.reshape(PREDICTORS, 2 << bits).view("<u8")


def _evidence(rows: DataFrame, mixer: Mixer, known: np.ndarray) -> np.ndarray:
    """The evidence of all rows, summed."""
    shared = rows.sparkSession.sparkContext.broadcast((mixer.bits, mixer.code, mixer.weights, known))

    def run(batches):
        bits, code, weights, known = shared.value
        mixer, total = Mixer(None, bits, code, weights), np.zeros((GATES, PREDICTORS + PREDICTORS**2))
        for docs in _pooled(batches):
            total += mixer.evidence(docs, known)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "x"])

    sums = rows.select("text").mapInArrow(lambda batches: trimmed(run(batches)), "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).collect()
    shared.unpersist()
    out = np.zeros(GATES * (PREDICTORS + PREDICTORS**2))
    for r in sums:
        out[r["place"]] = r["x"]
    return out.reshape(GATES, -1)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mix_docs: int = MIX_DOCS, mix_bytes: int = MIX_BYTES) -> Mixer:
    """Learns from the training fold of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where(crc_bucket("doc_id", FOLDS) != HELD_OUT)
    code = Code(_byte_counts(rows))
    size = text_bytes(docs, text)
    bits = int(np.clip(np.ceil(np.log2(max(2, size / 4))), *BITS))
    # every 16th document by hash may set the first weights, mix_docs at most
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 3
    sample = rows.where(turn).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(mix_docs)
    chosen = written(sample, "mix").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    mark = F.xxhash64("doc_id", "text")
    budget, fitted = mix_bytes, {}
    for r in chosen.withColumn("mark", mark).toLocalIterator():  # whole texts, mix_bytes of them at most
        doc = coded_bytes(words_of(r["text"]))
        if len(doc) <= budget and r["mark"] not in fitted:
            budget -= len(doc)
            fitted[r["mark"]] = doc
    # those set the weights to start from, on tables that do not know them
    counted = rows.where(~mark.isin(sorted(fitted))) if fitted else rows
    counts = _merged_tables(counted, code, bits).astype("<u8", copy=False).view("<u4")
    mixer = Mixer(stored(counts)[0], bits, code)
    mixer.fit(list(fitted.values()))
    # then they are counted too, as often as they occur, and all documents set the weights
    occurs: dict[int, list[np.ndarray]] = {}
    for r in rows.where(mark.isin(sorted(fitted))).groupBy(mark.alias("mark")).count().collect() if fitted else ():
        occurs.setdefault(r["count"], []).append(fitted[r["mark"]])
    for times, texts in occurs.items():
        count_tables(texts, code, bits, counts, times)
    mixer.tables, known = stored(counts)
    del counts
    mixer.improve(_evidence(rows, mixer, known))
    return mixer


def _ask(buckets: int):
    def run(key, table):
        """The chunk's distinct words by bucket, with their training counts."""
        counts, learned = _word_counts(table)
        by: dict[int, list[bytes]] = {}
        for w in counts:
            by.setdefault(zlib.crc32(w) % buckets, []).append(w)
        rows = []
        for b, words in sorted(by.items()):
            words.sort()
            n = np.array([learned.get(w, 0) for w in words], "<u4").tobytes()
            rows.append((b, zlib.compress(len(words).to_bytes(4, "little") + n + b"\n".join(words), 1)))
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()), "bucket": pa.array([b for b, _ in rows], pa.int32()), "blob": pa.array([x for _, x in rows], pa.binary())})

    return run


def _training(ids) -> list[bool]:
    return [zlib.crc32(b"" if x is None else str(x).encode()) % FOLDS != HELD_OUT for x in ids]


def _word_counts(table) -> tuple[Counter, Counter]:
    every, learned = Counter(), Counter()
    ids = table.column("doc_id").to_pylist()
    for ok, text in zip(_training(ids), table.column("text").to_pylist(), strict=True):
        words = words_of(text)
        words.append(b"")  # the end
        (learned if ok else every).update(words)
    every.update(learned.keys())
    return every, learned


def _numbered(words) -> tuple[dict[bytes, int], np.ndarray]:
    """Numbers of the distinct words, and the number of each word."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return numbers, np.fromiter(map(numbers.__getitem__, words), np.int64)


class Words:
    """A chunk's texts as numbers of their words; each text's last is the end."""

    def __init__(self, table):
        self.ids = table.column("doc_id").to_pylist()
        self.training = np.array(_training(self.ids), bool)
        split = [words_of(t) for t in table.column("text").to_pylist()]
        self.coded = [coded_bytes(w) for w in split]
        for w in split:
            w.append(b"")
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.numbers, self.number = _numbered(chain.from_iterable(split))

    def by_bucket(self, buckets: int):
        """bucket, its distinct words in order and their numbers."""
        by: dict[int, list[bytes]] = {}
        for w in self.numbers:
            by.setdefault(zlib.crc32(w) % buckets, []).append(w)
        for b, words in sorted(by.items()):
            words.sort()
            yield b, words, np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))


def _opened(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    data = zlib.decompress(blob)
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data, "<u4", n, 4), data[4 + 4 * n :].split(b"\n")


def _answer(key, table):
    """Total training counts of the asked words, and, as chunk -1, how many
    training tokens, distinct ones and ends the bucket holds."""
    chunks, counts, sizes = table.column("chunk").to_pylist(), [], []

    def asked_words():
        for blob in table.column("blob"):
            n, words = _opened(blob.as_py())
            counts.append(n)
            sizes.append(len(n))
            yield from words

    numbers, number = _numbered(asked_words())
    total = np.zeros(len(numbers), np.int64)
    np.add.at(total, number, np.concatenate(counts).astype(np.int64))
    out = [zlib.compress(total.take(at).astype("<u8").tobytes(), 1) for at in np.split(number, np.cumsum(sizes)[:-1])]
    ends = int(total[numbers[b""]]) if b"" in numbers else 0
    out.append(np.array([total.sum(), np.count_nonzero(total), ends], "<i8").tobytes())
    return pa.table({"chunk": pa.array([*chunks, -1], pa.int32()), "bucket": pa.array([key[0].as_py()] * len(out), pa.int32()), "blob": pa.array(out, pa.binary())})


def _sums(replies) -> tuple[int, int]:
    """Training tokens and ends; the end is a word of every chunk, so there is
    always a reply."""
    return replies.column("train_tokens")[0].as_py(), replies.column("train_ends")[0].as_py()


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mix_docs: int = MIX_DOCS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    bits_per_byte of each row."""
    spark = docs.sparkSession
    mixer = train(docs, doc_id, text, mix_docs)
    shared = spark.sparkContext.broadcast((mixer.tables, mixer.bits, mixer.code, mixer.weights))  # PREDICTORS * 2**22 bytes at most
    chunks = chunk_count(docs, text)
    buckets = max(8, chunks // 8)
    rows = dealt(docs, chunks, doc_id, text)
    answers = answered(asked(rows, _ask(buckets)), _answer)

    def totals(batches):
        for batch in batches:
            pairs = np.array([np.frombuffer(b, "<i8") for b in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, k].copy()) for k in range(3)], names=["n", "v", "e"])

    learned = answers.where("chunk = -1").select("blob").mapInArrow(totals, "n long, v long, e long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("train_tokens"), F.coalesce(F.sum("v"), F.lit(0)).alias("train_vocabulary"), F.coalesce(F.sum("e"), F.lit(0)).alias("train_ends"))

    def score(key, table, replies):
        mixer = Mixer(*shared.value)
        words = Words(table)
        known = np.zeros(len(words.numbers), np.int64)
        length = np.zeros(len(known), np.int64)
        blobs = dict(zip(replies.column("bucket").to_pylist(), replies.column("blob"), strict=True))
        for b, distinct, at in words.by_bucket(buckets):
            known[at] = np.frombuffer(zlib.decompress(blobs[b].as_py()), "<u8")
            length[at] = np.fromiter(map(len, distinct), np.int64, len(distinct))
        ids, sizes, number = words.ids, words.sizes, words.number
        doc = np.repeat(np.arange(len(ids)), sizes)
        n_known = np.bincount(doc, weights=(known > 0).take(number), minlength=len(ids)).astype(np.int64)
        logs = np.bincount(doc, weights=np.log10(known + 1.0).take(number), minlength=len(ids))
        plain = np.ones(len(number), bool)
        plain[np.cumsum(sizes) - 1] = False  # the ends
        number = number[plain]
        total, ends = _sums(replies)
        made = words_log10(mixer.byte_nats(words.coded), sizes - 1, length.take(number), known.take(number).astype(float), total, ends)
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
        columns = (ids, ~words.training, sizes, n_known, logs, made, [len(d) for d in words.coded])
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "n_bytes"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, n_bytes long"
    # every reply carries the corpus totals: one row, added to the chunk's own
    replies = answers.where("chunk >= 0").crossJoin(F.broadcast(learned))
    scored = rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, schema)
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("train_vocabulary") + 1)
    # learned is one row
    return scored.crossJoin(F.broadcast(learned)).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
