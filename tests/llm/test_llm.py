"""Operators of the llm subpackage against brute force, round trips and SQL."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

WORDS = [f"w{k}" for k in range(60)] + ["Ünï", "ÇA", "the", "and"]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies, shared passages, nulls, empties, repeats, and extra
    columns named like the operators' own."""
    rng = random.Random(3)
    base = [text(rng, rng.randint(1, 150)) for _ in range(40)]
    passage = text(rng, 70)
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, base[k]) for k in range(8)]
    rows += [(200 + k, f"{text(rng, 20)} {passage} {text(rng, k)}") for k in range(6)]
    rows += [(300, None), (301, ""), (302, " \t\n\x0b\x0c\r "), (303, "one"), (304, "one two three"), (None, base[30]), (7, base[7]), (7, base[9])]
    rows += [(400, (passage + " ") * 400)]
    rows = [(i, t, "en", f"s{k % 3}", len(t or ""), k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words long")


def collected(df):
    return [r.asDict() for r in df.collect()]


def split(t):
    return (t or "").encode().split()


def test_queries_match_sql(same):
    from gridloom.llm.queries import ORACLE_SQL

    for name in ORACLE_SQL:
        same(name)


# --- 1: WARC


def test_warc_round_trip(spark):
    from gridloom.llm import warc

    html = ["<p>é</p>", "<p>é</p>", None, "", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n", "x" * 300_000, "<p>é</p>", "<p>é</p>"]
    ids = [5, 2, 3, 4, 6, 7, 2, None]
    rows = [(i, "http://a/\r\nb" if k % 2 else None, h, "extra") for k, (i, h) in enumerate(zip(ids, html, strict=True))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = collected(warc.warc_transactions(spark, pages, with_payload=True))
    assert len(got) == len(rows)
    assert all(r["digest_agrees"] and r["request"] and r["metadata"] and r["response"] for r in got)
    want = Counter()
    for i, h in zip(ids, html, strict=True):
        data = (h or "").encode()
        first = min((j for j, g in zip(ids, html, strict=True) if (g or "") == (h or "") and j is not None))
        revisit = i is None or i > first
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    kept = [bytes(r["response"]["payload"]).decode() for r in got if r["record_type"] == "response" and r["page_id"] == 6]
    assert kept == [html[4]]


def test_warc_assembly_directions_and_orphans(spark):
    from gridloom.llm import warc

    def rec(k, rid, kind, to):
        return ("f", k, rid, kind, to, None, None, None, None, None, None, 0, {}, None)

    rows = [rec(0, "r1", "response", ["q1"]), rec(1, "q1", "request", []), rec(2, "m1", "metadata", ["r1"]), rec(3, "q9", "request", ["gone"]), rec(4, "r2", "response", [])]
    got = collected(warc.assemble(spark.createDataFrame(rows, warc.RECORD)))
    shape = sorted((r["capture"], *(bool(r[c]) for c in ("request", "response", "metadata"))) for r in got)
    assert shape == [("gone", True, False, False), ("r1", True, True, True), ("r2", False, True, False)]


# --- 2: substring dedup


def brute_dedup(rows, window):
    starts = defaultdict(lambda: 1 << 62)
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            starts[key] = min(starts[key], (1 << 62) - 1 if i is None else i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] < ((1 << 62) - 1 if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [50, 13, 5])
def test_substring_dedup(corpus, window):
    from gridloom.llm.substring_dedup import substring_dedup

    got = collected(substring_dedup(corpus, window=window))
    want = brute_dedup([(r.doc_id, r.text) for r in corpus.collect()], window)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want


def test_structured_words_differ(spark):
    """Words that collide under polynomial hashes modulo 2**64."""
    from gridloom.llm.substring_dedup import substring_dedup

    morse = "".join("ab"[k.bit_count() & 1] for k in range(4096))
    other = morse.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"v{k}" for k in range(60))
    rows = [(1, f"{morse} {tail[:150]}"), (2, f"{other} {tail[:150]}"), (3, " ".join([morse] * 60)), (4, " ".join([other] * 60)), (5, " ".join([morse] * 55))]
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 55}


def test_null_and_repeated_ids_are_dealt(spark):
    from gridloom.llm.exchange import dealt

    docs = spark.createDataFrame([(None if k % 2 else 5, f"t{k}") for k in range(200)], "doc_id long, text string")
    assert dealt(docs, 16, "doc_id", "text").select("chunk").distinct().count() > 10


def test_covers():
    from gridloom.llm.substring_dedup import difference_cover, period_for

    for p in (1, 3, 7, 13, 21, 31):
        cover = difference_cover(p)
        assert {(a - b) % p for a in cover for b in cover} == set(range(p))
    assert period_for(50) == 31 and len(difference_cover(31)) == 6


def test_rewrite_keeps_clean_rows(corpus):
    from gridloom.llm.substring_dedup import rewrite_documents

    got = collected(rewrite_documents(corpus))
    by = {(r["doc_id"], r["n_words"]): r for r in got}
    for r in corpus.collect():
        if r.doc_id is not None and r.doc_id < 100 and r.doc_id not in (7, 9):
            assert by[r.doc_id, r.n_words]["text"] == r.text
    assert not any(r["doc_id"] in range(100, 108) and len(split(r["text"])) >= 50 for r in got)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


# --- 3: decontamination


def test_decontamination(spark, corpus):
    from gridloom.llm.decontaminate import decontaminate, words_of

    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    own = [w.decode() for w in words_of(rows[3][1])]
    items = [(1, " ".join(own[:12]).upper()), (10, "one"), (2, "one TWO"), (3, None), (4, "..."), (5, "absent words here"), (1, " ".join(own[:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        w, hit, names = words_of(t), set(), set()
        for item, b in items:
            v = words_of(b)
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[k : k + n]:
                        hit.update(range(j, j + n))
                        names.add(str(item))
        want[i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)] += 1
    for block in (2_000_000, 10):
        got = collected(decontaminate(corpus, bench, block_words=block))
        assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == want
    assert not any(r["contaminated"] for r in collected(decontaminate(corpus, bench.limit(0))))


# --- 4: language model


def test_lm_base_and_model(corpus):
    from gridloom.llm.lm_scoring import lm_scores

    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    c = Counter(x for i, w in tokens if not held(i) for x in w)
    n, v = sum(c.values()), len(c)
    got = collected(lm_scores(corpus))
    want = Counter((i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in tokens)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_lm_is_a_distribution():
    """The probabilities of all next symbols sum to one."""
    from gridloom.llm import lm_scoring as L

    code = L.Code(np.bincount(np.frombuffer(b"abracadabra banana", np.uint8), minlength=256))
    counts = np.zeros((L.PREDICTORS, 2 << 16), np.uint32)
    L.count_tables([L.coded_bytes([b"abra", b"banana"])] * 5, code, 16, counts)
    mixer = L.Mixer(np.stack([L.logits(c) for c in counts]), 16, code)
    docs = [np.array([*b"ab", s], np.uint8) for s in range(256)]
    one = mixer.log10_probability([np.frombuffer(b"ab", np.uint8)])[0]
    assert abs(sum(10 ** (mixer.log10_probability(docs) - one)) - 1) < 1e-3


def test_lm_long_words_cost_all_their_bytes():
    from gridloom.llm.lm_scoring import WORD_WEIGHT, word_log10

    assert abs(word_log10(np.array([900.0]), [b""], np.zeros(1), 100, 10) - (np.log10(1 - WORD_WEIGHT) - 900 / np.log(10))) < 1e-6
    nats = np.full(100_001, 2.0)
    assert abs(word_log10(nats, [b"x" * 100_000], np.zeros(1), 100, 10) + 200_002 / np.log(10)) < 1
    # short words: as in plain probabilities
    got = word_log10(np.array([0.5, 1.0, 0.25, 0.75]), [b"a", b"b"], np.array([3.0, 0.0]), 100, 10)
    coded, exact = np.exp([-1.5, -1.0]), np.array([3 / 90 * 0.9, 0.0])
    post = WORD_WEIGHT * exact[0] / (WORD_WEIGHT * exact[0] + (1 - WORD_WEIGHT) * coded[0])
    weight = np.array([WORD_WEIGHT, (WORD_WEIGHT * 20 + post) / 21])
    assert abs(got - np.log10(weight * exact + (1 - weight) * coded).sum()) < 1e-9


def test_lm_counts_what_the_mixer_leaves(spark, monkeypatch):
    """Documents over the mixer's byte budget are counted, those in it are not."""
    from gridloom.llm import lm_scoring as L

    rng = random.Random(9)
    docs = spark.createDataFrame([(k, text(rng, 50)) for k in range(400)], "doc_id long, text string").repartition(4)
    seen = []
    monkeypatch.setattr(L, "_merged_tables", lambda rows, code, bits: seen.append(rows.count()) or np.zeros((L.PREDICTORS, 1 << bits), np.int8))
    fits = []
    monkeypatch.setattr(L.Mixer, "fit", lambda self, texts: fits.append(len(texts)))
    for size in (0, 500, 1 << 20):
        L.train(docs, mix_bytes=size)
    total = docs.where(L.crc_bucket("doc_id", 7) != 2).count()
    assert [n + m for n, m in zip(seen, fits, strict=True)] == [total] * 3
    assert fits[0] == 0 < fits[1] < fits[2]


def test_lm_adapts_every_block():
    """One-byte contexts have a predictor, and long documents keep adapting at
    every BLOCK bits."""
    from gridloom.llm import lm_scoring as L

    data = np.concatenate((np.zeros(L.PAD, np.uint8), np.frombuffer(b"xaya", np.uint8)))
    assert len(L.contexts(data)) == L.PREDICTORS == 5 and L.contexts(data)[0][L.PAD + 3] == ord("y")
    rng = np.random.default_rng(4)
    doc = rng.integers(97, 105, 6000).astype(np.uint8)
    code = L.Code(np.bincount(doc, minlength=256))
    mixer = L.Mixer(rng.integers(-60, 60, (L.PREDICTORS, 1 << 16)).astype(np.int8), 16, code)
    steps = L.Steps([(0, np.concatenate((np.zeros(L.PAD, np.uint8), doc)), L.PAD)], code)
    x, gate = mixer.inputs(steps)
    weights, want = mixer.weights.astype(float).copy(), 0.0
    for lo in range(0, len(gate), L.BLOCK):
        a, g, bit = x[lo : lo + L.BLOCK], gate[lo : lo + L.BLOCK], steps.bit[lo : lo + L.BLOCK].astype(float)
        z = (a * weights[g]).sum(axis=1)
        want += np.logaddexp(0, np.where(bit > 0, -z, z)).sum()
        for one in np.unique(g):
            own = g == one
            weights[one] += L.RATE * ((bit - 1 / (1 + np.exp(-z)))[own, None] * a[own]).sum(axis=0) / np.sqrt(own.sum() + 1)
    assert len(gate) > 32 * L.BLOCK
    assert abs(mixer.byte_nats([doc])[0].sum() / want - 1) < 1e-4


def test_lm_pieces_carry_contexts_and_weights(monkeypatch):
    """A text over a piece has the same inputs as in one piece, and its cost is
    that of a plain loop whose blocks also end with the pieces."""
    from gridloom.llm import lm_scoring as L

    rng = np.random.default_rng(10)
    words = [bytes(rng.integers(97, 105, int(rng.integers(1, 40))).astype(np.uint8)) for _ in range(400)] + [b"y" * 700, b"z"]
    doc = L.coded_bytes(words)
    code = L.Code(np.bincount(doc, minlength=256))
    mixer = L.Mixer(rng.integers(-60, 60, (L.PREDICTORS, 1 << 16)).astype(np.int8), 16, code)
    whole = L.Steps(next(iter(L.Pieces([doc]))), code)
    x, gate = mixer.inputs(whole)
    monkeypatch.setattr(L, "PIECE", 1000)
    parts = list(L.Pieces([doc]))
    assert len(parts) > 8
    steps = [L.Steps(p, code) for p in parts]
    assert np.array_equal(np.concatenate([mixer.inputs(s)[0] for s in steps]), x)
    weights, want, at = mixer.weights.astype(float).copy(), 0.0, 0
    for s in steps:
        for lo in range(0, len(s.bit), L.BLOCK):
            a, g, bit = x[at + lo : at + min(lo + L.BLOCK, len(s.bit))], gate[at + lo : at + min(lo + L.BLOCK, len(s.bit))], s.bit[lo : lo + L.BLOCK].astype(float)
            z = (a * weights[g]).sum(axis=1)
            want += np.logaddexp(0, np.where(bit > 0, -z, z)).sum()
            if lo + L.BLOCK < len(s.bit):
                for one in np.unique(g):
                    own = g == one
                    weights[one] += L.RATE * ((bit - 1 / (1 + np.exp(-z)))[own, None] * a[own]).sum(axis=0) / np.sqrt(own.sum() + 1)
        at += len(s.bit)
    assert abs(mixer.byte_nats([doc])[0].sum() / want - 1) < 1e-4


def test_lm_learns_from_all_training_documents(spark):
    """The tables count every training row, repeated ones as often as they
    occur, and the weights' step sums over all bits, each without itself."""
    from gridloom.llm import lm_scoring as L

    rng = random.Random(11)
    rows = [(k, text(rng, 30)) for k in range(300)]
    rows += [r for r in rows if r[0] % 3 == 0]
    docs = [L.coded_bytes(L.words_of(t)) for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    start = []
    fit, improve = L.Mixer.fit, L.Mixer.improve
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(L.Mixer, "fit", lambda self, texts: (fit(self, texts), start.append((len(texts), self.weights.copy())))[0])
        patch.setattr(L.Mixer, "improve", lambda self, e: (start.append(e), improve(self, e))[1])
        mixer = L.train(frame, mix_bytes=2000)
    (fitted, weights), evidence = start
    assert fitted > 1
    counts = np.zeros((L.PREDICTORS, 2 << mixer.bits), np.uint32)
    L.count_tables(docs, mixer.code, mixer.bits, counts)
    assert np.array_equal(mixer.tables, np.stack([L.logits(c) for c in counts]))
    grad, curve = np.zeros((L.GATES, L.PREDICTORS)), np.zeros((L.GATES, L.PREDICTORS, L.PREDICTORS))
    for doc in docs:
        steps = L.Steps(next(iter(L.Pieces([doc]))), mixer.code)
        x = []
        for k in range(L.PREDICTORS):
            at = steps.slots(k, mixer.bits) * 2
            both = np.stack([counts[k][at], counts[k][at + 1]], axis=1).astype(int)
            less = both - np.stack([steps.bit == 0, steps.bit == 1], axis=1)
            # beside a count from 15 on, to the next step of a stored logit
            own, sign = both[np.arange(len(at)), steps.bit], 2.0 * steps.bit - 1
            change = np.where(own < 15, np.rint(np.log((own + 0.4) / (own - 0.6)) * L.SHARP), 0)
            x.append(np.where((both < 15).all(axis=1), L.logits(less.ravel()), np.clip(L.logits(both.ravel()) - sign * change, -127, 127).astype(np.int8)))
            assert np.abs(x[-1].astype(int) - L.logits(less.ravel())).max() <= 1
        x = np.stack(x, axis=1)
        gate = L.LEVELS[x[:, -2].astype(np.uint8)] * 4 + L.LEVELS[x[:, -1].astype(np.uint8)]
        x = x / L.SHARP
        p = 1 / (1 + np.exp(-(x * weights[gate]).sum(axis=1)))
        for g, a, b, q in zip(gate, x, steps.bit, p, strict=True):
            grad[g] += (b - q) * a
            curve[g] += q * (1 - q) * np.outer(a, a)
    assert np.allclose(evidence[:, : L.PREDICTORS], grad, rtol=1e-3, atol=0.01)
    assert np.allclose(evidence[:, L.PREDICTORS :], curve.reshape(L.GATES, -1), rtol=1e-3, atol=0.01)
    step = np.linalg.solve(evidence[:, L.PREDICTORS :].reshape(curve.shape) + np.eye(L.PREDICTORS), evidence[:, : L.PREDICTORS, None])[:, :, 0]
    assert np.allclose(mixer.weights, weights + np.clip(step, -1, 1), atol=1e-5)


def test_lm_documents_together_cost_what_they_cost_alone():
    from gridloom.llm import lm_scoring as L

    rng = np.random.default_rng(12)
    docs = [np.append(rng.integers(97, 105, int(n)), L.END).astype(np.uint8) for n in rng.integers(0, 900, 60)]
    code = L.Code(np.bincount(np.concatenate(docs), minlength=256))
    mixer = L.Mixer(rng.integers(-60, 60, (L.PREDICTORS, 1 << 16)).astype(np.int8), 16, code)
    for doc, got in zip(docs, mixer.byte_nats(docs), strict=True):
        assert np.allclose(got, mixer.byte_nats([doc])[0], rtol=1e-3, atol=1e-4)


def test_lm_looks_up_equal_situations_once(monkeypatch):
    """Copies of a text cost no further look-ups in counting, evidence and
    scoring; the results are those of looking up every bit."""
    from gridloom.llm import lm_scoring as L

    rng = random.Random(13)
    docs = [L.coded_bytes(L.words_of(text(rng, 200))) for _ in range(3)]
    many = docs * 40
    code, bits = L.Code(np.bincount(np.concatenate(docs), minlength=256)), 16
    want = np.zeros((L.PREDICTORS, 2 << bits), np.uint32)
    for parts in L.Pieces(many):
        steps = L.Steps(parts, code)
        for k in range(L.PREDICTORS):
            np.add.at(want[k], steps.slots(k, bits) * 2 + steps.bit, np.uint32(1))
    looked = []
    one = L.slots
    monkeypatch.setattr(L, "slots", lambda context, *a: (looked.append(len(context)), one(context, *a))[1])

    def lookups(run):
        looked.clear()
        return run(), sum(looked)

    counts = np.zeros_like(want)
    _, few = lookups(lambda: L.count_tables(docs, code, bits, np.zeros_like(want)))
    _, all_of = lookups(lambda: L.count_tables(many, code, bits, counts))
    assert np.array_equal(counts, want) and all_of == few
    tables, known = L.stored(counts)
    mixer = L.Mixer(tables, bits, code)
    single, few = lookups(lambda: mixer.evidence(docs, known))
    evidence, all_of = lookups(lambda: mixer.evidence(many, known))
    assert all_of == few and np.allclose(evidence, 40 * single, rtol=1e-3, atol=0.01)
    alone, few = lookups(lambda: mixer.byte_nats(docs))
    nats, all_of = lookups(lambda: mixer.byte_nats(many))
    assert all_of == few and all(np.array_equal(a, b) for a, b in zip(nats, alone * 40, strict=True))


@pytest.mark.parametrize("good", [True, False])
def test_lm_situations_are_compared_as_they_are(monkeypatch, good):
    """Every byte's situation is its own, whatever the hash that sorts them."""
    from gridloom.llm import lm_scoring as L

    rng = np.random.default_rng(14)
    docs = [np.append(rng.integers(97, 100, int(n)), L.END).astype(np.uint8) for n in rng.integers(0, 400, 50)]
    docs += [L.coded_bytes([b"ab", b"b" * 900, b"a"]), docs[3]]
    code = L.Code(np.bincount(np.concatenate(docs), minlength=256))
    monkeypatch.setattr(L, "PIECE", 700)
    if not good:
        monkeypatch.setattr(L, "_hashed", lambda near, far: np.zeros(len(near), np.uint64))
    for pieces in L.pools(docs, 7) if good else [[p] for p in L.Pieces(docs)]:
        parts = [p for parts in pieces for p in parts]
        plain, seen = L.Steps(parts, code), L.Situations(pieces, code, which=True)
        assert len(seen.which) == len(plain.count) >= len(seen.times) and (not good or len(plain.count) > len(seen.times))
        assert np.array_equal(np.bincount(seen.which), seen.times)
        at = np.arange(len(plain.bit)) + np.repeat(seen.begin[seen.which] - plain.begin, plain.count)
        assert np.array_equal(seen.bit[at], plain.bit) and np.array_equal(seen.node[at], plain.node)
        for k in range(L.PREDICTORS):
            assert np.array_equal(seen.slots(k, 22)[at], plain.slots(k, 22))


# --- 5: URL filters


def test_url_history(spark):
    from datetime import date

    from gridloom.llm.url_filters import evaluate

    d = date
    events = [("A.com", "ads", d(2024, 1, 10), "add"), ("a.com", "ads", d(2024, 3, 5), "remove"), ("a.com", "ads", d(2024, 3, 5), "add"), ("a.com", "ads", d(2024, 5, 1), "remove"), ("x.a.com/p", "adult", d(2024, 2, 1), "add"), ("b.com", "allow", d(2024, 1, 1), "add"), ("b.com", "ads", d(2024, 1, 1), "add"), (None, "ads", d(2024, 1, 1), "add"), ("c.com", None, None, None)]
    captures = [(1, "http://u@X.a.com:80/p/q?x=1", d(2024, 4, 30)), (2, "http://a.com", d(2024, 5, 1)), (3, "http://a.com/p", d(2024, 1, 9)), (4, "https://b.com/", d(2025, 1, 1)), (5, None, d(2024, 4, 1)), (6, "http://a.com", None), (1, "http://u@X.a.com:80/p/q?x=1", d(2024, 4, 30)), (7, "nota.com", d(2024, 4, 1))]
    ev = spark.createDataFrame(events, "key string, list string, day date, action string")
    ca = spark.createDataFrame([(*c, "z") for c in captures], "capture_id long, url string, day date, list string")
    got = Counter((r["capture_id"], r["n_active"], r["lists"], r["blocked"]) for r in evaluate(ca, ev).collect())
    assert got == Counter([(1, 2, "ads,adult", True)] * 2 + [(2, 0, "", False), (3, 0, "", False), (4, 2, "ads,allow", False), (5, 0, "", False), (6, 0, "", False), (7, 0, "", False)])
    assert not any(r["blocked"] for r in evaluate(ca, ev.limit(0)).collect())


def test_url_paths_keep_their_case(spark):
    from datetime import date

    from gridloom.llm.url_filters import evaluate

    first = date(2024, 1, 1)
    events = [("Example.COM/Ads", "ads", first, "add"), ("example.com/ads", "adult", first, "add"), ("O.org/B/c", "malware", first, "add")]
    captures = [(1, "http://EXAMPLE.com/Ads/x"), (2, "http://example.com/ads"), (3, "http://example.com/ADS"), (4, "http://o.org/B/c/d"), (5, "http://o.org/b/c")]
    ev = spark.createDataFrame(events, "key string, list string, day date, action string")
    ca = spark.createDataFrame([(*c, date(2024, 2, 1)) for c in captures], "capture_id long, url string, day date")
    assert {r["capture_id"]: r["lists"] for r in evaluate(ca, ev).collect()} == {1: "ads", 2: "adult", 3: "", 4: "malware", 5: ""}


# --- 6: SimHash


def brute_fingerprint(t):
    import xxhash

    w = (t or "").encode().lower().split()
    s = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(fps)
    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {f: find(f) for f in nodes}


def test_simhash(spark, sf, corpus):
    from gridloom.llm.simhash import simhash_components

    for docs in (corpus, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
        root = brute_components({f for _, f in rows})
        least = defaultdict(list)
        for i, f in rows:
            least[root[f]] += [] if i is None else [i]
        want = Counter((i, f"{f:016x}", min(least[root[f]], default=None)) for i, f in rows)
        assert Counter(tuple(r) for r in simhash_components(docs).select("doc_id", "fingerprint", "component_id").collect()) == want


@pytest.mark.parametrize("hot", [4096, 40])
def test_bit_sliced_links(monkeypatch, hot):
    from gridloom.llm import simhash

    monkeypatch.setattr(simhash, "HOT", hot)
    rng = np.random.default_rng(1)
    flips = lambda x: x ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False))
    fps = sorted({flips(int(x)) for x in rng.integers(0, 1 << 62, 60) for _ in range(6)})
    a, b = simhash.links(np.array(fps, np.uint64), np.array([0, len(fps)]), 4)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    assert {f: find(f) for f in fps} == brute_components(fps)
    assert len(a) < len(fps)


def test_hot_fingerprint_buckets_split(spark):
    from gridloom.llm.simhash import fingerprint_links

    rng = np.random.default_rng(2)
    fps = {int(x) & 0x7FFFFFFFFFFFFF for x in rng.integers(0, 1 << 62, 120)}
    fps |= {f ^ 5 for f in list(fps)[:40]}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for hot in (4096, 20):
        got = fingerprint_links(df, hot=hot).collect()
        parent = brute_components(fps)
        groups = defaultdict(set)
        for f, r in parent.items():
            groups[r].add(f)
        linked = {frozenset((r.a, r.b)) for r in got}
        assert {f for pair in linked for f in pair} == {f for g in groups.values() if len(g) > 1 for f in g}


def test_near_duplicate_stage(corpus):
    from gridloom.llm.simhash import drop_near_duplicates, simhash_components

    kept = drop_near_duplicates(corpus)
    assert kept.columns == corpus.columns
    parts = {r["component_id"] for r in simhash_components(corpus).collect()}
    assert {r["doc_id"] for r in kept.collect()} == parts
    assert kept.count() == kept.distinct().count() <= len(parts) + 1  # id 7 is given to two texts


def brute_similar(rows):
    """Doc ids that name the components of five-word Jaccard 0.8 or more."""
    sets = [(i, frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").encode().lower().decode().split()) else frozenset()) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y in range(x):
            b = sets[y][1]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(x)] = find(y)
    groups = defaultdict(list)
    for x, (i, _) in enumerate(sets):
        groups[find(x)].append(i)
    return {min((i for i in g if i is not None), default=None) for g in groups.values()}


def test_pipeline_drops_copies_from_0_8_on(spark, sf):
    from corpus_pipeline import near_duplicates

    rng = random.Random(11)
    word = lambda: f"q{rng.randrange(5000)}"
    rows = []
    for k in range(60):
        base = [word() for _ in range(200)]
        rows.append((k, " ".join(base)))
        for j, edits in enumerate((1, 2, 3, 4, 5, 8)):  # each edit changes five shingles
            copy = list(base)
            for at in rng.sample(range(5, 195), edits):
                copy[at] = word()
            rows.append((100 * (j + 1) + k, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "ONE  two"), (None, "lonely null id here now"), (7, rows[0][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string")
    kept = near_duplicates(spark, docs, sf)
    assert kept.columns == docs.columns
    want = brute_similar(rows)
    assert {r["doc_id"] for r in kept.collect()} == want and len(want) < 250
    tables = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert {r["doc_id"] for r in near_duplicates(spark, tables, sf).collect()} == brute_similar([tuple(r) for r in tables.collect()])


def test_wide_comparison_counts_all_bits():
    from gridloom.llm.simhash import linked

    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, (20, 2), np.uint64)
    fps = np.repeat(base, 4, axis=0)
    for row in fps:
        for bit in rng.choice(128, int(rng.integers(0, 40)), replace=False):
            row[bit // 64] ^= np.uint64(1 << int(bit % 64))
    label = linked(fps, np.array([0, len(fps)]), 38)
    whole = [int(a) | int(b) << 64 for a, b in fps]
    want = list(range(len(fps)))
    for _ in want:
        want = [min(want[j] for j in range(len(fps)) if (whole[i] ^ whole[j]).bit_count() <= 38) for i in range(len(fps))]
    assert label.tolist() == want


def test_near_copies_in_blocks(spark):
    """Hot buckets and groups of many blocks give the same components, and a
    group near the threshold does not become pairs."""
    from gridloom.llm.near_copies import similar_links, with_marks
    from gridloom.llm.simhash import keep_first, label_nodes, text_mark

    rng = random.Random(12)
    template = [f"t{k}" for k in range(120)]
    rows = []
    for k in range(160):
        copy = list(template)
        for at in rng.sample(range(120), rng.randint(1, 5)):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = with_marks(docs.withColumn("mark", text_mark("text")), "text", ["doc_id", "mark"]).cache()
    want = brute_similar(rows)
    for hot, nodes in ((4096, 1024), (3, 1024), (4096, 16), (3, 7)):
        links = similar_links(marked, docs, "doc_id", "text", hot=hot, block_nodes=nodes).cache()
        kept = keep_first(docs, marked, label_nodes(marked, links), "doc_id", "text")
        assert {r["doc_id"] for r in kept.collect()} == want
        assert links.count() <= 160 * 160 / nodes + 160


# --- 7: toxicity


def test_toxicity_held_out(spark):
    from gridloom.llm.toxicity import drop_toxic, toxicity_scores

    rng = random.Random(5)
    docs, labels = [], []
    for k in range(600):
        toxic = k % 6 == 0
        t = text(rng, 30)
        docs.append((k, t + " " + " ".join(rng.choice(["blargh", "snotface", "zonk"]) for _ in range(2)) if toxic else t, "x"))
        if k % 2 == 0:
            labels.append((k, 1, int(toxic)))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, "blargh zonk snotface", "x"), (6, "clean", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame([*labels, (601, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = collected(toxicity_scores(d, lab))
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0) for r in got)
    wrong = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] != 6 and r["predicted"] != int(r["doc_id"] % 6 == 0)]
    assert len(wrong) <= 6
    kept = drop_toxic(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert {r["predicted"] for r in collected(toxicity_scores(d, lab.limit(0)))} == {0}


def test_label_model_against_brute_force(spark):
    """Posteriors and EM sums, pattern by pattern, with plain loops."""
    import itertools
    import math

    from gridloom.llm import toxicity as X

    rng = np.random.default_rng(6)
    y = (rng.random(400) < 0.3).astype(float)
    fire = lambda a, b: (rng.random(400) < np.where(y > 0, a, b)).astype(float)
    one = fire(0.7, 0.1)
    x = np.column_stack((one, np.where(rng.random(400) < 0.9, one, 1 - one), fire(0.2, 0.6), fire(0.5, 0.05), np.zeros(400)))
    x[:, 4] = x[:, :4].sum(axis=1) == 0
    model = X.LabelModel(x[:60], y[:60])
    assert sorted(np.flatnonzero(model.parent < 0)) == [0] and model.parent[1] == 0  # the copy hangs on its original

    def likelihood(row, c, m):
        out = 1.0
        for k in range(5):
            up = m["parent"][k]
            rate = m["rates"][int(row[up]) if up >= 0 else 0][c][k]
            out *= rate if row[k] else 1 - rate
        return out

    def posterior(row, m):
        a, b = m["prior"] * likelihood(row, 1, m), (1 - m["prior"]) * likelihood(row, 0, m)
        return a / (a + b)

    held = {"parent": model.parent.tolist(), "rates": model.rates.tolist(), "prior": model.prior}
    for c in (0, 1):
        assert abs(sum(likelihood(r, c, held) for r in itertools.product((0, 1), repeat=5)) - 1) < 1e-9
    assert np.allclose(model.posterior(x), [posterior(r, held) for r in x], atol=1e-9)
    votes = Counter(tuple(np.flatnonzero(r[:4]).tolist()) for r in x)
    patterns = spark.createDataFrame([(list(v), n) for v, n in votes.items()], "votes array<int>, n long").repartition(5)
    model.refine(patterns, rounds=1)
    total, on = [0.0, 0.0], [[0.0] * 5 for _ in (0, 1)]
    for rows, w, known in ((x[:60], 1.0, y[:60]), (x, 60 / 400, None)):
        for k, r in enumerate(rows):
            p = posterior(r, held) if known is None else known[k]
            for c, q in ((0, 1 - p), (1, p)):
                total[c] += w * q
                for v in range(5):
                    on[c][v] += w * q * r[v]
    assert math.isclose(model.prior, total[1] / sum(total), rel_tol=1e-9)
    assert np.allclose(model.rates[0, :, 0], [(on[c][0] + 0.5) / (total[c] + 1) for c in (0, 1)])
    model.refine(patterns, rounds=3)
    assert ((model.posterior(x) > 0.5) == (y > 0)).mean() > 0.85


def test_toxicity_labels_that_disagree(spark):
    from gridloom.llm.toxicity import _labelled

    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, None), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert sorted((r.y, r.text) for r in _labelled(docs, labels, "toxic", 10).collect() if r.text) == [(1, "a")]
    assert _labelled(docs, labels, "toxic", 10).count() == 2


# --- 8: packing


def test_packing(spark, sf, corpus):
    from tokenizers import Tokenizer

    from gridloom.llm.packing import pack_documents
    from gridloom.llm.queries import tokenizer_path

    tk = Tokenizer.from_file(tokenizer_path())
    odd = spark.createDataFrame([(900, "a  b"), (901, "x\n\n y  z"), (902, "don't we'll <|endoftext|> ok"), (903, "日本 語\tです"), (904, " lead and trail ")], "doc_id long, text string")
    docs = corpus.select("doc_id", "text").union(odd).union(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 10000", "text"))
    for capacity in (2048, 64):
        got = collected(pack_documents(docs, tokenizer_path(), capacity=capacity, with_ids=True))
        by, fill = defaultdict(list), defaultdict(list)
        for r in got:
            ids = np.frombuffer(r["ids"], "<u4").tolist()
            assert len(ids) == r["length"] <= capacity and zlib.crc32(r["ids"]) == r["ids_crc32"]
            fill[r["sequence_id"]].append((r["offset"], r["length"]))
            by[r["doc_id"]].append((r["piece"], r["start"], ids))
        for spans in fill.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= capacity
        texts = defaultdict(list)
        for r in docs.collect():
            texts[r[0]].append(r[1])
        for i, t in texts.items():
            if len(t) == 1:
                ids = (tk.encode(t[0], add_special_tokens=False).ids if t[0] else []) + [0]
                assert [x for _, _, p in sorted(by[i]) for x in p] == ids
                assert all(len(p) == capacity for k, _, p in by[i] if k > 0)
                assert len(by[i]) == -(-len(ids) // capacity)
        total = sum(r["length"] for r in got)
        assert len(fill) <= 1.02 * -(-total // capacity) + 1
    assert pack_documents(docs.limit(0), tokenizer_path()).count() == 0


def test_packing_knows_added_tokens():
    from tokenizers import Tokenizer

    from gridloom.llm.packing import Tokens
    from gridloom.llm.queries import tokenizer_path

    plain, made = Tokenizer.from_file(tokenizer_path()), Tokens(tokenizer_path())
    for t in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "don't <|endoftext| > stop", "a  <|endoftext|>\n", "x" * 200_000 + " \u2003\u0085 ok", "\u1e9e \U0001f600 \ua7cb1", "日本 x\u0378y \x1c \x0b z"):
        assert np.frombuffer(made.encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    assert np.frombuffer(made.encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]


def test_crossover_keeps_every_piece_once():
    from gridloom.llm.packing import best_fit, crossover, evolve, fitness

    rng = np.random.default_rng(0)
    lengths = np.sort(rng.integers(300, 1200, 500))[::-1].astype(np.int64)
    a = best_fit(lengths.tolist(), range(500), 2048)
    b = best_fit(lengths.tolist(), rng.permutation(500).tolist(), 2048)
    for _ in range(10):
        c = crossover(lengths, a, b, 2048, rng)
        assert (c >= 0).all() and np.bincount(c, weights=lengths).max() <= 2048
    # pieces that best fit alone places badly: the search needs fewer sequences
    for seed in range(3):
        hard = np.sort(np.random.default_rng(seed).integers(400, 1024, 600))[::-1].astype(np.int64)
        alone = fitness(hard, best_fit(hard.tolist(), range(600), 2048), 2048)[0]
        assert fitness(hard, evolve(hard, [], 2048, [seed])[0], 2048)[0] > alone


# --- 9: chat


def test_chat_round_trip(spark):
    from gridloom.llm import chat

    odd = ["\\### Assistant: </turn> ok", "", None, "###", "</turn>\n", ":\n", "\\l\\h\\b\\\\", "é\u0000x", "a" * 100_000]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(odd)]
    rows += [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q"), (3, 1, "assistant", "a"), (4, 0, "user", "q"), (4, 1, "assistant", "a"), (5, 0, None, "#"), (5, 0, "sys</turn>\n", "<"), (None, 1, "assistant", "n"), (6, 0, "user", "same"), (6, 0, "user", "same")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, record string")
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        want[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r["conv_id"]: r for r in chat.chat_digest(df).collect()}
    assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in got.items()} == want
    assert len({got[k]["layout"] for k in (1, 2, 3, 4)}) == 4


def test_chat_layouts(spark):
    from gridloom.llm import chat

    lines = ['{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":null}]}', '{"messages":[]}', '{"prompt":"p","completion":"c","system":"s"}', '{"instruction":"i","output":"o"}', '{"instruction":"i","input":"n","output":"o"}', '{"strange":1}', '{"prompt":"alone"}', '{"data":{"question":"q","answer":"w"}}']
    raw = spark.read.json(spark.sparkContext.parallelize(lines))
    from pyspark.sql import functions as F

    deep = spark.read.json(spark.sparkContext.parallelize(['{"messages":[{"role":"user","content":[{"text":"a"}]}]}', '{"messages":[{"role":"user","content":[{"text":null}]}]}', '{"messages":[{"role":"user","content":[]}]}']))
    marks = [r["m"] for r in deep.select(chat.fingerprint(F.struct("*"), deep.schema).alias("m")).collect()]
    assert marks == [chat.fingerprint_of(p) for p in (["messages[].role", "messages[].content[].text"], ["messages[].role"], ["messages[].role"])]
    got = [(r["layout"], [tuple(t) for t in r["turns"]] if r["turns"] is not None else None) for r in chat.canonical_turns(raw.select(F.struct("*").alias("record"))).collect()]
    assert got == [
        ("messages", [("user", "a"), ("assistant", None)]), ("messages", []), ("prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]), ("instruction", [("user", "i"), ("assistant", "o")]),
        ("instruction", [("user", "i"), ("user", "n"), ("assistant", "o")]), (None, None), (None, None), ("qa", [("user", "q"), ("assistant", "w")]),
    ]


# --- 10: nearest neighbours


def test_neighbours(spark):
    from pyspark.sql import functions as F

    from gridloom.llm.ann import nearest

    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16)) * rng.uniform(0.5, 2, (900, 1))
    x[100:180] = x[100]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (2080, [float("inf")] * 16), (None, [1.0] * 16), (2100, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, rank int")
    for shard_rows in (8192, 300):
        got = nearest(df, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect()
        by = defaultdict(list)
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            by[r.query_id].append((r.vec_id, r.score))
        assert set(by) == set(range(0, 900, 20))
        hits = 0
        for q, found in by.items():
            s = x @ x[q]
            best = [int(k) for k in np.lexsort((np.arange(900), -np.round(s, 12))) if k != q][:20]
            assert len(found) == 20 and all(abs(v - s[k]) < 1e-9 for k, v in found) and q not in dict(found)
            hits += len({k for k, _ in found} & set(best))
        assert hits >= 0.95 * 20 * len(by)
    few = nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert len(few) == 4
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_recall_at_a_shards_size(spark):
    """8,192 vectors, alone and with one that is very much longer; components
    of any size."""
    from pyspark.sql import functions as F

    from gridloom.llm.ann import nearest

    rng = np.random.default_rng(14)
    centres = rng.normal(size=(80, 32))
    x = centres[rng.integers(0, 80, 8192)] + 0.6 * rng.normal(size=(8192, 32))
    for extra in (None, 1e8, 1e20, 1e200):
        rows = [(k, v.tolist()) for k, v in enumerate(x)]
        y = x
        if extra:
            y = np.vstack((x, [extra, *[0.0] * 31]))
            rows.append((8193, y[-1].tolist()))
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        by = defaultdict(set)
        for r in nearest(df, F.col("vec_id") % 160 == 0).collect():
            by[r.query_id].add(min(r.vec_id, 8192))
        hits = 0
        for q, found in by.items():
            s = y @ x[q]
            s[q] = -np.inf
            hits += len(found & set(np.argsort(-s, kind="stable")[:20].tolist()))
            if extra and x[q, 0] > 0.01:
                assert 8192 in found
        assert len(by) == 52 and hits >= 0.9 * 20 * len(by)


# --- pipeline


def test_pipeline_stages(spark, sf, corpus):
    import corpus_pipeline as P
    from gridloom.llm.common import written

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, sf), name)
        if name != "packing":
            assert out.columns == names and out.count() <= docs.count()
            docs = out
    assert out.select("doc_id").distinct().count() == docs.count()
    assert P.run(spark, sf).count() == out.count()
    for _, stage in P.STAGES:
        stage(spark, corpus, sf).count()
        stage(spark, corpus.limit(0), sf).count()
