"""Toxicity by weak supervision.

Lexicon and pattern voters (words, word beginnings, and how many different
words share a beginning) are mined for either class from a bounded sample of
labelled training documents. A generative label model then estimates how often
every voter fires on toxic and on clean documents, and how it depends on the
voter that it repeats most: a tree of pair terms, chosen by conditional mutual
information. Expectation-maximisation runs over the vote patterns of all
documents, and the labelled sample anchors the classes. A linear classifier on
the votes is trained on the model's posteriors of all documents' patterns, with
the sample as its anchor again, and it scores every whole text.

Texts are read once for their votes. Only the labelled sample (``sample`` rows)
and sums of model parameters, added up in a tree, reach the driver. Labels
outside the training fold, lang, source and doc_id never enter a score.

Defined results: null and empty texts have no votes and get the classifier's
base score; with no labelled training row, or one class only, all documents
score the base rate (0 where unknown); repeated rows score alike; null labels
are ignored, and of labels of one document that disagree the toxic one counts;
very long texts are read whole, 512 documents at a time; an empty table gives
an empty result; extra columns are ignored, or passed on by ``drop_toxic``
whatever their names. The columns are doc_id, text and, of labels, doc_id and
``label``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import beside, crc_bucket, sliced, texts_of, trimmed, written

FOLDS = 5
SAMPLE = 20_000
VOTERS, CLEAN_VOTERS = 128, 32
PREFIXES = (3, 4, 5, 6, 7)
REPEATS = (1, 2, 4, 8)
WORD = re.compile(r"[^\W\d_]+")
ROUNDS = 4
#: Log-likelihood gain over the base rate that a voter needs: with a million
#: candidates, chance alone rarely reaches it.
GAIN = 12.0


def _words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features(text: str | None) -> set[str]:
    """w:word; p:beginning@n where n different words have it."""
    words, begins = _words(text), {}
    for w in words:
        for n in PREFIXES:
            if len(w) > n:
                begins[w[:n]] = begins.get(w[:n], 0) + 1
    return {f"w:{w}" for w in words} | {f"p:{p}@{n}" for p, c in begins.items() for n in REPEATS if c >= n}


@dataclass
class Model:
    voters: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -50.0

    def __post_init__(self):
        self.words = {v[2:]: k for k, v in enumerate(self.voters) if v[0] == "w"}
        self.begins: dict[int, dict[str, list[tuple[int, int]]]] = {}
        for k, v in enumerate(self.voters):
            if v[0] == "p":
                p, _, n = v[2:].rpartition("@")
                self.begins.setdefault(len(p), {}).setdefault(p, []).append((int(n), k))

    def votes(self, text: str | None) -> list[int]:
        words, out, counts = _words(text), [], {}
        out = [self.words[w] for w in words & self.words.keys()]
        for n, known in self.begins.items():
            for w in words:
                if w[:n] in known and len(w) > n:
                    counts[w[:n]] = counts.get(w[:n], 0) + 1
        for p, c in counts.items():
            out += [k for n, k in self.begins[len(p)][p] if c >= n]
        return sorted(out)


def _labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(y, text) of at most ``sample`` training rows: those with the smallest
    hash of their id. The id list is bounded, so it may be broadcast."""
    ids = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & (crc_bucket("doc_id", FOLDS) != 0)).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("y", "text")


def _mine(rows: DataFrame, voters: int) -> tuple[list[str], dict[int, int]]:
    def count(batches):
        totals: dict[tuple[str, int], int] = {}
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in features(text) | {"n:"}:
                    totals[f, y] = totals.get((f, y), 0) + 1
            if len(totals) > 200_000:
                yield _counts(totals)
                totals = {}
        yield _counts(totals)

    sums = rows.mapInArrow(lambda batches: trimmed(count(batches)), "feature string, y int, n long").groupBy("feature").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 1, 0).otherwise(F.col("n"))).alias("neg"))
    sums = written(sums, "features")
    total = sums.where("feature = 'n:'").first()
    if total is None or not total["pos"] or not total["neg"]:
        return [], {0: total["neg"] if total else 0, 1: total["pos"] if total else 0}
    base = total["pos"] / (total["pos"] + total["neg"])
    n, k, p = F.col("pos") + F.col("neg"), F.col("pos"), F.lit(base)
    gain = k * F.log(k / n / p) + F.col("neg") * F.when(F.col("neg") > 0, F.log(F.col("neg") / n / (1 - p))).otherwise(0.0)
    strong = sums.where("feature <> 'n:'").where(gain >= GAIN)
    chosen: list[str] = []
    for kind, most in ((k / n > F.greatest(F.lit(0.4), p), voters), (F.col("neg") / n > F.greatest(F.lit(0.6), 1 - p / 4), CLEAN_VOTERS if voters else 0)):
        found = strong.where(kind).orderBy(gain.desc(), F.col("feature").startswith("w:").desc(), F.length("feature").desc(), "feature").limit(40 * most).collect()
        own: dict[tuple, str] = {}
        for r in found:  # of features with the same counts and a common stem, the first stands for all
            own.setdefault((r["feature"][2:5], r["pos"], r["neg"]), r["feature"])
        chosen += list(own.values())[:most]
    return chosen, {0: total["neg"], 1: total["pos"]}


def _counts(totals: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f for f, _ in totals], pa.string()), pa.array([y for _, y in totals], pa.int32()), pa.array(list(totals.values()), pa.int64())], names=["feature", "y", "n"])


def with_votes(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and votes."""
    rows, at = beside(docs, text, keep)
    width = len(keep)

    def run(batches):
        for batch in sliced(batches):
            votes = [model.votes(x) for x in texts_of(batch, at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(votes, pa.list_(pa.int32()))], names=[*batch.schema.names[:width], "votes"])

    return rows.mapInArrow(lambda batches: trimmed(run(batches)), docs.select(*keep).schema.add("votes", T.ArrayType(T.IntegerType())))


def _matrix(votes: list[list[int]], n: int) -> np.ndarray:
    """Votes as a 0/1 matrix; the last column says that no voter fired."""
    out = np.zeros((len(votes), n + 1))
    for k, v in enumerate(votes):
        out[k, v if v else n] = 1
    return out


def _summed(patterns: DataFrame, step) -> np.ndarray | None:
    """The sum of the vectors that ``step(votes, n)`` gives for batches of the
    table (votes, n): added up in each task, then in 16 groups of tasks."""

    def run(batches):
        total = None
        for batch in batches:
            one = step(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float))
            total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def add(key, table):
        return pa.table({"sums": pa.array([sum(np.frombuffer(b) for b in sorted(table.column("sums").to_pylist())).tobytes()], pa.binary())})

    parts = patterns.select("votes", "n").mapInArrow(run, "sums binary").withColumn("part", F.spark_partition_id() % 16)
    blobs = [r["sums"] for r in parts.groupBy("part").applyInArrow(add, "sums binary").collect()]
    return sum(np.frombuffer(b) for b in sorted(blobs)) if blobs else None


class LabelModel:
    """Class prior, firing rates of each voter by class and by what its parent
    voter does: P(votes | class) is a product along a tree of pairs."""

    SMOOTH = 2.0

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.n = x.shape[1]
        self.anchor = self._stats(x, np.column_stack((1 - y, y)), np.ones(len(y)))
        self.parent = self._tree(self.anchor)
        self._fit(self.anchor)

    @staticmethod
    def _stats(x, post, weight):
        """Weights of the classes, of firing voters and of firing pairs."""
        p = post * weight[:, None]
        return np.concatenate((p.sum(axis=0), (p.T @ x).ravel(), *[((x * p[:, [c]]).T @ x).ravel() for c in (0, 1)]))

    def _split(self, flat):
        k = self.n
        return flat[:2], flat[2 : 2 + 2 * k].reshape(2, k), flat[2 + 2 * k :].reshape(2, k, k)

    def _tree(self, flat) -> np.ndarray:
        """The spanning tree of the largest mutual information given the class;
        -1 marks its root."""
        totals, fired, both = self._split(flat)
        info = np.zeros((self.n, self.n))
        for c in (0, 1):
            total = totals[c] + 4.0
            one = (fired[c] + 2.0) / total
            p11 = (both[c] + 1.0) / total
            for pair, a, b in ((p11, one[:, None], one[None]), (one[:, None] - p11, one[:, None], 1 - one[None]), (one[None] - p11, 1 - one[:, None], one[None]), (1 - one[:, None] - one[None] + p11, 1 - one[:, None], 1 - one[None])):
                pair = np.maximum(pair, 1e-12)
                info += totals[c] * pair * np.log(pair / np.maximum(a * b, 1e-12))
        parent, best, link = np.full(self.n, -1), info[0].copy(), np.zeros(self.n, int)
        inside = np.zeros(self.n, bool)
        inside[0] = True
        for _ in range(self.n - 1):
            k = int(np.where(inside, -np.inf, best).argmax())
            parent[k], inside[k] = link[k], True
            closer = info[k] > best
            best, link = np.where(closer, info[k], best), np.where(closer, k, link)
        return parent

    def _fit(self, flat) -> None:
        totals, fired, both = self._split(flat)
        self.prior = float(np.clip(totals[1] / totals.sum(), 1e-3, 1 - 1e-3))
        rate = (fired + 0.5) / (totals[:, None] + 1)
        up = np.maximum(self.parent, 0)
        pair = both[:, np.arange(self.n), up]
        on = (pair + self.SMOOTH * rate) / (fired[:, up] + self.SMOOTH)
        off = (fired - pair + self.SMOOTH * rate) / (totals[:, None] - fired[:, up] + self.SMOOTH)
        root = self.parent < 0
        #: P(fires | parent silent or firing, class)
        self.rates = np.clip(np.stack((np.where(root, rate, off), np.where(root, rate, on))), 1e-6, 1 - 1e-6)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        above = x[:, np.maximum(self.parent, 0)]
        z = np.full(len(x), np.log(self.prior / (1 - self.prior)))
        for b in (0, 1):
            held = above if b else 1 - above
            fire, silent = np.log(self.rates[b, 1] / self.rates[b, 0]), np.log((1 - self.rates[b, 1]) / (1 - self.rates[b, 0]))
            z += (held * x) @ fire + (held * (1 - x)) @ silent
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def refine(self, patterns: DataFrame, rounds: int = ROUNDS) -> None:
        """EM over the table (votes, n) of all documents; all of them together
        weigh as much as the labelled. The tree is chosen again once."""
        total = patterns.agg(F.sum("n")).first()[0] or 0
        if not total:
            return
        weight = float(self.anchor[:2].sum()) / total
        for k in range(rounds):
            model = self

            def step(votes, n, model=model):
                x = _matrix(votes, model.n - 1)
                p = model.posterior(x)
                return model._stats(x, np.column_stack((1 - p, p)), n)

            flat = self.anchor + weight * _summed(patterns, step)
            if not k:
                self.parent = self._tree(flat)
            self._fit(flat)


def _logistic(patterns: DataFrame, labeller: LabelModel, x: np.ndarray, y: np.ndarray, rounds: int = 12, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on the votes by Newton's method: the targets
    are the label model's posteriors of all documents, and the labelled rows
    (x, y), which weigh as much as all others together."""
    size = labeller.n
    total = patterns.agg(F.sum("n")).first()[0] or 0
    weight = len(y) / max(1, total)
    w = np.zeros(size)
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):

        def sums(x, target, n, w=w):
            a = np.column_stack((x[:, :-1], np.ones(len(x))))
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            return np.concatenate((a.T @ (n * (p - target)), ((a * (n * p * (1 - p))[:, None]).T @ a).ravel()))

        def step(votes, n, sums=sums):
            x = _matrix(votes, size - 1)
            return sums(x, labeller.posterior(x), n)

        flat = weight * _summed(patterns, step) + sums(x, y, np.ones(len(y)))
        move = np.linalg.solve(flat[size:].reshape(size, size) + np.diag(penalty), flat[:size] + penalty * w)
        w = w - np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, keep: list[str], text: str = "text", label: str = "toxic", sample: int = SAMPLE, voters: int = VOTERS) -> tuple[Model, DataFrame]:
    """Mines voters, refines the label model over all documents and trains the
    classifier on its posteriors. Returns the columns ``keep`` with their votes,
    as a written table, too."""
    rows = written(_labelled(docs.select("doc_id", F.col(text).alias("text")), labels, label, sample), "labelled")
    chosen, totals = _mine(rows, voters)
    base = totals[1] / max(1, totals[0] + totals[1])
    model = Model(chosen, np.zeros(len(chosen)), float(np.log((base + 1e-9) / (1 - base + 1e-9))))
    voted = written(with_votes(docs, model, keep, text), "votes")
    if chosen:
        marked = with_votes(rows, model, ["y"]).select("y", "votes").toArrow().to_pydict()  # bounded by sample
        x, y = _matrix(marked["votes"], len(chosen)), np.array(marked["y"], float)
        labeller = LabelModel(x, y)
        patterns = written(voted.groupBy("votes").agg(F.count("*").alias("n")), "patterns")
        if not patterns.isEmpty():
            labeller.refine(patterns)
            model = Model(chosen, *_logistic(patterns, labeller, x, y))
    return model, voted


def score(model: Model) -> Column:
    """The classifier's probability by the column ``votes``."""
    weights = F.array(*[F.lit(float(w)) for w in model.weights]) if len(model.weights) else F.array(F.lit(0.0))
    z = F.aggregate("votes", F.lit(float(model.bias)), lambda total, k: total + F.get(weights, k))
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    model, voted = learn(docs.select("doc_id", "text"), labels, ["doc_id"], **options)
    scored = voted.select("doc_id", score(model).alias("score"))
    return scored.select("doc_id", (crc_bucket("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``."""
    # positions, so that columns named votes or score stay apart
    place = docs.columns.index
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]).withColumnRenamed(f"c{place('doc_id')}", "doc_id")
    model, voted = learn(numbered, labels, numbered.columns, f"c{place('text')}", **options)
    return voted.where(score(model) < threshold).drop("votes").toDF(*docs.columns)
