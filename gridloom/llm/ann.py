"""Approximate nearest neighbours on robust-pruned directed graphs.

Distinct vectors are dealt to shards of bounded size, each of vectors whose
norms lie between two powers of two. In each shard a graph is built by batches:
a greedy beam search over the graph so far proposes neighbours, relaxed
distance pruning keeps a diverse few, and reverse edges are pruned where a node
has too many. Largest inner product becomes smallest Euclidean distance by one
more coordinate that lifts every vector to the norm of the shard's longest;
shards are scaled to that norm, so one very long vector costs the others no
precision. Queries, in blocks, beam-search every shard, and the shards' best
are merged; scores are inner products of the original vectors in double
precision.

Vectors that occur often stand in the graph once with their smallest ids: of
equal scores the smaller ids win, so no other id can be a result.

Defined results: null, zero, and vectors with null or non-finite components
take no part, nor do null ids; only vectors of one dimension are compared; with
fewer candidates than k, all are returned; repeated query rows are searched
once and answered once each; an empty table gives an empty one; extra columns
are ignored. A score too large for double precision is infinite.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Vectors of a shard: the first up to 2**16 vectors, then growing with the
#: square root of their number, the second at most.
SHARD_ROWS = (8192, 65536)
QUERY_BLOCK = 32768
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 32, 64, 128, 1.2
K = 20
STEP = 256


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled so that the longest row has length one, without overflow."""
    x = x / np.abs(x).max(initial=np.finfo(float).tiny)
    return x / max(np.sqrt(np.square(x).sum(axis=1)).max(initial=0), np.finfo(float).tiny)


def lifted(x: np.ndarray) -> np.ndarray:
    x = unit(x)
    return np.column_stack((x, np.sqrt(np.maximum(1 - np.square(x).sum(axis=1), 0)))).astype(np.float32)


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of each query's beam, nearest first; -1 where
    fewer were reached. All queries advance in step."""
    m, n = len(queries), len(x)
    norms = np.einsum("ij,ij->i", x, x)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True
    ids = np.full((m, beam), n, np.int64)
    dist = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    e = entries[:beam]
    ids[:, : len(e)], done[:, : len(e)] = e, False
    dist[:, : len(e)] = norms[e] - 2 * queries @ x[e].T
    seen[:, e] = True
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist, done = (np.take_along_axis(a, order, 1) for a in (ids, dist, done))
    active = np.arange(m)
    while len(active):
        open_ = ~done[active]
        active = active[open_.any(axis=1)]
        if not len(active):
            break
        rank = np.argsort(done[active], axis=1, kind="stable")[:, :width]  # first the open ones, nearest first
        fresh = ~np.take_along_axis(done[active], rank, 1)
        node = np.where(fresh, np.take_along_axis(ids[active], rank, 1), n)
        done[active[:, None], rank] = True
        near = np.where(node[:, :, None] < n, graph[np.minimum(node, n - 1)], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near = np.where(seen[active[:, None], near], n, near)
        seen[active[:, None], near] = True
        safe = np.minimum(near, n - 1)
        d = norms[safe] - 2 * np.matmul(x[safe], queries[active][:, :, None])[:, :, 0]
        d[near == n] = np.inf
        all_d = np.concatenate((dist[active], d), axis=1)
        keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        kept = np.take_along_axis(all_d, keep, 1)
        inner = np.argsort(kept, axis=1, kind="stable")
        keep = np.take_along_axis(keep, inner, 1)
        dist[active] = np.take_along_axis(kept, inner, 1)
        ids[active] = np.take_along_axis(np.concatenate((ids[active], near), axis=1), keep, 1)
        done[active] = np.take_along_axis(np.concatenate((done[active], near == n), axis=1), keep, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours for each node: a candidate falls to a kept nearer one
    that is ``alpha`` times closer to it than the node is."""
    safe = np.where(candidates < 0, 0, candidates)
    vec, own = x[safe], x[nodes]
    d = np.square(vec - own[:, None]).sum(axis=2)
    d[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    candidates, d, vec = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(vec, order[:, :, None], 1)
    sq = np.square(vec).sum(axis=2)
    mutual = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(vec, vec.transpose(0, 2, 1))
    alive = np.isfinite(d)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    out, rows, filled = np.full((len(nodes), degree), -1, np.int64), np.arange(len(nodes)), np.zeros(len(nodes), int)
    for _ in range(degree):
        rows = rows[alive[rows].any(axis=1)]
        if not len(rows):
            break
        first = alive[rows].argmax(axis=1)
        out[rows, filled[rows]] = candidates[rows, first]
        filled[rows] += 1
        alive[rows] &= alpha * alpha * mutual[rows, first] > d[rows]
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) over lifted vectors."""
    n, rng = len(x), np.random.default_rng(seed)
    graph = np.full((n, degree), -1, np.int64)
    centre = int(np.square(x - x.mean(axis=0)).sum(axis=1).argmin())
    order = rng.permutation(n)
    order = np.concatenate(([centre], order[order != centre]))
    entries = order[: min(n, 8)]
    at = 1
    while at < n:
        batch = order[at : at + min(STEP, max(1, at))]
        found, _ = beam_search(x, graph, entries[: max(1, min(len(entries), at))], x[batch], beam)
        graph[batch] = robust_prune(x, batch, found, degree, alpha)
        to = graph[batch]
        src, dst = np.repeat(batch, degree)[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
        _link_back(x, graph, src, dst, degree, alpha)
        at += len(batch)
    return graph, entries


def _link_back(x, graph, src, dst, degree, alpha) -> None:
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
    width = int(count.max()) if len(count) else 0
    extra = np.full((len(nodes), width), -1, np.int64)
    extra[np.repeat(np.arange(len(nodes)), count), np.arange(len(dst)) - np.repeat(start, count)] = src
    room = (graph[nodes] < 0).sum(axis=1)
    fits = count <= room
    for k in np.flatnonzero(fits):
        free = degree - room[k]
        graph[nodes[k], free : free + count[k]] = extra[k, : count[k]]
    full = np.flatnonzero(~fits)
    by_width = full[np.argsort(count[full], kind="stable")]
    for part in np.array_split(by_width, max(1, -(-len(by_width) // STEP))):
        if len(part):
            graph[nodes[part]] = robust_prune(x, nodes[part], np.concatenate((graph[nodes[part]], extra[part, : count[part].max()]), axis=1), degree, alpha)


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    fine = F.forall("embedding", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & F.exists("embedding", lambda v: v != 0)
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def norm_band(embedding: str) -> Column:
    """floor(log2(norm)), whatever the components' size."""
    most = F.array_max(F.transform(embedding, lambda v: F.abs(v.cast("double"))))
    square = F.aggregate(embedding, F.lit(0.0), lambda total, v: total + (v / most) * (v / most))
    return F.floor(F.log2(most) + F.log2(square) / 2).cast("int")


def index(rows: DataFrame, k: int, shard_rows: int) -> DataFrame:
    """dim, shard and the shard's vectors, ids and graph, written."""
    few = rows.withColumn("turn", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("turn") <= k + 1)
    classes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = written(classes.select(F.size("embedding").alias("dim"), norm_band("embedding").alias("band"), "embedding", "ids"), "classes")
    # a shard's number tells its band; there are some thousand bands at most
    bands = classes.groupBy("dim", "band").agg(F.ceil(F.count("*") / shard_rows).alias("parts"))
    number = F.concat_ws(":", "band", F.pmod(F.xxhash64("embedding"), F.col("parts")))
    dealt = classes.join(F.broadcast(bands), ["dim", "band"]).select("dim", number.alias("shard"), "embedding", "ids")

    def run(key, table):
        x = _stack(table.column("embedding"))
        ids = table.column("ids").combine_chunks()
        graph, entries = build(lifted(x))
        blobs = [x, ids.flatten().to_numpy().astype(np.int64), np.diff(ids.offsets.to_numpy()).astype(np.int32), graph.astype(np.int32), entries.astype(np.int32)]
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.string()), **{n: pa.array([b.tobytes()], pa.binary()) for n, b in zip(("vectors", "ids", "sizes", "graph", "entries"), blobs, strict=True)}})

    return written(dealt.groupBy("dim", "shard").applyInArrow(run, "dim int, shard string, vectors binary, ids binary, sizes binary, graph binary, entries binary"), "graphs")


def _search(key, table, graphs):
    empty = pa.table({"qid": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not len(graphs) or not len(table):
        return empty
    one = {c: graphs.column(c)[0].as_py() for c in ("vectors", "ids", "sizes", "graph", "entries")}
    x = np.frombuffer(one["vectors"]).reshape(-1, key[0].as_py())
    sizes = np.frombuffer(one["sizes"], np.int32)
    ids, first = np.frombuffer(one["ids"], np.int64), np.concatenate(([0], np.cumsum(sizes)))
    graph = np.frombuffer(one["graph"], np.int32).reshape(len(x), -1).astype(np.int64)
    entries = np.frombuffer(one["entries"], np.int32)
    high, k = lifted(x), table.column("k")[0].as_py() + 1
    qid, q = table.column("qid").to_numpy(), _stack(table.column("embedding"))
    out = [[], [], []]
    for lo in range(0, len(q), STEP):
        part = q[lo : lo + STEP]
        ways = np.concatenate([unit(p[None]) for p in part])
        found, _ = beam_search(high, graph, entries, np.column_stack((ways, np.zeros(len(part)))).astype(np.float32), max(SEARCH_BEAM, 2 * k))
        for row, hits in enumerate(found):
            hits = hits[hits >= 0]
            with np.errstate(over="ignore", invalid="ignore"):
                score = (x[hits] * part[row]).sum(axis=1)
            who = np.concatenate([ids[:0], *[ids[first[h] : first[h + 1]] for h in hits]])
            score = np.repeat(score, sizes[hits])
            best = np.lexsort((who, -score))[:k]
            out[0].append(np.full(len(best), qid[lo + row]))
            out[1].append(who[best])
            out[2].append(score[best])
    return pa.table({"qid": np.concatenate(out[0]), "vec_id": np.concatenate(out[1]), "score": np.concatenate(out[2])})


def nearest(vectors: DataFrame, query_ids, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, shard_rows: int | None = None, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. ``query_ids`` is a condition on the
    column vec_id that names the queries. Every query is searched in every
    shard: the cost is queries x shards x one beam search."""
    rows = valid(vectors, vec_id, embedding)
    queries = rows.where(query_ids)
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(query_ids, 1)).alias("q")).first()
    blocks = max(1, -(-counts["q"] // query_block))
    graphs = index(rows, k, shard_rows or int(min(SHARD_ROWS[1], SHARD_ROWS[0] * max(1.0, (counts["n"] / (1 << 16)) ** 0.5))))
    asked = written(queries.groupBy("embedding").agg(F.min("vec_id").alias("qid")), "queries")
    spread = asked.select(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int").alias("block"), "qid", "embedding", F.lit(k).alias("k"))
    # names only, one for 8,192 vectors or more
    spread = spread.join(F.broadcast(graphs.select(F.col("dim").alias("d"), F.col("shard").alias("part"))), F.col("dim") == F.col("d")).drop("d")
    many = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = spread.groupBy("dim", "part", "block").cogroup(many.groupBy("dim", "shard", "block")).applyInArrow(_search, "qid long, vec_id long, score double")
    best = lambda key: Window.partitionBy(key).orderBy(F.col("score").desc(), "vec_id")
    top = found.withColumn("turn", F.row_number().over(best("qid"))).where(F.col("turn") <= k + 1).drop("turn")
    mine = queries.join(asked, "embedding").select(F.col("vec_id").alias("query_id"), "qid")
    pairs = mine.join(top, "qid").where("vec_id <> query_id")
    # one row of a class comes after its k + 1 best, so the list per query is short
    pairs = pairs.withColumn("rank", F.row_number().over(best("query_id")).cast("int")).where(F.col("rank") <= k)
    return pairs.select("query_id", "rank", "vec_id", "score")
