"""Approximate nearest neighbours by robust-pruned directed graphs (Vamana,
Subramanya et al. 2019), one graph a shard.

Equal vectors are one node with its smallest k + 1 vec_ids, which is all that
a list of k neighbours can show of them.  Nodes are dealt to shards of about
``shard_rows`` by a hash, so a shard's build has bounded memory however many
rows there are.  Within a shard every node starts with random neighbours;
then, batch by batch, a greedy beam search from the medoid proposes
neighbours, and robust pruning keeps a candidate unless a kept one is
``alpha`` times closer to it than the node is; kept edges are added in
reverse, and overfull nodes pruned again.  A query runs a beam search on each
shard's graph, and the best of all shards are its answer.

Largest inner product becomes smallest distance by one more component,
sqrt(M^2 - |x|^2) with M the shard's largest norm, zero for queries.  Graphs
use 32-bit numbers, so the origin is moved by M along that component: what is
left of it, M - sqrt(M^2 - |x|^2), is small for small vectors, and one very long
vector does not blur its shard.  Searches compare inner products alone.  Scores
are inner products of the original vectors in double precision.

The index is a table in the shared folder, one row a shard; queries are packed
in blocks of ``block`` rows, and (block, shard) pairs are the units of work,
so neither side is ever held whole.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, neither as query nor as answer; ties go to
the smaller vec_id; a query has fewer than k answers only if there are fewer
candidates (of its own length); vectors of different lengths are searched
apart; repeated rows with one vec_id are that many candidates; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from layercake.llm.common import arrow_batches, materialize
from layercake.llm.vectors import classes, matrix, usable

SHARD_ROWS = 8192
DEGREE = 40
BEAM_BUILD = 64
BEAM = 128
ALPHA = 1.2
WIDTH = 4


def _distances(x: np.ndarray, squares: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances less |q|^2 of each query to its own row of ids."""
    return squares[ids] - 2 * np.einsum("qcd,qd->qc", x[ids], q, optimize=True)


def beam_search(x: np.ndarray, squares: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int,
                width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Node ids and distances (less |q|^2), nearest first, of the ``beam``
    nearest nodes that a greedy search finds for every row of ``q``; -1 where
    it found fewer."""
    n, rows = len(x), np.arange(len(q))[:, None]
    beam = min(beam, n)
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, [entry, n]] = True
    ids = np.full((len(q), beam), -1, np.int64)
    far = np.full((len(q), beam), np.inf, np.float32)
    ids[:, 0] = entry
    far[:, :1] = _distances(x, squares, q, np.full((len(q), 1), entry))
    expanded = np.ones((len(q), beam), bool)
    expanded[:, 0] = False
    active = np.arange(len(q))
    while len(active):
        # the nearest unexpanded nodes of each query still searching
        waiting = np.where(expanded[active], np.inf, far[active])
        pick = np.argpartition(waiting, min(width, beam) - 1, axis=1)[:, :min(width, beam)]
        open_ = np.isfinite(np.take_along_axis(waiting, pick, 1))
        go = open_.any(1)
        active, pick, open_ = active[go], pick[go], open_[go]
        if not len(active):
            break
        a = active[:, None]
        expanded[a, pick] = True
        near = np.where(open_[:, :, None], graph[np.maximum(ids[a, pick], 0)], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        near.sort(axis=1)
        fresh = ~seen[a, near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[a, near] = True
        # bring the fresh ones of each row to the front, to compare as few as needed
        most = int(fresh.sum(1).max())
        if not most:
            continue
        order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
        new = np.take_along_axis(near, order, 1)
        real = np.take_along_axis(fresh, order, 1)
        dist = np.where(real, _distances(x, squares, q[active], np.where(real, new, 0)), np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[active], np.where(real, new, -1)], 1)
        all_far = np.concatenate([far[active], dist], 1)
        all_exp = np.concatenate([expanded[active], ~real], 1)
        keep = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        ids[active], far[active] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_far, keep, 1)
        expanded[active] = np.take_along_axis(all_exp, keep, 1)
    order = np.argsort(far, axis=1, kind="stable")
    return ids[rows, order], far[rows, order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float,
                 chunk: int = 256) -> np.ndarray:
    """Pruned neighbour lists (-1 for none) of ``nodes`` among their candidate
    rows (-1 for none)."""
    out = np.full((len(nodes), degree), -1, np.int64)
    for s in range(0, len(nodes), chunk):
        p, c = nodes[s:s + chunk], candidates[s:s + chunk].copy()
        c.sort(axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        c[c == p[:, None]] = -1
        v = x[np.maximum(c, 0)]
        sq = np.einsum("bcd,bcd->bc", v, v)
        own = x[p]
        far = sq - 2 * np.einsum("bcd,bd->bc", v, own) + np.einsum("bd,bd->b", own, own)[:, None]
        far = np.where(c < 0, np.inf, np.maximum(far, 0))
        between = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
        rows = np.arange(len(p))
        alive = far.copy()
        for k in range(degree):
            best = alive.argmin(1)
            ok = np.isfinite(alive[rows, best])
            if not ok.any():
                break
            out[s:s + chunk][ok, k] = c[rows, best][ok]
            gone = alpha * alpha * between[rows, best] <= far
            alive[gone & ok[:, None]] = np.inf
            alive[rows, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM_BUILD, alpha: float = ALPHA, batch: int = 1024,
          seed: int = 0) -> tuple[np.ndarray, int]:
    """Graph (n x degree, -1 for none) and entry node."""
    n = len(x)
    rng = np.random.default_rng(seed)
    degree = max(1, min(degree, n - 1))
    graph = rng.integers(0, n, (n, degree))
    graph[graph == np.arange(n)[:, None]] = -1
    squares = np.einsum("nd,nd->n", x, x)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    for nodes in np.array_split(rng.permutation(n), max(1, -(-n // batch))):
        found, _ = beam_search(x, squares, graph, entry, x[nodes], beam)
        graph[nodes] = robust_prune(x, nodes, np.concatenate([found, graph[nodes]], 1), degree, alpha)
        # reverse edges: the nearest new ones of each node, pruned with what it has
        to, by = graph[nodes].ravel(), np.repeat(nodes, degree)
        to, by = to[to >= 0], by[to >= 0]
        d = ((x[to] - x[by]) ** 2).sum(1)
        order = np.lexsort((d, to))
        to, by = to[order], by[order]
        heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.empty(0, np.int64)
        place = np.arange(len(to)) - np.repeat(heads, np.diff(np.append(heads, len(to))))
        near = place < degree
        touched = to[heads]
        extra = np.full((len(touched), degree), -1, np.int64)
        extra[np.searchsorted(touched, to[near]), place[near]] = by[near]
        graph[touched] = robust_prune(x, touched, np.concatenate([graph[touched], extra], 1), degree, alpha)
    return graph.astype(np.int32), entry


def lifted(x: np.ndarray, moved: bool = False) -> np.ndarray:
    """Rows with the component that turns largest inner product into smallest
    distance; ``moved``: less that of a zero vector, without cancellation."""
    squares = np.einsum("nd,nd->n", x, x, dtype=np.float64)
    largest = squares.max(initial=0)
    more = np.sqrt(np.maximum(largest - squares, 0))
    if moved:
        more = -squares / np.maximum(np.sqrt(largest) + more, np.finfo(np.float64).tiny)
    return np.concatenate([x, more[:, None]], 1).astype(np.float32)


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> dict:
    return dict(np.load(io.BytesIO(data)))


def index(spark: SparkSession, vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
          beam: int = BEAM_BUILD, alpha: float = ALPHA) -> DataFrame:
    """The index of ``vectors`` (vec_id, embedding): dim, shard, shards, graph."""
    nodes = materialize(classes(vectors.where(usable() & F.col("vec_id").isNotNull()), k + 1)
                        .withColumn("dim", F.size("embedding")), spark, "ann_nodes")
    counts = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(counts, "dim").withColumn("shard", F.pmod(F.xxhash64("rep"), "shards").cast("int"))

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        column = lambda c: table.column(c).combine_chunks()
        x = matrix(column("embedding"))
        graph, entry = build(lifted(x, moved=True), degree, beam, alpha)
        members = column("members")
        data = _packed(x=x, graph=graph, entry=np.array(entry), members=members.flatten().to_numpy(),
                       starts=np.concatenate([[0], np.cumsum(members.value_lengths().to_numpy())]))
        first = table.slice(0, 1)
        return pa.table({"dim": first["dim"], "shard": first["shard"], "graph": pa.array([data], pa.binary())})

    # building takes far longer than moving: a partition a shard, however few bytes they are
    shards = int(counts.agg(F.sum("shards")).first()[0] or 1)
    rows = (dealt.select("dim", "shard", "rep", "embedding", "members").repartition(shards, "dim", "shard")
            .groupBy("dim", "shard")
            .applyInArrow(one, "dim int, shard int, graph binary"))
    return materialize(rows.join(counts, "dim"), spark, "ann_index")


def search(spark: SparkSession, found_index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM,
           block: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for ``queries``
    (vec_id, embedding)."""
    arrow_batches(spark, 4)
    asked = queries.where(usable() & F.col("vec_id").isNotNull()).select("vec_id", "embedding").distinct()
    asked = asked.withColumn("dim", F.size("embedding"))
    sizes = asked.groupBy("dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        data = _packed(q=matrix(table.column("embedding").combine_chunks()),
                       ids=table.column("vec_id").to_numpy())
        first = table.slice(0, 1)
        return pa.table({"dim": first["dim"], "block": first["block"], "asked": pa.array([data], pa.binary())})

    blocks = (asked.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
              .select("dim", "block", "vec_id", "embedding").groupBy("dim", "block")
              .applyInArrow(pack, "dim int, block int, asked binary"))
    shards = found_index.select("dim", "shards").distinct()
    pairs = (blocks.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .join(found_index.select("dim", "shard", "graph"), ["dim", "shard"])
             .select("asked", "graph"))

    def run(batches):
        for b in batches:
            for a, g in zip(b.column(0), b.column(1)):
                q, node = _unpacked(a.as_py()), _unpacked(g.as_py())
                x, starts, members = node["x"], node["starts"], node["members"]
                # all lifted norms are equal: the distance is that of the inner product
                ids, _ = beam_search(x.astype(np.float32), np.zeros(len(x), np.float32), node["graph"].astype(np.int64),
                                     int(node["entry"]), q["q"].astype(np.float32), max(beam, 2 * k))
                out = []
                for row, (me, near) in enumerate(zip(q["ids"], ids)):
                    near = near[near >= 0]
                    score = x[near] @ q["q"][row]
                    size = starts[near + 1] - starts[near]
                    vec = members[np.concatenate([np.arange(starts[i], starts[i + 1]) for i in near])]
                    score = np.repeat(score, size)[vec != me]
                    vec = vec[vec != me]
                    best = np.lexsort((vec, -score))[:k]
                    out.append((np.full(len(best), me), vec[best], score[best]))
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (pairs.repartition(max(1, spark.sparkContext.defaultParallelism * 2)).mapInArrow(
                run, "query_id long, vec_id long, score double")
            .withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, **options) -> DataFrame:
    """The k nearest found of every row where ``is_query`` holds, among all rows."""
    return search(spark, index(spark, vectors, k), vectors.where(is_query), k, **options)
