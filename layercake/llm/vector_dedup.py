"""Near-duplicate embeddings by an exact join of 8-bit codes.

Two unit vectors have cosine >= t exactly if their squared distance is at most
2 - 2t.  The vectors are turned to their principal components (a rotation
changes no distance), and rounded to 8-bit codes.  The first ``block_dim``
components alone bound the distance from below, and they are the most varied
ones: two vectors are first compared in these, and what is left in all codes.
What may then still be linked is verified on the original vectors in double
precision.

All comparisons before the verification are integer comparisons with the
rounding error added to the radius, so no linked pair is lost.  A pair so close
that it is linked whatever the rounding is settled where it is met: the task
adds it to the counts of both vectors and joins their components, so a dense
cluster leaves one row a vector and pair of tiles, not its pairs.  Only pairs
near the limit are emitted for the verification.

Disk grows with the vectors, not with the pairs.  The vectors are dealt by the
sides of the means on which they lie in the first components, and their codes
cut into tiles of at most ``tile_rows``, heavy cells into several.  A tile is
one file of the shared folder, its rows ordered by median cuts into leaves with
a bounding box each.  Every two tiles meet once, read from their files: nothing
is sent.  Tiles, then leaves, whose boxes are farther apart than a linked pair
can be are passed over.  Equal vectors are brought together first and count
through their number.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing and stay; vectors of different lengths
do not link; repeated rows are linked rows; a null vec_id takes no part and
stays; a vec_id that names different vectors has the links of all of them; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layercake.llm.common import arrow_batches, connected_components, materialize, run_dir
from layercake.llm.token_files import _store
from layercake.llm.vectors import classes, matrix, usable

STEP = 1 / 127  # of the codes
LEAF_ROWS = 1024
TURNED = 128  # components; longer vectors are turned at random, which needs no covariances
ID_LIST = 1_000_000  # ids that are broadcast


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _radius(budget: float, components: int) -> int:
    """Largest squared code distance that a pair within ``budget`` can have."""
    return math.floor(((math.sqrt(budget) + 1e-9) / STEP + math.sqrt(components) + 1e-6) ** 2)


def _scaled(x: np.ndarray) -> np.ndarray:
    """The rows times powers of two, which is exact, so that no square is beyond a double."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(_unit(x) @ turn / STEP), -127, 127).astype(np.int8)


def _settled_radius(budget: float, dim: int) -> int:
    """Largest squared code distance that only pairs within ``budget`` have (-1: none)."""
    steps = (math.sqrt(budget) - 1e-6) / STEP - math.sqrt(dim)
    return math.floor(steps ** 2) if steps >= 0 else -1


def ordered(part: np.ndarray, rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows of ``part`` in leaves of at most ``rows``, cut at the
    median of the most varied component; and where the leaves start, and the end."""
    order, starts, todo = np.arange(len(part)), [], [(0, len(part))]
    while todo:
        s, e = todo.pop()
        if e - s <= rows:
            starts.append(s)
            continue
        own = part[order[s:e]]
        half = (e - s) // 2
        order[s:e] = order[s:e][np.argpartition(own[:, np.argmax(own.var(0))], half)]
        todo += [(s + half, e), (s, s + half)]
    return order, np.array([*sorted(starts), len(part)], np.int64)


def write_tile(path: str, first: int, reps: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """One file of a tile's vectors; returns their box."""
    order, starts = ordered(codes[:, :first].astype(np.float32))
    store, name = _store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        for x in (np.array([len(codes), len(starts)]), starts, reps[order], sizes[order], codes[order]):
            out.write(np.ascontiguousarray(x).tobytes())
    return np.stack([codes.min(0), codes.max(0)])


class Tile:
    """A tile file in memory, with the boxes of its leaves."""

    def __init__(self, path: str, dim: int, first: int):
        store, name = _store(path)
        with store.open_input_stream(name) as source:
            data = source.read()
        n, leaves = np.frombuffer(data, np.int64, 2).tolist()
        self.starts = np.frombuffer(data, np.int64, leaves, 16)
        self.reps, self.sizes = np.frombuffer(data, np.int64, 2 * n, 16 + 8 * leaves).reshape(2, n)
        self.codes = np.frombuffer(data, np.int8, n * dim, 16 + 8 * leaves + 16 * n).reshape(n, dim)
        self.low, self.high = (f.reduceat(self.codes, self.starts[:-1], axis=0).astype(np.float32)
                               for f in (np.minimum, np.maximum))
        # products of a left row and a right column: squared distances, negated; integers below 2^24: exact
        part = self.codes[:, :first].astype(np.float32)
        square = (part * part).sum(1, keepdims=True)
        self.left = np.hstack([2 * part, -square, np.full_like(square, -1)])
        self.right = np.ascontiguousarray(np.hstack([part, np.ones_like(square), square]).T)


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distances of a box from others."""
    gap = np.maximum(np.maximum(low - highs, lows - high), 0)
    return np.einsum("nd,nd->n", gap, gap)


def candidates(a: Tile, b: Tile, budget: float, pairs: int = 1 << 16):
    """Row pairs (of a, of b; each once if these are one tile) whose code distance
    allows a link, with that squared distance; in pieces."""
    dim, first = a.codes.shape[1], len(a.right) - 2
    cut, whole = _radius(budget, first), _radius(budget, dim)
    most = np.diff(a.starts).max(initial=0) * np.diff(b.starts).max(initial=0)
    products, hits = np.empty(most, np.float32), np.empty(most, bool)
    for k, (s, e) in enumerate(zip(a.starts[:-1], a.starts[1:])):
        close = _apart(a.low[k], a.high[k], b.low, b.high) <= whole
        if a is b:
            close[:k] = False
        for leaf in np.flatnonzero(close):
            t, u = b.starts[leaf], b.starts[leaf + 1]
            product, hit = (x[:(e - s) * (u - t)].reshape(e - s, u - t) for x in (products, hits))
            np.matmul(a.left[s:e], b.right[:, t:u], out=product)
            np.greater_equal(product, -cut, out=hit)
            lines = np.flatnonzero(hit.any(1))  # few
            if not len(lines):
                continue
            i, j = np.nonzero(hit[lines])
            i, j = lines[i] + s, j + t
            if a is b:
                i, j = i[i < j], j[i < j]
            for p in range(0, len(i), pairs):
                ii, jj = i[p:p + pairs], j[p:p + pairs]
                diff = a.codes[ii].astype(np.int32) - b.codes[jj]
                far = np.einsum("nd,nd->n", diff, diff)
                ok = far <= whole
                yield ii[ok], jj[ok], far[ok]


def unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of the nodes i and j; labels holds each node's smallest."""
    while len(i):
        li, lj = labels[i], labels[j]
        apart = li != lj
        i, j, li, lj = i[apart], j[apart], li[apart], lj[apart]
        np.minimum.at(labels, np.maximum(li, lj), np.minimum(li, lj))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _by_length(batches):
    """For each batch of (rep, size, embedding) and length of vectors in it: the
    length, reps, sizes and vectors."""
    for batch in batches:
        reps, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        dims = batch.column(2).value_lengths().to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            yield int(dim), reps[at], sizes[at], matrix(batch.column(2).take(pa.array(at)))


def _turns(vectors: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Of each length of vectors: their number, the rotation to their principal
    components, the most varied first, and the means of these in code steps."""
    def add(batches):
        sums: dict = {}
        for dim, _, _, x in _by_length(batches):
            u = _unit(x)
            products = [(u.T @ u).ravel()] if dim <= TURNED else []
            sums[dim] = sums.get(dim, 0) + np.concatenate([[len(u)], u.sum(0), *products])
        for dim, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["dim", "sums"])

    found: dict = {}
    for r in vectors.mapInArrow(add, "dim int, sums binary").collect():  # a row a task and length
        found[r["dim"]] = found.get(r["dim"], 0) + np.frombuffer(r["sums"])
    out = {}
    for dim, x in found.items():
        mean, turn = x[1:dim + 1] / x[0], rotation(dim)
        if dim <= TURNED:
            turn = np.linalg.eigh(x[dim + 1:].reshape(dim, dim) / x[0] - np.outer(mean, mean))[1][:, ::-1]
        out[dim] = int(x[0]), np.ascontiguousarray(turn), mean @ turn / STEP
    return out


def tiles(spark: SparkSession, vectors: DataFrame, first: int, tile_rows: int) -> dict[int, list[tuple[str, np.ndarray]]]:
    """The tiles of ``vectors`` (rep, size, embedding): their files and boxes by length."""
    arrow_batches(spark, 4096)
    vectors = vectors.select("rep", "size", "embedding")
    dealing, total = {}, 0
    for dim, (n, turn, mean) in _turns(vectors).items():
        rows = min(tile_rows, max(4096, n // 32))
        sides = min(dim, 30, math.ceil(math.log2(max(1, n / rows))))
        dealing[dim] = rows, turn, mean[:sides], 1 << np.arange(sides)
        total += n * (dim + 32)
    if not dealing:
        return {}

    def deal(batches):
        for dim, reps, sizes, x in _by_length(batches):
            _, turn, mean, weight = dealing[dim]
            c = codes(x, turn)
            cell = (c[:, :len(mean)] > mean) @ weight
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(dim), len(c), [None, pa.py_buffer(c.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(c), dim, np.int32)), pa.array(cell.astype(np.int32)), pa.array(reps),
                 pa.array(sizes), packed.cast(pa.binary())], ["dim", "cell", "rep", "size", "code"])

    folder = run_dir(spark, "vector_tiles")

    def save(batches):
        key, held, n = None, [], 0  # a tile's length and cell, the rows held of it, their number

        def written():
            dim = key[0]
            reps, sizes, packed = (pa.chunked_array(x).combine_chunks() for x in zip(*held))
            c = np.frombuffer(b"".join(packed.to_pylist()), np.int8).reshape(-1, dim)
            path = f"{folder}/{uuid.uuid4().hex}"
            box = write_tile(path, min(first, dim), reps.to_numpy(), sizes.to_numpy(), c)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([path]), pa.array([box.tobytes()], pa.binary())],
                                              ["dim", "path", "box"])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(2)], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(keys)]):
                now = tuple(keys[s].tolist())
                while s < e:
                    if held and (now != key or n == dealing[key[0]][0]):
                        yield written()
                        held, n = [], 0
                    key, most = now, min(e - s, dealing[now[0]][0] - n)
                    held.append([batch.column(k).slice(s, most) for k in (2, 3, 4)])
                    s, n = s + most, n + most
        if held:
            yield written()

    order = ["dim", "cell", "rep"]  # a heavy cell is split by its reps
    parts = max(spark.sparkContext.defaultParallelism, total >> 25)
    dealt = (vectors.mapInArrow(deal, "dim int, cell int, rep long, size long, code binary")
             .repartitionByRange(parts, *order).sortWithinPartitions(*order))
    index = materialize(dealt.mapInArrow(save, "dim int, path string, box binary"), spark, "vector_tiles_index")
    found: dict = {}
    for r in index.collect():  # a row a file
        found.setdefault(r["dim"], []).append((r["path"], np.frombuffer(r["box"], np.int8).reshape(2, 1, -1)))
    return found


def meetings(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95, block_dim: int = 24,
             tile_rows: int = 32768, settle: bool = True) -> DataFrame:
    """What the tiles propose among ``vectors`` (rep, size, embedding), all usable and different.

    Columns a, b, n.  n null: a pair a < b to be verified.  Else n is the number
    of rows (by ``size``) that vector a is surely linked with in two tiles, and b
    a vector of a's component.  Without ``settle`` all rows are pairs."""
    budget = 2 - 2 * cosine
    found = tiles(spark, vectors, block_dim, tile_rows)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def meet(a, b, dim):
        # the nodes of this pair: both tiles' rows, or the one tile's
        reps, ahead = (a.reps, 0) if a is b else (np.concatenate([a.reps, b.reps]), len(a.reps))
        labels, linked = np.arange(len(reps)), np.zeros(len(reps), np.int64)
        sure = _settled_radius(budget, dim) if settle else -1
        for i, j, far in candidates(a, b, budget):
            close = far <= sure
            u, v = i[close], j[close]
            np.add.at(linked, u, b.sizes[v])
            np.add.at(linked, v + ahead, a.sizes[u])
            unite(labels, u, v + ahead)
            u, v = a.reps[i[~close]], b.reps[j[~close]]
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)),
                                                  pa.nulls(len(u), pa.int64())], schema=schema)
        some = np.flatnonzero(linked)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(reps[labels[some]]),
                                              pa.array(linked[some])], schema=schema)

    def meet_others(batches):
        """A tile with some of the others: ``begin`` to ``end`` places on in a circle."""
        for batch in batches:
            for dim, at, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                own, first = found[dim], min(block_dim, dim)
                path, box = own[at]
                a = Tile(path, dim, first)
                for d in range(begin, end):
                    path, other = own[(at + d) % len(own)]
                    if _apart(*box.astype(np.float32), *other.astype(np.float32))[0] <= _radius(budget, dim):
                        yield from meet(a, Tile(path, dim, first) if d else a, dim)

    # each meets itself and the half of the others that follow it: each two meet once
    units = []
    for dim, own in found.items():
        step = max(1, len(own) // 8)
        for at in range(len(own)):
            last = len(own) // 2 - (len(own) % 2 == 0 and at >= len(own) // 2)
            units += [(dim, at, d, min(d + step, last + 1)) for d in range(0, last + 1, step)]
    arrow_batches(spark, 8)
    work = spark.createDataFrame(units, "dim int, at int, begin int, end int")
    work = work.repartition(max(2, min(len(units), 64 * spark.sparkContext.defaultParallelism)))
    return materialize(work.mapInArrow(meet_others, "a long, b long, n long"), spark, "vector_meetings")


def verified(spark: SparkSession, vectors: DataFrame, proposed: DataFrame, cosine: float = 0.95) -> DataFrame:
    """The pairs of ``proposed`` (a, b) whose vectors (rep, embedding) have that cosine."""
    arrow_batches(spark, 4096)
    ends = vectors.select("rep", "embedding")
    ids = materialize(proposed.select("a").union(proposed.select("b")).toDF("rep").distinct(), spark, "vector_ends")
    if ids.count() <= ID_LIST:  # few vectors lie near the limit: only they are sent
        ends = materialize(ends.join(F.broadcast(ids), "rep", "left_semi"), spark, "vector_near")
    sided = (proposed.join(ends.toDF("a", "va"), "a").join(ends.toDF("b", "vb"), "b").select("a", "b", "va", "vb"))

    def verify(batches):
        for batch in batches:
            va, vb = batch.column(2), batch.column(3)
            dims = va.value_lengths().to_numpy()
            for dim in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == dim))
                x, y = _scaled(matrix(va.take(at))), _scaled(matrix(vb.take(at)))
                c = np.einsum("nd,nd->n", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                yield pa.RecordBatch.from_arrays([batch.column(k).take(at).filter(pa.array(c >= cosine))
                                                  for k in (0, 1)], ["a", "b"])

    return materialize(sided.mapInArrow(verify, "a long, b long").distinct(), spark, "vector_links")


def links(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95, **options) -> DataFrame:
    """All linked pairs (a < b) of ``vectors`` (rep, embedding), all usable and
    different; a dense cluster has many, see ``dedup``."""
    vectors = vectors.withColumn("size", F.lit(1).cast("long"))
    return verified(spark, vectors, meetings(spark, vectors, cosine, settle=False, **options).select("a", "b"), cosine)


def _digest(vector: str) -> list[Column]:
    """128 bits that stand for a vector (to the hash -0 is 0, as it is when compared), so that vectors
    are not sent to be joined."""
    return [F.xxhash64(F.lit(seed), vector).alias(f"_h{seed}") for seed in (1, 2)]


def dedup(spark: SparkSession, vectors: DataFrame, cosine: float = 0.95, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding)."""
    vectors = vectors.select("vec_id", "embedding")
    good = usable() & F.col("vec_id").isNotNull()
    reps = materialize(classes(vectors.where(good)), spark, "vector_classes")
    met = meetings(spark, reps, cosine, **options)
    pairs = verified(spark, reps, met.where("n is null").select("a", "b"), cosine)
    settled = met.where("n is not null")
    sizes = reps.select("rep", "size")
    both = pairs.union(pairs.select("b", "a")).toDF("rep", "other")
    counts = both.join(sizes.toDF("other", "n"), "other").select("rep", "n").union(settled.select("a", "n"))
    linked = counts.groupBy("rep").agg(F.sum("n").alias("linked"))
    joined = settled.where("a <> b").select("a", "b").union(pairs)
    parts = connected_components(spark, joined, "vector_components").toDF("rep", "component")
    by_class = (reps.select("rep", "size", *_digest("embedding")).join(linked, "rep", "left").join(parts, "rep", "left")
                .select("_h1", "_h2", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n"),
                        F.coalesce("component", "rep").alias("component")))
    rows = vectors.select("vec_id", *(F.when(good, h).alias(f"_h{k}") for k, h in enumerate(_digest("embedding"), 1)))
    return (rows.join(by_class, ["_h1", "_h2"], "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
