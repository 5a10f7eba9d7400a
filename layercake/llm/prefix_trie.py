"""Trie of conversation prefixes with subtree totals, by time-forward processing.

A conversation is a sequence of turns; every distinct sequence of first turns
is a node.  A node is named by the smallest conversation that begins with it
and its depth, so the nodes that one conversation names are a run of depths,
each the parent of the next, and a node's parent is named by two numbers.

Subtree totals (leaves, saved tokens) are passed upwards within shards: a
shard's nodes are sorted, outside of memory, by descending depth (reverse level
order), and each sends its totals to its parent through a priority queue that
spills, to be read when the parent comes (``settle``).  What leaves a shard is
the totals of its roots.

* Nodes with at most ``rows`` turns at or below them are light; a topmost light
  node and all below it lie in one shard.
* The heavy nodes above them take the light roots' totals, summed by parent.
  They are cut into shards of one conversation's nodes and ``rows`` depths, and
  settled by themselves; then the shards' roots pass their totals across the
  shards, by the same procedure over one row a shard; last, every heavy shard
  is settled again with what came from the shards below.

So a hot opening, a very long conversation and a large group of copies are all
cut.  The one pass that is not, that over the heavy shards' roots, has at most
one row for every ``rows`` turns and for every conversation that names a heavy
node; with n turns these are no more than about n * sqrt(2 / rows), reached
only where ever longer prefixes of one conversation are given, and the pass
keeps its memory bounded by spilling.

Sequences are told apart by the sum of 128 bits of SHA-256 of (place, turn)
over their turns, which running totals over ranges give for any length.

Defined results: rows with a null conv_id are no turn of any conversation; a
null role or text is empty; turns of equal number go by the digest of role and
text, repeated rows are repeated turns; no conversation, no node; conversations
without turns are members of the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm.common import materialize
from layercake.operators.windows import running_totals

ROWS = 256            # turns at or below a light node at most, and depths of a heavy shard, at least
SHARDS = 8192         # ``rows`` grows with the input, so that there are about so many heavy shards at most
MESSAGES = 1 << 17    # of a queue, in memory
IDS = 1 << 14         # conv_ids joined into one text at a time
WORD = r"[^\x20\x09-\x0D]+"

PREFIX = ["depth", "p0", "p1", "p2", "p3"]


class Queue:
    """Priority queue of (-depth, conv_id, n_children, n_leaves, saved) that
    keeps ``limit`` messages in memory and the rest as sorted runs in unnamed
    files of the task."""

    RECORD = struct.Struct("<5q")
    READ = 1024

    def __init__(self, limit: int = MESSAGES):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) >= self.limit:
            self._spill()

    def _spill(self) -> None:
        if len(self.runs) >= 64:  # few open files: all runs become one
            old, heads = self.runs, self.heads
            rest = [self._rest([row for row, k in heads if k == i], *run) for i, run in enumerate(old)]
            rows, self.heap, self.runs, self.heads = sorted(self.heap), [], [], []
            self._write(heapq.merge(rows, *rest))
            for f, _ in old:
                f.close()
        else:
            rows, self.heap = sorted(self.heap), []
            self._write(rows)

    def _write(self, rows) -> None:
        f, last = tempfile.TemporaryFile(), None
        for r in rows:
            if last is not None and last[:2] == r[:2]:
                last = (*r[:2], *(a + b for a, b in zip(last[2:], r[2:])))
                continue
            if last is not None:
                f.write(self.RECORD.pack(*last))
            last = r
        if last is not None:
            f.write(self.RECORD.pack(*last))
        f.seek(0)
        self.runs.append((f, iter(())))
        self._advance(len(self.runs) - 1)

    def _advance(self, i: int) -> None:
        f, rows = self.runs[i]
        row = next(rows, None)
        if row is None:
            data = f.read(self.RECORD.size * self.READ)
            rows = self.RECORD.iter_unpack(data)
            self.runs[i] = f, rows
            row = next(rows, None)
        if row is not None:
            heapq.heappush(self.heads, (row, i))

    def _rest(self, heads: list, f, rows):
        """What a run still has, its head included."""
        yield from heads
        yield from rows
        while data := f.read(self.RECORD.size * self.READ):
            yield from self.RECORD.iter_unpack(data)

    def take(self, depth: int, conv_id: int) -> tuple[int, int, int]:
        """Sum of the messages for a node; nodes must be asked for in queue order."""
        key, children, leaves, saved = (-depth, conv_id), 0, 0, 0
        while True:
            if self.heap and self.heap[0][:2] == key:
                r = heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][:2] == key:
                r, i = heapq.heappop(self.heads)
                self._advance(i)
            else:
                return children, leaves, saved
            children, leaves, saved = children + r[2], leaves + r[3], saved + r[4]


SETTLE = "conv_id long, depth long, up_conv long, up_depth long, inner boolean, n_children long, n_leaves long, saved long"


def settle(batches, limit: int = MESSAGES):
    """Totals of a shard's nodes.  Rows of (conv_id, depth, up_conv, up_depth,
    inner, n_children, n_leaves, saved) by descending depth, then conv_id: the
    parent (``inner``: in this shard), what has come from other shards, and the
    node's own value in ``saved``.  The same rows with the totals."""
    queue = Queue(limit)
    for batch in batches:
        conv, depth, up, up_depth, inner, *come = [c.to_pylist() for c in batch.columns]
        totals = [[], [], []]
        for i in range(len(conv)):
            children, leaves, saved = (a[i] + b for a, b in zip(come, queue.take(depth[i], conv[i])))
            if not children:
                leaves = 1
            for t, v in zip(totals, (children, leaves, saved)):
                t.append(v)
            if inner[i]:
                queue.push((-up_depth[i], up[i], 1, leaves, saved))
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], *(pa.array(t, pa.int64()) for t in totals)],
                                         batch.schema.names)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, said, words): the turns of each conversation by number,
    null first, from depth 1; ``said`` stands for role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    each = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    placed = running_totals(each, ["conv_id"], [F.asc_nulls_first("turn"), F.asc("said")],
                            {"depth": F.lit(1).cast("long")}, name="turns")
    return placed.select("conv_id", "depth", "said", "words")


def rebuild(spark: SparkSession, own: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: the first h turns of conversation c - c %
    ``group`` (all if it has fewer, none if it is absent), then its own after
    its first h; h = crc32(c as text) % ``heads``.  Returns the turns and the
    conversations (conv_id, length)."""
    own = materialize(own, spark, "own_turns")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("long")
    sizes = own.groupBy("conv_id").agg(F.max("depth").alias("n"))
    wanted = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    first = own.where((F.col("conv_id") % group == 0) & (F.col("depth") < heads)).withColumnRenamed("conv_id", "base")
    borrowed = wanted.join(first, "base").where("depth <= h").select("conv_id", "depth", "said", "words")
    taken = borrowed.groupBy("conv_id").agg(F.count("*").alias("taken"))
    shape = (wanted.join(taken, "conv_id", "left")
             .select("conv_id", "h", F.coalesce("taken", F.lit(0)).alias("taken"),
                     (F.coalesce("taken", F.lit(0)) + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    shape = materialize(shape, spark, "rebuilt")
    rest = (own.join(shape, "conv_id").where("depth > h")
            .select("conv_id", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "said", "words"))
    return materialize(borrowed.union(rest), spark, "rebuilt_turns"), shape.select("conv_id", "length")


def _lanes() -> list:
    digest = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), "said"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def prefixes(spark: SparkSession, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every turn with the numbers of the sequence that ends with it (p0 .. p3)
    and of the one before it (q0 .. q3), from turns (conv_id, depth, said,
    words) and all conversations (conv_id, length)."""
    named = turns.join(conversations, "conv_id").select("conv_id", "depth", "length", "words", *[
        c.alias(f"l{i}") for i, c in enumerate(_lanes())])
    summed = running_totals(named, ["conv_id"], [F.asc("depth")], {f"p{i}": F.col(f"l{i}") for i in range(4)},
                            name="running_prefixes")
    return materialize(summed.select("conv_id", "depth", "length", "words", *PREFIX[1:],
                                     *[(F.col(f"p{i}") - F.col(f"l{i}")).alias(f"q{i}") for i in range(4)]),
                       spark, "prefixes")


def trie(spark: SparkSession, at: DataFrame, conversations: DataFrame, rows: int | None = None) -> DataFrame:
    """One row for every node of the ``prefixes`` given and of all
    conversations (conv_id, length): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved (over the subtree: the words that nodes hold
    for their second and further conversations), p0 .. p3."""
    size = at.count()
    rows = rows or max(ROWS, size // SHARDS)
    members = conversations.agg(F.min("conv_id").alias("c"), F.count("*").alias("n")).first()
    grouped = at.groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        *[F.min(f"q{i}").alias(f"q{i}") for i in range(4)])
    grouped = materialize(grouped, spark, "nodes")
    above = grouped.select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
                           *[F.col(f"p{i}").alias(f"q{i}") for i in range(4)])
    step = ["depth", "q0", "q1", "q2", "q3"]
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "words", "weight", *PREFIX[1:]]
    deep = grouped.where("depth > 1").join(above, step).select(*columns)
    shallow = grouped.where("depth = 1").withColumn("parent_conv_id", F.lit(members.c).cast("long")).select(*columns)
    root = spark.createDataFrame([(members.c, 0, None, members.n, 0, size + 1, 0, 0, 0, 0)] if members.n else [],
                                 "conv_id long, depth long, parent_conv_id long, n_convs long, words long, "
                                 "weight long, p0 long, p1 long, p2 long, p3 long")
    nodes = materialize(root.union(shallow).union(deep), spark, "nodes")
    heavy = (F.col("weight") > rows) | (F.col("depth") == 0)

    # the topmost light node of each conversation's path: below its last heavy one
    over = nodes.where(heavy & (F.col("depth") > 0)).select(
        (F.col("depth") + 1).alias("depth"), *[F.col(f"p{i}").alias(f"q{i}") for i in range(4)])
    place = F.struct(*PREFIX)
    entered = at.where("depth = 1").select("conv_id", place.alias("top")).union(
        at.where("depth > 1").join(over, step).select("conv_id", place.alias("top")))
    tops = entered.groupBy("conv_id").agg(F.max("top").alias("top"))
    value = (F.col("n_convs") - 1) * F.col("words")
    zero = F.lit(0).cast("long")
    light = (nodes.where(~heavy).join(tops, "conv_id")
             .select("conv_id", "depth", F.col("parent_conv_id").alias("up_conv"),
                     (F.col("depth") - 1).alias("up_depth"), (F.col("depth") > F.col("top.depth")).alias("inner"),
                     zero.alias("n_children"), zero.alias("n_leaves"), value.alias("saved"), "top"))
    below = materialize(_settled(light, ["top"]), spark, "light_nodes")

    up = _summed(below.where("not inner"))
    came = ["n_children", "n_leaves", "saved"]
    band = F.floor(F.col("depth") / F.lit(rows)).cast("long")
    inner = (F.col("depth") > 0) & (F.col("parent_conv_id") == F.col("conv_id")) & (F.col("depth") % rows > 0)
    hub = (nodes.where(heavy).join(up, ["conv_id", "depth"], "left")
           .select("conv_id", "depth", F.col("parent_conv_id").alias("up_conv"), (F.col("depth") - 1).alias("up_depth"),
                   inner.alias("inner"), *[F.coalesce(c, zero).alias(c) for c in came[:2]],
                   (F.coalesce("saved", zero) + value).alias("saved"), band.alias("band")))
    hub = materialize(hub, spark, "heavy_nodes")
    cut = hub.where("not inner and depth > 0")
    children = cut.groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.count("*").alias("m"))
    first = _with(hub, children.select("conv_id", "depth", F.col("m").alias("n_children"), zero.alias("n_leaves"),
                                       zero.alias("saved")))
    # one row a heavy shard: its root, with the shard's own totals
    roots = materialize(_settled(first, ["conv_id", "band"]).where("not inner").withColumn("band", band), spark, "shard_roots")
    parents = roots.select(F.col("conv_id").alias("up_conv"), F.col("band").alias("up_band"),
                           F.col("depth").alias("root_depth"))
    across = (roots.withColumn("up_band", F.floor(F.col("up_depth") / F.lit(rows)).cast("long"))
              .join(parents, ["up_conv", "up_band"], "left")
              .select("conv_id", "depth", "up_conv", F.col("root_depth").alias("up_depth"),
                      (F.col("depth") > 0).alias("inner"), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved"))
    passed = materialize(across.repartition(1).sortWithinPartitions(F.desc("depth"), "conv_id")
                         .mapInArrow(settle, SETTLE), spark, "across_shards")
    came_up = (passed.select("conv_id", "depth", "n_leaves", "saved")
               .join(cut.select("conv_id", "depth", F.col("up_conv"), F.col("up_depth")), ["conv_id", "depth"])
               .withColumn("inner", F.lit(False)))
    last = _with(hub, _summed(came_up))
    above = _settled(last, ["conv_id", "band"])
    totals = below.select(*_TOTALS).union(above.select(*_TOTALS))
    return nodes.drop("words", "weight").join(totals, ["conv_id", "depth"])


_TOTALS = ["conv_id", "depth", "n_children", "n_leaves", "saved"]


def _settled(nodes: DataFrame, shard: list[str]) -> DataFrame:
    return (nodes.repartition(*shard).sortWithinPartitions(F.desc("depth"), "conv_id")
            .select("conv_id", "depth", "up_conv", "up_depth", "inner", *_TOTALS[2:]).mapInArrow(settle, SETTLE))


def _summed(roots: DataFrame) -> DataFrame:
    """What each parent gets from shard roots: (conv_id, depth, n_children, n_leaves, saved)."""
    return roots.groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _with(nodes: DataFrame, more: DataFrame) -> DataFrame:
    """``nodes`` with what ``more`` brings them added."""
    more = more.select("conv_id", "depth", *[F.col(c).alias(f"more_{c}") for c in _TOTALS[2:]])
    return nodes.join(more, ["conv_id", "depth"], "left").withColumns(
        {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("long")) for c in _TOTALS[2:]})


def _chunks(batches):
    """Rows of (prefix, conv_id) in order: each run of one prefix as texts of up to ``IDS`` ids."""
    names = [*PREFIX, "first", "ids"]
    kinds = [pa.int64()] * 6 + [pa.string()]
    key, first, ids = None, None, []
    for batch in batches:
        done = []
        for *k, c in zip(*[x.to_pylist() for x in batch.columns]):
            if k != key or len(ids) >= IDS:
                if ids:
                    done.append((*key, first, ",".join(ids)))
                key, first, ids = k, c, []
            ids.append(str(c))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done) if done else [[]] * 7, kinds)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, first, ",".join(ids)), kinds)], names)


def _digests(batches):
    """Rows of (prefix, first, ids) in order: the digest of each prefix's joined ids."""
    names = [*PREFIX, "digest"]
    kinds = [pa.int64()] * 5 + [pa.string()]
    key, h = None, None
    for batch in batches:
        done = []
        for *k, _, ids in zip(*[x.to_pylist() for x in batch.columns]):
            if k != key:
                if key is not None:
                    done.append((*key, h.hexdigest()))
                key, h = k, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done) if done else [[]] * 6, kinds)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, h.hexdigest()), kinds)], names)


def ends(at: DataFrame, conversations: DataFrame) -> DataFrame:
    """(prefix, conv_id) of every conversation's whole sequence."""
    zero = F.lit(0).cast("long")
    return at.where("depth = length").select(*PREFIX, "conv_id").union(
        conversations.where("length = 0").select(*[zero.alias(c) for c in PREFIX], "conv_id"))


def end_digests(found: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids that end at a prefix.
    Ranges of (prefix, conv_id) are joined into texts, which are hashed in
    order: a group of any size passes through, and is not held."""
    asc = [F.asc(c) for c in (*PREFIX, "conv_id")]
    chunks = (found.repartitionByRange(*asc).sortWithinPartitions(*asc)
              .mapInArrow(_chunks, ", ".join(f"{c} long" for c in (*PREFIX, "first")) + ", ids string"))
    order = [F.asc(c) for c in (*PREFIX, "first")]
    return (chunks.repartition(*PREFIX).sortWithinPartitions(*order)
            .mapInArrow(_digests, ", ".join(f"{c} long" for c in PREFIX) + ", digest string"))


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with the columns that ``turns`` (conv_id, depth, ...) has of their last turn; the root has none."""
    return nodes.join(turns, ["conv_id", "depth"], "left")
