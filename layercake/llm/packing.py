"""Best-fit packing of token pieces by a linear grouping scheme.

Each document becomes its ids and an end id; a longer one than a sequence is
cut into full pieces, the first of which may be shorter.  Pieces go into as
few sequences of ``capacity`` ids as the scheme finds:

1. The lengths are counted (at most ``capacity`` different ones, however many
   documents there are).  Only this histogram goes to the driver.
2. Large lengths, in descending order, are split into ``groups`` of equal
   cardinality, and each length counts as the largest of its group.
3. Configurations of those few sizes are chosen: the largest size left, and
   the subset of the other sizes that fills the sequence best (bounded subset
   sum), used as often as the counts allow.
4. Actual pieces take the places of their group.  What rounding left free
   stays known, as runs of sequences with equal room.
5. Small lengths go, longest first, into the run with the least sufficient
   room (best fit), and new sequences open only where none has room.

The plan is a list of runs (length, first rank, count, first sequence,
offset), whose size depends on capacity and groups, not on the number of
documents.  Pieces of one length are ranked within hash buckets of bounded
size, so a length that a third of all pieces share is spread over tasks.

Defined results: a null or empty text is its end id alone; equal texts are
packed separately; rows with equal doc_id are separate documents whose pieces
cannot be told apart; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from layercake.llm import tokens
from layercake.llm.common import arrow_batches, materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    arrow_batches(docs.sparkSession)

    def cut(batches):
        end = np.array([end_id], np.uint32)
        for b in batches:
            encoder, rows = tokens.load(tokenizer), []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate([encoder.ids(text or ""), end]).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(doc_id, k, s, e - s, zlib.crc32(ids[s:e].tobytes()))
                         for k, (s, e) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def _fill(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """Indices of the sizes (each at most ``left`` times) whose sum comes
    closest to ``room`` from below; large sizes first."""
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    by = np.full(room + 1, -1, np.int64)
    for j, s in enumerate(sizes):
        for _ in range(min(left[j], room // s)):
            new = np.zeros_like(reach)
            new[s:] = reach[:-s]
            new &= ~reach
            if not new.any():
                break
            by[new] = j
            reach |= new
        if reach[room]:
            break
    at, used = int(np.flatnonzero(reach)[-1]), []
    while at:
        used.append(int(by[at]))
        at -= sizes[used[-1]]
    return used


def plan(counts: dict[int, int], capacity: int, groups: int = 1000, small: int | None = None) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, count, first sequence, offset), sorted, and
    the number of sequences, for a histogram of lengths."""
    small = capacity // 8 if small is None else small
    runs: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(counts, 0)
    opened = 0
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)

    def give(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, taken[length], n, sequence, offset))
        taken[length] += n

    def leave(room: int, sequence: int, n: int) -> None:
        if room and n:
            rooms.setdefault(room, []).append((sequence, n))

    if counts.get(capacity):
        give(capacity, counts[capacity], 0, 0)
        opened = counts[capacity]
    large = sorted((x for x in counts if small < x < capacity and counts[x]), reverse=True)
    total = sum(counts[x] for x in large)
    # equal-cardinality groups: lists of [length, pieces of it], longest first
    share, members, sizes = -(-total // groups) if total else 0, [], []
    for x in large:
        n = counts[x]
        while n:
            if not members or sum(c for _, c in members[-1]) >= share:
                members.append([])
                sizes.append(x)
            part = min(n, share - sum(c for _, c in members[-1]))
            members[-1].append([x, part])
            n -= part
    left = [sum(c for _, c in m) for m in members]

    def substitute(used: list[int], times: int) -> None:
        """``times`` sequences of the groups ``used``, filled with actual pieces."""
        nonlocal opened
        while times:
            heads = []
            for g in used:
                if not any(g == h for h, _ in heads):
                    heads.append((g, used.count(g)))
            # as many sequences as have the same lengths throughout
            n = min([times, *(max(1, members[g][0][1] // k) for g, k in heads)])
            offset = 0
            for g, k in heads:
                for _ in range(k):
                    x = members[g][0][0]
                    give(x, n, opened, offset)
                    offset += x
                    members[g][0][1] -= n
                    if not members[g][0][1]:
                        members[g].pop(0)
            leave(capacity - offset, opened, n)
            opened += n
            times -= n

    for j in range(len(sizes)):
        while left[j]:
            own = left.copy()
            own[j] -= 1
            first = [i for i in range(j, len(sizes)) if own[i] and sizes[i] <= capacity - sizes[j]]
            used = [j] + [first[i] for i in _fill(capacity - sizes[j], [sizes[i] for i in first], [own[i] for i in first])]
            times = min(left[i] // used.count(i) for i in set(used))
            substitute(sorted(used), times)
            for i in used:
                left[i] -= times

    ordered = sorted(rooms)
    for x in sorted((x for x in counts if x <= small and x < capacity), reverse=True):
        n = counts[x]
        while n:
            at = bisect_left(ordered, x)
            if at == len(ordered):
                fresh = -(-n // (capacity // x))
                leave(capacity, opened, fresh)
                opened += fresh
                insort(ordered, capacity)
                continue
            room = ordered[at]
            sequence, there = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                ordered.pop(at)
            k = min(n, there)
            give(x, k, sequence, capacity - room)
            n -= k
            for rest, s, c in ((room, sequence + k, there - k), (room - x, sequence, k)):
                if rest and c:
                    if rest not in rooms:
                        insort(ordered, rest)
                    leave(rest, s, c)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), opened


def pack(spark: SparkSession, cut: DataFrame, capacity: int = 2048, groups: int = 1000,
         per_bucket: int = 50_000) -> DataFrame:
    """``cut`` (rows with doc_id, piece, length) with sequence_id and offset."""
    cut = materialize(cut, spark, "pieces")
    histogram = cut.groupBy("length").agg(F.count("*").alias("n"))
    counts = {int(r["length"]): int(r["n"]) for r in histogram.collect()}  # at most capacity rows
    runs, _ = plan(counts, capacity, groups)

    buckets = spark.createDataFrame([(x, -(-n // per_bucket)) for x, n in counts.items()] or [(0, 1)],
                                    "length long, buckets long")
    dealt = (cut.join(F.broadcast(buckets), "length")
             .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), "buckets")).drop("buckets"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(within).cast("long"))
    sizes = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket"))
                                               - F.col("n")).alias("before"))
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("rank") - 1 + F.col("before"))
    rows = ranked.select(*cut.columns, "rank")
    names = [*cut.columns, "sequence_id", "offset"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    keys = runs[:, 0] << 44 | runs[:, 1]

    def place(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                            for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(runs[at, 3] + rank - runs[at, 1]), pa.array(runs[at, 4])], names)

    return rows.mapInArrow(place, schema)
