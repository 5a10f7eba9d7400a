"""Benchmark decontamination by a distributed positional inverted index.

The index (``postings``) stores the places of every training term, block of
documents by block.  A test item is cut into windows of ``n`` words; a window
is looked up by intersecting, rarest term first, the places of its terms, each
list moved back by the term's offset in the window (``phrases``).
``near`` finds documents in which a window's terms stand close together in any
order, from the same lists.

The windows are dealt into blocks of a bounded number by the hash of their
content; one block after the other goes to the tasks that read the index (a
stated query set against all rows, in blocks).  Only documents with a hit leave
those tasks.  Each document is whole within one block of the index, so no match
is cut, and documents never share a task by what they contain.

Defined results: null and wordless texts and items have no words, so no window
and no hit; an item of fewer than ``n`` words is one window; items of equal text
hit alike; repeated rows on either side are rows of their own (an item_id that
comes twice counts once a document); null doc_ids are kept, a null item_id hits
words but is no named item; empty tables give no hits; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm import postings
from layercake.llm.common import arrow_batches, materialize

WINDOWS = 1 << 17       # windows of a block, about: 80 bytes each for 10 words
CANDIDATES = 1 << 20    # places looked at together


def _cut(batches, n: int):
    for batch in batches:
        keys, contents, ids = [], [], []
        for item_id, terms in zip(batch.column(0).to_pylist(), postings.terms_of(batch.column(1))):
            for k in range(max(len(terms) - n + 1, min(len(terms), 1))):
                content = terms[k:k + n].tobytes()
                keys.append(hashlib.blake2b(content, digest_size=16).digest())
                contents.append(content)
                ids.append(item_id)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(contents, pa.binary()),
                                          pa.array(ids, pa.string())], ["window", "content", "item_id"])


def windows(spark: SparkSession, items: DataFrame, n: int) -> DataFrame:
    """(window, content, item_id as text) of every distinct pair of the items' windows of ``n`` words."""
    arrow_batches(spark)
    cut = items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        lambda b: _cut(b, n), "window binary, content binary, item_id string")
    return materialize(cut.distinct(), spark, "windows")


class Phrases:
    """A block of windows: their keys and their terms, shorter ones filled up."""

    def __init__(self, keys: list[bytes], contents: list[bytes]):
        self.keys = keys
        sizes = np.array([len(c) // 8 for c in contents], np.int64)
        self.sizes, width = sizes, int(sizes.max())
        flat = np.frombuffer(b"".join(contents), np.uint64)
        self.terms, number = np.unique(flat, return_inverse=True)
        self.number = np.full((len(keys), width), -1, np.int64)
        self.number[np.arange(width) < sizes[:, None]] = number

    def lists(self, block: postings.Block):
        """Windows all of whose terms the block has, with the lists of their
        terms, rarest first (offset within the window, number in the block, length)."""
        at, count = block.find(self.terms)
        length = np.where(self.number >= 0, count[self.number], np.iinfo(np.int64).max)
        live = np.flatnonzero(length.min(axis=1) > 0) if len(self.terms) else np.empty(0, np.int64)
        length = length[live]
        offset = np.argsort(length, axis=1, kind="stable")
        number = np.take_along_axis(self.number[live], offset, 1)
        return live, offset, np.where(number >= 0, at[number], -1), np.take_along_axis(length, offset, 1)

    def find(self, block: postings.Block):
        """(window, first place) of every occurrence within one document."""
        live, offset, at, length = self.lists(block)
        if not len(live):
            return
        # all (term, place) of the block in one ascending list
        held = (np.repeat(np.arange(len(block.terms)), np.diff(block.starts)) << 32) | block.places
        for s, e in _slices(length[:, 0], CANDIDATES):
            of, k = postings.expand(block.starts[at[s:e, 0]], length[s:e, 0])
            of += s
            start = block.places[k] - offset[of, 0]
            of, start = of[start >= 0], start[start >= 0]
            for j in range(1, offset.shape[1]):
                wanted = (at[of, j] << 32) | (start + offset[of, j])
                found = held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted
                found |= at[of, j] < 0
                of, start = of[found], start[found]
            last = start + self.sizes[live[of]] - 1
            whole = (last < len(held)) & (block.document(start) == block.document(np.minimum(last, len(held) - 1)))
            yield live[of[whole]], start[whole]

    def close(self, block: postings.Block, span: int):
        """(window, first place, place after the last) of the shortest run of at
        most ``span`` words of one document around every place of the window's
        rarest term that holds all its terms (a term that it repeats, once)."""
        live, offset, at, length = self.lists(block)
        held = (np.repeat(np.arange(len(block.terms)), np.diff(block.starts)) << 32) | block.places
        for s, e in _slices(length[:, 0], CANDIDATES // 16) if len(live) else ():
            of, k = postings.expand(block.starts[at[s:e, 0]], length[s:e, 0])
            of += s
            rarest = block.places[k]
            doc = block.document(rarest)
            low = np.concatenate([[0], block.ends])[doc]
            high = block.ends[doc]
            best = np.full(len(of), np.iinfo(np.int64).max)
            begin = rarest.copy()
            for back in range(span):  # the run's first place, so many before the rarest term
                first = rarest - back
                last = rarest.copy()
                ok = first >= low
                for j in range(1, offset.shape[1]):
                    wanted = (at[of, j] << 32) | np.maximum(first, 0)
                    i = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                    here = (held[i] >> 32 == at[of, j]) & (held[i] >= wanted)
                    place = held[i] & 0xFFFFFFFF
                    used = at[of, j] >= 0
                    ok &= ~used | (here & (place < np.minimum(high, first + span)))
                    last = np.where(used & here, np.maximum(last, place), last)
                size = np.where(ok & (last - first < span), last - first + 1, np.iinfo(np.int64).max)
                begin = np.where(size < best, first, begin)
                best = np.minimum(best, size)
            found = best <= span
            yield live[of[found]], begin[found], (begin + best)[found]


def _slices(weights: np.ndarray, most: int):
    """Ranges of rows whose weights sum to about ``most``; one row at least."""
    total, s = np.cumsum(weights), 0
    while s < len(weights):
        e = max(s + 1, int(np.searchsorted(total, (total[s - 1] if s else 0) + most, "right")))
        yield s, e
        s = e


def _merge(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges, ascending."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _match(batches, shared, span: int | None):
    phrases = shared.value
    for batch in batches:
        out = {c: [] for c in ("uid", "windows", "begins", "ends")}
        for row in batch.to_pylist():
            block = postings.Block(row)
            found = phrases.find(block) if span is None else phrases.close(block, span)
            parts = [(p[0], p[1], p[1] + phrases.sizes[p[0]] if span is None else p[2]) for p in found]
            if not parts:
                continue
            window, begin, end = (np.concatenate(x) for x in zip(*parts))
            doc = block.document(begin)
            order = np.argsort(doc, kind="stable")
            window, begin, end, doc = window[order], begin[order], end[order], doc[order]
            edges = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                head = int(block.ends[doc[s]] - block.n_words[doc[s]])
                b, f = _merge(begin[s:e], end[s:e])
                out["uid"].append(int(block.uids[doc[s]]))
                out["windows"].append([phrases.keys[w] for w in np.unique(window[s:e]).tolist()])
                out["begins"].append((b - head).tolist())
                out["ends"].append((f - head).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["uid"], pa.int64()), pa.array(out["windows"], pa.list_(pa.binary())),
             pa.array(out["begins"], pa.list_(pa.int64())), pa.array(out["ends"], pa.list_(pa.int64()))], list(out))


def _hits(spark: SparkSession, index: DataFrame, cut: DataFrame, span: int | None) -> DataFrame:
    """(uid, windows, begins, ends) for every document with hits and block of windows."""
    arrow_batches(spark, 16)
    distinct = cut.select("window", "content").dropDuplicates(["window"])
    blocks = max(1, -(-distinct.count() // WINDOWS))
    placed = distinct.withColumn("block", F.pmod(F.hash("window"), F.lit(blocks)))
    out = None
    for k in range(blocks):  # each of a bounded number of windows, one at a time
        rows = placed.where(F.col("block") == k).select("window", "content").collect()
        if not rows:
            continue
        rows.sort(key=lambda r: bytes(r[0]))
        shared = spark.sparkContext.broadcast(Phrases([bytes(r[0]) for r in rows], [bytes(r[1]) for r in rows]))
        found = index.mapInArrow(lambda b, shared=shared: _match(b, shared, span),
                                 "uid long, windows array<binary>, begins array<long>, ends array<long>")
        out = materialize(found, spark, "phrase_hits") if out is None else out.union(materialize(found, spark, "phrase_hits"))
    if out is None:
        out = spark.createDataFrame([], "uid long, windows array<binary>, begins array<long>, ends array<long>")
    return out


def _items(hits: DataFrame, cut: DataFrame) -> DataFrame:
    """(uid, item_id) of every item with a hit in the document."""
    return (hits.select("uid", F.explode("windows").alias("window")).join(cut.select("window", "item_id"), "window")
            .where("item_id is not null").select("uid", "item_id").distinct())


def _spans(hits: DataFrame) -> DataFrame:
    """(uid, spans): the hit words of a document as ascending, disjoint ranges."""
    each = F.arrays_zip("begins", "ends")
    merged = F.expr("""aggregate(spans, cast(array() as array<struct<begins:bigint,ends:bigint>>), (a, x) ->
        if(size(a) > 0 and element_at(a, -1).ends >= x.begins,
           concat(slice(a, 1, size(a) - 1), array(named_struct('begins', element_at(a, -1).begins,
                  'ends', greatest(element_at(a, -1).ends, x.ends)))), concat(a, array(x))))""")
    one = F.when(F.col("n") == 1, F.col("spans")).otherwise(merged)  # a task has merged its own
    return (hits.groupBy("uid").agg(F.array_sort(F.flatten(F.collect_list(each))).alias("spans"), F.count("*").alias("n"))
            .select("uid", one.alias("spans")))


def matches(spark: SparkSession, index: DataFrame, items: DataFrame, n: int = 10, span: int | None = None) -> DataFrame:
    """What of ``items`` (item_id, text) stands in the indexed documents: one
    row for every document with a hit, (uid, doc_id, spans, item_ids): the hit
    words as ranges of word numbers, and the items, sorted as text.

    ``span`` None: exact phrases, every window of ``n`` words.  Else proximity:
    all words of a window within ``span`` consecutive words, in any order.
    """
    cut = windows(spark, items, n)
    hits = _hits(spark, index, cut, span)
    named = _items(hits, cut).groupBy("uid").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    docs = postings.documents(index).select("uid", "doc_id")
    return (docs.join(_spans(hits), "uid").join(named, "uid", "left")
            .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>"))))


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """One row for every document: doc_id, n_words, spans (hit words), item_ids
    (items of which a window of ``n`` words occurs)."""
    index = postings.build(spark, docs)
    found = matches(spark, index, items, n).drop("doc_id")
    return (postings.documents(index).join(found, "uid", "left")
            .select("doc_id", "n_words",
                    F.coalesce("spans", F.array().cast("array<struct<begins:bigint,ends:bigint>>")).alias("spans"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))
