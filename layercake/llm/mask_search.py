"""Ranked lexical search by presence masks over an inverted index.

Documents lie in the blocks of a ``postings`` index.  For an item, every
document of a block has a mask, one bit for each of the item's terms that it
holds; the bitmaps of the terms group the documents by mask.  A mask's maximum
score is the sum, over its terms, of the weight times the largest impact that
the term has in the block.  Distinct masks are taken by descending maximum, and
only their documents are scored; a block is finished once no mask left can
reach the item's k-th best score, which a task carries from block to block.
Masks whose maximum equals that score are still looked at, so ties stay exact.

The score is that of the term weights and impacts stated at ``weight`` and
``impacts``, in whole numbers.

The items are dealt into blocks of a bounded number of terms, which go to the
tasks one after the other (a stated query set against all rows, in blocks); a
task returns k rows an item, whatever the number of documents.

Defined results: items without terms, or none of whose terms occurs, have no
row; repeated items are ranked each on their own; repeated documents are ranked
each on their own; equal scores go by doc_id, null first; null texts have no
terms and do not count; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from layercake.llm import postings
from layercake.llm.common import arrow_batches, materialize

TERMS = 1 << 16       # terms of a block of items, about
CELLS = 1 << 22       # impacts held together: documents x terms of some items


def weight(df: int, n_documents: int) -> int:
    """Weight of a term that ``df`` of ``n_documents`` documents hold."""
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What a term that stands ``tf`` times in a document of ``n`` terms gives for each unit of weight."""
    m = 100 - 75 + (75 * n * n_documents) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """Some items: the terms of all, and of each its terms, how often it has them, and weights."""

    def __init__(self, uids: list[int], texts: list[np.ndarray]):
        self.uids = uids
        self.terms, number = np.unique(np.concatenate(texts), return_inverse=True)
        self.own, at = [], 0
        for t in texts:
            self.own.append(np.unique(number[at:at + len(t)], return_counts=True))
            at += len(t)
        self.weights = np.zeros(len(self.terms), np.int64)

    def parts(self, documents: int = postings.DOCUMENTS):
        """Ranges of items whose terms, times a block's documents, stay within ``CELLS``."""
        s, held = 0, 0
        for e, (terms, _) in enumerate(self.own):
            if e > s and held + len(terms) > max(CELLS // documents, 1):
                yield s, e
                s, held = e, 0
            held += len(terms)
        if s < len(self.own):
            yield s, len(self.own)


class Best:
    """The k best of an item so far: score descending, doc_id ascending (null first), uid."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores, doc_ids, uids) -> None:
        self.rows += zip((-scores).tolist(), doc_ids, uids)
        if len(self.rows) > self.k:
            self.rows = heapq.nsmallest(self.k, self.rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
        if len(self.rows) == self.k:
            self.least = max(1, -max(r[0] for r in self.rows))


def masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a bitmap (documents x terms) and, of each document, which it has."""
    bits = np.packbits(present, axis=1)
    if bits.shape[1] <= 8:
        wide = np.zeros((len(bits), 8), np.uint8)
        wide[:, :bits.shape[1]] = bits
        _, first, group = np.unique(wide.view(np.uint64).ravel(), return_index=True, return_inverse=True)
    else:
        rows = np.ascontiguousarray(bits).view(np.dtype((np.void, bits.shape[1]))).ravel()
        _, first, group = np.unique(rows, return_index=True, return_inverse=True)
    return present[first], group


def _rank_block(block: postings.Block, items: Items, best: list[Best], n_documents: int, n_terms: int) -> None:
    at, count = block.find(items.terms)
    slot = np.full(len(items.terms), -1, np.int64)  # column of a term among those of the part
    for s, e in items.parts():
        terms = np.unique(np.concatenate([t for t, _ in items.own[s:e]]))
        terms = terms[count[terms] > 0]
        if not len(terms):
            continue
        slot[terms] = np.arange(len(terms))
        of, k = postings.expand(block.starts[at[terms]], count[terms])
        pair, tf = np.unique(of * len(block.uids) + block.document(block.places[k]), return_counts=True)
        column, doc = np.divmod(pair, len(block.uids))
        seen, row = np.unique(doc, return_inverse=True)
        gain = np.zeros((len(seen), len(terms)), np.int64)
        gain[row, column] = impacts(tf, block.n_words[doc], n_documents, n_terms)
        for i in range(s, e):
            own, repeats = items.own[i]
            mine = slot[own]
            held = mine >= 0
            if held.any():
                _rank(gain[:, mine[held]], items.weights[own[held]] * repeats[held], seen, block, best[i])
        slot[terms] = -1


def _rank(gain: np.ndarray, weights: np.ndarray, seen: np.ndarray, block: postings.Block, best: Best) -> None:
    top = gain.max(axis=0) * weights
    if top.sum() < best.least:
        return
    distinct, group = masks(gain > 0)
    most = distinct @ top
    order = np.argsort(-most, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_rank = np.argsort(rank[group], kind="stable")  # documents, by their mask's maximum
    ends = np.cumsum(np.bincount(rank[group], minlength=len(order)))
    ceiling = most[order]
    done, step = 0, 0
    while step < len(order) and ceiling[step] >= best.least:
        # the masks that the next 4 k documents have, as far as they can still matter
        reach = int(np.searchsorted(ends, done + 4 * best.k, "left")) + 1
        safe = int(np.searchsorted(-ceiling, -best.least, "right"))
        upto = max(step + 1, min(reach, safe))
        rows = by_rank[done:ends[upto - 1]]
        scores = gain[rows] @ weights
        good = scores >= best.least
        docs = seen[rows[good]]
        best.add(scores[good], [block.doc_ids[d] for d in docs.tolist()], block.uids[docs].tolist())
        done, step = int(ends[upto - 1]), upto


def _rank_all(batches, shared, k: int, n_documents: int, n_terms: int, kind: pa.DataType):
    items = shared.value
    best = [Best(k) for _ in items.uids]
    for batch in batches:
        for row in batch.to_pylist():
            _rank_block(postings.Block(row), items, best, n_documents, n_terms)
    rows = [(u, -score, doc_id, uid) for u, b in zip(items.uids, best) for score, doc_id, uid in b.rows]
    item, score, doc_id, uid = zip(*rows) if rows else ((), (), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(score, pa.int64()),
                                      pa.array(doc_id, kind), pa.array(uid, pa.int64())],
                                     ["item", "score", "doc_id", "uid"])


def _held_by(batches, shared):
    """(term, documents that hold it) for the terms of some items, summed over a task's blocks."""
    terms = shared.value.terms
    total = np.zeros(len(terms), np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            block = postings.Block(row)
            at, count = block.find(terms)
            there = np.flatnonzero(count)
            of, k = postings.expand(block.starts[at[there]], count[there])
            doc = block.document(block.places[k])
            new = np.concatenate([[True], (of[1:] != of[:-1]) | (doc[1:] != doc[:-1])])[:len(of)]
            total[there] += np.bincount(of[new], minlength=len(there))
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "df"])


def _cut(batches):
    for batch in batches:
        terms = list(postings.terms_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t.tobytes() for t in terms], pa.binary()),
             pa.array([len(t) for t in terms], pa.int64())], ["item", "terms", "n"])


def search(spark: SparkSession, index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of the index with the highest scores above 0 for every
    row of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    arrow_batches(spark, 16)
    numbered = materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"),
                           spark, "items")
    cut = materialize(numbered.select("item", "text").mapInArrow(_cut, "item long, terms binary, n long").where("n > 0"),
                      spark, "item_terms")
    size = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = max(1, -(-size // TERMS))
    words = F.aggregate("n_words", F.lit(0).cast("long"), lambda a, x: a + x)
    with_terms = F.size(F.filter("n_words", lambda x: x > 0)).cast("long")
    n_documents, n_terms = index.agg(F.coalesce(F.sum(with_terms), F.lit(0)), F.coalesce(F.sum(words), F.lit(0))).first()
    doc_id = postings.schema(postings.documents(index))["doc_ids"].dataType.elementType
    out_schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()),
                               T.StructField("doc_id", doc_id), T.StructField("uid", T.LongType())])
    kind = postings._arrow(doc_id)
    out = None
    for b in range(blocks if n_terms else 0):
        rows = cut.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "terms").collect()
        if not rows:
            continue
        own = Items([r[0] for r in rows], [np.frombuffer(bytes(r[1]), np.uint64) for r in rows])
        shared = spark.sparkContext.broadcast(own)
        counted = (index.mapInArrow(lambda x, shared=shared: _held_by(x, shared), "term long, df long")
                   .groupBy("term").agg(F.sum("df").alias("df")).collect())
        df = dict.fromkeys(range(len(own.terms)), 0) | {r[0]: r[1] for r in counted}
        own.weights = np.array([weight(df[t], n_documents) for t in range(len(own.terms))], np.int64)
        weighted = spark.sparkContext.broadcast(own)
        found = index.mapInArrow(
            lambda x, shared=weighted: _rank_all(x, shared, k, n_documents, n_terms, kind), out_schema)
        found = materialize(found, spark, "mask_search")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], out_schema)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_first("doc_id"), "uid"))).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
