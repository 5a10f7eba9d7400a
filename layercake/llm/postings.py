"""Positional inverted index over whole texts, in blocks of documents.

A word is a maximal run of the bytes 0-9, a-z, A-Z (taken as a-z) and 0x80 to
0xFF.  A row of the index is one block: up to ``DOCUMENTS`` whole documents of
about ``WORDS`` words together (one document at least), with the ids and word
counts of its documents and, for every term, the ascending places at which it
stands.  A place counts words from the start of the block.  The index holds
every term of every document, whatever is asked of it later, and lies as
Parquet below the session's shared folder.

A term is its 64-bit number: the bytes themselves, scrambled one to one, for
words of up to 8 bytes, and a hash beyond.

Defined results: a null or wordless text has no words but counts as a
document; repeated rows are documents of their own (``uid`` tells them apart);
a null doc_id is kept; other columns are ignored; an empty table gives an
index without rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layercake.llm.common import arrow_batches, run_dir, text_buffer
from layercake.llm.shingles import mix

WORDS = 1 << 18       # words of a block, about
DOCUMENTS = 1024      # documents of a block at most
SLICE = 4 << 20       # bytes of text looked at together
LONG = 512            # bytes of a word beyond which it is hashed on its own

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Byte -> byte of a word, lower case; 0 where it ends a word."""
    b = np.arange(256, dtype=np.uint8)
    inside = (b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A))
    upper = (b >= 0x41) & (b <= 0x5A)
    return np.where(inside, b, np.where(upper, b + np.uint8(32), np.uint8(0)))


LETTERS = _letters()
# keeps the first n bytes of a little-endian number
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _term_numbers(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(low) + 1,), np.dtype("<u8"), padded.data, strides=(1,))  # the 8 bytes from each byte on
    number = mix(eight[starts] & _KEEP[np.minimum(lengths, 8)])
    longer, k = np.flatnonzero((lengths > 8) & (lengths <= LONG)), 8
    while len(longer):
        part = eight[starts[longer] + k] & _KEEP[np.minimum(lengths[longer] - k, 8)]
        number[longer] = mix(number[longer] * _ODD + part)
        k += 8
        longer = longer[lengths[longer] > k]
    for i in np.flatnonzero(lengths > LONG).tolist():
        s, n = int(starts[i]), int(lengths[i])
        whole = eight[s:s + n - n % 8:8]
        at = np.arange(len(whole), dtype=np.uint64)
        rest = eight[s + n - n % 8] & _KEEP[n % 8]
        number[i] = mix((np.array([mix(whole + mix(at + _ODD)).sum()]) * _ODD + rest) ^ np.uint64(n))[0]
    return number


def terms_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """Term numbers of the words of every text, in order."""
    data, offsets = text_buffer(texts)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        if offsets[j] - offsets[i] > SLICE:  # one long text, in slices that end between words
            yield _long_text(data[offsets[i]:offsets[j]])
            i = j
            continue
        numbers, owner = _slice_terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        ends = np.cumsum(np.bincount(owner, minlength=j - i))
        first = 0
        for e in ends.tolist():
            yield numbers[first:e]
            first = e
        i = j


def _slice_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = LETTERS[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low != 0
    begin = inside[1:-1] & ~inside[:-2]
    end = inside[1:-1] & ~inside[2:]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begin[heads] = inside[1:-1][heads]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    end[tails] = inside[1:-1][tails]
    starts = np.flatnonzero(begin)
    lengths = np.flatnonzero(end) + 1 - starts
    return _term_numbers(low, starts, lengths), np.searchsorted(offsets, starts, "right") - 1


def _long_text(data: np.ndarray) -> np.ndarray:
    parts, s = [], 0
    while s < len(data):
        e = min(s + SLICE, len(data))
        while e < len(data):  # to the end of a word
            gaps = np.flatnonzero(LETTERS[data[e:e + SLICE]] == 0)
            e = e + int(gaps[0]) if len(gaps) else min(e + SLICE, len(data))
            if len(gaps):
                break
        parts.append(_slice_terms(data[s:e], np.array([0, e - s]))[0])
        s = e
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


class Block:
    """One row of the index, as arrays."""

    def __init__(self, row: dict):
        self.uids = np.array(row["uids"], np.int64)
        self.doc_ids = row["doc_ids"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.ends = np.cumsum(self.n_words)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.uint32).astype(np.int64)  # one more than terms
        self.places = np.frombuffer(row["places"], np.uint32).astype(np.int64)

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number within the block of each term (any, if absent) and how often it stands there."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return at, np.where(self.terms[at] == terms, self.starts[at + 1] - self.starts[at], 0)

    def document(self, places: np.ndarray) -> np.ndarray:
        """Number within the block of the document that holds each place."""
        return np.searchsorted(self.ends, places, "right")


def expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges first .. first + count: (number of the range, element) of every element."""
    of = np.repeat(np.arange(len(first)), count)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + first[of]


def schema(docs: DataFrame) -> T.StructType:
    kind = docs.schema["doc_id"].dataType
    return T.StructType([T.StructField("uids", T.ArrayType(T.LongType())), T.StructField("doc_ids", T.ArrayType(kind)),
                         T.StructField("n_words", T.ArrayType(T.IntegerType())),
                         *[T.StructField(c, T.BinaryType()) for c in ("terms", "starts", "places")]])


def _blocks(batches, kind: pa.DataType, words: int, documents: int):
    uids, ids, texts, held = [], [], [], 0

    def row():
        number = np.concatenate(texts) if held else np.empty(0, np.uint64)
        order = np.argsort(number, kind="stable")
        number = number[order]
        new = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])) if held else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([uids], pa.list_(pa.int64())), pa.array([ids], pa.list_(kind)),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
            pa.array([number[new].tobytes()], pa.binary()),
            pa.array([np.append(new, held).astype(np.uint32).tobytes()], pa.binary()),
            pa.array([order.astype(np.uint32).tobytes()], pa.binary())],
            ["uids", "doc_ids", "n_words", "terms", "starts", "places"])

    for batch in batches:
        their = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), terms_of(batch.column(2)))
        for uid, doc_id, terms in their:
            if texts and (held + len(terms) > words or len(texts) == documents):
                yield row()
                uids, ids, texts, held = [], [], [], 0
            uids.append(uid)
            ids.append(doc_id)
            texts.append(np.array(terms))
            held += len(terms)
    if texts:
        yield row()


def build(spark: SparkSession, docs: DataFrame, words: int = WORDS, documents: int = DOCUMENTS) -> DataFrame:
    """Index of the texts of ``docs`` (doc_id, text), stored and read back."""
    arrow_batches(spark)
    out = schema(docs)
    kind = pa.schema([pa.field("x", _arrow(out["doc_ids"].dataType.elementType))])[0].type
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    path = run_dir(spark, "postings")
    (rows.mapInArrow(lambda b: _blocks(b, kind, words, documents), out)
     .write.option("parquet.block.size", 16 << 20).parquet(path))
    return spark.read.schema(out).parquet(path)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def documents(index: DataFrame) -> DataFrame:
    """(uid, doc_id, n_words) of every document of an index."""
    each = F.explode(F.arrays_zip("uids", "doc_ids", "n_words")).alias("d")
    return index.select(each).select(F.col("d.uids").alias("uid"), F.col("d.doc_ids").alias("doc_id"),
                                     F.col("d.n_words").cast("long").alias("n_words"))
