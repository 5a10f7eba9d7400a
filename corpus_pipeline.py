"""Training-corpus pipeline over ``documents``.

``run`` applies the stages in order; each result is written as Parquet below
the session's shared folder and read again.  All stages but the last return
the columns of documents, with text and n_chars as the stage leaves them; the
last returns packed pieces.

1. toxicity: documents that the lexicon scores at 0.5 or more go.  The lexicon
   is learnt from ``labels`` on rows that are not held out.
2. line_dedup: later repeated runs of lines are taken out of the text.
3. ngram_jaccard: of documents linked by five-word shingles at 0.75 or more
   the one with the smallest doc_id stays.
4. suffix_dedup: strings of 50 bytes or more that also start in a document
   with a smaller doc_id are taken out, in whole characters.
5. packing: pieces of at most 2048 ids are packed into sequences.

A document of which stage 2 or 4 leaves nothing stays, with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layercake.llm import jaccard_join, line_dedup, packing, span_dedup, toxicity
from layercake.llm.common import materialize, read
from layercake.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.fit(spark, docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, lexicon).where("score < 0.5").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(line_dedup.dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = jaccard_join.join(spark, docs).where("component_id <> doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(span_dedup.dedup(spark, docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, packing.pieces(docs, tokenizer_path()))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_jaccard", drop_near_copies),
          ("suffix_dedup", drop_spans), ("packing", pack)]

# Learnt scores, subword ids and packing are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), spark, f"stage_{name}")
    return docs
