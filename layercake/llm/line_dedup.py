"""Removal of repeated runs of lines by winnowing over line hashes.

Every line (text between line feeds) has a 64-bit hash.  In each window of
``run`` lines the place of the smallest hash, the last of equal ones, is the
window's fingerprint.  Its choice depends on the window alone, so two places
that share a run of ``run`` lines share a fingerprint at the same place of the
run: nothing of that length is missed.  Neighbouring windows mostly choose the
same place, so about two fingerprints stand for ``run + 1`` lines, and only
they leave their document, each with the lines around it that its windows
cover.  The places of equal fingerprints are joined; those alone of their kind
go.  From each that stays the match is extended both ways, to the windows that
chose it, and windows with equal lines are brought together.  Of each, the
first place (smallest doc_id, then position) stays; every line of every other
place is deleted.  Overlapping windows join up, so a deleted run is as long as
the whole match.

Only built-in functions are used.  Both groupings are map-side combined
minima and counts, and both joins back may be split by adaptive execution, so
a line or run that a third of all documents share is spread over tasks.

Defined results: a null text stays null and has no lines; an empty text is one
empty line; fewer than ``run`` lines are never touched; a run repeated within
one document goes too, except its first place; rows with equal doc_id and text
are one place, so neither is later than the other; a null doc_id comes first;
an empty table gives an empty result; extra columns are kept, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RUN = 3


def _fingerprints(lines: DataFrame, run: int) -> DataFrame:
    """doc, key, hash, place, from, around of every fingerprint: its line, and
    the lines of all windows that chose it, the first of which starts at from."""
    def chosen(at: Column) -> Column:
        return -F.array_min(F.transform(F.sequence(at, at + (run - 1)), lambda j: F.struct(
            F.get("hashes", j).alias("hash"), (-j).alias("back"))))["back"]

    starts = F.sequence(F.lit(0), F.size("hashes") - run)
    places = lines.where(F.size("hashes") >= run).select("doc", "key", "hashes", F.transform(starts, chosen).alias("places"))
    # the windows that choose one place follow one another; here are the first of them
    firsts = F.filter(F.transform("places", lambda p, at: F.struct(p.alias("place"), at.alias("from"))),
                      lambda w: (w["from"] == 0) | (F.get("places", w["from"] - 1) != w["place"]))

    def around(w: Column) -> Column:
        n = F.size(F.filter(F.slice("places", w["from"] + 1, run), lambda p: p == w["place"]))
        return F.struct(w["place"].alias("place"), w["from"].alias("from"), F.get("hashes", w["place"]).alias("hash"),
                        F.slice("hashes", w["from"] + 1, n + (run - 1)).alias("around"))

    return places.select("doc", "key", F.explode(F.transform(firsts, around)).alias("f")).select("doc", "key", "f.*")


def _extended(matched: DataFrame, run: int) -> DataFrame:
    """doc, key, at, content of every window that chose one of the fingerprints."""
    window = F.transform(F.sequence(F.lit(0), F.size("around") - run), lambda j: F.struct(
        (F.col("from") + j).alias("at"), F.xxhash64(F.slice("around", j + 1, run)).alias("content")))
    return matched.select("doc", "key", F.explode(window).alias("w")).select("doc", "key", "w.at", "w.content")


def repeated(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc, key, starts: the first lines of all windows to delete, by document."""
    lines = docs.where("text is not null").select(
        F.col("doc_id").alias("doc"), F.xxhash64("text").alias("key"),
        F.transform(F.split("text", "\n", -1), lambda x: F.xxhash64(x)).alias("hashes")).distinct()
    prints = _fingerprints(lines, run)
    places = prints.groupBy("hash").agg(
        F.min(F.struct("doc", "key", "place")).alias("first"), F.max(F.struct("doc", "key", "place")).alias("last"))
    matched = prints.join(places.where("first <> last").select("hash"), "hash", "left_semi")
    windows = _extended(matched, run)
    first = windows.groupBy("content").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n"))
    later = (windows.join(first.where("n > 1"), "content")
             .where(F.struct("doc", "at") > F.col("first")))
    return later.groupBy("doc", "key").agg(F.collect_list("at").alias("starts"))


def dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` with the repeated runs taken out of text, and n_lines_before
    and n_lines_removed (long)."""
    own = docs.withColumns({"_key": F.xxhash64("text"), "_doc": F.col("doc_id")})
    gone = repeated(docs, run).select(F.col("doc").alias("_doc2"), F.col("key").alias("_key2"), "starts")
    gone = gone.select("_doc2", "_key2", F.array_distinct(F.flatten(F.transform(
        "starts", lambda s: F.sequence(s, s + (run - 1))))).alias("_gone"))
    joined = own.join(gone, F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("_key") == F.col("_key2")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = (F.when(F.col("text").isNull() | F.col("_gone").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda j: F.get("_lines", j)), "\n")))
    return (joined.withColumn("_lines", lines).withColumns({
        "text": text,
        "n_lines_before": F.coalesce(F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")), F.lit(0)).cast("long"),
        "n_lines_removed": F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")})
        .drop("_key", "_doc", "_key2", "_doc2", "_gone", "_lines"))
