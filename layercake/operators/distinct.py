"""Exact distinct counts that roll up without reading the facts again.

A COUNT DISTINCT cannot be added up: the customers of a year are not the sum
of its months'.  ``distinct_words`` keeps, for every group of the finest grain,
which integer keys occur, as 64-bit words: key k is bit ``k % 64`` of word
``floor(k / 64)``.  Words of any groups are combined by OR, so every coarser
grain (``count_words``, ``roll_up``) comes from the words, not from the facts.

* Words are built by a hash aggregate with map-side combining, and OR on a long
  is compiled; a plan of COUNT DISTINCT over two columns expands every row and
  shuffles one row for each (group, key).  A group never has more words than
  distinct keys, and with dense surrogate keys (``keys.dense_key``) up to 64
  times fewer.  (Spark's own 4 KB bitmaps are aggregated by sorting all rows,
  and cost 4 KB for a group of one key.)
* Words of a group are spread by their number, so a group with a third of all
  rows, or the total over all, is counted by many tasks.

Defined results, as of COUNT DISTINCT: a NULL key does not count, and a group
of only NULL keys counts zero; NULL group values are a group; repeated rows
count once; negative keys count; an empty table gives no group, and a total of
zero; other columns are ignored, and a grouping column may not have one of the
names ``_kind``, ``_word`` and ``_bits``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = ["_kind", "_word"]


def _entry(kind: int, key: Column) -> Column:
    key = key.cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    return F.struct(F.lit(kind).alias("_kind"),
                    F.coalesce(F.shiftright(key, 6), F.lit(0).cast("long")).alias("_word"),
                    F.coalesce(bit, F.lit(0).cast("long")).alias("_bits"))


def distinct_words(df: DataFrame, by: Sequence[Column], keys: Sequence[Column]) -> DataFrame:
    """The columns ``by``, then _kind (place of the key in ``keys``), _word, _bits."""
    entries = F.array(*[_entry(i, k) for i, k in enumerate(keys)])
    rows = df.select(*by, F.inline(entries))
    names = [c for c in rows.columns[:len(by)]]
    if set(names) & {*_WORD, "_bits"}:
        raise ValueError("a grouping column may not be named _kind, _word or _bits")
    return rows.groupBy(*names, *_WORD).agg(F.bit_or("_bits").alias("_bits"))


def merge_words(words: DataFrame, by: Sequence[str]) -> DataFrame:
    """The words of the coarser grain ``by``."""
    return words.groupBy(*by, *_WORD).agg(F.bit_or("_bits").alias("_bits"))


def count_words(words: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``by`` and one distinct count for each of ``names``, from words of that very grain."""
    bits = F.bit_count("_bits").cast("long")
    return words.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("_kind") == i, bits)), F.lit(0)).cast("long").alias(n)
        for i, n in enumerate(names)])


def roll_up(words: DataFrame, by: Sequence[str], names: Sequence[str],
            levels: Mapping[str, int], level: str = "grain") -> DataFrame:
    """Distinct counts at several grains, each the first so many columns of ``by``.

    ``levels`` maps the text of column ``level`` to that number; columns beyond
    it are NULL.  ``words`` are read once a level, so give them written."""
    schema = words.schema
    out = None
    for text, depth in levels.items():
        kept = list(by[:depth])
        counted = count_words(merge_words(words, kept), kept, names)
        rows = counted.select(F.lit(text).alias(level), *[
            F.col(c) if c in kept else F.lit(None).cast(schema[c].dataType).alias(c) for c in by], *names)
        out = rows if out is None else out.unionByName(rows)
    return out
