"""Names and keys under the warehouse's collation.

The warehouse compares text without regard to case and trailing spaces.  Joins
in ``plans/gold.py`` do so by hand (``ci_key``).  Here the rule is declared on
the columns instead, as Spark's collated string type, so that GROUP BY,
DISTINCT, ORDER BY, windows, predicates and joins all follow it:

* ``collate`` declares columns, ``spelled`` takes the declaration back;
* ``declared`` does the same for a table's schema;
* ``group_names`` groups by declared names.  Grouping a collated column at once
  would sort every row (Spark keeps such keys out of hash aggregation), so rows
  are first hash-aggregated by their exact spelling, with map-side combine, and
  only one row a spelling is then grouped under the collation.  A name that
  holds a third of the rows is therefore combined before any shuffle.

Which spelling stands for a group is fixed: the least in code-unit order.
NULL names form one group, as in SQL; the empty text and a text of spaces are
equal.  Equality is that of lower-cased texts without trailing spaces; leading
spaces and accents tell texts apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WAREHOUSE = "UTF8_LCASE_RTRIM"
EXACT = "UTF8_BINARY"

# How a partial result of the first step is combined in the second.
_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _string_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def _typed(c, collation: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(T.StringType(collation))


def collate(df: DataFrame, columns: Iterable[str] | None = None, collation: str = WAREHOUSE) -> DataFrame:
    """``df`` with ``columns`` (all text columns if None) under ``collation``.

    Order and names of the columns stay."""
    columns = _string_columns(df.schema) if columns is None else list(columns)
    return df.withColumns({c: _typed(c, collation) for c in columns})


def spelled(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``df`` with ``columns`` (all text columns if None) compared exactly again."""
    return collate(df, columns, EXACT)


def declared(schema: T.StructType, columns: Iterable[str] | None = None,
             collation: str = WAREHOUSE) -> T.StructType:
    """A copy of ``schema`` with its text columns under ``collation``."""
    chosen = set(_string_columns(schema) if columns is None else columns)
    return T.StructType([T.StructField(f.name, T.StringType(collation), f.nullable, f.metadata)
                         if f.name in chosen else f for f in schema.fields])


def group_names(df: DataFrame, names: Iterable[str], aggs: Mapping[str, tuple[str, str]],
                spellings: str | None = None, collation: str = WAREHOUSE) -> DataFrame:
    """``aggs`` (output -> (sum, count, min or max; column, "*" for rows)) by
    ``names`` under ``collation``; each name in its least spelling, as plain
    text.  ``spellings`` names a column for the number of distinct spellings
    (combinations of them, for several names)."""
    names = list(names)
    unknown = {how for how, _ in aggs.values()} - set(_COMBINE)
    if unknown:
        raise ValueError(f"cannot be combined from parts: {sorted(unknown)}")

    parts = {f"a{i}": h for i, (h, _) in enumerate(aggs.values())}
    # only names of this function's own from here on, so that none can clash
    rows = df.select(*[_typed(n, EXACT).alias(f"s{i}") for i, n in enumerate(names)],
                     *[(F.lit(1) if c == "*" else F.col(c)).alias(a) for a, (_, c) in zip(parts, aggs.values())])
    s_, n_ = [f"s{i}" for i in range(len(names))], [f"n{i}" for i in range(len(names))]
    exact = rows.groupBy(*s_).agg(*[getattr(F, h)(a).alias(a) for a, h in parts.items()])
    under = exact.withColumns({n: _typed(s, collation) for n, s in zip(n_, s_)}).groupBy(*n_).agg(
        *[F.min(s).alias(s) for s in s_], *[_COMBINE[h](a).alias(a) for a, h in parts.items()],
        F.count(F.lit(1)).alias("k"))
    return under.select(*[F.col(s).alias(n) for s, n in zip(s_, names)],
                        *[F.col(a).alias(out) for a, out in zip(parts, aggs)],
                        *([F.col("k").alias(spellings)] if spellings else []))
