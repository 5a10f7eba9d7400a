"""Reusable cleansing operators: DataFrame in, DataFrame out.

Each operator takes the column names and rule parameters as arguments so it
applies to any table; the concrete silver plans in ``layercake.plans.silver``
are thin compositions of these.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layercake.operators.windows import lead_within
from layercake.functions.exprs import (
    as_col, code_map, int_date_rejected, int_div, int_to_date, std_code)


def keep_latest(df: DataFrame, key: str, order: Sequence[Column],
                drop_null_key: bool = True) -> DataFrame:
    """Keep one row per ``key``: the first in ``order`` (e.g. newest date).

    Written as ``row_number() = 1``: Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key and a hot key cannot overload the final task.  The
    NULL-key filter sits on the partition column and is pushed below the
    window (NULL keys never reach the shuffle)."""
    if drop_null_key:
        df = df.filter(F.col(key).isNotNull())
    w = Window.partitionBy(key).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def split_key(df: DataFrame, col: str, prefix_out: str, rest_out: str,
              prefix_len: int = 5, rest_start: int = 7,
              sep_from: str = "-", sep_to: str = "_") -> DataFrame:
    """Split a composite key: the first ``prefix_len`` characters (with
    ``sep_from`` replaced by ``sep_to``) and the remainder from ``rest_start``."""
    c = F.col(col)
    return df.withColumns({
        prefix_out: F.replace(F.substring(c, 1, prefix_len), F.lit(sep_from), F.lit(sep_to)),
        rest_out: c.substr(F.lit(rest_start), F.length(c)),
    })


def scd2_end_date(df: DataFrame, key: str, start: str, out: str,
                  tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Version end date: the next version's start minus one day, per key.

    The current version gets NULL.  The successor comes from ``lead_within``,
    so a key with very many versions is split across tasks."""
    df = lead_within(df, key, [start, *tie_breakers], start, "_next_start")
    return df.withColumn(out, F.date_sub(F.to_date("_next_start"), 1)).drop("_next_start")


def strip_prefix(df: DataFrame, col: str, prefix: str, case_insensitive: bool = True,
                 out: str | None = None) -> DataFrame:
    """Drop a leading ``prefix`` (``LIKE 'prefix%'`` under a case-insensitive
    collation when ``case_insensitive``)."""
    c = F.col(col)
    probe = F.upper(c) if case_insensitive else c
    pat = prefix.upper() if case_insensitive else prefix
    stripped = c.substr(F.lit(len(prefix) + 1), F.length(c))
    return df.withColumn(out or col, F.when(probe.startswith(pat), stripped).otherwise(c))


def null_out_of_range(df: DataFrame, col: str, upper_exclusive, lower_inclusive,
                      out: str | None = None) -> DataFrame:
    """NULL where ``col > upper_exclusive`` or ``col <= lower_inclusive``."""
    c = F.col(col)
    hi = as_col(upper_exclusive) if isinstance(upper_exclusive, Column) else F.lit(upper_exclusive)
    lo = as_col(lower_inclusive) if isinstance(lower_inclusive, Column) else F.lit(lower_inclusive)
    return df.withColumn(out or col, F.when(c > hi, F.lit(None))
                         .when(c <= lo, F.lit(None)).otherwise(c))


def repair_int_dates(df: DataFrame, cols: Sequence[str],
                     flag_suffix: str | None = None) -> DataFrame:
    """yyyymmdd INT columns -> DATE (invalid -> NULL), optionally with a
    ``<col><flag_suffix>`` reject flag per column.  The flags are derived from
    the raw value and the repaired date in a second projection, so each
    conversion runs once."""
    if not flag_suffix:
        return df.withColumns({c: int_to_date(c) for c in cols})
    raw = {f"_raw_{c}": F.col(c) for c in cols}
    out = df.withColumns(raw).withColumns({c: int_to_date(c) for c in cols})
    return out.withColumns({
        f"{c}{flag_suffix}": int_date_rejected(f"_raw_{c}", c) for c in cols
    }).drop(*raw)


def repair_measures(df: DataFrame, sales: str, qty: str, price: str) -> DataFrame:
    """Make sales = qty * |price| consistent, repairing both from the RAW inputs.

    * sales NULL, <= 0 or != qty*|price|  ->  qty*|price|
    * price NULL -> raw sales div qty (NULL when qty is 0); price <= 0 -> |price|

    Both new values are computed in one projection from the raw columns (a
    chained ``withColumn`` would feed the repaired sales into the price rule).
    """
    s, q, p = F.col(sales), F.col(qty), F.col(price)
    expected = q * F.abs(p)
    new_sales = (F.when(s.isNull() | (s <= 0) | (s != expected), expected)
                 .otherwise(s).cast("int"))
    new_price = (F.when(p.isNull(), int_div(s, q))
                 .when(p <= 0, F.abs(p)).otherwise(p).cast("int"))
    return df.withColumns({sales: new_sales, price: new_price})


def standardise_codes(df: DataFrame, rules: Mapping[str, Mapping],
                      default: str = "Unknown") -> DataFrame:
    """Apply ``code_map`` to several columns: ``{column: {code: label}}``."""
    return df.withColumns({c: code_map(c, m, default) for c, m in rules.items()})


def standardise_or_keep(df: DataFrame, col: str, mapping: Mapping,
                        blank: str = "Unknown") -> DataFrame:
    """Map known codes, blank/NULL -> ``blank``, anything else -> trimmed value."""
    c = F.col(col)
    key = std_code(c)
    out = None
    for k, v in mapping.items():
        cond = key.isin(list(k)) if isinstance(k, tuple) else (key == k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    out = out.when((key == "") | c.isNull(), F.lit(blank)).otherwise(F.trim(c))
    return df.withColumn(col, out)


def prefer_known(primary, fallback, unknown: str = "Unknown") -> Column:
    """Attribute precedence: ``primary`` unless it is ``unknown`` or NULL,
    then ``fallback``, then ``unknown``."""
    p, f = as_col(primary), as_col(fallback)
    return F.when(p != F.lit(unknown), p).otherwise(F.coalesce(f, F.lit(unknown)))


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def fill_null(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
