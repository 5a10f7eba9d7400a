"""Column expressions with the warehouse's SQL semantics.

Every helper returns a plain ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; none of them is a UDF.

The source warehouse ran on a dialect whose integer arithmetic and date
differences differ from Spark's defaults; the helpers below make those
semantics explicit:

* ``int_div`` / ``int_avg``  - INT / INT and AVG(INT) truncate toward zero.
* ``month_diff`` / ``year_diff`` - DATEDIFF counts calendar boundaries crossed,
  not elapsed whole units.
* ``concat_nulls_as_empty`` vs ``concat_null_propagating`` - the two string
  concatenations (function form skips NULLs, operator form propagates them).
* ``int_to_date`` - yyyymmdd integers to DATE with a validity guard.
* ``round_ratio`` - ROUND(x / y, n) computed exactly on the integer inputs
  (half away from zero), so it does not depend on binary float artefacts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

__all__ = [
    "as_col", "int_div", "int_avg", "int_avg_over", "month_diff", "year_diff",
    "concat_nulls_as_empty", "concat_null_propagating", "int_to_date",
    "int_date_rejected", "std_code", "code_map", "band",
    "round_ratio", "pct_text", "ci_key",
]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (``a div b``); NULL-safe.

    A zero divisor gives NULL instead of an error."""
    return F.call_function("div", as_col(a), F.nullif(as_col(b), F.lit(0)))


def int_avg(c) -> Column:
    """AVG over an integer column with integer (truncating) result."""
    c = as_col(c)
    return int_div(F.sum(c), F.count(c))


def int_avg_over(c, w: Window) -> Column:
    """Windowed truncating average: ``sum over w div count over w``."""
    c = as_col(c)
    return int_div(F.sum(c).over(w), F.count(c).over(w))


def month_diff(start, end) -> Column:
    """Number of month boundaries crossed between two dates."""
    s, e = as_col(start), as_col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("int")


def year_diff(start, end) -> Column:
    """Number of year boundaries crossed between two dates."""
    return (F.year(as_col(end)) - F.year(as_col(start))).cast("int")


def concat_nulls_as_empty(*cols) -> Column:
    """CONCAT(...) where NULL arguments count as empty strings."""
    return F.concat_ws("", *[as_col(c) for c in cols])


def concat_null_propagating(*cols) -> Column:
    """``a + b`` string concatenation: NULL if any argument is NULL."""
    return F.concat(*[as_col(c) for c in cols])


def _eight_chars(c: Column) -> Column:
    """The integer's text is exactly 8 characters (a sign counts)."""
    return (c.between(10000000, 99999999)) | (c.between(-9999999, -1000000))


def int_to_date(c) -> Column:
    """yyyymmdd integer -> DATE.

    0, NULL and values whose text is not exactly 8 characters give NULL.
    An 8-character value that is not a calendar date (20131332, -1234567)
    also gives NULL instead of failing the load; ``int_date_rejected``
    flags those rows so callers can count them.

    Pure integer arithmetic + ``make_date`` (no string formatting or date
    parsing per row); CASE branches are evaluated lazily, so ``make_date``
    only ever sees a valid year/month/day."""
    c = as_col(c)
    y = F.call_function("div", c, F.lit(10000))
    m = F.call_function("div", c, F.lit(100)) % 100
    d = c % 100
    none = F.lit(None).cast("date")
    month_len = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return (F.when(~c.between(10000000, 99999999), none)
             .when((m < 1) | (m > 12) | (d < 1), none)
             .when(d > month_len, none)
             .otherwise(F.make_date(y, m, d)))


def int_date_rejected(c, repaired=None) -> Column:
    """True where an 8-character, non-zero value is not a valid date.

    Pass the already repaired DATE column as ``repaired`` (in a later
    projection) to avoid evaluating the conversion twice."""
    c = as_col(c)
    d = int_to_date(c) if repaired is None else as_col(repaired)
    return F.coalesce(_eight_chars(c) & d.isNull(), F.lit(False))


def std_code(c) -> Column:
    """Normalised code text: UPPER(TRIM(c))."""
    return F.upper(F.trim(as_col(c)))


def code_map(c, mapping: Mapping[str, str], default: str | None = "Unknown",
             normalise: bool = True) -> Column:
    """Simple ``CASE UPPER(TRIM(c)) WHEN k THEN v ... ELSE default END``.

    ``mapping`` keys may be a string or a tuple of strings (an IN list)."""
    key = std_code(c) if normalise else as_col(c)
    out = None
    for k, v in mapping.items():
        cond = key.isin(list(k)) if isinstance(k, tuple) else (key == k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default))


def band(c, cuts: Sequence, labels: Sequence[str], default: str | None = None) -> Column:
    """Banding by inclusive upper bounds.

    ``labels[i]`` applies when ``c <= cuts[i]`` (first match).  If
    ``len(labels) == len(cuts) + 1`` the last label applies when
    ``c > cuts[-1]``.  Anything else (including NULL) gets ``default``."""
    c = as_col(c)
    if len(labels) not in (len(cuts), len(cuts) + 1):
        raise ValueError("need one label per cut, optionally one more for above the last cut")
    out = None
    for cut, label in zip(cuts, labels):
        cond = c <= F.lit(cut)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if len(labels) == len(cuts) + 1:
        out = out.when(c > F.lit(cuts[-1]), F.lit(labels[-1]))
    return out.otherwise(F.lit(default))


def round_ratio(num, den, digits: int, ints: bool = False) -> Column:
    """ROUND(num / den, digits) for integer inputs, exactly.

    Rounds half away from zero on the exact rational value using integer
    arithmetic on DECIMAL(38,0) (no overflow for sums of INT), or on BIGINT
    where both are INT columns (``ints``, exact for up to 8 digits), then
    returns a DOUBLE.  A zero or NULL divisor gives NULL."""
    scale = 10 ** digits
    kind = "bigint" if ints else "decimal(38,0)"
    n = as_col(num).cast(kind)
    d = F.nullif(as_col(den).cast(kind), F.lit(0).cast(kind))
    q = F.call_function("div", F.abs(n) * F.lit(2 * scale) + F.abs(d), F.abs(d) * F.lit(2))
    return (q * F.signum(n) * F.signum(d) / F.lit(float(scale))).cast("double")


def pct_text(p) -> Column:
    """Number -> text with a '%' suffix, whole numbers without '.0'.

    A NULL number gives just '%' (CONCAT treats NULL as empty)."""
    txt = F.regexp_replace(as_col(p).cast("string"), r"\.0$", "")
    return concat_nulls_as_empty(txt, F.lit("%"))


def ci_key(c) -> Column:
    """Join-key normalisation emulating a case- and trailing-space-insensitive
    collation: ``UPPER(RTRIM(c))``."""
    return F.upper(F.rtrim(as_col(c)))
