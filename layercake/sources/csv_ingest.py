"""CSV extract ingest: typed positional read, quarantine, audit.

* header row skipped, comma-separated, no quoting (a '"' is data), empty
  field -> NULL, columns mapped by position to the declared schema;
* numbers and dates may be padded with spaces; dates and datetimes are
  ``yyyy-MM-dd``, optionally followed by a space or T and ``HH:mm:ss``, with
  up to six digits of a second (a date column takes the date part);
* every line but a file's first is a row, whatever characters it holds; a
  blank line is a row of one empty field;
* rows that do not fit the schema (unparsable value, too few or too many
  fields) are kept apart with their raw text instead of being half-loaded.
  A line is read as one string and typed by expressions, so whether it fits
  does not depend on the columns or rows that a query asks for;
* one pass: parsed rows are written once, split by a ``quarantined`` flag
  into two folders, while an ``Observation`` counts read / rejected rows
  during that same write;
* more than ``max_errors`` rejected rows fails the table: nothing is
  published and the previous version stays visible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.sources.catalog import Direct
from layercake.session import path_exists, run_dir

CORRUPT = "_corrupt_record"
DEFAULT_MAX_ERRORS = None  # no threshold: good rows load, bad ones are quarantined
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": "",
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}
DATE_TEXT = r"^ *\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)? *$"


@dataclass(frozen=True)
class LoadSpec:
    table: str
    path: str
    schema: T.StructType


@dataclass
class LoadResult:
    table: str
    path: str
    status: str            # loaded | rejected | missing | failed
    rows_read: int = 0
    rows_loaded: int = 0
    rows_rejected: int = 0
    message: str = ""
    seconds: float = 0.0


def write_extract(df: DataFrame, path: str) -> str:
    """Write a DataFrame as a header + comma-separated, unquoted extract."""
    w = df.write.mode("overwrite")
    for k, v in CSV_OPTIONS.items():
        w = w.option(k, v)
    w.csv(path)
    return path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the text files at ``path`` but each file's first (its
    header), whole, whatever characters it holds; blank lines are lines.

    Lines end at a line feed, a carriage return, or both.  A file's first line
    is the one with the least number among those of its first block; these
    numbers, one a file, are broadcast."""
    block = F.col("_metadata.file_block_start")
    lines = (spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
                                          block.alias("_block"))
             .withColumn("_number", F.monotonically_increasing_id()))
    heads = lines.where("_block = 0").groupBy("_file").agg(F.min("_number").alias("_number")).select("_number")
    return lines.join(F.broadcast(heads), "_number", "left_anti").select("line")


def read_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed, positional read; bad rows carry their raw line in ``_corrupt_record``.

    Raises ``AnalysisException`` (condition PATH_NOT_FOUND) for a missing path."""
    parts = read_lines(spark, path).select("line", F.split("line", ",", -1).alias("parts"))
    texts = [F.nullif(F.get("parts", F.lit(i)), F.lit("")) for i in range(len(schema))]
    values = [_typed(text, f.dataType) for text, f in zip(texts, schema.fields)]
    fits = F.size("parts") == len(schema)
    for text, value in zip(texts, values):
        fits = fits & (text.isNull() | value.isNotNull())
    return parts.select(*(v.alias(f.name) for v, f in zip(values, schema.fields)),
                        F.when(~fits, F.col("line")).alias(CORRUPT))


def _typed(text: Column, kind: T.DataType) -> Column:
    """``text`` as ``kind``; NULL where it is not a value of that type."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(text.rlike(DATE_TEXT), F.trim(text).try_cast(kind))
    return F.trim(text).try_cast(kind)


def _condition(e: Exception) -> str:
    get = getattr(e, "getCondition", None)
    try:
        return (get() if get else None) or type(e).__name__
    except Exception:  # noqa: BLE001
        return type(e).__name__


def ingest(spark: SparkSession, spec: LoadSpec, target: str,
           max_errors: int | None = DEFAULT_MAX_ERRORS, into=None) -> LoadResult:
    """Load one extract into table ``target`` (and ``target``_quarantine),
    published at once or ``into`` a run."""
    into = into or Direct(spark)
    t0 = dt.datetime.now()
    res = LoadResult(spec.table, spec.path, "failed")
    if not path_exists(spark, spec.path):
        res.status, res.message = "missing", "File not found"
        return res
    try:
        parsed = read_extract(spark, spec.path, spec.schema)
    except AnalysisException as e:
        if _condition(e) == "PATH_NOT_FOUND":
            res.status, res.message = "missing", "File not found"
        else:
            res.message = f"{_condition(e)}: {e}"
        return res
    try:
        obs = Observation(f"ingest_{spec.table}_{id(res)}")
        tagged = parsed.withColumn("quarantined", F.col(CORRUPT).isNotNull()).observe(
            obs, F.count(F.lit(1)).alias("rows_read"),
            F.coalesce(F.sum(F.col("quarantined").cast("long")), F.lit(0)).alias("rejected"))
        version = run_dir(spark, "bronze_versions", spec.table)
        tagged.write.partitionBy("quarantined").parquet(version)   # the one action
        m = obs.get
        res.rows_read, res.rows_rejected = int(m["rows_read"]), int(m["rejected"])
        res.rows_loaded = res.rows_read - res.rows_rejected
        # an empty split writes no folder; a table over a missing location
        # reads as empty with its declared schema, so no placeholder write
        good, bad = f"{version}/quarantined=false", f"{version}/quarantined=true"
        bad_schema = T.StructType(list(spec.schema.fields) +
                                  [T.StructField(CORRUPT, T.StringType(), True)])
        into.publish_path(f"{target}_quarantine", bad, bad_schema)
        if max_errors is not None and res.rows_rejected > max_errors:
            res.status = "rejected"
            res.message = (f"{res.rows_rejected} rows could not be parsed "
                           f"(more than {max_errors}); table left unchanged")
            return res
        into.publish_path(target, good, spec.schema)
        res.status = "loaded"
    except Exception as e:  # noqa: BLE001 - failure isolation: log and continue
        res.status, res.message = "failed", f"{_condition(e)}: {e}"
    finally:
        res.seconds = (dt.datetime.now() - t0).total_seconds()
    return res


def write_lines(lines: DataFrame, header: str, path: str) -> str:
    """Write one prepared text line per row (single string column) with a
    header line at the top of every part file, as the reader expects.

    The CSV writer is used with a tab separator so a line's commas are never
    quoted; no value contains a tab."""
    col = lines.columns[0]
    (lines.select(F.col(col).alias(header)).write.mode("overwrite")
          .option("header", "true").option("sep", "\t").option("escapeQuotes", "false")
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
          .csv(path))
    return path
