"""Scans and sinks.

All readers take explicit schemas; JDBC reads are pushed-down and partitioned
by Spark's own ``partitionColumn`` splitting.  Writers return the path or
table they wrote so the next step reads what was written (not the source
again)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relational import require_columns

# Run-log line layouts (timestamp with optional ",mmm" milliseconds):
#   "<ts> - <LEVEL>: <message>"
#   "<ts> - <logger> - <LEVEL> - <message>"
#   "<ts> | <file>:<line> | <LEVEL> | <message>"
LOG_TS = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:[,.]\d+)?)"
LOG_LAYOUTS = [
    LOG_TS + r" - ()([A-Z]+): (.*)$",
    LOG_TS + r" - ([^ ]+) - ([A-Z]+) - (.*)$",
    LOG_TS + r" \| ([^|]+?) \| ([A-Z]+) \| (.*)$",
]
LOG_LINE_PATTERN = "^" + LOG_LAYOUTS[0]
LOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"

RUN_STATUS_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("total_size_mb", T.DoubleType()),
    T.StructField("s3_upload_success", T.IntegerType()),
    T.StructField("partitions", T.ArrayType(T.StructType([T.StructField("records_count", T.LongType())]))),
])

METRIC_LOG_SCHEMA = "timestamp long, value double, steps long"


# ---------------------------------------------------------------- JDBC

def jdbc_scan(spark: SparkSession, url: str, table: str, props: Mapping[str, str],
              fetchsize: int = 10000) -> DataFrame:
    """Whole-table JDBC read (filters/columns applied later are pushed to the source)."""
    return spark.read.jdbc(url, table, properties={"fetchsize": str(fetchsize), **props})


def jdbc_query_scan(spark: SparkSession, url: str, sql: str, props: Mapping[str, str]) -> DataFrame:
    """Push a whole SELECT to the source."""
    return spark.read.format("jdbc").options(url=url, query=sql, **props).load()


def jdbc_bounds(spark, url, table, column, props):
    """MIN/MAX of the split column, computed by the source (one row)."""
    row = jdbc_query_scan(spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}",
                          props).first()
    return row[0], row[1]


def jdbc_range_scan(spark: SparkSession, url: str, table: str, column: str, n: int = 15,
                    props: Mapping[str, str] | None = None, bounds=None,
                    fetchsize: int = 10000) -> DataFrame:
    """S3: parallel read in ``n`` ranges of ``column`` (numeric, date or timestamp).

    Spark's partitioned JDBC read makes the first range also take NULLs and
    values below MIN, and the last range open-ended, so no row is lost (the
    source's own split dropped the row holding MAX)."""
    props = dict(props or {})
    lo, hi = bounds if bounds is not None else jdbc_bounds(spark, url, table, column, props)
    if lo is None:
        return jdbc_scan(spark, url, table, props, fetchsize)
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lo),
                     upperBound=str(hi), numPartitions=str(n), fetchsize=str(fetchsize), **props)
            .load())


def source_catalog(spark: SparkSession, url: str, props: Mapping[str, str],
                   catalog_sql: str = "SELECT name FROM sysobjects WHERE type = 'U'") -> DataFrame:
    """User tables of the source, from its catalog view (dialect-specific SQL)."""
    return jdbc_query_scan(spark, url, catalog_sql, props)


def source_keys(spark: SparkSession, url: str, props: Mapping[str, str], key_sql: str) -> DataFrame:
    """Q18: primary-key columns from the source catalog (dialect-specific SQL pushed
    down as one query; space used comes from Q3 instead of a stored procedure)."""
    return jdbc_query_scan(spark, url, key_sql, props)


# ---------------------------------------------------------------- partitioning, copy, stage

def repartition_by_key(df: DataFrame, n: int | None = None, column: str | None = None) -> DataFrame:
    """Hash repartition before a write, rows of a key together.

    Partitions are sized from the bytes that arrive (``advisoryPartitionSizeInBytes``): small
    ones are put together and those of a hot key are split, so ``n``, the number to start
    from (by default that of the session), neither bounds the copy nor makes empty files."""
    by = ([] if n is None else [n]) + ([column] if column else [])
    return df.hint("rebalance", *by)


def copy_append(df: DataFrame, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None,
                partition_by: Sequence[str] = ()) -> str:
    """Append a copy (partitions are the chunks; for JDBC sinks pass ``batchsize``)."""
    w = df.write.mode("append").format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def stage_parquet(df: DataFrame, base: str, run_id: str, table: str) -> str:
    """Overwrite-write to ``<base>/<run_id>/<table>`` and return the path."""
    path = f"{base.rstrip('/')}/{run_id}/{table}"
    df.write.mode("overwrite").parquet(path)
    return path


#: Formats that need a package Spark does not bring, and what is written where it is absent.
STAND_INS = {"iceberg": "parquet", "avro": "orc"}


def stage_with_format(df: DataFrame, path: str, fmt: str, installed: Sequence[str] = ()) -> tuple[str, str]:
    """S10 writer: the format name comes from ``profile.stage_format``.  Formats in
    ``STAND_INS`` are written as such only if ``installed`` names them.  Returns the path
    and the format that was written, for the reader."""
    written = fmt if fmt in installed else STAND_INS.get(fmt, fmt)
    df.write.mode("overwrite").format(written).save(path)
    return path, written


def read_staged(spark: SparkSession, path: str, written: str) -> DataFrame:
    """A table staged by ``stage_with_format``."""
    return spark.read.format(written).load(path)


def warehouse_sink(df: DataFrame, fmt: str, options: Mapping[str, str], table: str | None = None) -> None:
    """Overwrite a target table through a connector (e.g. ``jdbc`` with url/dbtable)."""
    opts = dict(options)
    if table:
        opts.setdefault("dbtable", table)
    df.write.format(fmt).options(**opts).mode("overwrite").save()


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create-or-replace a table (external at ``path`` when given) and read it back."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, name: str, key: Sequence[str] | str, n_buckets: int,
                  path: str | None = None) -> DataFrame:
    """Stage a table bucketed and sorted by its join key, so later joins and
    aggregations on that key between tables bucketed the same way run without
    a shuffle (co-located sort-merge join)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = df.write.mode("overwrite").format("parquet").bucketBy(n_buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> str:
    """Replace only the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).parquet(path))
    return path


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A table over staged files, no copy."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def named_view(df: DataFrame, name: str) -> DataFrame:
    """A precomputed join behind a name (materialise with ``save_table``)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# ---------------------------------------------------------------- file scans

def csv_scan(spark: SparkSession, path: str, schema, required: Sequence[str] = (),
             header: bool = True) -> DataFrame:
    """Quoted CSV with an explicit schema and a required-column guard."""
    df = (spark.read.schema(schema).option("header", str(header).lower()).option("quote", '"')
          .option("escape", '"').option("mode", "FAILFAST").csv(path))
    return require_columns(df, required)


def metric_log_scan(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated ``timestamp value steps`` lines, ordered by step."""
    return (spark.read.schema(METRIC_LOG_SCHEMA).option("sep", " ").option("header", "false")
            .csv(path).orderBy("steps"))


def run_status_scan(spark: SparkSession, glob: str, multi_line: bool = True) -> DataFrame:
    """All run-status JSON documents under ``glob`` with an explicit schema."""
    return spark.read.schema(RUN_STATUS_SCHEMA).option("multiLine", str(multi_line).lower()).json(glob)


def run_log_scan(spark: SparkSession, glob: str) -> DataFrame:
    """Run-log lines in any of the known layouts into (ts, level, source,
    message); lines in other layouts keep their text in ``message`` with NULL
    ts/level/source."""
    v = F.col("value")
    parts = []
    for i in range(1, 5):
        parts.append(F.coalesce(*[F.when(v.rlike("^" + p), F.regexp_extract(v, "^" + p, i))
                                  for p in LOG_LAYOUTS]))
    ts, source, level, message = parts
    return spark.read.text(glob).select(
        F.to_timestamp_ntz(F.regexp_replace(ts, ",", ".")).alias("ts"), level.alias("level"),
        F.when(source != "", source).alias("source"), F.coalesce(message, v).alias("message"))


def object_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Stored objects without their bodies (the ``content`` column is pruned)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "modificationTime", "length")
