"""Table profiling and migration planning.

The whole profile is one aggregation over one scan (the source analysed a
table with one job per column and two more per candidate key, each re-reading
the source)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_KEY_TYPES = ("int", "bigint", "smallint", "tinyint", "timestamp", "timestamp_ntz", "date")
MB = 1024 * 1024

ESTIMATE_ERROR = 0.02  # relative standard error of the approximate counts

# Size tiers (GB) and the staging format chosen per tier.
SMALL_LIMIT_GB = 1
LARGE_LIMIT_GB = 100
TIER_FORMATS = {"small": "parquet", "medium": "parquet", "large": "iceberg", "row": "avro"}
TIER_PATHS = {"small": "local", "medium": "spark", "large": "spark-autoscaled"}


def _distinct_with_null(c: str, exact: bool) -> Column:
    base = F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(F.col(c), ESTIMATE_ERROR)
    return (base + F.max(F.col(c).isNull().cast("int"))).cast("long")


def _text_len(cols: Sequence[str]) -> Column:
    return sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in cols), F.lit(0))


def row_text_bytes(cols: Sequence[str] | None = None) -> Column:
    """Length of a row's text: the JSON of the whole row, or the text of ``cols``."""
    if cols is None:
        return F.length(F.to_json(F.struct("*")))
    return _text_len(cols)


def profile_table(df: DataFrame, exact: bool = True, size_cols: Sequence[str] | None = None,
                  table_name: str | None = None) -> DataFrame:
    """Q1: long form (column_name, dtype, null_count, distinct_count, row_count,
    size_mb) from a single aggregation; dtypes come from the schema (A8)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows"),
            F.sum(row_text_bytes(size_cols)).alias("_bytes")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        aggs.append(_distinct_with_null(c, exact).alias(f"d{i}"))
    wide = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"n{i}").cast("long").alias("null_count"),
                 F.col(f"d{i}").alias("distinct_count")) for i, c in enumerate(cols)]))
    out = wide.select(rows.alias("_s"), F.col("_rows").alias("row_count"),
                      F.round(F.coalesce(F.col("_bytes"), F.lit(0)) / F.lit(MB), 2).alias("size_mb"))
    out = out.select("_s.*", "row_count", "size_mb")
    if table_name:
        out = out.withColumn("table_name", F.lit(table_name))
    return out


def column_sketches(df: DataFrame, by: Sequence[str] = (), cols: Sequence[str] | None = None, lg_k: int = 12) -> DataFrame:
    """Q1/A6 at scale: one row per partition of the table (the columns ``by``) and column,
    with its rows, its nulls and a mergeable sketch of its distinct values.

    One pass with partial aggregation and without row expansion; the table is kept, and
    when a partition changes only that partition's rows are computed again.  The
    relative standard error of an estimate is 1.04 / sqrt(2^lg_k), 1.6 % for 12."""
    cols = [c for c in (cols or df.columns) if c not in by]
    # floating zeros and NaNs are one value each, as in COUNT(DISTINCT); a sketch takes numbers and text
    kinds = dict(df.dtypes)
    as_value = {c: F.col(c) if kinds[c] in ("int", "bigint", "string", "binary") else F.col(c).cast("string") for c in cols}
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[x for n, c in enumerate(cols) for x in (
        F.count_if(F.col(c).isNull()).alias(f"n{n}"), F.hll_sketch_agg(as_value[c], lg_k).alias(f"s{n}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{n}").alias("null_count"), F.col(f"s{n}").alias("sketch")) for n, c in enumerate(cols)])
    return wide.select(*by, F.col("_rows").alias("row_count"), F.explode(rows).alias("_s")).select(*by, "_s.column_name", "row_count", "_s.null_count", "_s.sketch")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column (and ``by``): rows, nulls and the estimated distinct count (a null counts
    as a value) over all partitions of ``column_sketches``; the table is not read again."""
    merged = sketches.groupBy(*by, "column_name").agg(F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
                                                      F.hll_union_agg("sketch").alias("sketch"))
    estimate = F.hll_sketch_estimate("sketch") + F.when(F.col("null_count") > 0, 1).otherwise(0)
    return merged.select(*by, "column_name", "row_count", "null_count", estimate.cast("long").alias("distinct_estimate"))


def exact_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, distinct_count) of the named columns, a null counting as a value: the
    values of each partition are made distinct before the shuffle, column by column, on
    (column, value) rows; no task sees all values of a column."""
    value = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(value.alias("_v")).select("_v.*").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))


def suggest_partition_keys(df: DataFrame, lo: int = 10, hi: int = 1000,
                           types: Sequence[str] = PARTITION_KEY_TYPES) -> DataFrame:
    """Q2: integer/time columns with lo..hi distinct values (NULL counts as a value),
    with the distinct count and its share of rows (%, 2 places).

    One approximate pass over all candidates; the exact count is taken only for columns
    whose estimate is within four standard errors of the window (two aggregations, never
    one job per column)."""
    cands = [c for c, t in df.dtypes if t in types]
    spark = df.sparkSession
    if not cands:
        return spark.createDataFrame([], "column_name string, distinct_count long, distinct_pct double")
    est = df.agg(*[_distinct_with_null(c, False).alias(c) for c in cands]).first().asDict()
    slack = 4 * ESTIMATE_ERROR
    near = [c for c in cands if lo * (1 - slack) - 1 <= est[c] <= hi * (1 + slack) + 1]
    if not near:
        return spark.createDataFrame([], "column_name string, distinct_count long, distinct_pct double")
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[_distinct_with_null(c, True).alias(f"d{i}") for i, c in enumerate(near)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                        F.col(f"d{i}").alias("distinct_count"))
                               for i, c in enumerate(near)]))
    out = wide.select(rows.alias("_s"), "_rows").select("_s.*", "_rows")
    return (out.filter(F.col("distinct_count").between(lo, hi))
            .select("column_name", "distinct_count",
                    F.round(F.col("distinct_count") * 100.0 / F.col("_rows"), 2).alias("distinct_pct")))


def estimate_size_mb(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3: total length of the rows' text in MB (2 places), with the row count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.round(F.coalesce(F.sum(row_text_bytes(cols)), F.lit(0)) / F.lit(MB), 2)
                  .alias("size_mb"))


def estimate_transfer(sizes: DataFrame, size_col: str = "size_mb", mbps: float = 100.0,
                      overhead: float = 1.2) -> DataFrame:
    """Q4: seconds = MB * 8 / mbps * overhead and minutes, both to 2 places."""
    secs = F.col(size_col) * 8.0 / F.lit(float(mbps)) * F.lit(float(overhead))
    return sizes.withColumns({"network_bandwidth_mbps": F.lit(float(mbps)),
                              "transfer_seconds": F.round(secs, 2),
                              "transfer_minutes": F.round(secs / 60.0, 2)})


def range_partitions(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """Q5: n equal-width ranges from MIN..MAX; rows per range.  The last range is
    closed so the row holding MAX is kept (the source lost it)."""
    # MIN/MAX is one row of two scalars: read it once and inline as literals
    lo_v, hi_v = df.agg(F.min(column), F.max(column)).first()
    if lo_v is None:
        return df.sparkSession.createDataFrame(
            [], "bucket int, range_lo double, range_hi double, row_count long")
    x, lo, hi = F.col(column), F.lit(lo_v), F.lit(hi_v)
    span = float(hi_v - lo_v)
    if span == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((x - lo).cast("double") * F.lit(n) / F.lit(span)), F.lit(n - 1))
    counts = (df.filter(x.isNotNull()).groupBy(b.cast("int").alias("bucket"))
              .agg(F.count(F.lit(1)).alias("row_count")))
    w = F.lit(span / n)
    return counts.select("bucket",
                         (F.lit(float(lo_v)) + F.col("bucket") * w).alias("range_lo"),
                         (F.lit(float(lo_v)) + (F.col("bucket") + 1) * w).alias("range_hi"),
                         "row_count")


def size_tier(size_mb) -> Column:
    """Tier from size: small < 1 GB <= medium <= 100 GB < large."""
    gb = (F.col(size_mb) if isinstance(size_mb, str) else size_mb) / F.lit(1024.0)
    return (F.when(gb < SMALL_LIMIT_GB, "small").when(gb <= LARGE_LIMIT_GB, "medium")
            .otherwise("large"))


def route_by_size(sizes: DataFrame, size_col: str = "size_mb") -> DataFrame:
    """Q13: tier, processing path and staging format for each table (S10 inside)."""
    tier = size_tier(size_col)
    fmt = F.create_map(*[x for k, v in TIER_FORMATS.items() for x in (F.lit(k), F.lit(v))])
    path = F.create_map(*[x for k, v in TIER_PATHS.items() for x in (F.lit(k), F.lit(v))])
    return sizes.withColumn("tier", tier).withColumns({
        "path": path[F.col("tier")], "staging_format": fmt[F.col("tier")]})


def stage_format(size_mb: float, row_oriented: bool = False) -> str:
    """Staging format for one table (pure function; the writer takes the name)."""
    if row_oriented:
        return TIER_FORMATS["row"]
    gb = size_mb / 1024.0
    tier = "small" if gb < SMALL_LIMIT_GB else ("medium" if gb <= LARGE_LIMIT_GB else "large")
    return TIER_FORMATS[tier]
