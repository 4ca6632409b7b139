"""Migration orchestration and reports.

A table copy is ``read -> repartition -> stage -> verify -> load``; the row
count comes from ``DataFrame.observe`` on the staging write, so the source is
read exactly once per table (the source counted with a second full read)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import io


def copy_table(df: DataFrame, table: str, stage_base: str, run_id: str, n_partitions: int = 20,
               partition_column: str | None = None,
               load: Callable[[DataFrame, str], None] | None = None) -> dict:
    """One table: repartition, stage as Parquet (observed row count), verify the
    staged count, optionally load the staged files onward; returns a summary."""
    obs = Observation(f"copy_{table}")
    observed = io.repartition_by_key(df, n_partitions, partition_column).observe(
        obs, F.count(F.lit(1)).alias("records"))
    path = io.stage_parquet(observed, stage_base, run_id, table)
    records = obs.get["records"]
    staged = df.sparkSession.read.parquet(path)
    staged_records = staged.count()  # reads Parquet footers/row groups, not the source
    if load is not None:
        load(staged, table)
    return {"table_name": table, "records": int(records), "staged_records": int(staged_records),
            "counts_match": int(records) == int(staged_records), "path": path}


def copy_tables(spark: SparkSession, sources: Mapping[str, DataFrame], config: Mapping,
                stage_base: str, run_id: str, load=None, max_concurrent: int = 4) -> DataFrame:
    """S19 + Q19: copy each configured table and return one summary row per table.

    ``config`` follows the migration settings: ``num_partitions`` and
    ``tables -> {partition_column}``.  Each copy is a parallel Spark job; up to
    ``max_concurrent`` tables are submitted at once (Spark schedules concurrent
    jobs from driver threads), so small tables do not leave the cluster idle.
    A failing table raises after the others finish; summaries keep config order."""
    from concurrent.futures import ThreadPoolExecutor
    n = int(config.get("num_partitions", 10))
    items = list(config["tables"].items())

    def one(item):
        table, opts = item
        return copy_table(sources[table], table, stage_base, run_id, n,
                          (opts or {}).get("partition_column"), load)
    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        rows = list(pool.map(one, items))
    return run_summary(spark, rows)


def run_summary(spark: SparkSession, results: list[dict]) -> DataFrame:
    """Q19: one row per table: name, records, staged records, match flag, path."""
    return spark.createDataFrame(
        [(r["table_name"], r["records"], r["staged_records"], r["counts_match"], r["path"]) for r in results],
        "table_name string, records long, staged_records long, counts_match boolean, path string")


def migration_report(status: DataFrame, log: DataFrame | None = None, run_col: str = "run_id",
                     log_run_col: str | None = None) -> DataFrame:
    """Q16: per run: overall status (Not Started / In Progress / Completed from
    progress), progress %, totals, partitions completed and error-line count."""
    parts = F.coalesce(F.col("partitions"), F.array().cast("array<struct<records_count:bigint>>"))
    done = F.aggregate(parts, F.lit(0).cast("long"),
                       lambda a, p: a + F.coalesce(p["records_count"], F.lit(0)).cast("long"))
    total = F.coalesce(F.col("total_records"), F.lit(0))
    pct = F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0))
    rep = status.select(
        run_col, pct.alias("progress_pct"), total.alias("total_records"),
        F.coalesce(F.col("total_size_mb"), F.lit(0.0)).alias("total_size_mb"),
        F.size(parts).alias("partitions_completed"),
        F.when(F.col("total_records").isNull(), "Not Started")
         .when(pct >= 100, "Completed").when(done > 0, "In Progress").otherwise("Not Started")
         .alias("overall_status"))
    if log is not None and log_run_col:
        errs = (log.filter(F.col("level") == "ERROR").groupBy(F.col(log_run_col).alias(run_col))
                .agg(F.count(F.lit(1)).alias("n_errors")))
        rep = rep.join(errs, run_col, "left").withColumn("n_errors", F.coalesce("n_errors", F.lit(0)))
    return rep


def incremental_load(df: DataFrame, key: str, last_mark=None) -> DataFrame:
    """Q17: the rows above the stored high-water mark (lazy)."""
    return df if last_mark is None else df.filter(F.col(key) > F.lit(last_mark))


def incremental_write(df: DataFrame, key: str, path: str, mark_path: str, fmt: str = "parquet"):
    """Q17 end to end: load the increment above the stored mark, append it to
    ``path``, then advance the mark from the rows actually written (read back),
    so a failed or concurrent load never moves the mark past unwritten rows.
    Returns (written increment, new mark)."""
    spark = df.sparkSession
    last = load_mark(spark, mark_path)
    inc = incremental_load(df, key, None if last is None else _typed(df, key, last))
    # named by the mark it starts from: a retry after a failure replaces the same batch
    import hashlib
    batch = f"{path.rstrip('/')}/load_id={hashlib.md5(repr(last).encode()).hexdigest()}"
    inc.write.mode("overwrite").format(fmt).save(batch)
    written = spark.read.format(fmt).load(batch)
    nxt = written.agg(F.max(key)).first()[0]
    if nxt is not None:
        save_mark(spark, mark_path, key, nxt)
    return written, (nxt if nxt is not None else last)


def _typed(df: DataFrame, key: str, mark: str):
    t = dict(df.dtypes)[key]
    return int(mark) if t in ("bigint", "int", "smallint", "tinyint") else mark


def save_mark(spark: SparkSession, path: str, key: str, mark) -> None:
    """Append a high-water mark (key, mark, time written); the latest one wins.
    Append-only, so a retried or concurrent writer never destroys a mark."""
    (spark.createDataFrame([(key, None if mark is None else str(mark))], "key string, mark string")
     .withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(path))


def load_mark(spark: SparkSession, path: str):
    """The latest stored mark (None on the first run).  The mark table is created
    with a null entry first, so no read ever targets a missing path."""
    save_mark(spark, path, "", None)
    r = (spark.read.parquet(path).filter(F.col("mark").isNotNull())
         .orderBy(F.col("written_at").desc()).limit(1).collect())
    return r[0]["mark"] if r else None
