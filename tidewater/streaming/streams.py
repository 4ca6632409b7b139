"""Structured Streaming operators.

The source settings (a 300 s status poll, a one-hour index lag, CDC capture
with 72 h retention, a daily refresh) become streaming queries: file sources,
watermarks, windowed and stateful aggregations, ``foreachBatch`` sinks that are
idempotent by batch id, and ``trigger(availableNow=True)`` or
``processingTime`` triggers.  Checkpoints live under the cluster's shared
``spark.checkpoint.dir``.  Every query has a batch twin with the same result.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import zscore_guarded
from ..session import scratch_path
from .versions import read_if_there


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one stream run."""
    return scratch_path(spark, f"streams/{name}/{uuid.uuid4().hex}")


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """File source over ``folder`` restricted to ``file_glob``; explicit schema."""
    r = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def table_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Stream over a stored table, which is one file or a folder of files.  The last
    character is given as a pattern: it finds either, and a file alone is no source folder."""
    return spark.readStream.schema(schema).format(fmt).load(f"{path[:-1]}[{path[-1]}]")


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not timestamp_ntz); the session zone is UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def _trigger(writer, trigger: str | None):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


# ---------------------------------------------------------------- X1

def progress_status(done: Column, total: Column) -> Column:
    """Not Started / In Progress / Completed from done and total records."""
    return (F.when(total.isNull() | (done <= 0), "Not Started")
            .when(done >= total, "Completed").otherwise("In Progress"))


def progress_stream(parts: DataFrame, totals: DataFrame, out_dir: str, ckpt: str,
                    run_col: str = "run_id", count_col: str = "records_count",
                    trigger: str | None = None) -> StreamingQuery:
    """Running progress per run as part records arrive (state: one row per run).

    ``parts`` is streaming (run, records_count); ``totals`` is static (run,
    total_records).  Each micro-batch writes the whole progress to a folder of its
    own (a replayed batch writes the same one again), so a snapshot being read is
    never overwritten; ``progress_snapshot`` reads the newest."""
    agg = parts.groupBy(run_col).agg(F.sum(count_col).alias("records_done"))

    def write(batch: DataFrame, batch_id: int):
        j = batch.join(totals, run_col, "left")
        done, total = F.col("records_done"), F.col("total_records")
        (j.select(run_col, "records_done", "total_records",
                  F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0)).alias("progress_pct"),
                  progress_status(done, total).alias("status"))
         .write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}"))
    w = agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", ckpt)
    return _trigger(w, trigger).start()


def progress_snapshot(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The progress after the newest complete micro-batch, or None before the first."""
    runs = read_if_there(spark, out_dir)
    newest = None if runs is None else runs.agg(F.max("batch_id")).first()[0]
    return None if newest is None else runs.filter(F.col("batch_id") == newest).drop("batch_id")


# ---------------------------------------------------------------- X2

def error_stream(lines: DataFrame, out_dir: str, ckpt: str, predicate: Column,
                 trigger: str | None = None, alert=None) -> StreamingQuery:
    """Stateless filter of error rows, appended to an alert sink.

    With ``alert`` (a function ``(batch_df, batch_id) -> None``, e.g. send a
    notification with the batch's count) each micro-batch is first written to
    ``out_dir/batch_id=<id>`` with overwrite (a replayed batch rewrites the
    same folder) and then handed to ``alert``."""
    errors = lines.filter(predicate)
    if alert is None:
        w = (errors.writeStream.outputMode("append").format("parquet")
             .option("path", out_dir).option("checkpointLocation", ckpt))
        return _trigger(w, trigger).start()

    def write(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        alert(batch.sparkSession.read.parquet(f"{out_dir}/batch_id={batch_id}"), batch_id)
    w = errors.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    return _trigger(w, trigger).start()


def await_completion(spark: SparkSession, query: StreamingQuery, progress_dir: str,
                     poll_seconds: float = 300.0, status_col: str = "status",
                     done_value: str = "Completed") -> bool:
    """X1 "ends when 100": poll the progress snapshot every ``poll_seconds`` and
    stop the stream once every run is complete.  Returns True when stopped for
    completion, False when the query ended by itself."""
    while query.isActive:
        if query.awaitTermination(poll_seconds):
            break
        snap = progress_snapshot(spark, progress_dir)
        if snap is None:
            continue
        left = snap.filter(F.col(status_col) != done_value).limit(1).count()
        if snap.limit(1).count() and not left:
            query.stop()
            return True
    return False


# ---------------------------------------------------------------- X3

def cdc_upsert_stream(changes: DataFrame, base: str, ckpt: str, key: Sequence[str], seq: Sequence[str],
                      trigger: str | None = None) -> StreamingQuery:
    """Apply an ordered change feed to a keyed table, merge-on-read.

    Each micro-batch keeps the last change per key (``max_by`` on the sequence)
    and writes it to ``base/changes/batch_id=<id>`` with overwrite, so a
    replayed batch rewrites the same folder (idempotent).  ``versions.cdc_current``
    resolves the table: the last change per key over a snapshot and the batches
    after it; ``versions.cdc_compact`` writes the snapshots."""
    cols = [c for c in changes.columns]
    order = F.struct(*[F.col(c) for c in seq])

    def write(batch: DataFrame, batch_id: int):
        last = (batch.groupBy(*key).agg(F.max_by(F.struct(*cols), order).alias("_tw_r"))
                .select("_tw_r.*"))
        last.write.mode("overwrite").parquet(f"{base}/changes/batch_id={batch_id}")
    w = changes.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    return _trigger(w, trigger).start()


# ---------------------------------------------------------------- X4

def cdc_dedup_stream(changes: DataFrame, out_dir: str, ckpt: str, key: Sequence[str],
                     ts: str = "ts", retention: str = "72 hours",
                     trigger: str | None = None) -> StreamingQuery:
    """Drop repeats of a key within the retention; rows older than the
    watermark are late and dropped.  State is bounded by the retention."""
    d = changes.withWatermark(ts, retention).dropDuplicatesWithinWatermark(list(key))
    w = (d.writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", ckpt))
    return _trigger(w, trigger).start()


# ---------------------------------------------------------------- X5

def index_refresh_stream(docs: DataFrame, out_dir: str, ckpt: str, build, trigger: str | None = None
                         ) -> StreamingQuery:
    """New documents -> chunks/terms (``build``: DataFrame -> DataFrame) appended
    to the index; ``trigger='1 hour'`` keeps it within an hour of the source."""
    w = (build(docs).writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", ckpt))
    return _trigger(w, trigger).start()


# ---------------------------------------------------------------- X6

def feature_refresh(series: DataFrame, features_path: str, since, compute, order: str = "date",
                    lookback: int = 5, part_col: str = "month") -> DataFrame:
    """Refresh a feature table from new rows only.

    Rows from the first day of ``since``'s month onward are recomputed, with
    the ``lookback`` earlier rows as window context, and only those month
    partitions are replaced (dynamic partition overwrite); older months are not
    read or written.  ``compute``: DataFrame -> DataFrame (e.g. F2)."""
    month_start = F.trunc(F.lit(since).cast("date"), "month")
    ctx = (series.filter(F.col(order) < month_start).select(order)
           .orderBy(F.col(order).desc()).limit(lookback))          # a k-row top-k
    first_ctx = ctx.agg(F.min(order)).first()[0]
    rows = series if first_ctx is None else series.filter(F.col(order) >= F.lit(first_ctx))
    fresh = (compute(rows).filter(F.col(order) >= month_start)
             .withColumn(part_col, F.date_format(F.col(order), "yyyy-MM")))
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(features_path))
    return series.sparkSession.read.parquet(features_path)


# ---------------------------------------------------------------- X7

def windowed_counts_stream(events: DataFrame, out_dir: str, ckpt: str, ts: str = "ts",
                           group: str = "event_type", window: str = "1 hour",
                           slide: str | None = None, delay: str = "10 minutes",
                           session_gap: str | None = None, trigger: str | None = None) -> StreamingQuery:
    """X7 (stream part): counts per event-time window and type with a watermark;
    tumbling by default, sliding with ``slide``, session windows with ``session_gap``."""
    w = (F.session_window(ts, session_gap) if session_gap else
         (F.window(ts, window, slide) if slide else F.window(ts, window)))
    agg = (events.withWatermark(ts, delay).groupBy(w.alias("window"), group)
           .agg(F.count(F.lit(1)).alias("n_events")))
    out = agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     group, "n_events")
    wr = (out.writeStream.outputMode("append").format("parquet").option("path", out_dir)
          .option("checkpointLocation", ckpt))
    return _trigger(wr, trigger).start()


def flag_windows(counts: DataFrame, group: str = "event_type", value: str = "n_events",
                 threshold: float = 2.0) -> DataFrame:
    """X7 (flag part): z-score of each window's count against its type's mean and
    population deviation (F1 guard); anomalous when |z| > threshold."""
    stats = counts.groupBy(group).agg(F.avg(value).alias("_tw_m"), F.stddev_pop(value).alias("_tw_s"))
    z = zscore_guarded(F.col(value).cast("double"), F.col("_tw_m"), F.col("_tw_s"))
    return (counts.join(stats, group).withColumn("z_score", z)
            .withColumn("is_anomaly", F.when(F.abs(F.col("z_score")) > threshold, 1).otherwise(0))
            .drop("_tw_m", "_tw_s"))


# ---------------------------------------------------------------- X8

def ingest_stream(src: DataFrame, out_dir: str, ckpt: str, partition_by: Sequence[str] = (),
                  trigger: str | None = None) -> StreamingQuery:
    """The staging path used by batch loads, fed by a stream (parquet sink
    with checkpoint: exactly-once file output)."""
    w = src.writeStream.outputMode("append").format("parquet").option("path", out_dir) \
        .option("checkpointLocation", ckpt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start()
