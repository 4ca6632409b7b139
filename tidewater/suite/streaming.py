"""Registered streaming queries (X1-X8): each runs its stream to the end with
``availableNow`` into a fresh folder under the shared checkpoint folder and
returns the sink read back, so it can be compared with its batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import text as TX
from ..sources import derived
from ..streaming import series as S
from ..streaming import streams as X
from ..streaming import versions as V
from .common import rounded, tables, with_shapes

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


def _stream(spark, sf, name):
    schema = tables(spark, sf).__getattr__(name).schema
    return X.table_stream(spark, f"{sf.rstrip('/')}/{name}.parquet", schema)


@reg("progress_stream", """WITH t AS (SELECT user_id AS run_id, COUNT(*) AS total_records FROM events GROUP BY 1),
  d AS (SELECT user_id AS run_id, SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS records_done
        FROM events GROUP BY 1)
  SELECT d.run_id, d.records_done, t.total_records,
    ROUND(CASE WHEN t.total_records > 0 THEN d.records_done * 100.0 / t.total_records ELSE 0.0 END, 6) AS progress_pct,
    CASE WHEN t.total_records IS NULL OR d.records_done <= 0 THEN 'Not Started'
         WHEN d.records_done >= t.total_records THEN 'Completed' ELSE 'In Progress' END AS status
  FROM d LEFT JOIN t ON d.run_id = t.run_id""")
def _x1(spark, sf):
    run = X.new_run_dir(spark, "progress")
    parts = _stream(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.when(F.col("event_type") != "error", 1).otherwise(0).cast("long").alias("records_count"))
    totals = tables(spark, sf).events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("total_records"))
    X.run_to_end(X.progress_stream(parts, totals, run + "/out", run + "/ckpt"))
    return rounded(X.progress_snapshot(spark, run + "/out"))


@reg("error_stream", "SELECT event_id, ts, user_id FROM events WHERE event_type = 'error'")
def _x2(spark, sf):
    run = X.new_run_dir(spark, "errors")
    ev = _stream(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    X.run_to_end(X.error_stream(ev, run + "/out", run + "/ckpt", F.col("event_type") == "error"))
    return spark.read.parquet(run + "/out").select("event_id", "ts", "user_id")


@reg("cdc_upsert_stream", """SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def _x3(spark, sf):
    run = X.new_run_dir(spark, "cdc")
    ch = _stream(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    X.run_to_end(X.cdc_upsert_stream(ch, run + "/table", run + "/ckpt", ["user_id"], ["ts", "event_id"]))
    return V.cdc_current(spark, run + "/table", ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value")


@reg("cdc_dedup_stream", "SELECT DISTINCT event_id, ts, user_id FROM events")
def _x4(spark, sf):
    run = X.new_run_dir(spark, "dedup")
    a = X.event_time(_stream(spark, sf, "events").select("event_id", "ts", "user_id"))
    b = X.event_time(_stream(spark, sf, "events").select("event_id", "ts", "user_id"))
    X.run_to_end(X.cdc_dedup_stream(a.unionByName(b), run + "/out", run + "/ckpt", ["event_id"]))
    return spark.read.parquet(run + "/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@reg("index_refresh_stream", """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS BIGINT)
  AS chunk_no, CAST(s AS BIGINT) AS chunk_start, substr(text, s + 1, 2000) AS chunk
  FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 300 - 1, 0), 1700)) AS s
        FROM documents WHERE length(text) > 0)""")
def _x5(spark, sf):
    run = X.new_run_dir(spark, "index")

    def build(docs):
        c = TX.chunk_fixed(docs, "text", 2000, 300, ["doc_id"])
        return c.withColumn("chunk_no", F.col("chunk_no").cast("long")).withColumn(
            "chunk_start", F.col("chunk_start").cast("long"))
    docs = _stream(spark, sf, "documents").select("doc_id", "text")
    X.run_to_end(X.index_refresh_stream(docs, run + "/index", run + "/ckpt", build))
    return spark.read.parquet(run + "/index")


F2_SQL = """SELECT date, close, lag_5_days, ROUND(std_dev, 6) AS std_dev, ROUND(CASE WHEN std_dev = 0 OR std_dev
  IS NULL OR lag_5_days IS NULL THEN NULL ELSE (close - lag_5_days) / std_dev END, 6) AS z_score
  FROM (SELECT date, close, LAG(close, 5) OVER (ORDER BY date) AS lag_5_days,
        STDDEV_SAMP(close) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS std_dev FROM market)"""


@reg("feature_refresh", with_shapes(F2_SQL, "market"))
def _x6(spark, sf):
    run = X.new_run_dir(spark, "features")
    m = derived.market(spark, sf)
    cut = "1998-06-15"

    def compute(df):
        return FT.lag_zscore(df, "close", 5, 5)
    first = m.filter(F.col("date") < F.lit(cut).cast("date"))
    start = first.agg(F.min("date")).first()[0]
    X.feature_refresh(first, run + "/features", start, compute)
    out = X.feature_refresh(m, run + "/features", cut, compute)
    return rounded(out.drop("month"))


def _three_parts(df, col, cuts):
    """The rows below the first cut, between the cuts, and from the second on (nulls first)."""
    c = F.col(col)
    a, b = [F.lit(x).cast(df.schema[col].dataType) for x in cuts]
    return [df.filter(c.isNull() | (c < a)), df.filter((c >= a) & (c < b)), df.filter(c >= b)]


@reg("cdc_snapshot_stream", """SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'""")
def _x3_snapshots(spark, sf):
    """Three runs over a growing feed whose error events delete their user; a snapshot
    is taken after the second run, so the result is snapshot and later changes."""
    run = X.new_run_dir(spark, "cdc_snapshots")
    events = tables(spark, sf).events.select("user_id", "event_id", "ts", "event_type", "value")
    key, seq = ["user_id"], ["ts", "event_id"]
    cuts = events.agg(F.percentile_approx("event_id", [0.4, 0.8])).first()[0] or [0, 0]
    for n, part in enumerate(_three_parts(events, "event_id", cuts)):
        part.write.mode("append").parquet(run + "/feed")
        feed = spark.readStream.schema(events.schema).parquet(run + "/feed")
        X.run_to_end(X.cdc_upsert_stream(feed, run + "/table", run + "/ckpt", key, seq))
        if n:
            V.cdc_compact(spark, run + "/table", key, seq)
    return V.cdc_current(spark, run + "/table", key, seq, "event_type", "error").select(events.columns)


F2_TICKER_SQL = F2_SQL.replace("SELECT date", "SELECT ticker, date").replace("ORDER BY date", "PARTITION BY ticker ORDER BY date").replace("FROM market", "FROM stock")


@reg("feature_refresh_stream", with_shapes(F2_TICKER_SQL, "stock"))
def _x6_stream(spark, sf):
    """Three runs over a growing series table; each reads the new rows only."""
    run = X.new_run_dir(spark, "series")
    stock = derived.stock(spark, sf).select("ticker", "date", "close")
    for part in _three_parts(stock, "date", ["1994-03-10", "1997-07-05"]):
        part.write.mode("append").parquet(run + "/series")
        rows = spark.readStream.schema(stock.schema).parquet(run + "/series")
        X.run_to_end(S.feature_refresh_stream(rows, run + "/features", run + "/ckpt", ["ticker"], "date", 5, S.lag_zscore_frame(),
                                              "lag_5_days double, std_dev double, z_score double"))
    return rounded(spark.read.parquet(run + "/features").drop("is_late"))


WIN_SQL = """WITH c AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
    event_type, COUNT(*) AS n_events FROM events GROUP BY 1, 2, 3),
  e AS (SELECT * FROM c WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE),
  s AS (SELECT event_type, AVG(n_events) AS m, STDDEV_POP(n_events) AS sd FROM e GROUP BY 1)
  SELECT e.window_start, e.window_end, e.event_type, e.n_events,
    ROUND(CASE WHEN s.sd = 0 OR s.sd IS NULL THEN NULL ELSE (e.n_events - s.m) / s.sd END, 6) AS z_score,
    CASE WHEN abs(CASE WHEN s.sd = 0 OR s.sd IS NULL THEN NULL ELSE (e.n_events - s.m) / s.sd END) > 2.0
         THEN 1 ELSE 0 END AS is_anomaly
  FROM e JOIN s ON e.event_type = s.event_type"""


@reg("windowed_anomaly_stream", WIN_SQL)
def _x7(spark, sf):
    run = X.new_run_dir(spark, "windows")
    ev = X.event_time(_stream(spark, sf, "events").select("ts", "event_type"))
    X.run_to_end(X.windowed_counts_stream(ev, run + "/out", run + "/ckpt"))
    counts = spark.read.parquet(run + "/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n_events")
    return rounded(X.flag_windows(counts, "event_type", "n_events", 2.0))


@reg("ingest_stream", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _x8(spark, sf):
    run = X.new_run_dir(spark, "ingest")
    X.run_to_end(X.ingest_stream(_stream(spark, sf, "orders"), run + "/stage", run + "/ckpt"))
    return spark.read.parquet(run + "/stage")
