"""Registered queries for scans, sinks and migration steps (S*, A10, A11, Q16, Q17, Q19).

Each writes what it needs into a fresh folder under the shared checkpoint
folder and reads it back through the operator under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds_ntz
from ..operators import migrate as M
from ..operators import profile as P
from ..operators import relational as R
from ..session import scratch_path
from ..sources import io
from .common import money, rounded, tables

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


def _run(spark, name):
    return scratch_path(spark, f"io/{name}/{uuid.uuid4().hex}")


ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@reg("repartition_by_key", ORDERS_SQL)
def _s4(spark, sf):
    return io.repartition_by_key(tables(spark, sf).orders, 20, "o_custkey")


@reg("copy_append", "SELECT l_returnflag, COUNT(*) AS n_rows FROM lineitem GROUP BY 1")
def _s6(spark, sf):
    path = _run(spark, "append")
    io.copy_append(tables(spark, sf).lineitem, path)
    return spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"))


@reg("csv_scan", "SELECT r_regionkey, r_name FROM region")
def _s7(spark, sf):
    path = _run(spark, "csv")
    tables(spark, sf).region.write.option("header", "true").csv(path)
    return io.csv_scan(spark, path, "r_regionkey int, r_name string", ["r_regionkey", "r_name"])


@reg("metric_log_scan", "SELECT CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, value, event_id AS steps FROM events")
def _s8(spark, sf):
    path = _run(spark, "metrics")
    ev = tables(spark, sf).events
    ev.select(F.concat_ws(" ", epoch_seconds_ntz("ts").cast("string"),
                          F.col("value").cast("string"), F.col("event_id").cast("string"))).write.text(path)
    return io.metric_log_scan(spark, path)


@reg("stage_parquet", ORDERS_SQL)
def _s9(spark, sf):
    path = io.stage_parquet(tables(spark, sf).orders, _run(spark, "stage"), "run1", "orders")
    return spark.read.parquet(path)


@reg("save_table", "SELECT r_regionkey, r_name FROM region")
def _s12(spark, sf):
    name = f"tw_region_{uuid.uuid4().hex[:12]}"
    return io.save_table(tables(spark, sf).region, name, _run(spark, "table"))


@reg("overwrite_partitions", """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN '5-LOW'
  ELSE o_orderpriority END AS o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def _s13(spark, sf):
    path = _run(spark, "parts")
    o = tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_orderdate") \
        .withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    io.overwrite_partitions(o.drop("o_orderdate"), path, ["month"])
    new = (o.filter(F.year("o_orderdate") == 1998).withColumn("o_orderpriority", F.lit("5-LOW"))
           .drop("o_orderdate"))
    io.overwrite_partitions(new, path, ["month"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "month")


@reg("external_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _s14(spark, sf):
    path = _run(spark, "ext")
    tables(spark, sf).nation.write.parquet(path)
    return io.external_table(spark, f"tw_nation_{uuid.uuid4().hex[:12]}", path)


@reg("named_view", """SELECT o_orderkey, c_custkey, c_name,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, c_custkey, c_name""")
def _s18(spark, sf):
    t = tables(spark, sf)
    li = t.lineitem.select("l_orderkey", money("l_quantity").alias("l_quantity"),
                           money("l_extendedprice").alias("l_extendedprice"))
    name = f"tw_order_totals_{uuid.uuid4().hex[:12]}"
    io.named_view(R.order_totals(t.orders, t.customer, li), name)
    return spark.sql(f"SELECT o_orderkey, c_custkey, c_name, CAST(total AS DOUBLE) AS total FROM {name}")


# ---- run status documents and run logs derived from events

def _write_status(spark, sf, path):
    ev = tables(spark, sf).events
    per_type = (ev.filter(F.col("event_type") != "error").groupBy("user_id", "event_type")
                .agg(F.count(F.lit(1)).alias("records_count")))
    parts = per_type.groupBy("user_id").agg(F.array_sort(F.collect_list(
        F.struct("event_type", "records_count"))).alias("p"))
    tot = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_records"),
                                    F.sum("value").alias("total_size_mb"))
    doc = tot.join(parts, "user_id", "left").select(
        F.col("user_id").alias("run_id"), "total_records", "total_size_mb", F.lit(1).alias("s3_upload_success"),
        F.transform("p", lambda s: F.struct(s["records_count"].alias("records_count"))).alias("partitions"))
    doc.write.mode("overwrite").json(path)
    return path


def _write_log(spark, sf, path):
    ev = tables(spark, sf).events
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    line = F.concat(F.date_format("ts", io.LOG_TS_FORMAT), F.lit(" - "), level, F.lit(": user="),
                    F.col("user_id").cast("string"), F.lit(" event="), F.col("event_id").cast("string"),
                    F.lit(" "), F.col("event_type"))
    ev.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


STATUS_CTE = """WITH p AS (SELECT user_id, event_type, COUNT(*) AS records_count FROM events
    WHERE event_type <> 'error' GROUP BY 1, 2),
  t AS (SELECT user_id, COUNT(*) AS total_records, SUM(value) AS total_size_mb FROM events GROUP BY 1),
  d AS (SELECT user_id, SUM(records_count) AS done, COUNT(*) AS n_parts FROM p GROUP BY 1)"""


@reg("run_status_scan", STATUS_CTE + """ SELECT t.user_id AS run_id, t.total_records, ROUND(t.total_size_mb, 6)
  AS total_size_mb, 1 AS s3_upload_success, coalesce(d.n_parts, 0) AS n_partitions
  FROM t LEFT JOIN d ON t.user_id = d.user_id""")
def _s15(spark, sf):
    st = io.run_status_scan(spark, _write_status(spark, sf, _run(spark, "status")), multi_line=False)
    return rounded(st.select("run_id", "total_records", "total_size_mb", "s3_upload_success",
                             F.coalesce(F.size("partitions"), F.lit(0)).alias("n_partitions")))


@reg("progress_ratio", STATUS_CTE + """ SELECT t.user_id AS run_id, t.total_records, coalesce(d.done, 0) AS records_done,
  ROUND(CASE WHEN t.total_records > 0 THEN coalesce(d.done, 0) * 100.0 / t.total_records ELSE 0.0 END, 6)
  AS progress_pct FROM t LEFT JOIN d ON t.user_id = d.user_id""")
def _a10(spark, sf):
    st = io.run_status_scan(spark, _write_status(spark, sf, _run(spark, "status")), multi_line=False)
    return rounded(R.progress_ratio(st))


@reg("records_per_partition", """SELECT user_id AS run_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_type, records_count) AS INTEGER) AS partition_no,
  concat('Partition ', CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_type, records_count) AS VARCHAR))
  AS partition_label, records_count FROM (SELECT user_id, event_type, COUNT(*) AS records_count FROM events
  WHERE event_type <> 'error' GROUP BY 1, 2)""")
def _a11(spark, sf):
    st = io.run_status_scan(spark, _write_status(spark, sf, _run(spark, "status")), multi_line=False)
    return R.records_per_partition(st)


@reg("run_log_scan", """SELECT date_trunc('millisecond', ts) AS ts,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  concat('user=', CAST(user_id AS VARCHAR), ' event=', CAST(event_id AS VARCHAR), ' ', event_type) AS message
  FROM events""")
def _s16(spark, sf):
    return io.run_log_scan(spark, _write_log(spark, sf, _run(spark, "log"))).drop("source")


@reg("migration_report", STATUS_CTE + """, e AS (SELECT user_id, COUNT(*) AS n_errors FROM events
    WHERE event_type = 'error' GROUP BY 1)
  SELECT t.user_id AS run_id,
    ROUND(CASE WHEN t.total_records > 0 THEN coalesce(d.done, 0) * 100.0 / t.total_records ELSE 0.0 END, 6) AS progress_pct,
    t.total_records, ROUND(t.total_size_mb, 6) AS total_size_mb, CAST(coalesce(d.n_parts, 0) AS INTEGER) AS partitions_completed,
    CASE WHEN coalesce(d.done, 0) * 100.0 / t.total_records >= 100 THEN 'Completed'
         WHEN coalesce(d.done, 0) > 0 THEN 'In Progress' ELSE 'Not Started' END AS overall_status,
    coalesce(e.n_errors, 0) AS n_errors
  FROM t LEFT JOIN d ON t.user_id = d.user_id LEFT JOIN e ON t.user_id = e.user_id""")
def _q16(spark, sf):
    st = io.run_status_scan(spark, _write_status(spark, sf, _run(spark, "status")), multi_line=False)
    log = io.run_log_scan(spark, _write_log(spark, sf, _run(spark, "log")))
    log = log.withColumn("run", F.regexp_extract("message", r"user=(\d+)", 1).cast("long"))
    return rounded(M.migration_report(st, log, "run_id", "run"))


@reg("run_status_files", STATUS_CTE + """ SELECT t.user_id AS run_id, t.total_records, ROUND(t.total_size_mb, 6)
  AS total_size_mb, 1 AS s3_upload_success, coalesce(d.n_parts, 0) AS n_partitions
  FROM t LEFT JOIN d ON t.user_id = d.user_id""")
def _s15_files(spark, sf):
    """Status files as the tool that writes them lays them out: documents over several
    lines, here up to 32 to a file."""
    plain = spark.read.schema(io.RUN_STATUS_SCHEMA).json(_write_status(spark, sf, _run(spark, "status")))
    doc = F.to_json(F.struct("*"), {"pretty": "true"})
    group = F.floor(F.col("run_id") / 32)
    text = plain.select(group.alias("g"), doc.alias("d")).groupBy("g").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("d"), ",\n"), F.lit("\n]")).alias("value"))
    path = _run(spark, "status_files")
    text.select("value", F.col("g").alias("file")).write.partitionBy("file").text(path)
    st = io.run_status_scan(spark, path, multi_line=True)
    return rounded(st.select("run_id", "total_records", "total_size_mb", "s3_upload_success",
                             F.coalesce(F.size("partitions"), F.lit(0)).alias("n_partitions")))


@reg("run_log_layouts", """SELECT date_trunc('millisecond', ts) AS ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'loader' END AS source, concat('event=', CAST(event_id AS VARCHAR)) AS message FROM events""")
def _s16_layouts(spark, sf):
    """Lines of all known layouts in one folder."""
    ev, path = tables(spark, sf).events, _run(spark, "logs")
    ts = F.date_format("ts", io.LOG_TS_FORMAT)
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    message = F.concat(F.lit("event="), F.col("event_id").cast("string"))
    layouts = [F.concat(ts, F.lit(" - "), level, F.lit(": "), message),
               F.concat(ts, F.lit(" - loader - "), level, F.lit(" - "), message),
               F.concat(ts, F.lit(" | loader | "), level, F.lit(" | "), message)]
    which = F.pmod("event_id", F.lit(3))
    line = F.when(which == 0, layouts[0]).when(which == 1, layouts[1]).otherwise(layouts[2])
    ev.select(line.alias("value")).write.text(path)
    return io.run_log_scan(spark, path)


STAGED = ("nation", "customer", "orders", "lineitem")


@reg("stage_formats", " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{f}' AS written, COUNT(*) AS n_rows FROM {t}"
     for t, f in zip(STAGED, ("orc", "parquet", "parquet", "parquet"))))
def _s10(spark, sf):
    """Tables staged in the format chosen for their size (the first as a row-oriented one,
    the last as if it were large), read back."""
    t, out = tables(spark, sf), None
    for name in STAGED:
        df = getattr(t, name)
        size = P.estimate_size_mb(df).first()["size_mb"] * (1e9 if name == "lineitem" else 1)
        path, written = io.stage_with_format(df, _run(spark, f"staged_{name}"), P.stage_format(size, row_oriented=name == "nation"))
        back = io.read_staged(spark, path, written).agg(F.count(F.lit(1)).alias("n_rows"))
        row = back.select(F.lit(name).alias("table_name"), F.lit(written).alias("written"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@reg("object_listing")
def _s17(spark, sf):
    return io.object_listing(spark, sf, "*.parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


COPY_CFG = {"num_partitions": 20, "tables": {"region": {"partition_column": "r_regionkey"},
                                            "nation": {"partition_column": "n_regionkey"},
                                            "supplier": {"partition_column": "s_nationkey"}}}


@reg("copy_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS records, COUNT(*) AS staged_records, true AS counts_match FROM {t}"
    for t in COPY_CFG["tables"]))
def _s19(spark, sf):
    t = tables(spark, sf)
    sources = {name: getattr(t, name) for name in COPY_CFG["tables"]}
    out = M.copy_tables(spark, sources, COPY_CFG, _run(spark, "copy"), "run1")
    return out.drop("path")


@reg("incremental_load", """SELECT event_id, user_id FROM events WHERE event_id >
  (SELECT MAX(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-16')""")
def _q17(spark, sf):
    ev = tables(spark, sf).events.select("event_id", "user_id", "ts")
    base = _run(spark, "incremental")
    first = ev.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    M.incremental_write(first, "event_id", base + "/data", base + "/mark")   # round 1
    inc, _ = M.incremental_write(ev, "event_id", base + "/data", base + "/mark")  # round 2
    return inc.select("event_id", "user_id")
