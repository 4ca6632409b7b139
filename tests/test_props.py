"""Property tests for operators without an SQL oracle, plus streaming restarts."""
import json
import os
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import features as FT
from tidewater.operators import relational as R
from tidewater.operators import text as TX
from tidewater.operators.anomaly import isolation_forest_fit, isolation_forest_score
from tidewater.sources import io
from tidewater.sources.tables import Tables
from tidewater.streaming import streams as X
from tidewater.streaming import versions as V

from .conftest import SF_SMALL


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_recursive_chunks_bounded_and_ordered(text, size, overlap):
    chunks = TX.recursive_chunks(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    # dropping each chunk's overlap (some split of at most `overlap` chars) rebuilds
    # the whole text in order; search the splits, since repetitive text is ambiguous
    def rebuild(i, done):
        if i == len(chunks):
            return done == len(text)
        c = chunks[i]
        for k in range(min(overlap, len(c), done), -1, -1):
            if text[done - k:done] == c[:k] and text.startswith(c[k:], done) and \
                    rebuild(i + 1, done + len(c) - k):
                return True
        return False
    assert rebuild(0, 0)


def test_chunk_recursive_distributed_matches_helper(spark):
    d = Tables(spark, SF_SMALL).documents.select("doc_id", "text")
    got = {(r["doc_id"], r["chunk_no"]): r["chunk"] for r in TX.chunk_recursive(d, "doc_id", "text", 500, 50).collect()}
    for r in d.limit(20).collect():
        for k, c in enumerate(TX.recursive_chunks(r["text"], 500, 50)):
            assert got[(r["doc_id"], k)] == c


def test_udtf_chunker(spark):
    spark.udtf.register("recursive_chunker", TX.RecursiveChunker)
    out = spark.sql("SELECT * FROM recursive_chunker('aaa bbb ccc', 4, 0)").collect()
    assert [r["chunk"] for r in out] == ["aaa ", "bbb ", "ccc"]


def test_lsh_recall_against_exact(spark):
    e = Tables(spark, SF_SMALL).embeddings
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    exact = {(r["query_id"], r["vec_id"]) for r in TX.knn_exact(e, q, 5).collect()}
    approx = {(r["query_id"], r["vec_id"]) for r in TX.knn_lsh(e, q, 5, bucket_length=1.0, num_tables=8,
                                                                threshold=2.0).collect()}
    assert len(exact & approx) / len(exact) > 0.5


def test_knn_exact_query_groups_equal_single_group(spark):
    e = Tables(spark, SF_SMALL).embeddings
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    cols = ["query_id", "rank", "vec_id", F.round("distance", 9).alias("distance")]
    a = TX.knn_exact(e, q, 3).select(*cols)
    b = TX.knn_exact(e, q, 3, max_broadcast=120).select(*cols)  # several broadcast groups, still exact
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_embed_hashed_unit_norm(spark):
    from pyspark.ml.functions import vector_to_array
    d = TX.embed_hashed(Tables(spark, SF_SMALL).documents.select("doc_id", "text"), "text", 256)
    n = d.select(F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x * x).alias("n"))
    assert n.filter(F.abs(F.col("n") - 1.0) > 1e-6).filter(F.col("n") > 0).count() == 0


def test_isolation_forest_ranks_planted_outliers_high(spark):
    ev = Tables(spark, SF_SMALL).events.select("event_id", "value")
    planted = spark.createDataFrame([(10_000_000 + i, 1e6 + i) for i in range(5)], "event_id long, value double")
    data = ev.unionByName(planted)
    forest = isolation_forest_fit(data, ["value"], "event_id", trees=40, sample=128, seed=1)
    s = isolation_forest_score(data, forest, ["value"], "event_id", sample=128)
    med = s.approxQuantile("anomaly_score", [0.5], 0.0)[0]
    top = s.filter(F.col("event_id") >= 10_000_000).agg(F.min("anomaly_score")).first()[0]
    assert top > med and top > 0.6


def test_contamination_flags_exact_count(spark):
    ev = Tables(spark, SF_SMALL).events.select("event_id", "value")
    out = FT.contamination_flags(ev, "value", ["event_id"], 0.05)
    n = ev.count()
    assert out.filter(F.col("is_anomaly") == 1).count() == -(-5 * n // 100)


def test_require_columns_and_dtypes(spark):
    d = Tables(spark, SF_SMALL).region
    with pytest.raises(ValueError):
        R.require_columns(d, ["r_regionkey", "nope"])
    h = {r["dtype"]: r["n_columns"] for r in R.dtype_histogram(d).collect()}
    assert h == {"int": 1, "string": 1}


def test_status_json_multiline_and_report(spark, tmp_path):
    from tidewater.operators.migrate import migration_report
    p = tmp_path / "migration_status_1.json"
    p.write_text(json.dumps({"run_id": 1, "total_records": 10, "total_size_mb": 1.5, "s3_upload_success": 1,
                             "partitions": [{"records_count": 4}, {"records_count": 6}]}, indent=2))
    (tmp_path / "migration_status_2.json").write_text(json.dumps({"run_id": 2, "total_records": 0}, indent=2))
    st = io.run_status_scan(spark, str(tmp_path / "migration_status_*.json"))
    rep = {r["run_id"]: r for r in migration_report(st).collect()}
    assert rep[1]["overall_status"] == "Completed" and rep[1]["partitions_completed"] == 2
    assert rep[2]["progress_pct"] == 0.0 and rep[2]["overall_status"] == "Not Started"


def test_run_log_other_layouts_kept(spark, tmp_path):
    p = tmp_path / "run.log"
    p.write_text("2024-01-01 10:00:00,123 - ERROR: broke\nfree text line\n"
                 "2024-01-01 10:00:01 - analyzer - WARNING - slow scan\n"
                 "2024-01-01 10:00:02 | conn.py:43 | INFO | connected\n")
    rows = io.run_log_scan(spark, str(p)).collect()
    assert rows[0]["level"] == "ERROR" and rows[0]["message"] == "broke" and rows[0]["ts"].microsecond == 123000
    assert rows[1]["level"] is None and rows[1]["message"] == "free text line"
    assert (rows[2]["level"], rows[2]["source"], rows[2]["message"]) == ("WARNING", "analyzer", "slow scan")
    assert (rows[3]["level"], rows[3]["source"], rows[3]["message"]) == ("INFO", "conn.py:43", "connected")


def _write_changes(spark, folder, rows, name):
    spark.createDataFrame(rows, "user_id long, event_id long, ts timestamp_ntz, value double") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(folder, name))


def test_cdc_upsert_restart_and_replay(spark):
    import datetime as dt
    base = tempfile.mkdtemp(prefix="tw-cdc-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    t0 = dt.datetime(2024, 1, 1)
    _write_changes(spark, src, [(1, 1, t0, 1.0), (2, 2, t0, 2.0)], "a")
    schema = "user_id long, event_id long, ts timestamp_ntz, value double"
    mk = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
    X.run_to_end(X.cdc_upsert_stream(mk(), base + "/table", base + "/ckpt", ["user_id"], ["ts", "event_id"]))
    # new changes arrive; the stream restarts from its checkpoint
    _write_changes(spark, src, [(1, 3, t0 + dt.timedelta(hours=1), 10.0)], "b")
    X.run_to_end(X.cdc_upsert_stream(mk(), base + "/table", base + "/ckpt", ["user_id"], ["ts", "event_id"]))
    cur = {r["user_id"]: r["value"] for r in V.cdc_current(spark, base + "/table", ["user_id"], ["ts", "event_id"]).collect()}
    assert cur == {1: 10.0, 2: 2.0}


def test_dedup_drops_late_repeats(spark):
    import datetime as dt
    base = tempfile.mkdtemp(prefix="tw-dedup-")
    src = os.path.join(base, "src")
    os.makedirs(src)
    t0 = dt.datetime(2024, 1, 10)
    schema = "event_id long, ts timestamp_ntz"
    spark.createDataFrame([(1, t0), (1, t0), (2, t0 + dt.timedelta(days=5))], schema) \
        .coalesce(1).write.parquet(os.path.join(src, "a"))
    mk = lambda: X.event_time(spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                              .parquet(src))
    X.run_to_end(X.cdc_dedup_stream(mk(), base + "/out", base + "/ckpt", ["event_id"]))
    # a repeat of event 1 arrives far behind the watermark (late): dropped
    spark.createDataFrame([(1, t0), (3, t0 + dt.timedelta(days=5))], schema).coalesce(1) \
        .write.parquet(os.path.join(src, "b"))
    X.run_to_end(X.cdc_dedup_stream(mk(), base + "/out", base + "/ckpt", ["event_id"]))
    ids = sorted(r["event_id"] for r in spark.read.parquet(base + "/out").collect())
    assert ids == [1, 2, 3]


@pytest.mark.parametrize("kind", ["sliding", "session"])
def test_windowed_counts_variants_match_batch(spark, kind):
    import datetime as dt
    base = tempfile.mkdtemp(prefix=f"tw-win-{kind}-")
    src = os.path.join(base, "src")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=m), "a") for m in (0, 5, 50, 130, 131, 400)]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").coalesce(1).write.parquet(src)
    stream = X.event_time(spark.readStream.schema("ts timestamp_ntz, event_type string").parquet(src))
    opts = {"slide": "30 minutes"} if kind == "sliding" else {"session_gap": "20 minutes"}
    X.run_to_end(X.windowed_counts_stream(stream, base + "/out", base + "/ckpt", delay="0 seconds", **opts))
    got = sorted((r["window_start"], r["n_events"]) for r in spark.read.parquet(base + "/out").collect())
    batch = X.event_time(spark.read.parquet(src))
    w = (F.window("ts", "1 hour", "30 minutes") if kind == "sliding" else F.session_window("ts", "20 minutes"))
    exp = batch.groupBy(w.alias("w"), "event_type").count()
    max_ts = batch.agg(F.max("ts")).first()[0]
    exp = sorted((r["w"]["start"], r["count"]) for r in exp.collect() if r["w"]["end"] <= max_ts)
    assert got == exp and len(got) > 0


def test_error_stream_alert_hook_and_progress_completion(spark):
    base = tempfile.mkdtemp(prefix="tw-alert-")
    ev = X.file_stream(spark, SF_SMALL, "events.parquet", Tables(spark, SF_SMALL).events.schema)
    seen = []
    q = X.error_stream(ev.select("event_id", "event_type"), base + "/out", base + "/ckpt",
                       F.col("event_type") == "error", alert=lambda df, bid: seen.append((bid, df.count())))
    X.run_to_end(q)
    n_err = Tables(spark, SF_SMALL).events.filter(F.col("event_type") == "error").count()
    assert sum(c for _, c in seen) == n_err == spark.read.parquet(base + "/out").count()
    # progress stream: every run completes when all parts count towards done
    parts = X.file_stream(spark, SF_SMALL, "events.parquet", Tables(spark, SF_SMALL).events.schema) \
        .select(F.col("user_id").alias("run_id"), F.lit(1).cast("long").alias("records_count"))
    totals = Tables(spark, SF_SMALL).events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("total_records"))
    q2 = X.progress_stream(parts, totals, base + "/progress", base + "/ckpt2", trigger="1 second")
    assert X.await_completion(spark, q2, base + "/progress", poll_seconds=1.0)
    snap = X.progress_snapshot(spark, base + "/progress")
    assert snap.filter(F.col("status") != "Completed").count() == 0


def test_contamination_flags_with_massive_ties(spark):
    # 90 % of scores tie at the cut: the tied rows are numbered in parallel
    ev = Tables(spark, SF_SMALL).events.select("event_id",
                                              F.when(F.col("event_id") % 10 == 0, F.col("value")).otherwise(1.0)
                                              .alias("score"))
    out = FT.contamination_flags(ev, "score", ["event_id"], 0.5)
    n = ev.count()
    flagged = out.filter(F.col("is_anomaly") == 1)
    assert flagged.count() == -(-n // 2)
    # brute force: top half by (score desc, event_id asc)
    rows = sorted(ev.collect(), key=lambda r: (-r["score"], r["event_id"]))[: -(-n // 2)]
    assert {r["event_id"] for r in rows} == {r["event_id"] for r in flagged.collect()}
