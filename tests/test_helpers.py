"""Small helpers and functions that no registered query calls by themselves."""
import datetime as dt
import re

from pyspark.sql import functions as F

from tidewater import session
from tidewater.functions import columns as C
from tidewater.operators import profile, relational
from tidewater.sources import io


def one(spark, value, col, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col).first()[0]


def test_column_helpers(spark):
    assert one(spark, "((a(b)c))", C.strip_brackets("x")) == "a(b)c" and one(spark, None, C.strip_brackets("x")) is None
    assert one(spark, "a\nb\0c", C.clean_control("x")) == "a b c"
    assert one(spark, "say ### and ### this", C.after_marker("x", "### ")) == "and ### this" and one(spark, "none", C.after_marker("x", "###")) is None
    assert one(spark, 6.0, C.safe_ratio("x", F.lit(4.0)), "double") == 1.5 and one(spark, 6.0, C.safe_ratio("x", F.lit(0.0)), "double") is None
    assert re.fullmatch(r"\d{8}_\d{6}", one(spark, "", C.run_id_now()))


def test_relational_helpers(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("a", 1)], "k string, n int")
    assert [tuple(r) for r in relational.with_columns(df, {"m": F.col("n") + 1, "k": F.upper("k")}).collect()] == [("A", 2, 3), ("A", 1, 2), ("B", 3, 4), ("A", 1, 2)]
    assert [tuple(r) for r in relational.sort_multi(df, ["k", "n"]).collect()] == [("a", 1), ("a", 1), ("a", 2), ("b", 3)]
    assert {(r["k"], r["n"]) for r in relational.group_having_many(df, "k", "n").collect()} == {("a", 1), ("a", 2)}
    edges, groups = spark.createDataFrame([(n,) for n in range(6)], "src long"), spark.createDataFrame([(1, 3), (4, 5)], "first long, last long")
    assert {r["src"] for r in relational.interval_anti_join(edges, groups).collect()} == {0, 3, 5}


def test_rebalanced_copies_keep_all_rows_and_split_a_hot_key(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("k"), "id")
    for n, column in ((None, None), (4, None), (None, "k"), (7, "k")):
        assert io.repartition_by_key(df, n, column).agg(F.sum("id")).first()[0] == 50_000 * 49_999 // 2
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        sizes = [r["count"] for r in io.repartition_by_key(df, 8, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert sum(sizes) == 50_000 and max(sizes) < 25_000


def test_staging_uses_stand_ins_for_absent_formats(spark):
    df, base = spark.range(5), session.scratch_path(spark, f"test/staging/{dt.datetime.now().timestamp()}")
    for fmt, written in (("parquet", "parquet"), ("iceberg", "parquet"), ("avro", "orc"), ("orc", "orc")):
        path, got = io.stage_with_format(df, f"{base}/{fmt}", fmt)
        assert got == written and io.read_staged(spark, path, got).count() == 5


def test_session_helpers(spark):
    conf = session.cluster_conf(100 << 40, 1000, 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20) and conf["spark.sql.adaptive.enabled"] == "true"
    assert session.cut_lineage(spark.range(3).withColumn("y", F.col("id") * 2)).agg(F.sum("y")).first()[0] == 6


def test_partition_keys_near_the_window_are_not_lost(spark):
    df = spark.range(30_000).select((F.col("id") % 1000).alias("edge"), (F.col("id") % 1001).alias("above"), (F.col("id") % 10).alias("low"), (F.col("id") % 9).alias("below"))
    assert {r["column_name"]: r["distinct_count"] for r in profile.suggest_partition_keys(df).collect()} == {"edge": 1000, "low": 10}
