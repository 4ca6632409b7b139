"""Plan-shape and equivalence tests for the scale-oriented plans."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import features as FT
from tidewater.operators import profile as P
from tidewater.operators import relational as R
from tidewater.plans.halo_window import bounded_window, running_moments
from tidewater.plans.ordinal import ordinal_within
from tidewater.plans.range_join import range_anti_join
from tidewater.sources import derived
from tidewater.sources.tables import Tables

from .conftest import SF_MID, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ordinal_matches_row_number_on_a_hot_group(spark):
    # one key holds most rows; tiny width forces many buckets inside it
    ev = Tables(spark, SF_SMALL).events.withColumn("g", F.when(F.col("user_id") < 100, 0).otherwise(F.col("user_id")))
    got = ordinal_within(ev, ["g"], ["event_id"], out="pos", width=7)
    ref = ev.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("event_id")))
    a = got.select("event_id", "pos").exceptAll(ref.select("event_id", "pos"))
    assert a.count() == 0 and got.count() == ref.count()


def test_halo_window_equals_plain_window(spark):
    m = derived.market(spark, SF_MID)
    make = lambda w: {"l5": F.lag("close", 5).over(w),
                      "sd": F.stddev_samp("close").over(w.rowsBetween(-4, 0))}
    d = m.withColumn("o", F.unix_date("date"))
    got = bounded_window(d, [], ["o"], 5, make, block_rows=37, width=11)
    ref = d.withColumns(make(Window.orderBy("o")))
    cols = ["date", "l5", F.round("sd", 6).alias("sd")]
    assert got.select(*cols).exceptAll(ref.select(*cols)).count() == 0
    assert got.count() == ref.count()


def test_partitioned_halo_window_equals_plain(spark):
    s = derived.stock(spark, SF_MID).select("ticker", "date", "close")
    a = FT.lag_fanout(s, "close", 5, partition=["ticker"], scalable=True)
    b = FT.lag_fanout(s, "close", 5, partition=["ticker"], scalable=False)
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_running_moments_equal_window_stddev(spark):
    s = derived.stock(spark, SF_MID).select("ticker", "date", "close").withColumn("o", F.unix_date("date"))
    got = running_moments(s, ["ticker"], ["o"], "close", prefix="r", block_rows=50, width=13)
    ref = s.withColumn("sd", F.stddev_samp("close").over(Window.partitionBy("ticker").orderBy("o")))
    j = got.join(ref, ["ticker", "date"]).select(F.abs(F.coalesce(F.col("r_std") - F.col("sd"), F.lit(0.0))).alias("d"))
    assert j.agg(F.max("d")).first()[0] < 1e-6


def test_scalable_global_window_has_no_single_partition_for_rows(spark):
    m = derived.market(spark, SF_SMALL)
    plan = _plan(FT.lag_k(m, "close", 5))
    # the only SinglePartition exchange is the one over the per-bucket counts
    assert plan.count("SinglePartition") <= 1
    plain = _plan(FT.lag_k(m, "close", 5, scalable=False))
    assert "SinglePartition" in plain


def test_range_anti_join_matches_brute_force(spark):
    rnd = random.Random(3)
    pts = spark.createDataFrame([(i, rnd.randint(0, 500)) for i in range(400)], "id long, p long")
    ivs = spark.createDataFrame([(lo, lo + rnd.randint(1, 40)) for lo in rnd.sample(range(500), 30)],
                                "lo long, hi long")
    got = {r["id"] for r in range_anti_join(pts, ivs, "p", "lo", "hi").collect()}
    iv = [(r["lo"], r["hi"]) for r in ivs.collect()]
    exp = {r["id"] for r in pts.collect() if not any(lo <= r["p"] < hi for lo, hi in iv)}
    assert got == exp


def test_correlated_in_becomes_semi_join(spark):
    t = Tables(spark, SF_SMALL)
    plan = _plan(R.correlated_in(spark, t.nation, t.region, t.supplier))
    assert "LeftSemi" in plan


def test_profile_is_one_scan(spark):
    plan = _plan(P.profile_table(Tables(spark, SF_SMALL).orders))
    assert plan.count("FileScan parquet") == 1


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, SF_SMALL)
    df = R.filter_eq(t.part, "p_size", 7).select("p_partkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(p_size), EqualTo(p_size,7)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


def test_flagship_prunes_columns(spark):
    t = Tables(spark, SF_SMALL)
    plan = _plan(R.wide_denormalise(t.customer, t.orders, t.lineitem, t.supplier, t.nation, t.events, t.part))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in plan


def test_bucketed_tables_join_without_shuffle(spark):
    import uuid

    from tidewater.session import scratch_path
    from tidewater.sources import io
    t = Tables(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:8]
    o = io.save_bucketed(t.orders, f"tw_o_{tag}", "o_orderkey", 8, scratch_path(spark, f"b/o_{tag}"))
    li = io.save_bucketed(t.lineitem, f"tw_l_{tag}", "l_orderkey", 8, scratch_path(spark, f"b/l_{tag}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = o.join(li, o.o_orderkey == li.l_orderkey).groupBy("o_orderkey").count()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")) \
            .select("o_orderkey").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordinal_keeps_null_keys_first(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (1, 2), (2, None), (2, 7)], "g int, k long")
    got = {(r["g"], r["k"]): r["pos"] for r in ordinal_within(df, ["g"], ["k"], width=2).collect()}
    assert got == {(1, None): 1, (1, 2): 2, (1, 5): 3, (2, None): 1, (2, 7): 2}
