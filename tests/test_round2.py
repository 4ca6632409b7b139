"""NULL keys, real SQL texts, deep nesting and large sums."""
import pytest
from pyspark.sql import functions as F

from tidewater.operators import features, querylog, reconcile, relational, text
from tidewater.plans.range_join import range_anti_join


def one(spark, sql, col):
    return spark.createDataFrame([(sql,)], "q string").select(col("q")).first()[0]


def test_no_depth_limit(spark):
    deep = "SELECT * FROM a JOIN b WHERE f" + "(" * 40 + " 1 " + ")" * 40
    log = spark.createDataFrame([(1, deep), (2, "SELECT * FROM a JOIN (SELECT 1")], "query_id long, query_text string")
    got = {r.query_id: r.join_target for r in querylog.missing_join_conditions(log).collect()}
    assert got == {1: "b", 2: "unknown"}


def test_sql_texts(spark):
    assert one(spark, "-- note\nUPDATE t SET a = 1,\n b = 2\nWHERE id = 3", querylog.written_columns) == ["a", "b"]
    assert one(spark, "-- note\nUPDATE t SET a = 1", querylog.target_table) == "t"
    assert one(spark, "/* x */ update T set a = 1", querylog.statement_kind) == "UPDATE"
    assert one(spark, "UPDATE t SET a = CASE WHEN b = 1 THEN 2 END, c = f(d, e = 1)", querylog.written_columns) == ["a", "c"]
    assert one(spark, "UPDATE t SET a='p--q', b=2", querylog.written_columns) == ["a", "b"]
    assert one(spark, "UPDATE t SET a = 'x WHERE y'\nWHERE name = 'it''s'", querylog.where_text) == "name = 'it''s'"


def test_different_literals_are_different_rows(spark):
    log = spark.createDataFrame([(1, "UPDATE t SET a = 1 WHERE name = 'x'"), (2, "UPDATE t SET b = 1 WHERE name = 'y'"),
                                 (3, "UPDATE t SET c = 1 WHERE name = 'x'")], "query_id long, query_text string")
    assert sorted(r.query_id for r in querylog.same_row_updates(log).collect()) == [1, 3]


def test_null_keys_keep_their_rows(spark):
    rows = [(None if k % 2 else "A", k, float(k * k % 7)) for k in range(20)]
    d = spark.createDataFrame(rows, "ticker string, date long, close double")
    for f in (features.cumulative_std, features.ticker_zscore):
        new, plain = (f(d, partition=["ticker"], scalable=s) for s in (True, False))
        key = lambda r: (str(r.ticker), r.date)
        a, b = sorted(new.collect(), key=key), sorted(plain.collect(), key=key)
        assert len(a) == 20
        assert [r.rolling_stddev for r in a] == pytest.approx([r.rolling_stddev for r in b], nan_ok=True)
    log = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", 5)], "query_id long, query_text string, rows_produced long")
    assert sorted((r.query_id, r.n_queries) for r in querylog.rows_produced_groups(log).collect()) == [(1, 2), (2, 2), (3, 1)]
    p = spark.createDataFrame([(None, 3), (7, 3)], "s long, p long")
    iv = spark.createDataFrame([(None, 1, 5), (7, 1, 5)], "s long, a long, b long")
    assert range_anti_join(p, iv, "p", "a", "b", scope=["s"]).count() == 0


def test_key_parts_do_not_run_together(spark):
    a, b = spark.createDataFrame([("ab", "c")], "x string, y string"), spark.createDataFrame([("a", "bc")], "x string, y string")
    assert reconcile.compare_keys(a, b, ["x", "y"]).count() == 2
    assert [r.Source for r in reconcile.compare_keys(a, b, ["x", "y"], sep="").collect()] == ["All rows match"]


def test_checksums_are_decimals(spark):
    d = spark.range(10)
    assert dict(relational.table_checksum(d).dtypes)["checksum"] == "decimal(38,0)"
    big = spark.createDataFrame([(2 ** 62,)] * 4, "h long").agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()[0]
    assert big == 2 ** 64


def test_knn_skips_missing_vectors(spark):
    index = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(9, [0.0, 1.0]), (10, None)], "query_id long, query_vec array<double>")
    assert [(r.query_id, r.vec_id) for r in text.knn_exact(index, q, 2).orderBy("rank").collect()] == [(9, 1), (9, 3)]
