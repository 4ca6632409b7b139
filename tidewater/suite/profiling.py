"""Registered queries for Q1-Q15 (profiling, planning, reconciliation)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import merkle as M
from ..operators import profile as P
from ..operators import reconcile as RC
from ..session import materialise, scratch_path
from .common import money, tables

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
ORDER_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]

# integer and text columns per table: their text length is the same in every engine
SIZE_COLS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"],
    "orders": ORDER_TEXT,
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
}


def _len_sql(cols):
    return " + ".join(f"coalesce(length(CAST({c} AS VARCHAR)), 0)" for c in cols)


def _profile_sql():
    size = f"(SELECT ROUND(SUM({_len_sql(ORDER_TEXT)}) / 1048576.0, 2) FROM orders)"
    parts = [f"""SELECT '{c}' AS column_name, '{t}' AS dtype, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count,
      CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count,
      COUNT(*) AS row_count, {size} AS size_mb FROM orders""" for c, t in ORDER_TYPES.items()]
    return " UNION ALL ".join(parts)


@reg("profile_table", _profile_sql())
def _q1(spark, sf):
    return P.profile_table(tables(spark, sf).orders, size_cols=ORDER_TEXT)


def _keys_sql(table, cols):
    parts = [f"""SELECT '{table}' AS table_name, '{c}' AS column_name, d AS distinct_count,
      ROUND(d * 100.0 / n, 2) AS distinct_pct FROM (SELECT CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c}
      IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS d, COUNT(*) AS n FROM {table}) WHERE d BETWEEN 10 AND 1000"""
             for c in cols]
    return " UNION ALL ".join(parts)


@reg("suggest_partition_keys",
     _keys_sql("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"])
     + " UNION ALL " + _keys_sql("customer", ["c_custkey", "c_nationkey"]))
def _q2(spark, sf):
    t = tables(spark, sf)
    a = P.suggest_partition_keys(t.lineitem).withColumn("table_name", F.lit("lineitem"))
    b = P.suggest_partition_keys(t.customer).withColumn("table_name", F.lit("customer"))
    return a.unionByName(b)


@reg("estimate_size_mb", f"SELECT COUNT(*) AS row_count, ROUND(SUM({_len_sql(SIZE_COLS['customer'])})"
     " / 1048576.0, 2) AS size_mb FROM customer")
def _q3(spark, sf):
    return P.estimate_size_mb(tables(spark, sf).customer, SIZE_COLS["customer"])


def _sizes_spark(spark, sf):
    t = tables(spark, sf)
    out = None
    for name, cols in SIZE_COLS.items():
        s = P.estimate_size_mb(getattr(t, name), cols).withColumn("table_name", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out


SIZES_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count, ROUND(SUM({_len_sql(c)}) / 1048576.0, 2) AS size_mb FROM {n}"
    for n, c in SIZE_COLS.items())


@reg("estimate_transfer", f"""SELECT table_name, row_count, size_mb, 100.0 AS network_bandwidth_mbps,
  ROUND(size_mb * 8.0 / 100.0 * 1.2, 2) AS transfer_seconds,
  ROUND(size_mb * 8.0 / 100.0 * 1.2 / 60.0, 2) AS transfer_minutes FROM ({SIZES_SQL})""")
def _q4(spark, sf):
    return P.estimate_transfer(_sizes_spark(spark, sf))


@reg("route_by_size", f"""SELECT table_name, row_count, size_mb, tier,
  CASE tier WHEN 'small' THEN 'local' WHEN 'medium' THEN 'spark' ELSE 'spark-autoscaled' END AS path,
  CASE tier WHEN 'large' THEN 'iceberg' ELSE 'parquet' END AS staging_format
  FROM (SELECT *, CASE WHEN size_mb / 1024.0 < 1 THEN 'small' WHEN size_mb / 1024.0 <= 100 THEN 'medium'
        ELSE 'large' END AS tier FROM ({SIZES_SQL}))""")
def _q13(spark, sf):
    return P.route_by_size(_sizes_spark(spark, sf))


@reg("range_partitions", """WITH b AS (SELECT MIN(o_custkey) AS lo, MAX(o_custkey) AS hi FROM orders)
  SELECT bucket, ROUND(lo + bucket * ((hi - lo) / 15.0), 6) AS range_lo,
         ROUND(lo + (bucket + 1) * ((hi - lo) / 15.0), 6) AS range_hi, COUNT(*) AS row_count
  FROM (SELECT CAST(least(floor(CAST(o_custkey - lo AS DOUBLE) * 15 / CAST(hi - lo AS DOUBLE)), 14) AS INTEGER)
        AS bucket, lo, hi FROM orders, b WHERE o_custkey IS NOT NULL) GROUP BY bucket, lo, hi""")
def _q5(spark, sf):
    from .common import rounded
    return rounded(P.range_partitions(tables(spark, sf).orders, "o_custkey", 15))


@reg("row_count_check", """SELECT s.n AS src_count, d.n AS dst_count, s.n = d.n AS counts_match
  FROM (SELECT COUNT(*) AS n FROM orders) s, (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P') d""")
def _q6(spark, sf):
    o = tables(spark, sf).orders
    return RC.row_count_check(o, o.filter(F.col("o_orderstatus") != "P"))


def _hash_sql(cols):
    key = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {key})), 1, 8)) AS BIGINT)"


ALTERED = """(SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority
  FROM orders)"""


@reg("checksum_check", f"""WITH s AS (SELECT floor(o_orderkey / 1000) AS bucket, COUNT(*) AS src_count,
    CAST(SUM({_hash_sql(ORDER_TEXT)}) AS BIGINT) AS src_checksum FROM orders GROUP BY 1),
  d AS (SELECT floor(o_orderkey / 1000) AS bucket, COUNT(*) AS dst_count,
    CAST(SUM({_hash_sql(ORDER_TEXT)}) AS BIGINT) AS dst_checksum FROM {ALTERED} GROUP BY 1)
  SELECT CAST(coalesce(s.bucket, d.bucket) AS BIGINT) AS bucket, src_count, src_checksum, dst_count, dst_checksum,
    coalesce(src_count = dst_count AND src_checksum = dst_checksum, false) AS bucket_match
  FROM s FULL OUTER JOIN d ON s.bucket = d.bucket""")
def _q7(spark, sf):
    o = tables(spark, sf).orders.select(*ORDER_TEXT, "o_totalprice")
    alt = o.withColumn("o_orderpriority", F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000),
                                                 "5-LOW").otherwise(F.col("o_orderpriority")))
    b = F.floor(F.col("o_orderkey") / 1000).cast("long")
    return RC.checksum_check(o, alt, ORDER_TEXT, b).withColumns(
        {c: F.col(c).cast("long") for c in ("src_checksum", "dst_checksum")})  # small sums here; the oracle has BIGINT


@reg("compare_keys", """WITH l AS (SELECT DISTINCT concat(CAST(c_custkey AS VARCHAR), c_mktsegment) AS k FROM customer
    JOIN orders ON c_custkey = o_custkey WHERE year(o_orderdate) < 1995),
  r AS (SELECT DISTINCT concat(CAST(c_custkey AS VARCHAR), c_mktsegment) AS k FROM customer
    JOIN orders ON c_custkey = o_custkey WHERE year(o_orderdate) >= 1995),
  d AS (SELECT 'DB only' AS "Source", k AS "Concatenated" FROM (SELECT k FROM r EXCEPT SELECT k FROM l)
    UNION ALL SELECT 'Sheet only', k FROM (SELECT k FROM l EXCEPT SELECT k FROM r))
  SELECT * FROM d UNION ALL SELECT 'All rows match', NULL WHERE (SELECT COUNT(*) FROM d) = 0""")
def _q8(spark, sf):
    t = tables(spark, sf)
    j = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    l = j.filter(F.year("o_orderdate") < 1995).select("c_custkey", "c_mktsegment")
    r = j.filter(F.year("o_orderdate") >= 1995).select("c_custkey", "c_mktsegment")
    return RC.compare_keys(l, r, ["c_custkey", "c_mktsegment"], sep="")


@reg("find_duplicates", """SELECT 'documents' AS side, d.doc_id AS row_id, d.text, c.n_copies FROM documents d
  JOIN (SELECT text, COUNT(*) AS n_copies FROM documents GROUP BY text HAVING COUNT(*) > 1) c ON d.text = c.text
  UNION ALL SELECT 'benchmark', b.item_id, b.text, c.n_copies FROM benchmark b
  JOIN (SELECT text, COUNT(*) AS n_copies FROM benchmark GROUP BY text HAVING COUNT(*) > 1) c ON b.text = c.text""")
def _q9(spark, sf):
    t = tables(spark, sf)
    return RC.find_duplicates({"documents": t.documents.select(F.col("doc_id").alias("id"), "text"),
                               "benchmark": t.benchmark.select(F.col("item_id").alias("id"), "text")},
                              "text", "id")


RULES_SQL = [
    ("discount_out_of_range", "l_discount < 0 OR l_discount > 0.1"),
    ("quantity_not_positive", "l_quantity <= 0"),
    ("tax_negative", "l_tax < 0"),
    ("ship_before_order", "l_shipdate < o_orderdate"),
]


@reg("check_ranges", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, CAST(COUNT(*) FILTER (WHERE {c}) AS BIGINT) AS n_violations "
    f"FROM lineitem JOIN orders ON l_orderkey = o_orderkey" for n, c in RULES_SQL))
def _q10(spark, sf):
    t = tables(spark, sf)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return RC.check_ranges(j, {n: F.expr(c) for n, c in RULES_SQL})


@reg("check_references", """SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL
  AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)""")
def _q11(spark, sf):
    t = tables(spark, sf)
    return RC.check_references(t.events, t.customer, "user_id", "c_custkey")


RECOMP_SQL = """(SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
   * (1 + CAST(l_tax AS DECIMAL(18,2)))) AS DOUBLE) AS recomputed FROM lineitem GROUP BY l_orderkey)"""


@reg("check_calculations", f"""SELECT o_orderkey, o_totalprice AS stored, ROUND(recomputed, 6) AS recomputed
  FROM orders JOIN {RECOMP_SQL} r ON o_orderkey = r.l_orderkey WHERE abs(o_totalprice - recomputed) > 0.01""")
def _q12(spark, sf):
    from .common import rounded
    t = tables(spark, sf)
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(money("l_extendedprice") * (1 - money("l_discount")) * (1 + money("l_tax")))
        .cast("double").alias("recomputed"))
    j = t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return rounded(RC.check_calculations(j, "o_totalprice", F.col("recomputed"), 0.01, ["o_orderkey"]))


URL_PATH = r"^[a-zA-Z]+://[^/]+/([^?#]*)"


@reg("layout_check", f"""SELECT DISTINCT lang AS prefix FROM documents WHERE lang IS NOT NULL AND lang NOT IN
  (SELECT split_part(regexp_extract(url, '{URL_PATH}', 1), '/', 1) FROM pages WHERE url IS NOT NULL)""")
def _q14(spark, sf):
    t = tables(spark, sf)
    listing = t.pages.select(F.regexp_extract("url", URL_PATH, 1).alias("path"))
    expected = t.documents.select(F.col("lang").alias("prefix")).filter(F.col("prefix").isNotNull())
    return RC.layout_check(listing, expected, "path", 1)


TREE_SQL = f"""WITH found AS (SELECT DISTINCT string_split(regexp_extract(url, '{URL_PATH}', 1), '/') AS p FROM pages WHERE url IS NOT NULL),
  f AS (SELECT DISTINCT p[1] AS prefix FROM found UNION SELECT DISTINCT p[1] || '/' || p[2] FROM found WHERE len(p) > 1 AND p[2] <> ''),
  w AS (SELECT DISTINCT lang AS a, lang || '/' || source AS leaf FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL
        UNION SELECT DISTINCT lang, lang FROM documents WHERE lang IS NOT NULL),
  m AS (SELECT CASE WHEN a NOT IN (SELECT prefix FROM f) THEN a ELSE leaf END AS prefix FROM w WHERE leaf NOT IN (SELECT prefix FROM f))
  SELECT prefix, CASE WHEN strpos(prefix, '/') > 0 THEN 2 ELSE 1 END AS level, COUNT(*) AS n_expected FROM m GROUP BY 1, 2"""


@reg("layout_tree_check", TREE_SQL)
def _q14_tree(spark, sf):
    """Two levels at once: a folder per language, and in it one per source."""
    t = tables(spark, sf)
    listing = t.pages.select(F.regexp_extract("url", URL_PATH, 1).alias("path"))
    both = t.documents.select(F.explode(F.array(F.concat_ws("/", "lang", "source"), "lang")).alias("prefix"), "lang", "source")
    return RC.layout_tree_check(listing, both.filter("lang is not null and source is not null"))


DAMAGE = {"changed": "o_orderkey % 997 = 5", "left only": "o_orderkey % 1009 = 3", "right only": "o_orderkey % 1013 = 2"}


@reg("merkle_diff", f"""SELECT o_orderkey, CASE WHEN {DAMAGE['right only']} THEN 'right only' WHEN {DAMAGE['left only']} THEN 'left only' ELSE 'changed' END
  AS status FROM orders WHERE {' OR '.join(DAMAGE.values())}""")
def _q7_tree(spark, sf):
    """Orders against a copy with altered, lost and added rows."""
    o, run = tables(spark, sf).orders, scratch_path(spark, f"merkle/{uuid.uuid4().hex}")
    left = o.filter(f"not ({DAMAGE['right only']})")
    copy = o.filter(f"{DAMAGE['right only']} or not ({DAMAGE['left only']})").withColumn(
        "o_totalprice", F.when(F.expr(DAMAGE["changed"]), F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    trees = [M.build_tree(df, ["o_orderkey"], f"{run}/{side}", depth=3) for side, df in (("left", left), ("right", copy))]
    return M.differing_keys(spark, *trees)


SKETCHED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@reg("profile_sketches", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count,
  COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count, TRUE AS estimate_fits FROM orders""" for c in SKETCHED))
def _q1_sketches(spark, sf):
    """Sketches kept per order status, merged; estimates are held against exact counts
    (four standard errors)."""
    o = tables(spark, sf).orders.withColumn("part", F.col("o_orderstatus"))
    sketches = materialise(P.column_sketches(o, ["part"], SKETCHED, 14), "sketches")
    j = P.merge_sketches(sketches).join(P.exact_distinct(o, SKETCHED), "column_name")
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) / F.col("distinct_count")
    return j.select("column_name", "row_count", "null_count", "distinct_count", (error <= 4 * 1.04 / 2 ** 7).alias("estimate_fits"))


@reg("first_failure", f"""WITH c AS (
  SELECT 1 AS check_order, (SELECT COUNT(*) FROM orders) = (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P')
    AS passed, 'row counts differ' AS message
  UNION ALL SELECT 2, (SELECT COUNT(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)) = 0,
    'orphan user ids'
  UNION ALL SELECT 3, (SELECT COUNT(*) FROM orders JOIN {RECOMP_SQL} r ON o_orderkey = r.l_orderkey
    WHERE abs(o_totalprice - recomputed) > 0.01) = 0, 'order totals disagree')
  SELECT coalesce(min(CASE WHEN NOT passed THEN struct_pack(o := check_order, m := message) END).m, 'success')
    AS result, CAST(COUNT(*) FILTER (WHERE NOT passed) AS BIGINT) AS n_failed FROM c""")
def _q15(spark, sf):
    t = tables(spark, sf)
    o = t.orders
    c1 = RC.row_count_check(o, o.filter(F.col("o_orderstatus") != "P")).select(
        F.lit(1).alias("check_order"), F.col("counts_match").alias("passed"), F.lit("row counts differ").alias("message"))
    orphans = RC.check_references(t.events, t.customer, "user_id", "c_custkey")
    c2 = orphans.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(2).alias("check_order"), (F.col("n") == 0).alias("passed"), F.lit("orphan user ids").alias("message"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(money("l_extendedprice") * (1 - money("l_discount")) * (1 + money("l_tax")))
        .cast("double").alias("recomputed"))
    bad = RC.check_calculations(o.join(per_order, F.col("o_orderkey") == F.col("l_orderkey")),
                                "o_totalprice", F.col("recomputed"), 0.01)
    c3 = bad.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(3).alias("check_order"), (F.col("n") == 0).alias("passed"), F.lit("order totals disagree").alias("message"))
    return RC.first_failure(c1.unionByName(c2).unionByName(c3))
