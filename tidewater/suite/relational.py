"""Registered queries for P*, J*, A*, O*, U* over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..sources import derived
from .common import money, rounded, tables

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


J1_SQL = """
WITH passes AS (
  SELECT user_id AS bp_user, day(ts) AS bp_day, MIN(event_id) AS boarding_no
  FROM events WHERE event_type = 'purchase' GROUP BY user_id, day(ts)),
seats AS (SELECT p_partkey AS st_partkey, p_size AS st_size, p_name AS seat_no
          FROM part WHERE p_size < 25)
SELECT c_custkey, c_name, c_acctbal, o_orderkey, o_orderdate, l_linenumber, l_suppkey,
       s_name, s_acctbal, l_partkey, l_quantity, l_extendedprice, l_discount, l_shipdate,
       l_returnflag, s_nationkey, n_name, n_regionkey, boarding_no, seat_no
FROM customer
JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON o_orderkey = l_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN passes ON o_custkey = bp_user AND day(o_orderdate) = bp_day
LEFT JOIN seats ON l_partkey = st_partkey AND s_nationkey = st_size
ORDER BY c_custkey, o_orderkey, l_suppkey, s_nationkey
"""


def j1(spark, sf):
    t = tables(spark, sf)
    return R.wide_denormalise(t.customer, t.orders, t.lineitem, t.supplier, t.nation,
                              t.events, t.part)


reg("wide_denormalise", J1_SQL)(j1)


@reg("project_alias", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, "
     "o_totalprice AS amount FROM orders")
def _p1(spark, sf):
    return R.project_alias(tables(spark, sf).orders, {"o_orderkey": "order_id",
                           "o_custkey": "customer_id", "o_totalprice": "amount"})


@reg("filter_eq", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size = 7")
def _p2(spark, sf):
    return R.filter_eq(tables(spark, sf).part, "p_size", 7).select("p_partkey", "p_name", "p_size")


@reg("filter_null", "SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT * FROM orders "
     "WHERE o_orderpriority = '1-URGENT') u ON c_custkey = o_custkey WHERE o_orderkey IS NULL")
def _p3(spark, sf):
    t = tables(spark, sf)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    j = R.left_join_composite(t.customer, urgent, [("c_custkey", "o_custkey")])
    return R.filter_null(j, "o_orderkey").select("c_custkey", "c_name")


@reg("filter_half_open", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem "
     "WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'")
def _p4(spark, sf):
    lo = F.lit("1996-01-01").cast("timestamp_ntz")
    hi = F.lit("1997-01-01").cast("timestamp_ntz")
    return R.filter_half_open(tables(spark, sf).lineitem, "l_shipdate", lo, hi) \
        .select("l_orderkey", "l_linenumber", "l_shipdate")


@reg("filter_in", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN "
     "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _p5(spark, sf):
    t = tables(spark, sf)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    return R.filter_in(t.customer, urgent, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@reg("filter_contains", "SELECT doc_id, source FROM documents WHERE contains(text, 'License')")
def _p6(spark, sf):
    return R.filter_contains(tables(spark, sf).documents, "text", "License").select("doc_id", "source")


@reg("case_when", """SELECT l_orderkey, l_linenumber, l_discount,
  CASE WHEN l_discount >= 0.05 THEN 'high' WHEN l_discount > 0 THEN 'low' ELSE 'none' END
  AS discount_band FROM lineitem""")
def _p7(spark, sf):
    d = F.col("l_discount")
    return R.case_when(tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_discount"),
                       "discount_band", [(d >= 0.05, "high"), (d > 0, "low")], "none")


@reg("literal_concat", "SELECT doc_id, concat(source, ': ', text) AS labelled FROM documents")
def _p9(spark, sf):
    return R.literal_concat(tables(spark, sf).documents, "labelled", F.col("source"), ": ",
                            F.col("text")).select("doc_id", "labelled")


@reg("row_key", """SELECT o_orderkey, concat(coalesce(CAST(o_orderkey AS VARCHAR), ''),
  coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
  coalesce(o_orderpriority, '')) AS "Concatenated" FROM orders""")
def _p10(spark, sf):
    o = tables(spark, sf).orders
    return R.row_key(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]) \
        .select("o_orderkey", "Concatenated")


@reg("distinct_nonnull", "SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL")
def _p11(spark, sf):
    return R.distinct_nonnull(tables(spark, sf).customer, "c_mktsegment")


@reg("changed_rows", """SELECT s.o_orderkey, s.o_orderstatus FROM orders s JOIN
  (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus
   FROM orders) t ON s.o_orderkey = t.o_orderkey
  WHERE s.o_orderstatus IS DISTINCT FROM t.o_orderstatus""")
def _p13(spark, sf):
    o = tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    target = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F")
                          .otherwise(F.col("o_orderstatus")))
    return R.changed_rows(o, target, ["o_orderkey"], ["o_orderstatus"])


@reg("mask_columns", "SELECT c_custkey, md5(c_name) AS c_name FROM customer")
def _p14(spark, sf):
    return R.mask_columns(tables(spark, sf).customer.select("c_custkey", "c_name"), ["c_name"])


@reg("left_join_composite", """SELECT a.l_orderkey, a.l_linenumber, a.l_quantity,
  b.l_shipdate AS r_shipdate FROM lineitem a LEFT JOIN
  (SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_returnflag = 'R') b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""")
def _j2(spark, sf):
    li = tables(spark, sf).lineitem
    a = li.select("l_orderkey", "l_linenumber", "l_quantity")
    b = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("r_orderkey"), F.col("l_linenumber").alias("r_linenumber"),
        F.col("l_shipdate").alias("r_shipdate"))
    return R.left_join_composite(a, b, [("l_orderkey", "r_orderkey"),
                                        ("l_linenumber", "r_linenumber")]) \
        .select("l_orderkey", "l_linenumber", "l_quantity", "r_shipdate")


OUTER_SQL = """
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < 1995),
     b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) >= 1995)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
       CASE WHEN b.o_custkey IS NULL THEN 'left_only' WHEN a.o_custkey IS NULL THEN 'right_only'
            ELSE 'both' END AS _merge
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey"""


@reg("outer_indicator", OUTER_SQL)
def _j4(spark, sf):
    o = tables(spark, sf).orders
    a = o.filter(F.year("o_orderdate") < 1995).select("o_custkey").distinct()
    b = o.filter(F.year("o_orderdate") >= 1995).select("o_custkey").distinct()
    return R.outer_indicator(a, b, "o_custkey")


@reg("order_totals", """SELECT o_orderkey, c_custkey, c_name,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY o_orderkey, c_custkey, c_name""")
def _j5(spark, sf):
    t = tables(spark, sf)
    li = t.lineitem.select("l_orderkey", money("l_quantity").alias("l_quantity"),
                           money("l_extendedprice").alias("l_extendedprice"))
    return R.order_totals(t.orders, t.customer, li).withColumn("total", F.col("total").cast("double"))


@reg("correlated_in", """SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_nationkey IN (SELECT s.s_nationkey FROM supplier s
                          WHERE s.s_nationkey = n.n_nationkey AND s.s_acctbal > 0.0)""")
def _j6(spark, sf):
    t = tables(spark, sf)
    return R.correlated_in(spark, t.nation, t.region, t.supplier, 0.0)


@reg("global_min_max_count", "SELECT MIN(o_totalprice) AS min_value, MAX(o_totalprice) AS max_value, "
     "COUNT(*) AS row_count FROM orders")
def _a1(spark, sf):
    return R.global_min_max_count(tables(spark, sf).orders, "o_totalprice")


@reg("group_sum_expr", """SELECT l_returnflag, l_linestatus,
  CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _a2(spark, sf):
    li = tables(spark, sf).lineitem.select("l_returnflag", "l_linestatus",
                                           money("l_quantity").alias("q"), money("l_extendedprice").alias("p"))
    return R.group_sum_expr(li, ["l_returnflag", "l_linestatus"], "q", "p") \
        .withColumn("total", F.col("total").cast("double"))


@reg("duplicate_rows", """SELECT d.doc_id, c.n_copies FROM documents d JOIN
  (SELECT text, COUNT(*) AS n_copies FROM documents GROUP BY text HAVING COUNT(*) > 1) c
  ON d.text = c.text""")
def _a5(spark, sf):
    d = tables(spark, sf).documents.select("doc_id", "text")
    return R.duplicate_rows(d, ["text"]).select("doc_id", "n_copies")


def _distinct_sql(table, cols):
    parts = [f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL "
             f"THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count FROM {table}" for c in cols]
    return " UNION ALL ".join(parts)


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]


@reg("distinct_count_per_column", _distinct_sql("orders", ORDER_COLS))
def _a6(spark, sf):
    return R.distinct_count_per_column(tables(spark, sf).orders)


J1_COLS = ["c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_orderdate", "l_linenumber",
           "l_suppkey", "s_name", "s_acctbal", "l_partkey", "l_quantity", "l_extendedprice",
           "l_discount", "l_shipdate", "l_returnflag", "s_nationkey", "n_name", "n_regionkey",
           "boarding_no", "seat_no"]


def _null_sql(src, cols):
    parts = [f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM j"
             for c in cols]
    body = J1_SQL.replace("ORDER BY c_custkey, o_orderkey, l_suppkey, s_nationkey", "")
    body = body.strip()
    assert body.startswith("WITH")
    return "WITH j AS (" + body + ")\n" + " UNION ALL ".join(parts)


@reg("null_count_per_column", _null_sql("j", J1_COLS))
def _a7(spark, sf):
    t = tables(spark, sf)
    j = R.wide_denormalise(t.customer, t.orders, t.lineitem, t.supplier, t.nation, t.events,
                           t.part, sort=False)
    return R.null_count_per_column(j)


@reg("accuracy", """SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
  CAST(SUM(CASE WHEN list_position(s, list_max(s)) - 1 = label THEN 1 ELSE 0 END) AS BIGINT) AS n_right,
  ROUND(AVG(CASE WHEN list_position(s, list_max(s)) - 1 = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
  FROM (SELECT label, embedding AS s FROM embeddings)""")
def _a13(spark, sf):
    e = tables(spark, sf).embeddings
    return rounded(R.accuracy(e.select("label", F.col("embedding").alias("s")), "s", "label"))


@reg("table_checksum", """SELECT CAST(COUNT(*) AS BIGINT) AS row_count,
  CAST(SUM(CAST(('0x' || substr(md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''),
    coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
    coalesce(o_orderpriority, ''))), 1, 8)) AS BIGINT)) AS BIGINT) AS checksum FROM orders""")
def _a15(spark, sf):
    o = tables(spark, sf).orders
    return R.table_checksum(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]) \
        .withColumn("checksum", F.col("checksum").cast("long"))


SAVINGS_SQL = """
WITH b AS (SELECT event_type, AVG(value) AS m FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
     a AS (SELECT event_type, AVG(value) AS m FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1)
SELECT coalesce(b.event_type, a.event_type) AS event_type, ROUND(b.m, 6) AS before, ROUND(a.m, 6) AS after,
       ROUND((b.m - a.m) * 100.0 / nullif(b.m, 0.0), 6) AS saved_pct
FROM b FULL OUTER JOIN a ON b.event_type = a.event_type"""


@reg("savings_pct", SAVINGS_SQL)
def _a16(spark, sf):
    ev = tables(spark, sf).events
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    b = ev.filter(F.col("ts") < cut).groupBy("event_type").agg(F.avg("value").alias("m"))
    a = ev.filter(F.col("ts") >= cut).groupBy("event_type").agg(F.avg("value").alias("m"))
    return rounded(R.savings_pct(b, a, "event_type", "m"))


@reg("top_n_by_key", """SELECT o_orderkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def _o2(spark, sf):
    o = tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@reg("keyset_page", """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >
  (SELECT MIN(o_orderkey) FROM orders) ORDER BY o_orderkey LIMIT 1000""")
def _s5(spark, sf):
    o = tables(spark, sf).orders.select("o_orderkey", "o_custkey")
    first = o.agg(F.min("o_orderkey")).first()[0]
    return R.keyset_page(o, "o_orderkey", first, 1000)


@reg("two_sided_except", """WITH a AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE year(o_orderdate) < 1995),
  b AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE year(o_orderdate) >= 1995)
  SELECT custkey, 'left_only' AS side FROM (SELECT custkey FROM a EXCEPT SELECT custkey FROM b)
  UNION ALL SELECT custkey, 'right_only' AS side FROM (SELECT custkey FROM b EXCEPT SELECT custkey FROM a)""")
def _u2(spark, sf):
    o = tables(spark, sf).orders
    a = o.filter(F.year("o_orderdate") < 1995).select(F.col("o_custkey").alias("custkey"))
    b = o.filter(F.year("o_orderdate") >= 1995).select(F.col("o_custkey").alias("custkey"))
    return R.two_sided_except(a, b, ["custkey"])


@reg("moments_per_column", """SELECT 'value' AS feature, ROUND(AVG(value), 6) AS mean,
  ROUND(STDDEV_POP(value), 6) AS std_pop FROM events UNION ALL
  SELECT 'trip_duration', ROUND(AVG(trip_duration), 6), ROUND(STDDEV_POP(trip_duration), 6)
  FROM (SELECT value AS trip_duration FROM events)""")
def _a12(spark, sf):
    ev = tables(spark, sf).events.select("value", F.col("value").alias("trip_duration"))
    return rounded(R.moments_per_column(ev, ["value", "trip_duration"]))
