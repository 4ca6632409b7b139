"""Golden answers read from the reference's inline samples and comments."""
import pytest
from pyspark.sql import functions as F

from tidewater.operators import querylog as L
from tidewater.operators.profile import estimate_transfer, stage_format
from tidewater.operators.relational import progress_ratio

LOG_SCHEMA = ("query_id long, query_text string, execution_time double, status string, "
              "rows_produced long, session_id long")

# Fixed sample statements (the DML sample list of the reference, in order).
DML = [
    "UPDATE customers SET name = 'John' WHERE id = 1",
    "UPDATE customers SET email = 'john@example.com' WHERE id = 1",
    "UPDATE customers SET phone = '123-456-7890' WHERE id = 1",
    "DELETE FROM orders WHERE order_id = 101",
    "INSERT INTO customers (name, email) VALUES ('Jane', 'jane@example.com')",
    "UPDATE orders SET status = 'shipped' WHERE order_id = 100",
    "UPDATE orders SET delivery_date = '2024-09-10' WHERE order_id = 100",
]

# Fixed join samples: expected missing-condition targets per query.
JOINS = [
    (101, "SELECT * FROM users u JOIN orders o ON u.id = o.user_id JOIN payments p ON o.id = p.order_id "
          "JOIN shipments s", [(3, "shipments")]),
    (102, "SELECT * FROM employees e JOIN departments d USING (department_id) JOIN locations l",
     [(2, "locations")]),
    (103, "SELECT * FROM customers c JOIN orders o JOIN payments p ON o.id = p.order_id", [(1, "orders")]),
    (104, "SELECT * FROM students s JOIN classes c ON s.class_id = c.id JOIN teachers t ON c.teacher_id = t.id "
          "JOIN schools sch ON sch.id = t.school_id", []),
    (1, "SELECT * FROM users u JOIN (SELECT user_id, amount FROM payments) p JOIN orders o ON u.id = o.user_id",
     [(1, "Subquery")]),
    (2, "SELECT * FROM users u JOIN (SELECT user_id, amount FROM payments) p ON u.id = p.user_id "
        "JOIN orders o ON u.id = o.user_id", []),
    (3, "SELECT * FROM customers c JOIN orders o JOIN (SELECT order_id, status FROM shipments) s",
     [(1, "orders"), (2, "Subquery")]),
    (4, "SELECT * FROM employees e JOIN departments d USING (department_id) "
        "JOIN (SELECT location_id, city FROM locations) l ON e.location_id = l.location_id", []),
]


def _log(spark, texts):
    return spark.createDataFrame([(i + 1, t, 1.0, "SUCCESS", 0, 1) for i, t in enumerate(texts)], LOG_SCHEMA)


def test_extract_targets_groups(spark):
    t = L.extract_targets(_log(spark, DML)).collect()
    by_table = {}
    for r in t:
        by_table.setdefault(r["target_table"], []).append(r["query_id"])
    assert sorted(by_table["customers"]) == [1, 2, 3, 5]
    assert sorted(by_table["orders"]) == [4, 6, 7]
    cols = {r["query_id"]: r["columns"] for r in t}
    assert cols[5] == ["name", "email"] and cols[1] == ["name"] and cols[4] == []


def test_dependency_edges_expand_to_all_pairs(spark):
    rows = L.dependency_edges(_log(spark, DML)).collect()
    # brute-force expansion of the exact successor intervals (small fixture only)
    by_scope = {}
    for r in rows:
        by_scope.setdefault(r["target_table"], {})[r["pos"]] = r["query_id"]
    pairs = set()
    for r in rows:
        ids = by_scope[r["target_table"]]
        for p in range(r["pos"] + 1, r["pos"] + r["n_successors"] + 1):
            pairs.add((r["query_id"], ids[p]))
    assert pairs == {(1, 2), (1, 3), (1, 5), (2, 3), (2, 5), (3, 5), (4, 6), (4, 7), (6, 7)}


def test_queries_sharing_table(spark):
    # the predicate-sample table of the reference: name per query
    rows = [("query1", "customers"), ("query2", "customers"), ("query3", "orders"),
            ("query4", "orders"), ("query5", "products"), ("query6", "customers")]
    texts = [f"UPDATE {t} SET x = 1 WHERE k = 1" for _, t in rows]
    out = L.queries_sharing_table(_log(spark, texts)).collect()
    got = {}
    for r in out:
        got.setdefault(r["target_table"], set()).add(rows[r["query_id"] - 1][0])
    assert got == {"customers": {"query1", "query2", "query6"}, "orders": {"query3", "query4"}}


def test_missing_join_conditions(spark):
    df = spark.createDataFrame([(q, t, 1.0, "S", 0, 1) for q, t, _ in JOINS], LOG_SCHEMA)
    got = {}
    for r in L.missing_join_conditions(df).collect():
        got.setdefault(r["query_id"], []).append((r["join_no"], r["join_target"]))
    for q, _, expected in JOINS:
        assert sorted(got.get(q, [])) == expected, q


def test_cross_and_natural_not_flagged(spark):
    df = _log(spark, ["SELECT * FROM a CROSS JOIN b NATURAL JOIN c NATURAL LEFT JOIN d JOIN e"])
    assert [(r["join_no"], r["join_target"]) for r in L.missing_join_conditions(df).collect()] == [(4, "e")]


def test_quoted_keywords_ignored(spark):
    df = _log(spark, ["SELECT * FROM a JOIN b ON a.x = b.x WHERE a.s = 'JOIN c'"])
    assert L.missing_join_conditions(df).count() == 0


def test_execution_chain_with_merge_groups(spark):
    chain = _log(spark, [f"Q{i}" for i in range(1, 12)])
    groups = spark.createDataFrame([(1, 2, 5, 2, 5), (1, 7, 10, 7, 10)],
                                   "session_id long, first_pos long, last_pos long, first_id long, last_id long")
    edges = sorted((r["src"], r["dst"]) for r in L.execution_chain(chain, groups).collect())
    assert edges == [(1, 2), (5, 6), (6, 7), (10, 11)]


def test_merge_by_prefix_time_saved_as_written_is_zero(spark):
    log = spark.createDataFrame([(1, "SELECT 1", 2.0, "S", 0, 1), (2, "SELECT 2", 3.0, "S", 0, 1),
                                 (3, "UPDATE t SET a = 1", 4.0, "S", 0, 1)], LOG_SCHEMA)
    g = {r["query_prefix"]: r for r in L.merge_groups(log).collect()}
    assert g["SELECT"]["merged_query_id"] == 1 and g["UPDATE"]["merged_query_id"] == 2
    assert g["SELECT"]["time_saved"] == 0.0 and g["SELECT"]["savings_if_merged"] == 2.0
    pieces = L.merge_text_pieces(log).filter(F.col("query_prefix") == "SELECT").first()
    assert pieces["merged_query"] == "SELECT 1 MERGED QUERY SELECT 2"


def test_estimate_transfer_100mb(spark):
    r = estimate_transfer(spark.createDataFrame([(100.0,)], "size_mb double")).first()
    assert r["transfer_seconds"] == 9.6 and r["transfer_minutes"] == 0.16


@pytest.mark.parametrize("total,parts,expected", [(0, [5], 0.0), (None, None, 0.0), (10, [2, 3], 50.0)])
def test_progress_ratio_zero_rules(spark, total, parts, expected):
    df = spark.createDataFrame([(1, total, [(p,) for p in parts] if parts is not None else None)],
                               "run_id long, total_records long, partitions array<struct<records_count:bigint>>")
    assert progress_ratio(df).first()["progress_pct"] == expected


def test_stage_format_tiers():
    assert stage_format(10.0) == "parquet"
    assert stage_format(50 * 1024.0) == "parquet"
    assert stage_format(200 * 1024.0) == "iceberg"
    assert stage_format(1.0, row_oriented=True) == "avro"
