"""Registered queries for L1-L12 over the query_log shape, plus C2/C6/C10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import querylog as L
from ..sources import derived
from .common import rounded, tables, with_shapes

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


def ql(spark, sf):
    return derived.query_log(spark, sf)


# ---- DuckDB spellings of the column helpers (RE2 patterns, 'g' to replace all)
FW = r"regexp_extract(query_text, '^\s*(\S+)', 1)"
KIND = f"upper({FW})"
TT = (r"CASE WHEN regexp_extract(query_text, '(?i)^\s*(?:UPDATE|DELETE\s+FROM|INSERT\s+INTO)\s+([A-Za-z_][A-Za-z0-9_.]*)', 1) <> '' "
      r"THEN lower(regexp_extract(query_text, '(?i)^\s*(?:UPDATE|DELETE\s+FROM|INSERT\s+INTO)\s+([A-Za-z_][A-Za-z0-9_.]*)', 1)) END")
BL = (r"regexp_replace(regexp_replace(regexp_replace(query_text, '--[^\n]*', ' ', 'g'), '/\*.*?\*/', ' ', 'g'), "
      r"'''[^'']*''', '''''', 'g')")
SETP = rf"regexp_extract({BL}, '(?i)\bSET\s+(.*?)(?:\s+WHERE\b|$)', 1)"
SETC = rf"regexp_extract_all({SETP}, '([A-Za-z_][A-Za-z0-9_]*)\s*=', 1)"
INSP = rf"regexp_extract({BL}, '(?i)^\s*INSERT\s+INTO\s+[A-Za-z_][A-Za-z0-9_.]*\s*\(([^)]*)\)', 1)"
INSC = rf"list_filter(list_transform(string_split({INSP}, ','), lambda c: trim(c)), lambda c: c <> '')"
COLS = f"list_transform(CASE WHEN len({SETC}) > 0 THEN {SETC} ELSE {INSC} END, lambda c: lower(c))"
WH = r"CASE WHEN contains(query_text, ' WHERE ') THEN trim(substr(query_text, instr(query_text, ' WHERE ') + 7)) END"

TARGETS = f"SELECT query_id, {KIND} AS kind, {TT} AS target_table, {COLS} AS columns FROM query_log"


@reg("extract_targets", with_shapes(TARGETS, "query_log"))
def _l1(spark, sf):
    return L.extract_targets(ql(spark, sf))


@reg("queries_sharing_table", with_shapes(f"""WITH t AS ({TARGETS})
  SELECT t.target_table, t.query_id, s.n_queries FROM t JOIN (SELECT target_table, COUNT(*) AS n_queries
  FROM t WHERE target_table IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1) s ON t.target_table = s.target_table""",
                                          "query_log"))
def _l2(spark, sf):
    return L.queries_sharing_table(ql(spark, sf))


@reg("merge_by_prefix", with_shapes(f"""SELECT row_number() OVER (ORDER BY query_prefix) AS merged_query_id,
  query_prefix, n_queries, ROUND(total_time, 6) AS total_time, 0.0 AS time_saved,
  ROUND(total_time - max_time, 6) AS savings_if_merged FROM (SELECT {FW} AS query_prefix, COUNT(*) AS n_queries,
  SUM(execution_time) AS total_time, MAX(execution_time) AS max_time FROM query_log GROUP BY 1)""", "query_log"))
def _l3(spark, sf):
    return rounded(L.merge_groups(ql(spark, sf)))


MEMBERS = f"""SELECT {FW} AS query_prefix, query_id, query_text,
  row_number() OVER (PARTITION BY {FW} ORDER BY query_id) AS pos FROM query_log"""


@reg("merge_members", with_shapes(MEMBERS, "query_log"))
def _l3m(spark, sf):
    return L.merge_members(ql(spark, sf))


@reg("merge_text_pieces", with_shapes(f"""SELECT query_prefix, CAST(floor((pos - 1) / 256) AS BIGINT) AS piece,
  MIN(query_id) AS first_query_id, COUNT(*) AS n_queries,
  string_agg(query_text, ' MERGED QUERY ' ORDER BY pos) AS merged_query FROM ({MEMBERS}) GROUP BY 1, 2""",
                                      "query_log"))
def _l3t(spark, sf):
    return L.merge_text_pieces(ql(spark, sf))


DEPS = f"""WITH t AS ({TARGETS}), p AS (SELECT query_id, target_table,
    row_number() OVER (PARTITION BY target_table ORDER BY query_id) AS pos,
    COUNT(*) OVER (PARTITION BY target_table) AS scope_size,
    lead(query_id) OVER (PARTITION BY target_table ORDER BY query_id) AS next_id
    FROM t WHERE target_table IS NOT NULL)
  SELECT query_id, target_table, pos, scope_size, next_id, scope_size - pos AS n_successors FROM p"""


@reg("dependency_edges", with_shapes(DEPS, "query_log"))
def _l4(spark, sf):
    return L.dependency_edges(ql(spark, sf)).select("query_id", "target_table", "pos", "scope_size",
                                                   "next_id", "n_successors")


@reg("merge_suggestions")
def _l5(spark, sf):
    return L.merge_suggestions(ql(spark, sf))


O["merge_suggestions"] = with_shapes(
    DEPS.replace("SELECT query_id, target_table, pos, scope_size, next_id, scope_size - pos AS n_successors FROM p",
                 """, d AS (SELECT query_id, target_table, next_id, scope_size - pos AS n_successors FROM p)
  SELECT d.query_id, d.target_table, d.next_id, q.query_text AS next_text, d.n_successors
  FROM d LEFT JOIN query_log q ON d.next_id = q.query_id"""), "query_log")


def _collapse(x, depth=3):  # the shape nests no deeper
    for _ in range(depth):
        x = rf"regexp_replace({x}, '\([^()]*\)', '{{}}', 'g')"
    return x


MISSING = rf"""WITH f AS (SELECT query_id, {_collapse(BL)} AS flat FROM query_log),
  s AS (SELECT query_id, flat, regexp_split_to_array(flat, '(?i)\bJOIN\b') AS segs FROM f),
  u AS (SELECT query_id, flat, segs, unnest(generate_series(2, len(segs))) AS i FROM s)
  SELECT query_id, CAST(i - 1 AS INTEGER) AS join_no,
    CASE WHEN regexp_matches(flat, '[()]') THEN 'unknown'
         WHEN regexp_matches(segs[i], '^\s*\{{\}}') THEN 'Subquery'
         ELSE regexp_extract(segs[i], '^\s*([A-Za-z_][A-Za-z0-9_.]*)', 1) END AS join_target
  FROM u WHERE NOT regexp_matches(segs[i], '(?i)\b(ON|USING)\b')
    AND NOT regexp_matches(segs[i - 1], '(?i)\b(CROSS|NATURAL)\s+((LEFT|RIGHT|FULL|INNER)\s+)?(OUTER\s+)?$')"""


@reg("missing_join_conditions", with_shapes(MISSING, "query_log"))
def _l6(spark, sf):
    return L.missing_join_conditions(ql(spark, sf))


@reg("rows_produced_groups", with_shapes("""SELECT q.rows_produced, q.query_id, q.query_text, s.n_queries
  FROM query_log q JOIN (SELECT rows_produced, COUNT(*) AS n_queries FROM query_log GROUP BY 1) s
  ON q.rows_produced IS NOT DISTINCT FROM s.rows_produced""", "query_log"))
def _l7(spark, sf):
    return L.rows_produced_groups(ql(spark, sf))


@reg("same_row_updates", with_shapes(f"""WITH u AS (SELECT query_id, {TT} AS target_table, {WH} AS predicate,
    {COLS} AS columns FROM query_log WHERE {KIND} = 'UPDATE'),
  s AS (SELECT target_table, predicate, COUNT(*) AS n_updates FROM u GROUP BY 1, 2 HAVING COUNT(*) > 1)
  SELECT u.target_table, u.predicate, u.query_id, u.columns, s.n_updates FROM u JOIN s
  ON u.target_table = s.target_table AND u.predicate = s.predicate""", "query_log"))
def _l8(spark, sf):
    return L.same_row_updates(ql(spark, sf))


@reg("profile_queries", with_shapes(f"""SELECT {KIND} AS kind, COUNT(*) AS n_queries,
  ROUND(AVG(execution_time), 6) AS avg_time,
  ROUND(AVG(CASE WHEN status = 'FAILED' THEN 1.0 ELSE 0.0 END), 6) AS failure_rate,
  COUNT(*) FILTER (WHERE execution_time > 10.0) AS n_long, COUNT(*) FILTER (WHERE status = 'FAILED') AS n_failed
  FROM query_log GROUP BY 1""", "query_log"))
def _l9(spark, sf):
    return rounded(L.profile_queries(ql(spark, sf), 10.0))


CHAIN = f"""WITH t AS (SELECT session_id, query_id, concat_ws(':', {KIND}, coalesce({TT}, '')) AS k,
    row_number() OVER (PARTITION BY session_id ORDER BY query_id) AS pos FROM query_log),
  i AS (SELECT *, pos - row_number() OVER (PARTITION BY session_id, k ORDER BY pos) AS isl FROM t),
  g AS (SELECT session_id, MIN(pos) AS first_pos, MAX(pos) AS last_pos FROM i GROUP BY session_id, k, isl
        HAVING MAX(pos) > MIN(pos)),
  e AS (SELECT session_id, query_id AS src, lead(query_id) OVER (PARTITION BY session_id ORDER BY query_id) AS dst,
        pos AS src_pos FROM t)
  SELECT session_id, src, dst FROM e WHERE dst IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g
    WHERE g.session_id = e.session_id AND e.src_pos >= g.first_pos AND e.src_pos < g.last_pos)"""


@reg("execution_chain", with_shapes(CHAIN, "query_log"))
def _l10(spark, sf):
    return L.execution_chain(ql(spark, sf))


@reg("sequence_edges", with_shapes("""SELECT session_id, src, dst FROM (SELECT session_id, query_id AS src,
  lead(query_id) OVER (PARTITION BY session_id ORDER BY query_id) AS dst FROM query_log) WHERE dst IS NOT NULL""",
                                   "query_log"))
def _w9(spark, sf):
    from ..operators.features import sequence_edges
    return sequence_edges(ql(spark, sf), "query_id", "query_id", ["session_id"])


@reg("redundant_updates", """SELECT COUNT(*) AS n_matched,
  COUNT(*) FILTER (WHERE s.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus) AS n_unchanged,
  ROUND(COUNT(*) FILTER (WHERE s.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus) / COUNT(*), 6) AS redundant_share
  FROM orders s JOIN (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END
  AS o_orderstatus FROM orders) t ON s.o_orderkey = t.o_orderkey""")
def _l11(spark, sf):
    o = tables(spark, sf).orders.select("o_orderkey", "o_orderstatus")
    target = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F")
                          .otherwise(F.col("o_orderstatus")))
    return rounded(L.redundant_updates(o, target, ["o_orderkey"], ["o_orderstatus"]))


@reg("time_comparison", with_shapes(f"""SELECT ROUND(SUM(total_time), 6) AS time_before,
  ROUND(SUM(max_time), 6) AS time_after, ROUND(SUM(total_time) - SUM(max_time), 6) AS seconds_saved,
  ROUND((SUM(total_time) - SUM(max_time)) * 100.0 / nullif(SUM(total_time), 0.0), 6) AS saved_pct
  FROM (SELECT {FW} AS p, SUM(execution_time) AS total_time, MAX(execution_time) AS max_time
        FROM query_log GROUP BY 1)""", "query_log"))
def _l12(spark, sf):
    return rounded(L.time_comparison(ql(spark, sf)))


@reg("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _c6(spark, sf):
    ev = tables(spark, sf).events
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


URL_PATH = r"^[a-zA-Z]+://[^/]+/([^?#]*)"


@reg("url_parts", rf"""SELECT page_id, split_part(url, '/', 3) AS host,
  split_part(regexp_extract(url, '{URL_PATH}', 1), '/', 1) AS first_segment FROM pages""")
def _c10(spark, sf):
    p = tables(spark, sf).pages
    return p.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
                    F.split_part(F.regexp_extract("url", URL_PATH, 1), F.lit("/"), F.lit(1)).alias("first_segment"))
