"""Analytics over a query-log table.

Input: ``log(query_id, query_text, execution_time, status, rows_produced,
session_id)``.  SQL text is handled with built-in string and regex functions,
row by row on the executors; there is no SQL parser.  Groups that may be huge
(all UPDATEs, all statements on one hot table) are returned in long form with
exact positions from ``plans.ordinal`` — never gathered into one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import first_word
from ..plans.ordinal import ROWS_PER_BUCKET, ordinal_within
from ..plans.range_join import range_anti_join
from .features import row_ids
from .relational import pair_successors, profile_groups

MERGE_SEPARATOR = " MERGED QUERY "


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# A quoted string.  Possessive runs, no choice under a star: such a choice takes a level of
# the matcher's stack for each character of a string.
QUOTED = r"'[^']*+(?:''[^']*+)*+'"
# a quoted string, or a comment; strings come first, so "--" inside one is text
STRING_OR_COMMENT = rf"({QUOTED})|--[^\n]*+|/\*(?s:.*?)\*/"
TOKEN = rf"{QUOTED}|[()]|[A-Za-z0-9_$]++|[^'()A-Za-z0-9_$]++|'"


def strip_comments(text) -> Column:
    """The text without comments; quoted strings stay as they are."""
    return F.regexp_replace(_c(text), STRING_OR_COMMENT, "$1")


def blank_literals(text) -> Column:
    """Comments removed and quoted strings emptied, so keywords inside them are ignored."""
    return F.regexp_replace(strip_comments(text), QUOTED, "''")


def outside_parens(text) -> Column:
    """Every outermost parenthesised part becomes ``{}``, to any depth, in one pass;
    a lone ``(`` is appended when the parentheses do not match."""
    pieces = F.regexp_extract_all(_c(text), F.lit(r"[()]|[^()]+"), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"), F.lit(False).alias("bad"))

    def step(acc, p):
        d, op, cl = acc["depth"], p == "(", p == ")"
        add = F.when(op, F.lit("{}")).when(~cl, p)
        return F.struct(F.when(op, d + 1).when(cl, F.greatest(d - 1, F.lit(0))).otherwise(d).alias("depth"),
                        F.when((d == 0) & ~cl, F.concat(acc["kept"], F.array(add))).otherwise(acc["kept"]).alias("kept"),
                        (acc["bad"] | (cl & (d == 0))).alias("bad"))

    return F.aggregate(pieces, start, step, lambda r: F.concat(
        F.array_join(r["kept"], ""), F.when(r["bad"] | (r["depth"] > 0), F.lit("(")).otherwise(F.lit(""))))


def statement_kind(text) -> Column:
    return F.upper(first_word(strip_comments(text)))


def target_table(text) -> Column:
    """UPDATE x / DELETE FROM x / INSERT INTO x -> x (NULL otherwise)."""
    t = F.regexp_extract(strip_comments(text), r"(?i)^\s*(?:UPDATE|DELETE\s+FROM|INSERT\s+INTO)\s+([A-Za-z_][A-Za-z0-9_.]*)", 1)
    return F.when(t != "", F.lower(t))


def written_columns(text) -> Column:
    """Columns of the SET list, or of the INSERT column list (lower case, in order)."""
    t = blank_literals(text)
    set_part = F.regexp_extract(outside_parens(t), r"(?is)\bSET\s+(.*?)(?:\s+WHERE\b|$)", 1)
    set_cols = F.regexp_extract_all(set_part, F.lit(r"(?:^|,)\s*([A-Za-z_][A-Za-z0-9_]*)\s*="), 1)
    ins_part = F.regexp_extract(t, r"(?i)^\s*INSERT\s+INTO\s+[A-Za-z_][A-Za-z0-9_.]*\s*\(([^)]*)\)", 1)
    ins_cols = F.transform(F.split(ins_part, ","), lambda c: F.trim(c))
    ins_cols = F.filter(ins_cols, lambda c: c != "")
    return F.transform(F.when(F.size(set_cols) > 0, set_cols).otherwise(ins_cols), lambda c: F.lower(c))


def where_text(text) -> Column:
    """The statement's own WHERE clause as written, comments aside (trimmed), NULL when
    absent: what follows the first WHERE outside parentheses and strings.  Literals stay:
    updates of ``name = 'x'`` and ``name = 'y'`` are different rows."""
    t = strip_comments(text)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("after"))

    def step(acc, p):
        depth = acc["depth"] + F.when(p == "(", 1).when(p == ")", -1).otherwise(0)
        at = acc["at"] + F.length(p)
        own = (acc["after"] == 0) & (acc["depth"] <= 0) & (F.length(p) == 5) & (F.upper(p) == "WHERE")
        return F.struct(depth.alias("depth"), at.alias("at"), F.when(own, at).otherwise(acc["after"]).alias("after"))

    after = F.aggregate(F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0)), start, step, lambda r: r["after"])
    w = F.when(after > 0, F.regexp_replace(t.substr(after + 1, F.length(t)), r"^\s+|\s+$", ""))
    return F.when(w != "", w)


def extract_targets(log: DataFrame) -> DataFrame:
    """L1: statement kind, target table and written columns per query."""
    return log.select("query_id", statement_kind("query_text").alias("kind"),
                      target_table("query_text").alias("target_table"),
                      written_columns("query_text").alias("columns"))


def queries_sharing_table(log: DataFrame) -> DataFrame:
    """L2 (A4): tables touched by more than one query, one row per (table, query)."""
    t = extract_targets(log).filter(F.col("target_table").isNotNull())
    sizes = (t.groupBy("target_table").agg(F.count(F.lit(1)).alias("n_queries"))
             .filter(F.col("n_queries") > 1))
    return t.select("target_table", "query_id").join(sizes, "target_table")


def merge_groups(log: DataFrame) -> DataFrame:
    """L3 summary: per first word, the 1-based merged id, members, total time,
    the time saved as written (always 0: both sums cover the same rows) and the
    saving if a merged statement took as long as its slowest member."""
    g = (log.withColumn("query_prefix", first_word("query_text"))
         .groupBy("query_prefix")
         .agg(F.count(F.lit(1)).alias("n_queries"),
              F.sum("execution_time").alias("total_time"),
              F.max("execution_time").alias("max_time")))
    g = row_ids(g, ["query_prefix"], "merged_query_id")
    return g.select(F.col("merged_query_id").cast("int").alias("merged_query_id"), "query_prefix", "n_queries",
                    "total_time", F.lit(0.0).alias("time_saved"),
                    (F.col("total_time") - F.col("max_time")).alias("savings_if_merged"))


def merge_members(log: DataFrame) -> DataFrame:
    """L3/A3 long form: (query_prefix, query_id, pos) — the ordered id list of each group."""
    d = log.select(first_word("query_text").alias("query_prefix"), "query_id", "query_text")
    return ordinal_within(d, ["query_prefix"], ["query_id"], out="pos")


def merge_text_pieces(log: DataFrame, piece_size: int = 256, sep: str = MERGE_SEPARATOR) -> DataFrame:
    """L3/A3 text: member texts joined by ``sep`` in id order, cut into pieces of
    at most ``piece_size`` statements (so no row grows with the log)."""
    m = merge_members(log).withColumn("piece", F.floor((F.col("pos") - 1) / F.lit(piece_size)).cast("long"))
    g = m.groupBy("query_prefix", "piece").agg(
        F.array_sort(F.collect_list(F.struct("pos", "query_text"))).alias("_tw_m"),
        F.min("query_id").alias("first_query_id"), F.count(F.lit(1)).alias("n_queries"))
    return g.select("query_prefix", "piece", "first_query_id", "n_queries",
                    F.array_join(F.transform("_tw_m", lambda s: s["query_text"]), sep).alias("merged_query"))


def dependency_edges(log: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """L4 (J8): "each earlier statement precedes each later one on the same table",
    as one row per statement: position, next statement and the exact successor
    interval ``(pos, pos + n_successors]`` — linear output, no pair explosion."""
    t = extract_targets(log).filter(F.col("target_table").isNotNull())
    t = t.join(log.select("query_id", *scope), "query_id") if scope else t
    return pair_successors(t.select("query_id", "target_table", *scope),
                           ["target_table", *scope], "query_id", "query_id")


def merge_suggestions(log: DataFrame) -> DataFrame:
    """Per statement, the next statement on the same table (its merge partner),
    the partner's text and how many later statements share the table."""
    e = dependency_edges(log)
    txt = log.select(F.col("query_id").alias("next_id"), F.col("query_text").alias("next_text"))
    return (e.join(txt, "next_id", "left")
            .select("query_id", "target_table", "next_id", "next_text", "n_successors"))


def missing_join_conditions(log: DataFrame) -> DataFrame:
    """Every JOIN with neither ON nor USING before the next JOIN, naming the
    joined table or ``Subquery``.  CROSS and NATURAL joins are not flagged.

    Parenthesised parts are left out to any depth, so only the statement's own joins
    are examined; a text whose parentheses do not match reports ``unknown``."""
    flat = outside_parens(blank_literals("query_text"))
    segs = F.split(flat, r"(?i)\bJOIN\b")
    d = log.select("query_id", flat.alias("_tw_flat"), segs.alias("_tw_segs"))
    d = d.select("query_id", "_tw_flat", "_tw_segs",
                 F.posexplode(F.expr("slice(_tw_segs, 2, greatest(size(_tw_segs) - 1, 0))")).alias("_tw_i", "seg"))
    prev = F.element_at("_tw_segs", F.col("_tw_i") + 1)
    target = F.when(F.col("_tw_flat").rlike(r"[()]"), F.lit("unknown")) \
        .when(F.col("seg").rlike(r"^\s*\{\}"), F.lit("Subquery")) \
        .otherwise(F.regexp_extract("seg", r"^\s*([A-Za-z_][A-Za-z0-9_.]*)", 1))
    flagged = (~F.col("seg").rlike(r"(?i)\b(ON|USING)\b")) & \
        (~prev.rlike(r"(?i)\b(CROSS|NATURAL)\s+((LEFT|RIGHT|FULL|INNER)\s+)?(OUTER\s+)?$"))
    return d.filter(flagged).select("query_id", (F.col("_tw_i") + 1).alias("join_no"),
                                    target.alias("join_target"))


def rows_produced_groups(log: DataFrame) -> DataFrame:
    """L7 (A9): queries grouped by rows produced, long form with text and group size."""
    sizes = log.groupBy(F.col("rows_produced").alias("_tw_rows")).agg(F.count(F.lit(1)).alias("n_queries"))
    return (log.select("rows_produced", "query_id", "query_text")
            .join(sizes, F.col("rows_produced").eqNullSafe(F.col("_tw_rows"))).drop("_tw_rows"))


def same_row_updates(log: DataFrame) -> DataFrame:
    """UPDATEs with the same table and the same WHERE text (more than one):
    long form (table, predicate, query_id, set columns, group size)."""
    u = log.filter(statement_kind("query_text") == "UPDATE").select(
        "query_id", target_table("query_text").alias("target_table"),
        where_text("query_text").alias("predicate"), written_columns("query_text").alias("columns"))
    sizes = (u.groupBy("target_table", "predicate").agg(F.count(F.lit(1)).alias("n_updates"))
             .filter(F.col("n_updates") > 1))
    return u.join(sizes, ["target_table", "predicate"])


def profile_queries(log: DataFrame, long_threshold: float = 10.0) -> DataFrame:
    """L9 (A14): by statement kind: count, average time, failure rate, long-running
    and failed counts."""
    return profile_groups(log, statement_kind("query_text"), long_threshold=long_threshold).withColumnRenamed("grp", "kind")


def run_groups(log: DataFrame, scope: str = "session_id", key: Column | None = None) -> DataFrame:
    """Merge groups for L10 from the data: maximal runs (>= 2) of consecutive
    statements in a session with the same kind and target table.
    Returns (scope, first_pos, last_pos, first_id, last_id)."""
    key = key if key is not None else F.concat_ws(":", statement_kind("query_text"),
                                                  F.coalesce(target_table("query_text"), F.lit("")))
    if "pos" in log.columns:  # positions shared with the caller
        p = log.select(scope, "query_id", "pos", key.alias("_tw_key"))
    else:
        d = log.select(scope, "query_id", key.alias("_tw_key"))
        p = ordinal_within(d, [scope], ["query_id"], out="pos")
    # positions are dense (1..n per scope): fixed-size buckets need no probe
    q = ordinal_within(p, [scope, "_tw_key"], ["pos"], out="_tw_kpos", width=ROWS_PER_BUCKET)
    g = (q.withColumn("_tw_island", F.col("pos") - F.col("_tw_kpos"))
         .groupBy(scope, "_tw_key", "_tw_island")
         .agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
              F.min("query_id").alias("first_id"), F.max("query_id").alias("last_id"))
         .filter(F.col("last_pos") > F.col("first_pos")))
    return g.select(scope, "first_pos", "last_pos", "first_id", "last_id")


def execution_chain(log: DataFrame, groups: DataFrame | None = None, scope: str = "session_id"
                    ) -> DataFrame:
    """L10 (W9 + J9): next-statement edges per session; edges whose source lies in
    ``[first_pos, last_pos)`` of a merge group vanish (the group runs as one)."""
    p = ordinal_within(log.select(scope, "query_id", "query_text"), [scope], ["query_id"], out="pos")
    a = p.select(scope, F.col("query_id").alias("src"), "pos")
    b = p.select(F.col(scope).alias("_tw_s"), F.col("query_id").alias("dst"),
                 (F.col("pos") - 1).alias("_tw_p"))
    edges = (a.join(b, (a[scope].eqNullSafe(b["_tw_s"])) & (a["pos"] == b["_tw_p"]))
             .select(scope, "src", "dst", F.col("pos").alias("src_pos")))
    groups = groups if groups is not None else run_groups(p, scope)
    kept = range_anti_join(edges, groups, "src_pos", "first_pos", "last_pos", scope=[scope])
    return kept.select(scope, "src", "dst")


def redundant_updates(source: DataFrame, target: DataFrame, key: Sequence[str],
                      cols: Sequence[str]) -> DataFrame:
    """Of the rows an update would touch (matched keys), how many change nothing."""
    t = target.select(*key, *[F.col(c).alias(f"_tw_t_{c}") for c in cols])
    same = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_tw_t_{c}"))
        same = e if same is None else (same & e)
    j = source.select(*key, *cols).join(t, list(key))
    return j.agg(F.count(F.lit(1)).alias("n_matched"), F.count_if(same).alias("n_unchanged")) \
        .withColumn("redundant_share", F.col("n_unchanged") / F.nullif(F.col("n_matched"), F.lit(0)))


def time_comparison(log: DataFrame) -> DataFrame:
    """L12 (A16 over L3): total time before, after merging by first word (the
    merged statement costs its slowest member), seconds saved and percent."""
    g = merge_groups(log)
    return g.agg(F.sum("total_time").alias("time_before"),
                 F.sum(F.col("total_time") - F.col("savings_if_merged")).alias("time_after")) \
        .withColumn("seconds_saved", F.col("time_before") - F.col("time_after")) \
        .withColumn("saved_pct", F.col("seconds_saved") * 100.0 / F.nullif(F.col("time_before"), F.lit(0.0)))
