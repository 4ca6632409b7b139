"""Projections, filters, joins, aggregates, sorts and set operations (P*, J*, A*, O*, U*).

Every operator is ``DataFrame(s) -> DataFrame`` and stays declarative so that
Catalyst prunes columns, pushes filters into the Parquet scan and lets AQE pick
broadcast or sort-merge joins from runtime sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import row_key_col
from ..plans.broadcast import bounded_broadcast
from ..plans.ordinal import ordinal_within


# ---------------------------------------------------------------- P: projections / filters

def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any work when needed columns are absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def project_alias(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """``SELECT a AS x, b AS y``; ``None`` is ``SELECT *``."""
    if mapping is None:
        return df.select("*")
    require_columns(df, mapping.keys())
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Equality / point lookup."""
    return df.filter(F.col(column) == F.lit(value))


def filter_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def filter_half_open(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """``lo <= column < hi``."""
    return df.filter((F.col(column) >= F.lit(lo)) & (F.col(column) < F.lit(hi)))


def filter_in(df: DataFrame, keys, column: str, key_column: str | None = None) -> DataFrame:
    """P5: membership in a set.  A DataFrame set becomes a left-semi join (scales,
    duplicates in the set do not repeat rows); a Python list becomes ``isin``."""
    if isinstance(keys, DataFrame):
        key_column = key_column or column
        return df.join(keys.select(F.col(key_column).alias("_tw_k")),
                       F.col(column) == F.col("_tw_k"), "left_semi")
    return df.filter(F.col(column).isin(list(keys)))


def filter_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    """Line contains ``needle`` (e.g. ``ERROR``)."""
    return df.filter(F.col(column).contains(needle))


def case_when(df: DataFrame, out: str, branches: Sequence[tuple[Column, object]],
              otherwise=None) -> DataFrame:
    """Guarded CASE; branches are (condition, value) pairs in order."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return df.withColumn(out, expr)


def with_columns(df: DataFrame, mapping: Mapping[str, Column]) -> DataFrame:
    """Add many generated columns as one projection."""
    return df.withColumns(dict(mapping))


def literal_concat(df: DataFrame, out: str, *parts) -> DataFrame:
    """``CONCAT(a, ': ', b)``; string literals become constants; NULL propagates."""
    cols = [F.col(p) if isinstance(p, str) and p in df.columns else
            (p if isinstance(p, Column) else F.lit(p)) for p in parts]
    return df.withColumn(out, F.concat(*cols))


def row_key(df: DataFrame, cols: Sequence[str] | None = None, out: str = "Concatenated",
            sep: str = "") -> DataFrame:
    """P10: NULL -> '' then every column as text, concatenated (no separator by default)."""
    return df.withColumn(out, row_key_col(cols or df.columns, sep))


def distinct_nonnull(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Values as text, NULLs dropped, duplicates dropped."""
    return (df.select(F.col(column).cast("string").alias(out or column))
            .dropna().distinct())


def changed_rows(source: DataFrame, target: DataFrame, key: Sequence[str],
                 cols: Sequence[str]) -> DataFrame:
    """Source rows whose value in any of ``cols`` really differs from the
    target row with the same key (NULL-safe); unchanged rows are not touched."""
    t = target.select(*key, *[F.col(c).alias(f"_tw_t_{c}") for c in cols])
    diff = None
    for c in cols:
        d = ~F.col(c).eqNullSafe(F.col(f"_tw_t_{c}"))
        diff = d if diff is None else (diff | d)
    return (source.join(t, list(key), "inner").filter(diff)
            .select(*source.columns))


def mask_columns(df: DataFrame, cols: Sequence[str], method: str = "md5") -> DataFrame:
    """Replace sensitive values by a digest (md5, sha2) or a character mask."""
    fn = {"md5": lambda c: F.md5(F.col(c).cast("string")),
          "sha2": lambda c: F.sha2(F.col(c).cast("string"), 256),
          "mask": lambda c: F.mask(F.col(c).cast("string"))}[method]
    return df.withColumns({c: fn(c) for c in cols})


# ---------------------------------------------------------------- J: joins

def wide_denormalise(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                     supplier: DataFrame, nation: DataFrame, events: DataFrame,
                     part: DataFrame, sort: bool = True) -> DataFrame:
    """J1 (flagship): four inner joins, two left joins on two keys each, 20 columns,
    sorted by four keys.

    Join order is chosen for width, not text order: the order side (customer,
    orders and the per-(customer, day) purchase summary — one row per order)
    and the line side (line items, supplier, nation and seats — keyed by the
    line's own columns) are built separately with only the columns they carry,
    and meet once on the order key.  Each left join depends only on its own
    side's columns, so moving it before the final inner join gives the same
    rows, and the widest (20-column) rows are shuffled once instead of through
    every join.  The nation dimension (25 rows) is broadcast behind a checked
    row bound — shuffling the line side on 25 key values would put it into 25
    tasks; everything else is left to AQE, which turns small sides into
    broadcasts from runtime sizes and splits skewed partitions.
    """
    # boarding passes: one row per (customer, day of month) of purchase events
    passes = (events.filter(F.col("event_type") == "purchase")
              .groupBy(F.col("user_id").alias("bp_user"), F.dayofmonth("ts").alias("bp_day"))
              .agg(F.min("event_id").alias("boarding_no")))
    # seats: parts of size below 25, joined on (part, size = supplier nation)
    seats = (part.filter(F.col("p_size") < 25)
             .select(F.col("p_partkey").alias("st_partkey"),
                     F.col("p_size").alias("st_size"), F.col("p_name").alias("seat_no")))
    order_side = (customer.select("c_custkey", "c_name", "c_acctbal")
                  .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                        F.col("c_custkey") == F.col("o_custkey"))
                  .join(passes, (F.col("o_custkey") == F.col("bp_user"))
                        & (F.dayofmonth("o_orderdate") == F.col("bp_day")), "left")
                  .select("c_custkey", "c_name", "c_acctbal", "o_orderkey", "o_orderdate", "boarding_no"))
    line_side = (lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity",
                                 "l_extendedprice", "l_discount", "l_shipdate", "l_returnflag")
                 .join(supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey"),
                       F.col("l_suppkey") == F.col("s_suppkey"))
                 .join(bounded_broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"), 10_000),
                       F.col("s_nationkey") == F.col("n_nationkey"))
                 .join(seats, (F.col("l_partkey") == F.col("st_partkey"))
                       & (F.col("s_nationkey") == F.col("st_size")), "left"))
    j = order_side.join(line_side, F.col("o_orderkey") == F.col("l_orderkey"))
    out = j.select("c_custkey", "c_name", "c_acctbal",
                   "o_orderkey", "o_orderdate",
                   "l_linenumber", "l_suppkey",
                   "s_name", "s_acctbal", "l_partkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_shipdate", "l_returnflag",
                   "s_nationkey", "n_name", "n_regionkey",
                   "boarding_no", "seat_no")
    if sort:
        out = out.orderBy("c_custkey", "o_orderkey", "l_suppkey", "s_nationkey")
    return out


def left_join_composite(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]
                        ) -> DataFrame:
    """Left outer join on several (left, right) key pairs."""
    cond = [left[a] == right[b] for a, b in keys]
    return left.join(right, cond, "left")


def join_on_date(metrics: DataFrame, origin: DataFrame, on: Sequence[str],
                 metric_cols: Sequence[str], origin_cols: Sequence[str]) -> DataFrame:
    """Inner join of a derived metric frame with its origin on the date key,
    projecting from both sides.  Keys must be unique on each side (see F7)."""
    m = metrics.select(*on, *metric_cols)
    o = origin.select(*on, *origin_cols)
    return o.join(m, list(on), "inner")


def outer_indicator(left: DataFrame, right: DataFrame, key: str,
                    out: str = "_merge") -> DataFrame:
    """Full outer join on ``key`` with ``left_only`` / ``right_only`` / ``both``."""
    l = left.select(F.col(key).alias("_tw_lk"), F.lit(True).alias("_tw_l"))
    r = right.select(F.col(key).alias("_tw_rk"), F.lit(True).alias("_tw_r"))
    j = l.join(r, F.col("_tw_lk") == F.col("_tw_rk"), "full_outer")
    return j.select(
        F.coalesce("_tw_lk", "_tw_rk").alias(key),
        F.when(F.col("_tw_r").isNull(), "left_only")
         .when(F.col("_tw_l").isNull(), "right_only").otherwise("both").alias(out))


def order_totals(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Three-way join then SUM(quantity * price) by order and customer.

    The line items are aggregated per order *before* the joins (partial
    aggregation map-side), so the joins carry one row per order instead of one
    per line item."""
    per_order = (lineitem.groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_quantity") * F.col("l_extendedprice")).alias("total")))
    return (orders.select("o_orderkey", "o_custkey")
            .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
            .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
            .select("o_orderkey", "c_custkey", "c_name", "total"))


def correlated_in(spark, nation: DataFrame, region: DataFrame, supplier: DataFrame,
                  min_acctbal: float = 0.0) -> DataFrame:
    """``IN (SELECT ... WHERE inner.key = outer.key AND ...)`` on top of a
    two-table join; Catalyst decorrelates it into a left-semi join."""
    return spark.sql(
        """SELECT n.n_nationkey, n.n_name, r.r_name
           FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
           WHERE n.n_nationkey IN (SELECT s.s_nationkey FROM {supplier} s
                                   WHERE s.s_nationkey = n.n_nationkey
                                     AND s.s_acctbal > {min_acctbal})""",
        nation=nation, region=region, supplier=supplier, min_acctbal=min_acctbal)


def pair_successors(df: DataFrame, scope: Sequence[str], order_col: str, id_col: str
                    ) -> DataFrame:
    """J8 re-aimed: the relation "every earlier row precedes every later row in the
    same scope" without emitting the n^2/2 pairs.

    One row per member: its position, the next member (the transitive reduction
    edge) and the exact successor set as a position interval ``(pos, last_pos]``
    with its size.  Pair (a, b) belongs to the relation iff they share the scope
    and ``a.pos < b.pos``.  Positions come from the skew-safe ``ordinal_within``.
    """
    scope = list(scope)
    pos = ordinal_within(df, scope, [order_col, id_col], out="pos")
    sizes = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("scope_size")).select(
        *[F.col(c).alias(f"_tw_z_{i}") for i, c in enumerate(scope)], "scope_size")
    nxt = pos.select(*[F.col(c).alias(f"_tw_x_{i}") for i, c in enumerate(scope)],
                     (F.col("pos") - 1).alias("_tw_p"), F.col(id_col).alias("next_id"))
    j = pos.join(sizes, [pos[c].eqNullSafe(sizes[f"_tw_z_{i}"]) for i, c in enumerate(scope)])
    j = j.join(nxt, [j[c].eqNullSafe(nxt[f"_tw_x_{i}"]) for i, c in enumerate(scope)]
               + [j["pos"] == nxt["_tw_p"]], "left")
    j = j.drop("_tw_p", *[f"_tw_z_{i}" for i in range(len(scope))],
               *[f"_tw_x_{i}" for i in range(len(scope))])
    return j.withColumn("n_successors", F.col("scope_size") - F.col("pos"))


def interval_anti_join(edges: DataFrame, groups: DataFrame, src_col: str = "src",
                       first_col: str = "first", last_col: str = "last") -> DataFrame:
    """Drop edges whose source lies in ``[first, last)`` of any group.

    Uses the dyadic range join (plans.range_join), not a nested loop over a
    broadcast, so neither side needs a size bound."""
    from ..plans.range_join import range_anti_join
    return range_anti_join(edges, groups, src_col, first_col, last_col)


# ---------------------------------------------------------------- A: aggregates

def global_min_max_count(df: DataFrame, column: str) -> DataFrame:
    """A1: MIN, MAX and COUNT(*) in one pass."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"),
                  F.count(F.lit(1)).alias("row_count"))


def group_sum_expr(df: DataFrame, keys: Sequence[str], a: str, b: str,
                   out: str = "total") -> DataFrame:
    """A2: SUM(a * b) by keys (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.sum(F.col(a) * F.col(b)).alias(out))


def group_members(df: DataFrame, key: str, member: str, min_members: int = 1,
                  count_col: str = "n_members") -> DataFrame:
    """A3/A4/A9 long form: one row per (group, member) with the group's size,
    only groups with at least ``min_members``.  Group sizes are a partial
    aggregate joined back, so a hot group is never gathered into one row."""
    sizes = (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
             .filter(F.col(count_col) >= min_members))
    return df.select(key, member).join(sizes, key, "inner")


def group_having_many(df: DataFrame, key: str, member: str) -> DataFrame:
    """A4: groups with more than one member, each member listed (long form)."""
    return group_members(df.select(key, member).distinct(), key, member, min_members=2)


def content_digest(cols: Sequence[str]) -> Column:
    """SHA-256 of the columns' values (JSON of a struct keeps positions and NULLs
    apart): a 32-byte grouping key standing in for long texts."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def duplicate_rows(df: DataFrame, cols: Sequence[str], count_col: str = "n_copies",
                   by_digest: bool = True) -> DataFrame:
    """A5: every row whose value in ``cols`` occurs more than once, with the count.

    Counting is a partial aggregate; the rows come back by a join with the
    repeated values (AQE splits a hot value across tasks), not by a window that
    would put the hottest value into one task.  With ``by_digest`` the grouping
    and the join use a SHA-256 digest of the values, so long texts are not
    shuffled as keys.  Rows with a NULL in ``cols`` are never duplicates."""
    cols = list(cols)
    if not by_digest:
        reps = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
                .filter(F.col(count_col) > 1))
        return df.join(reps, cols, "inner")
    not_null = None
    for c in cols:
        e = F.col(c).isNotNull()
        not_null = e if not_null is None else (not_null & e)
    d = df.filter(not_null).withColumn("_tw_h", content_digest(cols))
    reps = (d.groupBy("_tw_h").agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))
    return d.join(reps, "_tw_h", "inner").drop("_tw_h")


def distinct_count_per_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column, NULL counted as one value; long form."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        aggs.append((F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int")))
                    .cast("long").alias(c))
    wide = df.agg(*aggs)
    return _unpivot_one_row(wide, cols, "distinct_count")


def null_count_per_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one job, long form (column_name, null_count)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot_one_row(wide, cols, "null_count")


def _unpivot_one_row(wide: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
    renamed = wide.select(*[F.col(c).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias(value))
        for i, c in enumerate(cols)])).alias("_tw_s")
    return renamed.select(stacked).select("_tw_s.column_name", f"_tw_s.{value}")


def dtype_histogram(df: DataFrame) -> DataFrame:
    """Number of columns per type (metadata only)."""
    spark = df.sparkSession
    rows = [(name, dtype) for name, dtype in df.dtypes]
    meta = spark.createDataFrame(rows, "column_name string, dtype string")
    return meta.groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"))


def progress_ratio(status: DataFrame, total_col: str = "total_records",
                   parts_col: str = "partitions", key: str = "run_id") -> DataFrame:
    """A10: sum of partition record counts over the total, as a percentage;
    0 when the total is 0 or missing."""
    done = F.aggregate(F.coalesce(F.col(parts_col), F.array().cast(
        "array<struct<records_count:bigint>>")), F.lit(0).cast("long"),
        lambda acc, p: acc + F.coalesce(p["records_count"], F.lit(0)).cast("long"))
    total = F.col(total_col)
    return status.select(
        key, total.alias(total_col), done.alias("records_done"),
        F.when(total > 0, done * 100.0 / total).otherwise(F.lit(0.0)).alias("progress_pct"))


def records_per_partition(status: DataFrame, parts_col: str = "partitions",
                          key: str = "run_id") -> DataFrame:
    """One row per partition with its ordinal label ``Partition i`` (1-based)."""
    return (status.select(key, F.posexplode(parts_col).alias("_tw_i", "_tw_p"))
            .select(key, (F.col("_tw_i") + 1).alias("partition_no"),
                    F.concat(F.lit("Partition "), (F.col("_tw_i") + 1).cast("string"))
                    .alias("partition_label"),
                    F.col("_tw_p.records_count").alias("records_count")))


def moments_per_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature, one pass, long form."""
    wide = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m{c}"),
                                              F.stddev_pop(c).alias(f"s{c}"))])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{c}").alias("mean"),
                 F.col(f"s{c}").alias("std_pop")) for c in cols])).alias("_tw_s")
    return wide.select(stacked).select("_tw_s.*")


def argmax_col(v: Column) -> Column:
    """0-based position of the largest element (first on ties)."""
    return F.array_position(v, F.array_max(v)) - 1


def accuracy(df: DataFrame, scores: str | Column, label: str) -> DataFrame:
    """Argmax of class scores against the label; fraction right and counts."""
    s = F.col(scores) if isinstance(scores, str) else scores
    right = (argmax_col(s) == F.col(label)).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(right).alias("n_right"),
                  F.avg(right.cast("double")).alias("accuracy"))


def profile_groups(log: DataFrame, group: str | Column, time_col: str = "execution_time",
                   status_col: str = "status", long_threshold: float = 10.0,
                   failed_value: str = "FAILED") -> DataFrame:
    """Average time, failure rate, long-running and failed counts by group."""
    g = F.col(group) if isinstance(group, str) else group
    return log.groupBy(g.alias("grp")).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg(time_col).alias("avg_time"),
        F.avg((F.col(status_col) == failed_value).cast("double")).alias("failure_rate"),
        F.count_if(F.col(time_col) > long_threshold).alias("n_long"),
        F.count_if(F.col(status_col) == failed_value).alias("n_failed"))


def row_hash_col(cols: Sequence[str]) -> Column:
    """First 8 hex digits of md5(row key) as a number: engine-neutral row hash."""
    return F.conv(F.substring(F.md5(row_key_col(cols, "|")), 1, 8), 16, 10).cast("long")


def table_checksum(df: DataFrame, cols: Sequence[str] | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    """Order-free checksum (sum of row hashes, DECIMAL(38,0): no table overflows it)
    and row count, optionally per bucket."""
    cols = list(cols or df.columns)
    h = row_hash_col(cols)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"),
                               F.sum(h.cast("decimal(38,0)")).alias("checksum"))


def savings_pct(before: DataFrame, after: DataFrame, key: str, metric: str) -> DataFrame:
    """(before - after) / before * 100 per key; NULL when before is 0."""
    b = before.select(key, F.col(metric).alias("before"))
    a = after.select(key, F.col(metric).alias("after"))
    return (b.join(a, key, "full_outer")
            .withColumn("saved_pct", (F.col("before") - F.col("after")) * 100.0
                        / F.nullif(F.col("before"), F.lit(0.0))))


# ---------------------------------------------------------------- O: sort / top-k

def sort_multi(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """O1: global sort (range-partitioned, sampled bounds)."""
    return df.orderBy(*keys)


def top_n_by_key(df: DataFrame, key: str, n: int, ascending: bool = True) -> DataFrame:
    """O2/O3: first ``n`` rows by key (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(F.col(key).asc() if ascending else F.col(key).desc()).limit(n)


def keyset_page(df: DataFrame, key: str, last_id, size: int = 10000) -> DataFrame:
    """The page after ``last_id``: ``key > last_id ORDER BY key LIMIT size``."""
    if not 1000 <= size <= 50000:
        raise ValueError("page size must be within 1000..50000")
    return df.filter(F.col(key) > F.lit(last_id)).orderBy(key).limit(size)


# ---------------------------------------------------------------- U: set operations

def labelled_union(frames: Mapping[str, DataFrame], label_col: str = "Source") -> DataFrame:
    """Append frames by column name with a label column."""
    out = None
    for label, f in frames.items():
        f = f.withColumn(label_col, F.lit(label))
        out = f if out is None else out.unionByName(f)
    return out


def two_sided_except(left: DataFrame, right: DataFrame, cols: Sequence[str],
                     left_label: str = "left_only", right_label: str = "right_only",
                     label_col: str = "side") -> DataFrame:
    """Distinct values only on the left, and only on the right, labelled."""
    l = left.select(*cols).distinct()
    r = right.select(*cols).distinct()
    return labelled_union({left_label: l.join(r, list(cols), "left_anti"),
                           right_label: r.join(l, list(cols), "left_anti")}, label_col)


def subset_missing(expected: DataFrame, found: DataFrame, col: str) -> DataFrame:
    """Expected values absent from ``found`` (empty = pass)."""
    return (expected.select(col).distinct()
            .join(found.select(col).distinct(), col, "left_anti"))
