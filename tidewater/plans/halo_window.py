"""Ordered windows that do not funnel a whole series into one task.

``lag(x, k).over(Window.orderBy(d))`` has no partition, so Spark plans an
``Exchange SinglePartition``; a partitioned window with one hot key is the
same problem for that key.  For frames that look back a bounded number of
rows the plan here is exact and parallel:

1. exact positions inside each series (``ordinal_within``: range buckets +
   prefix sums of bucket counts, no single task sees a whole series);
2. rows are cut into blocks of ``block_rows`` consecutive positions;
3. the last ``lookback`` rows of every block are also emitted (same pass,
   ``explode``) into the next block as "halo" rows;
4. the window runs partitioned by (series, block) — every frame finds the rows
   it needs inside its block — and halo rows are dropped afterwards.

Unbounded running aggregates (cumulative count/sum/sum of squares) use the
same blocks: block totals are prefix-summed on the small per-block table and
added to the in-block running values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .ordinal import ordinal_within

MakeCols = Callable[[WindowSpec], dict[str, Column]]


def _positions(df, group_cols, order_cols, width):
    if "_tw_pos" in df.columns:  # positions already computed by the caller (shared)
        return df, (list(group_cols) or ["_tw_all"])
    if not group_cols:
        df = df.withColumn("_tw_all", F.lit(0))
        group_cols = ["_tw_all"]
    return ordinal_within(df, group_cols, order_cols, out="_tw_pos", width=width), list(group_cols)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL meets NULL; the key columns come from the left."""
    right = right.select(*[F.col(c).alias(f"_tw_k_{i}") if c in keys else F.col(c)
                           for c in right.columns for i in ([list(keys).index(c)] if c in keys else [0])])
    cond = [left[c].eqNullSafe(right[f"_tw_k_{i}"]) for i, c in enumerate(keys)]
    return left.join(right, cond).drop(*[f"_tw_k_{i}" for i in range(len(keys))])


def bounded_window(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   lookback: int, make_cols: MakeCols, block_rows: int = 1 << 16,
                   width: int | None = None, keep_pos: bool = False) -> DataFrame:
    """Add the columns of ``make_cols(window)``, where ``window`` is ordered like
    ``order_cols`` inside ``group_cols`` and every frame reaches at most
    ``lookback`` rows back and none forward.  ``order_cols[0]`` must be numeric
    and ``order_cols`` must be a total order within a group.  With
    ``keep_pos`` the exact positions stay in ``_tw_pos`` for a following
    window over the same series (no second position pass)."""
    if lookback >= block_rows:
        raise ValueError("block_rows must exceed lookback")
    pos, groups = _positions(df, list(group_cols), list(order_cols), width)
    blk = F.floor((F.col("_tw_pos") - 1) / F.lit(block_rows))
    # one pass: a row in the last ``lookback`` of its block is emitted twice,
    # once for its own block and once as a halo row of the next block
    tail = ((F.col("_tw_pos") - 1) % F.lit(block_rows)) >= F.lit(block_rows - lookback)
    u = (pos.withColumn("_tw_own", blk)
         .withColumn("_tw_blk", F.explode(F.when(tail, F.array(blk, blk + 1)).otherwise(F.array(blk))))
         .withColumn("_tw_halo", F.col("_tw_blk") != F.col("_tw_own")).drop("_tw_own"))
    w = Window.partitionBy(*groups, "_tw_blk").orderBy("_tw_pos")
    out = u.withColumns(make_cols(w)).filter(~F.col("_tw_halo"))
    return out.drop("_tw_blk", "_tw_halo", *([] if keep_pos else ["_tw_pos", "_tw_all"]))


def running_moments(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    x: str, prefix: str = "run", block_rows: int = 1 << 16,
                    width: int | None = None) -> DataFrame:
    """Cumulative count, mean and sample deviation of ``x`` from the first row of
    the group to the current one (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    pos, groups = _positions(df, list(group_cols), list(order_cols), width)
    pos = pos.withColumn("_tw_blk", F.floor((F.col("_tw_pos") - 1) / F.lit(block_rows)))
    # centre each group on its mean before squaring (one small aggregate per
    # group), so the sums of squares do not cancel catastrophically
    centre = pos.groupBy(*groups).agg(F.avg(F.col(x).cast("double")).alias("_tw_c"))
    pos = _join_null_safe(pos, centre, groups)
    xv = F.col(x).cast("double") - F.col("_tw_c")
    nn = F.when(xv.isNotNull(), 1).otherwise(0)
    x0 = F.coalesce(xv, F.lit(0.0))
    tot = (pos.groupBy(*groups, "_tw_blk")
           .agg(F.sum(nn).alias("_tw_bn"), F.sum(x0).alias("_tw_bs"), F.sum(x0 * x0).alias("_tw_bq")))
    prior = Window.partitionBy(*groups).orderBy("_tw_blk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*groups, "_tw_blk",
                     *[F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(c + "_p")
                       for c in ("_tw_bn", "_tw_bs", "_tw_bq")])
    inb = Window.partitionBy(*groups, "_tw_blk").orderBy("_tw_pos").rowsBetween(
        Window.unboundedPreceding, 0)
    run = pos.withColumns({"_tw_n": F.sum(nn).over(inb), "_tw_s": F.sum(x0).over(inb),
                           "_tw_q": F.sum(x0 * x0).over(inb)})
    j = _join_null_safe(run, tot, [*groups, "_tw_blk"])
    n = F.col("_tw_n") + F.col("_tw_bn_p")
    s = F.col("_tw_s") + F.col("_tw_bs_p")
    q = F.col("_tw_q") + F.col("_tw_bq_p")
    mean = s / F.nullif(n, F.lit(0)) + F.col("_tw_c")
    var = F.greatest((q - s * s / n) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))
    out = j.withColumns({f"{prefix}_count": n.cast("long"), f"{prefix}_mean": mean,
                         f"{prefix}_std": F.when(n > 1, F.sqrt(var))})
    return out.drop("_tw_blk", "_tw_pos", "_tw_all", "_tw_n", "_tw_s", "_tw_q", "_tw_c",
                    "_tw_bn_p", "_tw_bs_p", "_tw_bq_p")
