"""Exact positions inside groups that may be huge, by ranges of a known width.

For keys that are dense in units known beforehand (positions, days): a fixed width bounds
the distinct keys of a range, so no sample is needed.  Without a width, positions come
from sampled splitters (``plans.ranking``), which hold for any key.

``row_number().over(partitionBy(g))`` sends a whole group to one task; when
one key holds a third of the table that task holds a third of the table.  The
plan here splits every group into ranges of the (numeric) ordering key:

1. ``bucket = floor(key / width)`` — a range split of each group;
2. row counts per (group, bucket) — a partial aggregate, tiny after combine;
3. running sum of those counts per group — a window over the small count table;
4. ``row_number`` inside (group, bucket) — each bucket holds at most ``width``
   distinct keys, so no task is larger than a bucket;
5. position = offset of the bucket + local number.

The big side is shuffled once (by (group, bucket)); the offset join reuses
that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranking import rank_within


ROWS_PER_BUCKET = 1 << 20


def ordinal_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   out: str = "pos", width: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number inside ``group_cols`` ordered by ``order_cols``.

    The order columns must be a total order inside each group (add a tie-break
    column otherwise).  ``width`` is the range width of one bucket of the first
    order column, which must then be numeric; without it the positions come from
    sampled splitters over all order columns, of any type.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    key = order_cols[0]
    if width is None:
        return rank_within(df, group_cols, order_cols, out)
    d = df.withColumn("_tw_b", F.floor(F.col(key) / F.lit(width)))
    counts = d.groupBy(*group_cols, "_tw_b").agg(F.count(F.lit(1)).alias("_tw_n"))
    before = Window.partitionBy(*group_cols).orderBy("_tw_b").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_tw_g_{i}") for i, c in enumerate(group_cols)],
        F.col("_tw_b").alias("_tw_ob"),
        F.coalesce(F.sum("_tw_n").over(before), F.lit(0)).alias("_tw_off"))
    local = Window.partitionBy(*group_cols, "_tw_b").orderBy(*order_cols)
    numbered = d.withColumn("_tw_r", F.row_number().over(local))
    cond = [numbered[c].eqNullSafe(offsets[f"_tw_g_{i}"]) for i, c in enumerate(group_cols)]
    cond.append(numbered["_tw_b"].eqNullSafe(offsets["_tw_ob"]))  # NULL keys number first
    joined = numbered.join(offsets, cond, "inner")
    return (joined.withColumn(out, (F.col("_tw_off") + F.col("_tw_r")).cast("long"))
            .drop("_tw_b", "_tw_r", "_tw_off", "_tw_ob",
                  *[f"_tw_g_{i}" for i in range(len(group_cols))]))


def pieces(df: DataFrame, group_cols: Sequence[str], pos_col: str, size: int,
           out: str = "piece") -> DataFrame:
    """Piece number (0-based) for bounded-size folding: ``(pos - 1) // size``."""
    return df.withColumn(out, F.floor((F.col(pos_col) - 1) / F.lit(size)).cast("long"))
