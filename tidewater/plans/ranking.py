"""Exact positions by splitters, for any order columns and any distribution.

``row_number`` over a whole table, or over a group that holds a third of it, is one task.
Here rows are dealt into ranges of all order columns, whose bounds Spark takes from a
sample of the rows, so neither an outlier nor a value that most rows share puts many rows
into one range as long as the order columns tell the rows apart.  Each range is sorted
and numbered by itself and written; the number of rows of each range, a table of one row
a range, gives the offset of the next.  Positions are stable: they are read from the
written table, not computed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOCAL_BITS = 33  # of monotonically_increasing_id: partition above, row in the partition below


def rank_rows(df: DataFrame, order_cols: Sequence[str], out: str = "pos") -> DataFrame:
    """Add ``out``: the 1-based position of each row by ``order_cols`` (ascending, nulls
    first).  Rows equal in all of them get consecutive positions in some order."""
    from ..session import materialise
    order = [F.col(c) for c in order_cols]
    numbered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_tw_id", F.monotonically_increasing_id()))
    rows = materialise(numbered, "ranked").withColumn("_tw_part", F.shiftright("_tw_id", LOCAL_BITS))
    sizes = rows.groupBy("_tw_part").agg(F.count(F.lit(1)).alias("_tw_n"))
    before = Window.orderBy("_tw_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select("_tw_part", F.coalesce(F.sum("_tw_n").over(before), F.lit(0)).alias("_tw_off"))
    local = F.col("_tw_id").bitwiseAND((1 << LOCAL_BITS) - 1)
    return (rows.join(F.broadcast(offsets), "_tw_part").withColumn(out, (F.col("_tw_off") + local + 1).cast("long"))
            .drop("_tw_id", "_tw_part", "_tw_off"))


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out: str = "pos") -> DataFrame:
    """Add ``out``: the 1-based position of each row inside its group (null groups are
    groups) by ``order_cols``."""
    if not group_cols:
        return rank_rows(df, order_cols, out)
    ranked = rank_rows(df, [*group_cols, *order_cols], "_tw_rank")
    keys = {c: f"_tw_first_{n}" for n, c in enumerate(group_cols)}
    first = ranked.groupBy(*group_cols).agg(F.min("_tw_rank").alias("_tw_first")).withColumnsRenamed(keys)
    joined = ranked.join(first, [ranked[c].eqNullSafe(first[k]) for c, k in keys.items()])
    return joined.withColumn(out, F.col("_tw_rank") - F.col("_tw_first") + 1).drop("_tw_rank", "_tw_first", *keys.values())
