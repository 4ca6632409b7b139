"""Point-in-interval joins without a nested loop.

Each interval ``[lo, hi)`` of whole numbers is cut into dyadic blocks: block ``i`` of
level ``k`` holds the positions ``i * 2^k .. (i + 1) * 2^k - 1``.  The largest blocks
that fit number at most two a level, so an interval of ``n`` positions gives at most
2 * log2(n) rows, however long it is.  A point lies in one block of each level; it is
given the levels that occur among the intervals (64 at most), and the join is an
equi-join on (scope, level, block) that needs no further test.  Neither side is broadcast
by this code, and the rows of neither grow with the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 62

# l = ceil(lo / 2^k) and r = floor(hi / 2^k) are the ends of what is left at level k; an
# odd end is cut off as a block of that level.
_COVER = f"""filter(flatten(transform(sequence(0, {LEVELS}), k -> transform(
    array(struct(-shiftright(-_tw_lo, k) AS l, shiftright(_tw_hi, k) AS r)),
    e -> struct(k AS level, CASE WHEN e.l < e.r AND pmod(e.l, 2) = 1 THEN e.l END AS first,
                CASE WHEN e.l < e.r AND pmod(e.r, 2) = 1 THEN e.r - 1 END AS last)))),
    b -> b.first IS NOT NULL OR b.last IS NOT NULL)"""


def dyadic_cover(intervals: DataFrame, lo: str, hi: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., level, block): the blocks that make up each interval ``[lo, hi)``, each
    once an interval.  Null or empty intervals give no rows."""
    iv = intervals.select(*keep, F.col(lo).cast("long").alias("_tw_lo"), F.col(hi).cast("long").alias("_tw_hi")).filter("_tw_lo < _tw_hi")
    cut = iv.select(*keep, F.explode(F.expr(_COVER)).alias("_tw_b"))
    ends = F.array_compact(F.array("_tw_b.first", "_tw_b.last"))
    return cut.select(*keep, F.col("_tw_b.level").alias("level"), F.explode(ends).alias("block"))


def _blocks(intervals: DataFrame, lo: str, hi: str, scope: Sequence[str]):
    """The blocks of the intervals of each scope, and the levels that occur."""
    named = intervals.select(*[F.col(c).alias(f"_tw_s_{i}") for i, c in enumerate(scope)], F.col(lo).alias("_tw_from"), F.col(hi).alias("_tw_to"))
    blocks = dyadic_cover(named, "_tw_from", "_tw_to", [f"_tw_s_{i}" for i in range(len(scope))]).distinct()
    return blocks, sorted(r["level"] for r in blocks.select("level").distinct().collect())  # 63 at most


def range_semi_join(points: DataFrame, intervals: DataFrame, point_col: str, lo: str, hi: str,
                    scope: Sequence[str] = ()) -> DataFrame:
    """Rows of ``points`` whose ``point_col`` lies in some interval ``[lo, hi)`` of the same
    scope.  Null scopes match each other; a null point lies in no interval."""
    return _matched(points, intervals, point_col, lo, hi, scope, True)


def range_anti_join(points: DataFrame, intervals: DataFrame, point_col: str, lo: str, hi: str,
                    scope: Sequence[str] = ()) -> DataFrame:
    """Rows of ``points`` whose ``point_col`` lies in no interval ``[lo, hi)`` of the same scope."""
    return _matched(points, intervals, point_col, lo, hi, scope, False)


def _matched(points, intervals, point_col, lo, hi, scope, inside: bool) -> DataFrame:
    """The distinct (scope, point) pairs are matched, block by block, and joined back; a
    pair lies in one block of a level, so no pair is matched with all its intervals."""
    blocks, levels = _blocks(intervals, lo, hi, scope)
    if not levels:
        return points.filter("false") if inside else points
    spots = points.select(*[F.col(c).alias(f"_tw_p_{i}") for i, c in enumerate(scope)], F.col(point_col).alias("_tw_point")).distinct()
    spread = spots.filter("_tw_point is not null").withColumn("_tw_at", F.explode(places_of(levels)))
    cond = [spread["_tw_at"]["level"] == blocks["level"], spread["_tw_at"]["block"] == blocks["block"]]
    cond += [spread[f"_tw_p_{i}"].eqNullSafe(blocks[f"_tw_s_{i}"]) for i in range(len(scope))]
    hit = spread.join(blocks, cond, "left_semi").drop("_tw_at").distinct()
    match = [points[point_col] == hit["_tw_point"]] + [points[c].eqNullSafe(hit[f"_tw_p_{i}"]) for i, c in enumerate(scope)]
    return points.join(hit, match, "left_semi" if inside else "left_anti")


def places_of(levels: Sequence[int]):
    """The block of ``_tw_point`` at each of the levels."""
    at = F.col("_tw_point").cast("long")
    return F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(at, k).alias("block")) for k in levels])
