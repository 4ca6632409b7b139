"""Reconciliation and data-quality checks (Q6-Q12, Q14, Q15).

Every check is a handful of aggregates or a join; results are DataFrames so a
check over 100 TB never materialises rows on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import path_part, row_key_col
from .relational import duplicate_rows, labelled_union, row_hash_col, subset_missing


def row_count_check(src: DataFrame, dst: DataFrame) -> DataFrame:
    """Q6: both counts and whether they agree, as one row: one union, one global
    aggregate (no join between the two counts)."""
    u = (src.select(F.lit(1).alias("_tw_s"), F.lit(0).alias("_tw_d"))
         .unionByName(dst.select(F.lit(0).alias("_tw_s"), F.lit(1).alias("_tw_d"))))
    c = u.agg(F.sum("_tw_s").cast("long").alias("src_count"), F.sum("_tw_d").cast("long").alias("dst_count"))
    c = c.select(F.coalesce("src_count", F.lit(0)).alias("src_count"),
                 F.coalesce("dst_count", F.lit(0)).alias("dst_count"))
    return c.withColumn("counts_match", F.col("src_count") == F.col("dst_count"))


def checksum_check(src: DataFrame, dst: DataFrame, cols: Sequence[str], bucket: Column | None = None
                   ) -> DataFrame:
    """Q7: order-free checksum and count per key bucket on both sides, full-joined,
    so a mismatch points at the damaged bucket.  ``bucket=None`` gives one row."""
    b = bucket if bucket is not None else F.lit(0)

    def side(df, p):
        return df.groupBy(b.alias("bucket")).agg(
            F.count(F.lit(1)).alias(f"{p}_count"), F.sum(row_hash_col(cols).cast("decimal(38,0)")).alias(f"{p}_checksum"))
    j = side(src, "src").join(side(dst, "dst"), "bucket", "full_outer")
    return j.withColumn("bucket_match", F.coalesce(
        (F.col("src_count") == F.col("dst_count")) & (F.col("src_checksum") == F.col("dst_checksum")),
        F.lit(False)))


def compare_keys(left: DataFrame, right: DataFrame, cols: Sequence[str],
                 left_label: str = "Sheet only", right_label: str = "DB only", sep: str = "\x1f") -> DataFrame:
    """Q8: row keys (P10) present on one side only, labelled; a single
    ``All rows match`` row when there is no difference.  Key parts are separated by
    ``sep``, so ('ab', 'c') and ('a', 'bc') differ; ``sep=""`` gives the plain concatenation.

    Both sides are read once, by one aggregation over their union; the differences are
    written, and the "no difference" row is decided inside the plan from their count."""
    from ..session import materialise
    sides = (left.select(row_key_col(cols, sep).alias("Concatenated"), F.lit(True).alias("_tw_l"))
             .unionAll(right.select(row_key_col(cols, sep).alias("Concatenated"), F.lit(False).alias("_tw_l"))))
    both = sides.groupBy("Concatenated").agg(F.bool_or("_tw_l").alias("_tw_any_l"), F.bool_and("_tw_l").alias("_tw_all_l"))
    only = both.filter(F.col("_tw_any_l") == F.col("_tw_all_l"))
    diff = materialise(only.select(F.when(F.col("_tw_all_l"), left_label).otherwise(right_label).alias("Source"), "Concatenated"), "key_differences")
    ok = (diff.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 0)
          .select(F.lit("All rows match").alias("Source"),
                  F.lit(None).cast("string").alias("Concatenated")))
    return diff.unionByName(ok)


def find_duplicates(sides: dict[str, DataFrame], key: str, id_col: str) -> DataFrame:
    """Q9: on each side, every row whose key value is repeated (side, id, key, copies);
    grouping runs on a digest of the key (see ``relational.duplicate_rows``)."""
    out = None
    for label, df in sides.items():
        part = (duplicate_rows(df.select(F.col(id_col).alias("row_id"), key), [key])
                .withColumn("side", F.lit(label)))
        out = part if out is None else out.unionByName(part)
    return out


def check_ranges(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q10: rows violating each rule (rule -> violation condition), one aggregation,
    long form (rule, n_violations)."""
    wide = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(rules.values())])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"),
                                        F.col(f"r{i}").cast("long").alias("n_violations"))
                               for i, name in enumerate(rules)]))
    return wide.select(rows.alias("_s")).select("_s.*")


def check_references(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
                     ) -> DataFrame:
    """Q11: distinct child keys with no parent row (orphans)."""
    return (child.select(child_key).filter(F.col(child_key).isNotNull()).distinct()
            .join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"))


def check_calculations(df: DataFrame, stored: str, recomputed: Column, tol: float = 0.01,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Q12: rows whose stored value differs from the recomputed value by more than ``tol``."""
    return (df.select(*keep, F.col(stored).alias("stored"), recomputed.alias("recomputed"))
            .filter(F.abs(F.col("stored") - F.col("recomputed")) > F.lit(tol)))


def layout_check(listing: DataFrame, expected: DataFrame, path_col: str = "path",
                 level: int = 1, prefix_col: str = "prefix") -> DataFrame:
    """Q14: expected prefixes at ``level`` (1 = top-level folder) missing from the
    listing; empty means the layout is complete."""
    found = listing.select(path_part(F.ltrim(F.col(path_col)), level).alias(prefix_col))
    return subset_missing(expected, found.filter(F.col(prefix_col).isNotNull()), prefix_col)


def prefix_rows(paths: DataFrame, path_col: str, depth: int) -> DataFrame:
    """Every prefix of the paths up to ``depth`` parts, once: one pass with a roll-up over
    the parts.  A path shorter than a level has no prefix there."""
    parts = F.split(F.ltrim(F.col(path_col)), "/")
    part = [F.when(F.try_element_at(parts, F.lit(n + 1)) != "", F.try_element_at(parts, F.lit(n + 1))).alias(f"p{n}") for n in range(depth)]
    rolled = paths.filter(F.col(path_col).isNotNull()).select(*part).rollup(*[f"p{n}" for n in range(depth)]).agg(F.grouping_id().alias("_tw_g"))
    # grouping_id has a set bit for each part that is rolled up: 2^k - 1 when the last k are
    level = F.lit(depth) - F.log2(F.col("_tw_g") + 1).cast("int")
    held = rolled.withColumn("level", level).withColumn("_tw_parts", F.slice(F.array(*[f"p{n}" for n in range(depth)]), F.lit(1), F.col("level")))
    whole = held.filter((F.col("level") > 0) & ~F.exists("_tw_parts", lambda x: x.isNull()))
    return whole.select("level", F.array_join("_tw_parts", "/").alias("prefix"))


def layout_tree_check(listing: DataFrame, expected: DataFrame, path_col: str = "path", prefix_col: str = "prefix") -> DataFrame:
    """Q14 for folders of any depth: (prefix, level, n_expected), the missing branches of
    the listing, each cut at its highest missing folder, with the number of expected
    folders that are missing in it.  Empty means that the layout is complete."""
    wanted = expected.select(F.rtrim(F.ltrim(F.col(prefix_col)), F.lit("/")).alias("leaf")).filter("leaf <> ''").distinct()
    wanted = wanted.withColumn("parts", F.split("leaf", "/"))
    depth = wanted.agg(F.max(F.size("parts"))).first()[0]
    if depth is None:
        return wanted.select(F.col("leaf").alias("prefix"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("n_expected"))
    found = prefix_rows(listing, path_col, depth).select("prefix")
    above = wanted.select("leaf", "parts", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("level"))
    above = above.select("leaf", "level", F.array_join(F.slice("parts", F.lit(1), F.col("level")), "/").alias("prefix"))
    missing = above.join(found, "prefix", "left_anti").groupBy("leaf").agg(F.min(F.struct("level", "prefix")).alias("top"))
    return missing.groupBy("top.prefix", "top.level").agg(F.count(F.lit(1)).alias("n_expected")).select("prefix", "level", "n_expected")


def first_failure(checks: DataFrame, order_col: str = "check_order", passed_col: str = "passed",
                  message_col: str = "message", success: str = "success") -> DataFrame:
    """Q15: the message of the first failing check in order, else ``success``."""
    failed = F.when(~F.col(passed_col), F.struct(F.col(order_col), F.col(message_col)))
    first = F.min(failed)
    return checks.agg(F.coalesce(first[message_col], F.lit(success)).alias("result"),
                      F.count_if(~F.col(passed_col)).alias("n_failed"))
