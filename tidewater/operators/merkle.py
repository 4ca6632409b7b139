"""Locate damage between two copies of a table with trees of digests.

A row's place in the tree comes from the hash of its key, so both copies use the same
tree whatever their order or files.  A leaf's digest is the number of its rows and two
independent sums of row hashes; a node's is the sum of its children's.  The tree of a
table is built once, with one aggregation, and kept as a table with one row per node
that holds the digests of all its children, beside the keys and hashes of the rows, which
are stored by their place below the root.

Two trees are compared from the root down.  Of each level only the children of nodes
that differ are read, and row hashes only of leaves that differ, so after the trees are
built an altered row costs one node per level and one leaf, not another pass over the
tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUMS = ("n", "h1", "h2")
NODE = "node long, children array<struct<child: long, n: decimal(38,0), h1: decimal(38,0), h2: decimal(38,0)>>"


@dataclass(frozen=True)
class DigestTree:
    """Where a tree lies and its shape: ``fan`` children a node, ``depth`` levels below the root."""
    path: str
    keys: tuple[str, ...]
    key_types: tuple[str, ...]
    fan: int
    depth: int

    def rows(self, spark: SparkSession) -> DataFrame:
        keys = ", ".join(f"`{k}` {t}" for k, t in zip(self.keys, self.key_types))
        return spark.read.schema(f"{keys}, leaf long, h1 long, h2 long, top int").parquet(f"{self.path}/rows")

    def nodes(self, spark: SparkSession, level: int) -> DataFrame:
        return spark.read.schema(NODE).parquet(f"{self.path}/nodes/level={level}")


def _hash(cols: Sequence[str], seed: int) -> Column:
    """A hash in which a null is a value of its own."""
    parts = [c for name in cols for c in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(F.lit(seed), *parts)


def row_hashes(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fan: int, depth: int) -> DataFrame:
    """The keys, the leaf of each row (0 .. fan^depth - 1), and its two hashes."""
    leaf = F.pmod(_hash(keys, 0), F.lit(fan ** depth))
    return df.select(*keys, leaf.alias("leaf"), _hash(cols, 1).alias("h1"), _hash(cols, 2).alias("h2"))


def build_tree(df: DataFrame, keys: Sequence[str], path: str, cols: Sequence[str] | None = None, fan: int = 16, depth: int = 4) -> DigestTree:
    """Write the tree of ``df`` below ``path``: ``rows`` and ``nodes``."""
    spark = df.sparkSession
    tree = DigestTree(path, tuple(keys), tuple(df.schema[k].dataType.simpleString() for k in keys), fan, depth)
    rows = row_hashes(df, keys, cols or df.columns, fan, depth)
    (rows.withColumn("top", F.floor(F.col("leaf") / fan ** (depth - 1)).cast("int")).repartition("top", "leaf").sortWithinPartitions("leaf")
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("top").parquet(f"{path}/rows"))
    level = (tree.rows(spark).groupBy(F.col("leaf").alias("node"))
             .agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in SUMS[1:]]))
    for k in range(depth - 1, -1, -1):  # level k: nodes whose children are those of level k + 1
        child = F.struct(F.col("node").alias("child"), *SUMS)
        nodes = (level.groupBy(F.floor(F.col("node") / fan).alias("node"))
                 .agg(F.sort_array(F.collect_list(child)).alias("children"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in SUMS]))
        (nodes.select("node", "children").sortWithinPartitions("node").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{path}/nodes/level={k}"))
        level = tree.nodes(spark, k).select("node", *[_total("children", c) for c in SUMS])
    return tree


def _total(children: str, name: str) -> Column:
    zero = F.lit(0).cast("decimal(38,0)")
    return F.aggregate(children, zero, lambda total, child: (total + child[name]).cast("decimal(38,0)")).alias(name)


def _children(spark: SparkSession, tree: DigestTree, level: int, wanted: DataFrame | None) -> DataFrame:
    nodes = tree.nodes(spark, level)
    if wanted is not None:
        nodes = nodes.join(wanted, "node", "left_semi")
    return nodes.select(F.explode("children").alias("c")).select(F.col("c.child").alias("node"), F.struct(*[f"c.{s}" for s in SUMS]).alias("digest"))


def differing_nodes(spark: SparkSession, a: DigestTree, b: DigestTree) -> list[DataFrame]:
    """For each level below the root, the nodes whose digests differ (stored tables)."""
    from ..session import materialise
    if (a.keys, a.key_types, a.fan, a.depth) != (b.keys, b.key_types, b.fan, b.depth):
        raise ValueError("trees of different shape")
    found, wanted = [], None
    for level in range(a.depth):
        left = _children(spark, a, level, wanted).withColumnRenamed("digest", "_tw_a")
        right = _children(spark, b, level, wanted).withColumnRenamed("digest", "_tw_b")
        wanted = materialise(left.join(right, "node", "full_outer").filter(~F.col("_tw_a").eqNullSafe(F.col("_tw_b"))).select("node"), f"merkle_level_{level}")
        found.append(wanted)
    return found


def differing_keys(spark: SparkSession, a: DigestTree, b: DigestTree) -> DataFrame:
    """One row per key whose rows differ: the keys and ``status`` (left only, right only
    or changed).  Keys that repeat are compared as sets of rows."""
    keys = list(a.keys)
    leaves = differing_nodes(spark, a, b)[-1].withColumnRenamed("node", "leaf")
    leaves = leaves.withColumn("top", F.floor(F.col("leaf") / a.fan ** (a.depth - 1)).cast("int"))

    def side(tree, name):
        rows = tree.rows(spark).join(leaves, ["top", "leaf"], "left_semi")
        hashes = F.sort_array(F.collect_list(F.struct("h1", "h2")))
        return rows.groupBy(*keys).agg(hashes.alias(name)).select(*[F.col(k).alias(f"{name}_{n}") for n, k in enumerate(keys)], name)

    left, right = side(a, "_tw_a"), side(b, "_tw_b")
    same = [left[f"_tw_a_{n}"].eqNullSafe(right[f"_tw_b_{n}"]) for n in range(len(keys))]
    both = left.join(right, same, "full_outer").filter(~F.col("_tw_a").eqNullSafe(F.col("_tw_b")))
    status = F.when(F.col("_tw_b").isNull(), "left only").when(F.col("_tw_a").isNull(), "right only").otherwise("changed")
    pick = [F.when(F.col("_tw_a").isNull(), F.col(f"_tw_b_{n}")).otherwise(F.col(f"_tw_a_{n}")).alias(k) for n, k in enumerate(keys)]
    return both.select(*pick, status.alias("status"))
