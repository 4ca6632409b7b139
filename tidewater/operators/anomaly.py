"""Isolation forest (F10; Liu, Ting & Zhou 2008) on Spark.

Fit: every row joins tree ``t`` when a hash of (key, t, seed) falls under a
small fraction, so each tree gets a bounded, repeatable sample whatever the
partitioning; the ``sample`` rows with the smallest hashes are kept per tree
and each tree is grown in one ``applyInPandas`` group (bounded by the sample
size).  The forest is a small node table (trees x <= 2*sample rows).
Score: the node table is broadcast and ``mapInPandas`` walks all trees over
Arrow batches: score = 2 ** (-E[path length] / c(sample)).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NODE_SCHEMA = ("tree_id long, node_id long, feature int, threshold double, left long, right long, "
               "size long, depth int")
EULER = 0.5772156649015329


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def isolation_forest_fit(df: DataFrame, cols: Sequence[str], key: str, trees: int = 100,
                         sample: int = 256, seed: int = 42, oversample: float = 3.0) -> DataFrame:
    cols = list(cols)
    n = df.count()
    if n == 0:
        return df.sparkSession.createDataFrame([], NODE_SCHEMA)
    frac = min(1.0, oversample * sample / n)
    scale = 1 << 30
    h = lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(scale))
    picked = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).withColumn(
        "tree_id", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                                      lambda t: h(t) < F.lit(int(frac * scale)))))
    picked = picked.withColumn("_tw_h", F.xxhash64(F.col(key), F.col("tree_id"), F.lit(seed)))
    w = Window.partitionBy("tree_id").orderBy("_tw_h", key)
    sampled = picked.withColumn("_tw_r", F.row_number().over(w)).filter(F.col("_tw_r") <= sample)
    height_limit = max(1, math.ceil(math.log2(max(sample, 2))))

    def grow(pdf):
        import numpy as np
        import pandas as pd
        tree_id = int(pdf["tree_id"].iloc[0])
        x = pdf[cols].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree_id])
        nodes = []

        def build(idx, depth):
            node_id = len(nodes)
            nodes.append(None)
            sub = x[idx]
            if depth >= height_limit or len(idx) <= 1:
                nodes[node_id] = (tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth)
                return node_id
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            spread = np.flatnonzero(hi > lo)
            if len(spread) == 0:
                nodes[node_id] = (tree_id, node_id, -1, 0.0, -1, -1, len(idx), depth)
                return node_id
            f = int(rng.choice(spread))
            thr = float(rng.uniform(lo[f], hi[f]))
            left_idx, right_idx = idx[sub[:, f] < thr], idx[sub[:, f] >= thr]
            left = build(left_idx, depth + 1)
            right = build(right_idx, depth + 1)
            nodes[node_id] = (tree_id, node_id, f, thr, left, right, len(idx), depth)
            return node_id
        build(np.arange(len(x)), 0)
        return pd.DataFrame(nodes, columns=["tree_id", "node_id", "feature", "threshold", "left", "right",
                                            "size", "depth"])
    return sampled.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


def isolation_forest_score(df: DataFrame, forest: DataFrame, cols: Sequence[str], key: str,
                           sample: int = 256, out: str = "anomaly_score") -> DataFrame:
    """``out`` per key.  The forest's size is set by the fit's parameters, at most
    ``trees * (2 * sample - 1)`` rows, and does not grow with the data."""
    import numpy as np
    cols = list(cols)
    spark = df.sparkSession
    nodes = forest.toPandas()
    trees = []
    for _, g in nodes.groupby("tree_id"):
        g = g.sort_values("node_id")
        trees.append(tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size", "depth")))
    bc = spark.sparkContext.broadcast(trees)
    cn = c_factor(sample)
    key_type = dict(df.dtypes)[key]

    def score(batches):
        import pandas as pd
        forest_ = bc.value
        cf = np.vectorize(c_factor, otypes=[float])
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype="float64")
            total = np.zeros(len(x))
            for feat, thr, left, right, size, depth in forest_:
                node = np.zeros(len(x), dtype="int64")
                active = feat[node] >= 0
                while active.any():
                    f = feat[node[active]]
                    go_left = x[np.flatnonzero(active), f] < thr[node[active]]
                    node[active] = np.where(go_left, left[node[active]], right[node[active]])
                    active = feat[node] >= 0
                total += depth[node] + cf(size[node])
            mean_path = total / max(len(forest_), 1)
            s = np.power(2.0, -mean_path / cn) if cn > 0 else np.full(len(x), 0.5)
            yield pd.DataFrame({key: pdf[key], out: s})
    return df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).mapInPandas(
        score, f"{key} {key_type}, {out} double")
