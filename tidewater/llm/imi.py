"""Approximate nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in two halves, and each half is quantised by a codebook of its own
(k-means on a bounded sample), whose size grows with the number of rows, so that a cell
of the index, a pair of centroids, holds about ``cell_rows`` of them.  A query walks
pairs of centroids in the order of their summed inner products, with a heap over the two
sorted lists.  A cell is left out when its bound, the centroids' product plus the
lengths of the halves times the greatest distances of its rows from the centroids,
is below the k-th best product among the sample, which the k-th best of all rows cannot
be; the walk ends when the cells seen hold ``visit`` of all entries (and at least
``k``).  All entries of these cells are ranked by the exact product.

Every row is indexed.  Entries are grouped by the first half's centroid, large groups
are split into blocks, and each block is held once, in one task, through which the
queries that visit it stream in batches; each block gives its best ``k`` for a query.

Defined results: vectors that are null, empty, zero, of another length than the
commonest (ties: the shorter), or that hold null or non-finite components take no part,
nor do rows without an id; rows that repeat a vec_id are separate rows, and a query
meets all but its own row; ties go to the smaller vec_id; fewer candidates than ``k``
are all returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors
from .common import stored

RESULT = "query_row long, query_id long, row long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, vec array<double>), stored: the rows that take part, each with a number of its own."""
    kept = anchors.usable(vectors.withColumn("__id", F.col(id_col).cast("long")).filter("__id is not null"), vector_col, vec_id="__id")
    return stored(kept.filter(F.exists("vec", lambda x: x != 0)).withColumn("row", F.monotonically_increasing_id()), "imi_rows")


def kmeans(rows: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    g = np.random.default_rng(seed)
    start = np.unique(rows, axis=0)
    centres = start[g.permutation(len(start))[:k]].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)
        count = np.bincount(near, minlength=len(centres))
        total = np.stack([np.bincount(near, rows[:, d], minlength=len(centres)) for d in range(rows.shape[1])], axis=1)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)


class MultiIndex:
    """Two codebooks, the number of entries in each cell, how far they lie from its
    centroids at most, and the sample: sizes set by parameters."""

    def __init__(self, first: np.ndarray, second: np.ndarray, sample: np.ndarray):
        self.books, self.sample = (first, second), sample
        self.dim = first.shape[1] + second.shape[1]
        self.counts = np.zeros((len(first), len(second)), np.int64)
        self.far = np.zeros((2, len(first), len(second)))

    def halves(self, rows):
        cut = self.books[0].shape[1]
        return rows[:, :cut], rows[:, cut:]

    def cells(self, rows: np.ndarray):
        """Both centroids of each row, and its distances from them."""
        out = []
        for half, book in zip(self.halves(rows), self.books):
            near = nearest(half, book)
            out += [near, np.sqrt(((half - book[near]) ** 2).sum(1))]
        return out

    def least(self, queries: np.ndarray, k: int) -> np.ndarray:
        """A product that the k-th best of each query cannot be below: one more is taken, as
        the sample may hold the query itself."""
        if len(self.sample) <= k:
            return np.full(len(queries), -np.inf)
        near = queries @ self.sample.T
        return np.partition(near, near.shape[1] - k - 1, axis=1)[:, near.shape[1] - k - 1]

    def walk(self, query: np.ndarray, enough: int, least: float) -> np.ndarray:
        """Cells (as first * size + second) by falling summed product, until they hold ``enough`` entries."""
        a, b = self.halves(query[None])
        sa, sb = (a @ self.books[0].T)[0], (b @ self.books[1].T)[0]
        reach = sa[:, None] + sb[None] + np.sqrt((a * a).sum()) * self.far[0] + np.sqrt((b * b).sum()) * self.far[1]
        wanted = (self.counts > 0) & (reach >= least - 1e-9 * (abs(least) + 1) if np.isfinite(least) else True)
        left = int(self.counts[wanted].sum())
        oa, ob = np.argsort(-sa, kind="stable"), np.argsort(-sb, kind="stable")
        heap, out, seen = [(-(sa[oa[0]] + sb[ob[0]]), 0, 0)], [], 0
        while heap and seen < min(enough, left):
            _, i, j = heapq.heappop(heap)
            if wanted[oa[i], ob[j]]:
                out.append(oa[i] * len(ob) + ob[j])
                seen += self.counts[oa[i], ob[j]]
            if j + 1 < len(ob):
                heapq.heappush(heap, (-(sa[oa[i]] + sb[ob[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(oa):
                heapq.heappush(heap, (-(sa[oa[i + 1]] + sb[ob[0]]), i + 1, 0))
        return np.array(out, np.int64)


def build(entries: DataFrame, centroids: int | None = None, sample_rows: int = 20_000, cell_rows: int = 50,
          most_centroids: int = 512) -> tuple[MultiIndex | None, DataFrame]:
    """Codebooks from ``sample_rows`` rows at most (smallest hash of the row's id), and
    every entry with its cell (columns row, vec_id, vec, c1, c2), stored."""
    total = entries.count()
    if total == 0:
        return None, entries
    centroids = centroids or min(most_centroids, max(32, math.ceil(math.sqrt(total / cell_rows))))
    order = F.xxhash64("vec_id", "vec")
    sample = anchors.matrix(entries.select("vec_id", "vec").orderBy(order, "vec_id").limit(sample_rows).toArrow()["vec"],
                            entries.select(F.size("vec")).first()[0])
    dim = sample.shape[1]
    cut = max(1, dim // 2)
    second = sample[:, cut:] if dim > 1 else np.zeros((1, 0))
    index = MultiIndex(kmeans(sample[:, :cut], centroids), kmeans(second, centroids) if dim > 1 else second, sample)
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def assign(batches):
        ix = shared.value
        for batch in batches:
            if len(batch):
                c1, d1, c2, d2 = ix.cells(anchors.matrix(batch.column("vec"), ix.dim))
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in ("row", "vec_id", "vec")] + [pa.array(c1, pa.int32()), pa.array(c2, pa.int32()),
                                                 pa.array(d1), pa.array(d2)], ["row", "vec_id", "vec", "c1", "c2", "d1", "d2"])

    cells = stored(entries.select("row", "vec_id", "vec").mapInArrow(
        assign, "row long, vec_id long, vec array<double>, c1 int, c2 int, d1 double, d2 double"), "imi_entries")
    for r in cells.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).collect():
        index.counts[r["c1"], r["c2"]] = r["n"]  # at most most_centroids squared rows
        index.far[:, r["c1"], r["c2"]] = r["d1"], r["d2"]
    return index, cells


def search(entries: DataFrame, is_query, k: int = 20, visit: float = 0.6, centroids: int | None = None, sample_rows: int = 20_000,
           block_entries: int = 1 << 16, batch_queries: int = 128) -> DataFrame:
    """The ``k`` best entries found for each entry for which ``is_query`` holds, the
    query's own row aside: query_id, rank (from 1), vec_id, score.  ``entries`` as from ``usable``."""
    spark = entries.sparkSession
    index, cells = build(entries, centroids, sample_rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    enough = max(k + 1, math.ceil(visit * int(index.counts.sum())))
    width = index.counts.shape[1]
    blocks = np.maximum(1, -(-index.counts.sum(1) // block_entries))  # entry blocks of each first centroid
    shared = spark.sparkContext.broadcast(index)

    def route(batches):
        """A row for each query and each first centroid it visits, with the second centroids it visits there."""
        ix = shared.value
        for batch in batches:
            rows, vecs = batch.column("row").to_numpy(), anchors.matrix(batch.column("vec"), ix.dim)
            ids = batch.column("vec_id").to_numpy()
            for at in range(0, len(ids), 256):
                out, least = [], ix.least(vecs[at:at + 256], k)
                for n, q in enumerate(range(at, min(at + 256, len(ids)))):
                    got = ix.walk(vecs[q], enough, least[n])
                    for c1 in np.unique(got // width):
                        out.append((int(rows[q]), int(ids[q]), vecs[q], int(c1), np.sort(got[got // width == c1] % width)))
                if out:
                    row, q, v, c1, c2 = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(q, pa.int64()), pa.array(v, pa.list_(pa.float64())),
                                                      pa.array(c1, pa.int32()), pa.array(c2, pa.list_(pa.int32()))], ["row", "id", "vec", "c1", "c2"])

    split = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("c1") + 1)
    asked = cells.filter(is_query).select("row", "vec_id", "vec")
    queries = asked.repartition(max(spark.sparkContext.defaultParallelism, asked.count() // 4096), "row")
    routed = (queries.mapInArrow(route, "row long, id long, vec array<double>, c1 int, c2 array<int>")
              .withColumn("eb", F.explode(F.sequence(F.lit(0), split - 1))).withColumn("kind", F.lit(1)))
    held = cells.select("row", F.col("vec_id").alias("id"), "vec", "c1", F.array("c2").alias("c2"),
                        F.pmod(F.xxhash64("row"), split).cast("int").alias("eb"), F.lit(0).alias("kind"))
    dealt = held.unionByName(routed).repartition(int(blocks.sum()), "c1", "eb").sortWithinPartitions("c1", "eb", "kind")

    def rank(batches):
        dim = shared.value.dim
        block, waiting, entry = None, [], None
        for batch in batches:
            key = np.stack([batch.column(n).to_numpy() for n in ("c1", "eb", "kind")])
            cuts = np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if tuple(key[:2, a]) != block:
                    block, waiting, entry = tuple(key[:2, a]), [], None
                if key[2, a] == 0:
                    waiting.append([part.column(n).to_numpy() for n in ("row", "id")] + [anchors.matrix(part.column("vec"), dim), np.asarray(part.column("c2").flatten())])
                    continue
                if entry is None:
                    entry = [np.concatenate(x) for x in zip(*waiting)] if waiting else None
                    waiting = []
                if entry is not None:
                    for at in range(0, len(part), batch_queries):
                        yield best(part.slice(at, batch_queries), entry, dim)

    def best(part, entry, dim):
        rows, ids, vecs, cell = entry
        q_rows, q_ids, q = part.column("row").to_numpy(), part.column("id").to_numpy(), anchors.matrix(part.column("vec"), dim)
        allowed = np.zeros((len(q), width), bool)
        for n, c2 in enumerate(part.column("c2").to_pylist()):
            allowed[n, c2] = True
        near = q @ vecs.T
        near[~allowed[:, cell]] = -np.inf
        near[q_rows[:, None] == rows[None, :]] = -np.inf
        found = []
        for n in range(len(q)):
            s = near[n]
            kth = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
            pick = np.flatnonzero((s >= kth - 1e-9 * max(1.0, abs(kth))) & (s > -np.inf) if kth > -np.inf else s > -np.inf)
            exact = (vecs[pick] * q[n]).sum(1)  # the same sum for equal vectors, wherever they stand
            first = np.lexsort((rows[pick], ids[pick], -exact))[:k]
            found.append((np.full(len(first), q_rows[n]), np.full(len(first), q_ids[n]), rows[pick][first], ids[pick][first], exact[first]))
        flat = [np.concatenate(x) for x in zip(*found)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in flat[:4]] + [pa.array(flat[4], pa.float64())],
                                          ["query_row", "query_id", "row", "vec_id", "score"])

    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (dealt.mapInArrow(rank, RESULT).withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
