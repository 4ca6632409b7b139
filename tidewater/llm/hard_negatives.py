"""Hard negatives by inner product, mined from cover trees over norm-augmented vectors.

Rows are dealt into groups and cut into blocks; over each block's vectors, with one
component more that brings all to the length of the longest, a cover tree is built:
the children of a ball are points of it further apart than a part of its radius, each
with the points nearest to it, and every ball keeps the radius that covers its points.
On that sphere the inner product with a query falls with the distance, so centre and
radius bound the products of a whole ball from above and below.

A search goes down from the ball with the highest bound.  A ball is skipped when its
bound is less than the worst of the results kept so far, when it lies outside all
windows of scores asked for, or when none of its labels counts; points of a leaf are
verified with exact integer products.  Queries are copied once to each group of
blocks and stream through it, so a task holds the trees of one group and one batch of
queries, whatever the number of rows or queries.

Defined results: rows with a null id, a null label, a null or empty vector, null or
non-finite components, or a vector of another length than the commonest (ties: the
shorter) take no part; integers are moved into the range whose products are exact in
double precision (for 64 components 2^23, that is components of 46 000 at a scale of
256); rows that repeat an id are separate rows, and only an anchor's own row is not one
of its "other rows"; ties go to the smaller id; fewer rows than asked for are all
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anchors import integers, matrix, usable
from .common import stored

#: A query: its row and id, its label, its vector, and the windows of scores [least, most], each with a key.
QUERY = "kind int, row long, id long, label string, vec array<int>, key array<long>, least array<long>, most array<long>"
BLOCK = "labels array<string>, ids array<long>, rows array<long>, label array<int>, points array<int>, balls array<double>"
FOUND = "row long, id long, key long, most long, found_row long, found_id long, score long"
#: Columns of a ball: centre (a point), points from and to, first child and number of children, least and greatest label, radius.
CENTRE, BEGIN, END, CHILD, CHILDREN, LOW, HIGH, RADIUS = range(8)


def cover_tree(points: np.ndarray, label: np.ndarray, shrink: float = 0.6, leaf: int = 64, fan: int = 64):
    """Order of the points, balls in the order of their level, and the square of the
    common length.  A ball whose points would need more than ``fan`` children is a leaf."""
    norm = (points * points).sum(1)
    length = float(norm.max())
    flat = np.concatenate([points, np.sqrt(length - norm)[:, None]], axis=1)
    order, balls, level = np.arange(len(points)), [], [(0, 0, len(points))]
    while level:  # (centre's place, from, to) of the balls of this level; children are put behind them
        below, first = [], len(balls) + len(level)
        for centre, a, b in level:
            rows = order[a:b]
            to_centre = np.sqrt(((flat[rows] - flat[order[centre]]) ** 2).sum(1))
            radius, groups = to_centre.max(), None
            if b - a > leaf and radius > 0:
                groups = _children(flat, rows, order[centre], to_centre, shrink * radius, fan)
            entry = [order[centre], a, b, first + len(below), 0, label[rows].min(), label[rows].max(), radius]
            if groups is not None:
                at = a
                for middle, members in groups:
                    order[at:at + len(members)] = members
                    below.append((at + int(np.flatnonzero(members == middle)[0]), at, at + len(members)))
                    at += len(members)
                entry[CHILDREN] = len(groups)
            balls.append(entry)
        level = below
    balls = np.array(balls, np.float64).reshape(-1, 8)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    balls[:, CENTRE] = place[balls[:, CENTRE].astype(np.int64)]
    return order, balls, length


def _children(flat, rows, centre, to_centre, radius, fan):
    """(centre, rows) of children whose centres are more than ``radius`` apart, or None
    when more than ``fan`` would be needed."""
    centres, near, owner = [centre], to_centre.copy(), np.zeros(len(rows), np.int64)
    while near.max() > radius:
        if len(centres) == fan:
            return None
        new = rows[near.argmax()]
        d = np.sqrt(((flat[rows] - flat[new]) ** 2).sum(1))
        won = d < near
        near[won], owner[won] = d[won], len(centres)
        centres.append(new)
    return [(c, rows[owner == k]) for k, c in enumerate(centres)]


def bounds(flat_centres: np.ndarray, radius: np.ndarray, length: float, queries: np.ndarray):
    """Least and greatest inner product of each query (row) with the points of each ball (column)."""
    norm = (queries * queries).sum(1)[:, None]
    apart = np.sqrt(np.maximum(norm + length - 2 * queries @ flat_centres.T, 0))
    slack = 1e-9 * (norm + length) + 1e-6
    top = (norm + length - np.maximum(apart - radius, 0) ** 2) / 2 + slack
    low = (norm + length - (apart + radius) ** 2) / 2 - slack
    return low, top


class Block:
    """A block's rows in the order of its tree, and the tree."""

    def __init__(self, labels, ids, rows, label, points, balls):
        self.code = {x: k for k, x in enumerate(labels)}
        self.ids, self.rows, self.label = ids, rows, label
        self.points = points.astype(np.float64)
        self.balls, self.length = balls[:-1].reshape(-1, 8), balls[-1]
        self.spans = self.balls[:, BEGIN:CHILDREN + 1].astype(np.int64).tolist()

    def search(self, rows, labels, vecs, windows, same: bool, k: int):
        """For query ``n`` and each window (least, most) of ``windows[n]``, the rows of the
        same label, or of other labels, with the ``k`` highest scores in it: yields
        (query, window, places, scores)."""
        centres = self.points[self.balls[:, CENTRE].astype(np.int64)]
        low, top = bounds(centres, self.balls[:, RADIUS], self.length, vecs)
        least_label, most_label = self.balls[:, LOW], self.balls[:, HIGH]
        for n, vec in enumerate(vecs):
            code = self.code.get(labels[n], -1)
            if same and code < 0:
                continue
            dead = (least_label > code) | (most_label < code) if same else (least_label == code) & (most_label == code)
            floors, ceils = [w[0] for w in windows[n]], [w[1] for w in windows[n]]
            best = [(np.empty(0, np.int64), np.empty(0)) for _ in floors]
            heap = [(-top[n, 0], 0)]
            while heap:
                bound, ball = heapq.heappop(heap)
                if dead[ball] or not any(-bound >= a and low[n, ball] <= b for a, b in zip(floors, ceils)):
                    continue
                begin, end, child, children = self.spans[ball]
                if children:
                    for c in range(child, child + children):
                        heapq.heappush(heap, (-top[n, c], c))
                    continue
                score = self.points[begin:end] @ vec  # whole numbers below 2^53: exact
                fits = self.label[begin:end] == code
                if same:
                    fits &= self.rows[begin:end] != rows[n]
                else:
                    fits = ~fits
                for w, (a, b) in enumerate(zip(floors, ceils)):
                    at = np.flatnonzero(fits & (score >= a) & (score <= b))
                    if not len(at):
                        continue
                    places, scores = np.concatenate([best[w][0], at + begin]), np.concatenate([best[w][1], score[at]])
                    if len(places) > 4 * k:
                        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        places, scores = places[keep], scores[keep]
                    first = np.lexsort((self.ids[places], -scores))[:k]
                    best[w] = places[first], scores[first]
                    if len(first) == k:
                        floors[w] = max(a, scores[first[-1]])
            for w, (places, scores) in enumerate(best):
                if len(places):
                    yield n, w, places, scores


def build(rows: DataFrame, dim: int, block_rows: int = 4096, group_rows: int = 1 << 17) -> tuple[DataFrame, int]:
    """Blocks of ``rows`` (row, id, label, vec of integers) with their trees and a group
    number, stored, and the number of groups.  A partition's rows are sorted by label, so
    most blocks have few labels."""

    def one(table: pa.Table):
        given = table["label"].to_pylist()
        names = sorted(set(given))
        code = {x: k for k, x in enumerate(names)}
        label = np.array([code[x] for x in given])
        points = matrix(table["vec"], dim).astype(np.float64)
        order, balls, length = cover_tree(points, label)
        lists = [pa.array(names, pa.string()), pa.array(table["id"].to_numpy()[order], pa.int64()), pa.array(table["row"].to_numpy()[order], pa.int64()),
                 pa.array(label[order], pa.int32()), pa.array(points[order].astype(np.int32).ravel(), pa.int32()), pa.array(np.append(balls.ravel(), length), pa.float64())]
        cols = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        return pa.RecordBatch.from_arrays(cols, ["labels", "ids", "rows", "label", "points", "balls"])

    def run(batches):
        waiting, n = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                take = batch.slice(at, block_rows - n)
                waiting.append(take)
                at, n = at + len(take), n + len(take)
                if n == block_rows:
                    yield one(pa.Table.from_batches(waiting))
                    waiting, n = [], 0
        if n:
            yield one(pa.Table.from_batches(waiting))

    blocks = stored(rows.sortWithinPartitions("label", "row").select("row", "id", "label", "vec").mapInArrow(run, BLOCK), "cover_trees")
    held = blocks.agg(F.sum(F.size("ids"))).first()[0] or 0
    groups = max(1, -(-held // group_rows))
    return blocks.withColumn("group", F.pmod(F.xxhash64("rows"), F.lit(groups)).cast("int")), groups


def search(blocks: DataFrame, groups: int, queries: DataFrame, dim: int, same: bool, k: int, batch_queries: int = 256) -> DataFrame:
    """The ``k`` best rows of each query and window in each group (see FOUND).  ``queries`` as in QUERY."""
    names = [c.split()[0] for c in QUERY.split(", ")]
    block_names = [c.split()[0] for c in BLOCK.split(", ")]

    def nulls(spec):
        return [F.lit(None).cast(c.split(" ", 1)[1]).alias("b_" + c.split()[0] if spec is BLOCK else c.split()[0]) for c in spec.split(", ")]

    held = blocks.select("group", F.lit(0).alias("kind"), *nulls(QUERY)[1:], *[F.col(c).alias("b_" + c) for c in block_names])
    asked = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("group", *names, *nulls(BLOCK))
    dealt = held.unionByName(asked).repartition(groups, "group").sortWithinPartitions("group", "kind")

    def run(batches):
        group, trees = None, []
        for batch in batches:
            numbers, kinds = batch.column("group").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.slice(a, b - a)
                if numbers[a] != group:
                    group, trees = numbers[a], []
                if kinds[a] == 0:
                    for n in range(len(part)):
                        col = [part.column("b_" + c)[n].values for c in block_names]
                        trees.append(Block(col[0].to_pylist(), *[c.to_numpy() for c in col[1:4]], col[4].to_numpy().reshape(-1, dim), col[5].to_numpy()))
                    continue
                for at in range(0, len(part), batch_queries):
                    yield from answer(part.slice(at, batch_queries), trees)

    def answer(part, trees):
        own = [part.column(c).to_numpy() for c in ("row", "id")]
        labels, keys = part.column("label").to_pylist(), part.column("key").to_pylist()
        windows = [list(zip(a, b)) for a, b in zip(part.column("least").to_pylist(), part.column("most").to_pylist())]
        vecs = matrix(part.column("vec"), dim).astype(np.float64)
        out = []
        for tree in trees:
            for n, w, places, scores in tree.search(own[0], labels, vecs, windows, same, k):
                one = np.ones(len(places), np.int64)
                out.append(np.stack([own[0][n] * one, own[1][n] * one, keys[n][w] * one, windows[n][w][1] * one,
                                     tree.rows[places], tree.ids[places], scores.astype(np.int64)]))
        if out:
            rows = np.concatenate(out, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], [c.split()[0] for c in FOUND.split(", ")])

    return dealt.mapInArrow(run, FOUND)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding",
         scale: int = 256, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100), block_rows: int = 4096,
         group_rows: int = 1 << 17) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of other labels whose score is at most the positive's and at
    least ``low`` of it: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  ``is_anchor`` and ``label`` are expressions over ``vectors``."""
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    marked = vectors.select(F.col(id_col).cast("long").alias("__id"), label.cast("string").alias("__label"),
                            F.coalesce(is_anchor, F.lit(False)).alias("__anchor"), F.col(vector_col).alias("__vec"))
    kept = usable(marked.filter("__id is not null and __label is not null"), "__vec", id="__id", label="__label", anchor="__anchor")
    first = kept.select(F.size("vec")).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if first is None:
        return spark.createDataFrame([], out)
    dim = first[0]
    limit = math.isqrt((1 << 53) // dim)

    def whole(batches):
        for batch in batches:
            if len(batch):
                rows = integers(matrix(batch.column("vec"), dim), scale, limit).astype(np.int32)
                vec = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dim, pa.int32()), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "label", "anchor")] + [vec], ["id", "label", "anchor", "vec"])

    rows = stored(kept.mapInArrow(whole, "id long, label string, anchor boolean, vec array<int>")
                  .withColumn("row", F.monotonically_increasing_id()), "negatives_rows")
    blocks, groups = build(rows, dim, block_rows, group_rows)
    anchors = rows.filter("anchor").select(F.lit(1).alias("kind"), "row", "id", "label", "vec")
    whole_range = [F.array(F.lit(0).cast("long")).alias("key"), F.array(F.lit(-(1 << 62))).alias("least"), F.array(F.lit(1 << 62)).alias("most")]
    near = search(blocks, groups, anchors.select("*", *whole_range), dim, True, positives)
    place = Window.partitionBy("row").orderBy(F.desc("score"), "found_id", "found_row")
    best = stored(near.withColumn("n", F.row_number().over(place)).filter(F.col("n") <= positives)
                  .select("row", "n", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # least * den >= low * positive, in whole numbers; a negative positive score has an empty window
    num, den = low
    per = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("p"))
    asked = (anchors.join(per, "row").withColumn("p", F.filter("p", lambda x: x["positive_score"] >= 0)).filter(F.size("p") > 0)
             .select("kind", "row", "id", "label", "vec", F.transform("p", lambda x: x["n"].cast("long")).alias("key"),
                     F.expr(f"transform(p, x -> (x.positive_score * {num} + {den - 1}) div {den})").alias("least"),
                     F.transform("p", lambda x: x["positive_score"]).alias("most")))
    far = search(blocks, groups, asked, dim, False, negatives)
    place = Window.partitionBy("row", "key").orderBy(F.desc("score"), "found_id", "found_row")
    ranked = far.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= negatives)
    return ranked.join(best, (ranked["row"] == best["row"]) & (ranked["key"] == best["n"])).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
