"""Vector codes: integer k-means of vector parts over anchors hierarchies.

Components become integers, vectors are cut into equal consecutive parts, and each
part position has a codebook.  Rows are gathered in blocks, and for each part position
of a block a metric tree is built middle-out: about the square root of the points
become anchors (each new one the point furthest from its anchor, taking over the points
that it is nearer to), each anchor's points are built likewise, and the balls are merged
pairwise, smallest first.  Balls keep the sum and number of their points.

An assignment goes down a tree with a list of entries that may own points of a ball.
An entry leaves the list when the whole ball lies on another entry's side of the plane
between the two; children inherit the list.  A ball with one entry left is owned whole
and adds its kept sum; points of a leaf with more are compared one by one, in integers.
The trees are written once and read in each round; a round brings a fixed number of
sums to the driver.

Defined results: rows whose vector is null, or holds null or non-finite components, are
left out, as are vectors whose length is not the commonest one (ties: the shorter) or
not a multiple of the number of parts; integers beyond the range in which errors fit a
long (for 64 components 2^27, that is components of 32 768 at a scale of 4 096) are
moved to its end; null ids come last and, for equal ids, smaller vectors first in the
choice of first entries; fewer rows than entries give fewer entries; repeated rows are
coded alike; an empty table gives no rows; of other columns only the label is kept.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, stored

NODES = ("node_start", "begin", "end", "left", "right", "radius", "total")


def usable(vectors: DataFrame, vector_col: str, **columns: str) -> DataFrame:
    """The columns (new name = old name) and ``vec`` (array<double>) of rows whose vector
    can be used: all of one length, not empty, only finite components."""
    kept = vectors.select(*[F.col(quoted(old)).alias(new) for new, old in columns.items()],
                          F.col(quoted(vector_col)).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & F.coalesce(fine, F.lit(False)))
    common = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.filter(F.size("vec") == (common["n"] if common else 0))


def matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, dim)


def integers(rows: np.ndarray, scale: int, limit: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(rows * scale), -limit, limit).astype(np.int64)


class Tree:
    """Balls over one part of a block's rows, in preorder; a ball's points are consecutive."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.leaf, self.raw = leaf, points
        self.begin, self.end, self.left, self.right, self.radius, self.total, self.order = [], [], [], [], [], [], []
        if len(points):
            self._lay_out(self._grow(np.arange(len(points))))
        self.order = np.concatenate(self.order) if self.order else np.empty(0, np.int64)

    def _anchors(self, rows: np.ndarray) -> list[np.ndarray]:
        """The rows by their anchor."""
        points = self.raw[rows].astype(np.float64)
        pivots = [0]
        near, owner = np.sqrt(((points - points[0]) ** 2).sum(1)), np.zeros(len(rows), np.int64)
        for k in range(1, math.isqrt(len(rows) - 1) + 1):
            far = int(near.argmax())
            if near[far] == 0:
                break
            apart = np.sqrt(((points[pivots] - points[far]) ** 2).sum(1))
            reach = np.flatnonzero(near * 2 > apart[owner])  # the others are nearer to their own anchor
            d = np.sqrt(((points[reach] - points[far]) ** 2).sum(1))
            won = d < near[reach]
            near[reach[won]], owner[reach[won]] = d[won], k
            pivots.append(far)
        return [rows[owner == k] for k in range(len(pivots))]

    def _ball(self, rows: np.ndarray, children: tuple = ()):
        points = self.raw[rows]
        total = points.sum(0)
        radius = np.sqrt(((points - total / len(rows)) ** 2).sum(1).max())
        return rows, total, radius, children

    def _grow(self, rows: np.ndarray):
        groups = self._anchors(rows) if len(rows) > self.leaf else []
        if len(groups) < 2:
            return self._ball(rows)
        balls = [self._grow(g) for g in groups]
        centre = np.array([b[1] / len(b[0]) for b in balls])
        radius, count = np.array([b[2] for b in balls]), np.array([len(b[0]) for b in balls], np.float64)

        def joint(k, others):
            """A bound of the radius of ball ``k`` joined with each of the others."""
            apart = np.sqrt(((centre[others] - centre[k]) ** 2).sum(1))
            share = count[others] / (count[others] + count[k])
            return np.maximum(radius[k] + apart * share, radius[others] + apart * (1 - share))

        alive = np.arange(len(balls))
        cost = np.full((len(balls), len(balls)), np.inf)
        for k in alive:
            cost[k, k + 1:] = joint(k, alive[k + 1:])
        while True:
            a, b = divmod(int(cost.argmin()), len(balls))
            merged = self._ball(np.concatenate([balls[a][0], balls[b][0]]), (balls[a], balls[b]))
            balls[a] = merged
            alive = alive[alive != b]
            if len(alive) == 1:
                return merged
            cost[b], cost[:, b] = np.inf, np.inf
            centre[a], radius[a], count[a] = merged[1] / len(merged[0]), merged[2], len(merged[0])
            others = alive[alive != a]
            new = joint(a, others)
            cost[np.minimum(a, others), np.maximum(a, others)] = new

    def _lay_out(self, root):
        at, todo = 0, [(root, None, 0)]
        while todo:
            (rows, total, radius, children), parent, side = todo.pop()
            here = len(self.begin)
            if parent is not None:
                (self.left, self.right)[side][parent] = here
            self.begin.append(at)
            self.end.append(at + len(rows))
            self.left.append(-1)
            self.right.append(-1)
            self.radius.append(radius)
            self.total.append(total)
            if children:
                todo += [(children[1], here, 1), (children[0], here, 0)]
            else:
                self.order.append(rows)
                at += len(rows)


def assign(points, begin, end, left, right, radius, total, book):
    """Entry of each point, and the sum and number of the points of each entry.

    ``points`` in the order of the tree.  Ties go to the lower index."""
    k = len(book)
    code = np.zeros(len(points), np.int64)
    sums, counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
    entries = book.astype(np.float64)
    apart = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(2))
    centre = total / (end - begin)[:, None]
    nodes = np.zeros(min(1, len(begin)), np.int64)
    listed = np.zeros((len(nodes), k), bool)
    listed[:, np.unique(book, axis=0, return_index=True)[1]] = True  # of equal entries only the first can own points
    while len(nodes):
        d = ((centre[nodes][:, None] - entries[None]) ** 2).sum(2)
        d[~listed] = np.inf
        best = d.argmin(1)
        least = d[np.arange(len(nodes)), best][:, None]
        with np.errstate(invalid="ignore"):
            beyond = d - least - 1e-9 * (d + least) > 2 * apart[best] * (radius[nodes] * (1 + 1e-9))[:, None]
        listed &= ~beyond
        owned = listed.sum(1) == 1
        for node, entry in zip(nodes[owned].tolist(), best[owned].tolist()):
            code[begin[node]:end[node]] = entry
            sums[entry] += total[node]
            counts[entry] += end[node] - begin[node]
        leaves = ~owned & (left[nodes] < 0)
        if leaves.any():
            size = (end - begin)[nodes[leaves]]
            at = np.concatenate([np.arange(begin[n], end[n]) for n in nodes[leaves]])
            exact = ((points[at][:, None] - book[None]) ** 2).sum(2)
            exact[~np.repeat(listed[leaves], size, axis=0)] = np.iinfo(np.int64).max
            code[at] = near = exact.argmin(1)
            np.add.at(sums, near, points[at])
            counts += np.bincount(near, minlength=k)
        inner = ~owned & (left[nodes] >= 0)
        listed = np.repeat(listed[inner], 2, axis=0)
        nodes = np.stack([left[nodes[inner]], right[nodes[inner]]], axis=1).ravel()
    return code, sums, counts


class Blocks:
    """Blocks of rows with a tree for each part position, one stored row each."""

    def __init__(self, dim: int, parts: int, scale: int, block_rows: int = 2048, leaf: int = 48):
        self.dim, self.parts, self.scale, self.block_rows, self.leaf = dim, parts, scale, block_rows, leaf
        self.width = dim // parts
        self.limit = min(1 << 30, math.isqrt((1 << 62) // dim) // 2)

    def build(self, kept: DataFrame) -> DataFrame:
        """``kept`` has vec_id, label and vec."""
        types = {f.name: f.dataType for f in kept.schema.fields}
        lists = {"ids": types["vec_id"], "labels": types["label"], "points": T.IntegerType(), "order": T.IntegerType(),
                 **{n: T.IntegerType() for n in NODES[:5]}, "radius": T.DoubleType(), "total": T.LongType()}
        schema = T.StructType([T.StructField(n, T.ArrayType(t)) for n, t in lists.items()])
        arrow = {T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}

        def one(table: pa.Table):
            rows = integers(matrix(table["vec"], self.dim), self.scale, self.limit)
            trees = [Tree(rows[:, p * self.width:(p + 1) * self.width], self.leaf) for p in range(self.parts)]
            out = {"points": [t.raw[t.order].ravel() for t in trees], "order": [t.order for t in trees],
                   "node_start": [np.cumsum([0] + [len(t.begin) for t in trees])]}
            for n in NODES[1:]:
                out[n] = [np.array(getattr(t, n)).ravel() for t in trees]
            cols = [pa.array([table[c].to_pylist()], pa.list_(table[c].type)) for c in ("vec_id", "label")]
            for n in list(lists)[2:]:
                flat = pa.array(np.concatenate(out[n]), arrow[lists[n]])
                cols.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
            return pa.RecordBatch.from_arrays(cols, list(lists))

        def run(batches):
            waiting, n = [], 0
            for batch in batches:
                at = 0
                while at < len(batch):
                    take = batch.slice(at, self.block_rows - n)
                    waiting.append(take)
                    at, n = at + len(take), n + len(take)
                    if n == self.block_rows:
                        yield one(pa.Table.from_batches(waiting))
                        waiting, n = [], 0
            if n:
                yield one(pa.Table.from_batches(waiting))

        return stored(kept.select("vec_id", "label", "vec").mapInArrow(run, schema), "anchors")

    def read(self, batches):
        """For each block: its ids and labels (Arrow), and for each part the row order, points and balls."""
        for batch in batches:
            for k in range(len(batch)):
                col = {n: batch.column(n)[k].values for n in batch.schema.names}
                ids, labels = col.pop("ids"), col.pop("labels")
                arr = {n: c.to_numpy(zero_copy_only=False) for n, c in col.items()}
                n, start = len(ids), arr.pop("node_start")
                points = arr.pop("points").astype(np.int64).reshape(self.parts, n, self.width)
                order = arr.pop("order").reshape(self.parts, n)
                arr["total"] = arr["total"].reshape(-1, self.width)
                parts = [(order[p], points[p], [arr[m][start[p]:start[p + 1]] for m in NODES[1:]]) for p in range(self.parts)]
                yield ids, labels, parts


def fit(blocks: DataFrame, layout: Blocks, book: np.ndarray, rounds: int = 6) -> np.ndarray:
    """The codebooks (part, entry, component) after ``rounds`` rounds."""
    spark = blocks.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(book)

        def sums(batches):
            books = shared.value
            total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
            for _, _, parts in layout.read(batches):
                for p, (_, points, balls) in enumerate(parts):
                    _, s, n = assign(points, *balls, books[p])
                    total[p, :, :-1] += s
                    total[p, :, -1] += n
            flat = total.ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(flat[at], pa.int64())], ["cell", "total"])

        cells = blocks.mapInArrow(sums, "cell int, total long").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        total = np.zeros((*book.shape[:2], book.shape[2] + 1), object)
        flat = total.ravel()
        for r in cells.collect():  # at most parts * entries * (components + 1)
            flat[r["cell"]] = int(r["total"])
        total = flat.reshape(total.shape)
        used = total[:, :, -1] > 0
        fresh = total[:, :, :-1][used] // total[:, :, -1][used][:, None]
        book = book.copy()
        book[used] = fresh.astype(np.int64)
    return book


def codebooks_text(book: np.ndarray) -> str:
    return ",".join(map(str, book.ravel().tolist()))


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label", block_rows: int = 2048) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of each usable row, stored, and the codebooks.  ``entries`` is 256 at most."""
    spark = vectors.sparkSession
    kept = usable(vectors, vector_col, vec_id=id_col, label=label_col)
    types = {f.name: f.dataType for f in kept.schema.fields}
    schema = T.StructType([T.StructField("vec_id", types["vec_id"]), T.StructField("label", types["label"]),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).select("vec").toArrow()
    dim = len(first["vec"][0].as_py()) if first.num_rows else 0
    if dim == 0 or dim % parts:
        return spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    layout = Blocks(dim, parts, scale, block_rows)
    blocks = layout.build(kept)
    start = integers(matrix(first["vec"], dim), scale, layout.limit)
    book = fit(blocks, layout, start.reshape(-1, parts, layout.width).transpose(1, 0, 2).copy(), rounds)
    shared = spark.sparkContext.broadcast(book)

    def code(batches):
        books = shared.value
        for ids, labels, cut in layout.read(batches):
            codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
            for p, (order, points, balls) in enumerate(cut):
                near, _, _ = assign(points, *balls, books[p])
                codes[order, p] = near
                error[order] += ((points - books[p][near]) ** 2).sum(1)
            text = codes.tobytes().hex()
            names = [text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(names, pa.string()), pa.array(error, pa.int64())], schema.names)

    return stored(blocks.mapInArrow(code, schema), "codes"), book


def label_errors(coded: DataFrame, share: int = 256) -> DataFrame:
    """``coded`` with the error summed over its label (label_error).  Labels with at least
    one ``share``-th of the rows, ``share`` of them at most, are sent to all tasks; the
    others are joined by label."""
    sums = stored(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"),
                                             F.count(F.lit(1)).alias("__n")).withColumnRenamed("label", "__label"), "label_errors")
    rows = sums.agg(F.sum("__n")).first()[0] or 0
    hot = sums.filter(F.col("__n") * share >= rows).select("__label", "label_error", F.lit(True).alias("__hot"))
    cold = sums.filter(F.col("__n") * share < rows).select("__label", "label_error")
    marked = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
    rest = marked.filter("__hot is null").drop("label_error", "__hot").join(cold, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
    return marked.filter("__hot").drop("__hot").unionByName(rest)


def codebooks_digest(book: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(book).encode()).hexdigest()
