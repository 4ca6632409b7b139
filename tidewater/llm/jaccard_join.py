"""Exact similarity join on word n-grams with token-group matrices.

Two documents link when the Jaccard similarity of their shingle sets is at least
``num / den``.  The join is exact (up to 64-bit hashes of shingles and of sets):

1. Every text becomes its set of hashed shingles.  Equal sets are one node.
2. Similar documents are brought into clusters.  A linked pair of at most r
   shingles each differs in at most k of them, so if shingles are dealt by hash into
   more than k parts, some are the same in both, and how many at least is known.  Nodes
   that share as many parts are joined.  Parts held by many are not counted pair by pair:
   nodes that hold as many of these as they need are joined to one of them (within a task
   first, so such a part crosses the network a few times per task), and for others they
   count as shared.  The connected components are the clusters: no link leaves a cluster.
3. A cluster is cut into blocks of bounded size and, if it has several, of like set
   sizes; each pair of its blocks that may hold a link is one unit of work.  There the documents of one block are partitioned into small groups
   of similar ones, the union of each group's tokens is a column of the token-group
   matrix, and the product of a query's tokens with it bounds the overlap of the
   query with any member.  Only groups whose bound reaches the overlap that the
   threshold asks for are opened and their members compared exactly.
4. Each unit returns a spanning forest of its links instead of all pairs; the
   components over these give each document its class.

Defined results: words are runs without ASCII white space, A-Z lower-cased; a text
of fewer words than ``n`` has one shingle, its whole word sequence; a text without
words (or null) has the empty set, links with nothing and is its own component;
repeated rows are documents with equal sets; a null id is reachable but never the
smallest unless there is no other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, list_of, may_hold, slices, stored
from .graph import components

U = np.uint64
M1, M2, BASE = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x100000001B3)
SEGMENT = 1 << 20
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (each output bit depends on all input bits)."""
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


class WordHasher:
    """64-bit hashes of the words of a byte string, by differences of running polynomial sums."""

    def __init__(self):
        self.power = self.inverse = np.empty(0, U)

    def _grow(self, n: int):
        if len(self.power) < n:
            inv = U(pow(int(BASE), -1, 1 << 64))
            self.power = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, BASE)]))
            self.inverse = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, inv)]))

    def segment(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word."""
        b = np.frombuffer(raw, np.uint8)
        space = IS_SPACE[b]
        edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
        start, end = edge[0::2], edge[1::2]
        self._grow(len(b) + 1)
        run = np.zeros(len(b) + 1, U)
        np.cumsum((b.astype(U) + U(1)) * self.power[:len(b)], out=run[1:])
        return start, mix((run[end] - run[start]) * self.inverse[start] + (end - start).astype(U) * M2)

    def words(self, texts: list[str]):
        """Hashes of all words of the texts in order, and the number of words of each text."""
        raw = [x.encode("utf-8").lower() for x in texts]  # bytes.lower changes A-Z alone
        sizes = np.array([len(x) + 1 for x in raw], np.int64)
        joined = b" ".join(raw) + b" "
        at, starts, hashes = 0, [], []
        while at < len(joined):
            stop = min(len(joined), at + SEGMENT)
            while stop < len(joined) and not IS_SPACE[joined[stop - 1]]:
                stop += 1
            s, h = self.segment(joined[at:stop])
            starts.append(s + at)
            hashes.append(h)
            at = stop
        start = np.concatenate(starts) if starts else np.empty(0, np.int64)
        return (np.concatenate(hashes) if hashes else np.empty(0, U)), np.diff(np.searchsorted(start, np.cumsum(sizes)), prepend=0)


def shingle_sets(texts: list[str], hasher: WordHasher, n: int = 3) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = hasher.words(texts)
    grams = np.zeros(max(0, len(words) - n + 1), U)
    for k in range(n):
        grams = mix(grams * BASE + words[k:k + len(grams)] + U(k + 1))
    out, at = [], 0
    for c in counts.tolist():
        if c >= n:
            out.append(np.unique(grams[at:at + c - n + 1]))
        elif c:
            h = np.full(1, c, U)
            for w in words[at:at + c]:
                h = mix(h * M1 + w)
            out.append(h)
        else:
            out.append(np.empty(0, U))
        at += c
    return out


def set_hash(tokens: np.ndarray) -> np.int64:
    """One number for the whole set."""
    total = mix(tokens ^ M1).sum(keepdims=True, dtype=U)
    return mix(total + np.full(1, len(tokens), U) * M2).view(np.int64)[0]


class Parts:
    """Hashed parts of a set, equal for some part in any two sets that link.

    Sizes fall into ranges up to ``tops``; a set takes part in the range of its own
    size and, if it may link with a larger set of the next range, in that one too.
    Very frequent shingles may be left out of the parts: what remains of two linked
    sets still differs in at most k shingles.  A set with more than k parts that are
    not empty meets each partner in one of those; only a set with fewer (nearly all
    of it is frequent) gives keys for its empty parts too.
    """

    def __init__(self, num: int, den: int, frequent: np.ndarray | None = None):
        self.num, self.den = num, den
        self.frequent = frequent if frequent is not None else np.empty(0, U)
        self.tops = [0]

    def _range(self, size: int) -> int:
        while self.tops[-1] < size:
            t = self.tops[-1]
            if t == 0:  # the largest size at which sets that link are equal
                while self._differ(t + 1) == 0:
                    t += 1
                self.tops.append(max(1, t))
            else:
                self.tops.append(max(t + 1, t * 3 // 2, t * self.den // self.num))
        return int(np.searchsorted(self.tops, size))

    def _differ(self, top: int) -> int:
        """The most shingles in which two linked sets of at most ``top`` can differ."""
        return 2 * top * (self.den - self.num) // (self.den + self.num)

    def keys(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """The keys of the set's parts, and how many of them it shares with any partner at least."""
        n, need = len(tokens), 1 << 30
        if n == 0:
            return np.empty(0, np.int64), 1
        own = self._range(n)
        ranges = [own]
        if n * self.den >= (self.tops[own] + 1) * self.num:
            self._range(self.tops[own] + 1)
            ranges.append(own + 1)
        if len(self.frequent):
            at = np.searchsorted(self.frequent, tokens)
            tokens = tokens[self.frequent[np.minimum(at, len(self.frequent) - 1)] != tokens]
        out = []
        sums = np.zeros(len(tokens) + 1, U)
        np.cumsum(mix(tokens ^ M2), out=sums[1:])
        high = tokens >> U(32)
        for r in ranges:
            k = self._differ(self.tops[r])
            if k == 0:
                continue  # only equal sets can link: one node already
            parts = k + 1 + (k + 1) // 2  # so that random gaps leave more than k parts filled
            edges = np.searchsorted((high * U(parts)) >> U(32), np.arange(parts + 1, dtype=U))
            held = np.diff(edges)
            part = sums[edges[1:]] - sums[edges[:-1]] + held.astype(U) * M1
            keys = mix(part + mix(np.arange(parts, dtype=U) + U(r) * U(1 << 32)))
            filled = int(np.count_nonzero(held))
            out.append(keys[held > 0] if filled > k else keys)
            need = min(need, max(1, filled - k))
        return (np.concatenate(out).view(np.int64), need) if out else (np.empty(0, np.int64), 1)


def frequent_shingles(docs: DataFrame, id_col: str, text_col: str, n: int, sample_docs: int, at_least: int) -> np.ndarray:
    """Shingles that ``at_least`` of ``sample_docs`` documents (those of the smallest hash
    of the id) hold.  They speed the join up and never change its result."""
    chosen = docs.select(F.col(id_col).alias("__id")).filter("__id is not null").distinct().orderBy(F.xxhash64("__id"), "__id").limit(sample_docs)
    rows = docs.join(F.broadcast(chosen), F.col(id_col) == F.col("__id")).select(text_col)

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for _, texts in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(texts, hasher, n)).view(np.int64))], ["token"])

    found = rows.mapInArrow(lean(run), "token long").groupBy("token").count().filter(F.col("count") >= at_least).select("token").toArrow()
    return np.sort(found["token"].to_numpy().astype(np.int64).view(U))


def _described(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """Per document: id, set size, node, and how many keys a partner of the node shares at least."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(c, T.LongType()) for c in ("size", "node", "need")]])
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        hasher, parts = WordHasher(), Parts(num, den, shared.value)
        for batch in batches:
            for at, texts in slices(batch, text_col):
                sets = shingle_sets(texts, hasher, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).slice(at, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) for s in sets], pa.int64()), pa.array([parts.keys(s)[1] for s in sets], pa.int64())], schema.names)

    return docs.select(id_col, text_col).mapInArrow(lean(run), schema)


def _keyed(docs: DataFrame, text_col: str, n: int, num: int, den: int, frequent: np.ndarray, few: int) -> DataFrame:
    """Per node of a slice: its keys.  A key of more than ``few`` nodes in the same slice is
    heavy and stays with one of them.  Each node that holds such a key, that one too, has a
    number for the key in this slice.  Both stand in front, with the heavy key in ``whole``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        hasher, parts = WordHasher(), Parts(num, den, shared.value)
        for batch in batches:
            for _, texts in slices(batch, text_col):
                sets = shingle_sets(texts, hasher, n)
                nodes, at = np.unique(np.array([set_hash(s) for s in sets], np.int64), return_index=True)
                found = [parts.keys(sets[k])[0] for k in at]
                flat, of = np.concatenate(found), np.repeat(np.arange(len(nodes)), [len(k) for k in found])
                order = np.lexsort((of, flat))
                flat, of = flat[order], of[order]
                head = np.flatnonzero(np.diff(flat, prepend=flat[:1] - 1))
                count = np.diff(np.append(head, len(flat)))
                many = np.repeat(count > few, count)
                is_head = np.zeros(len(flat), bool)
                is_head[head] = True
                first, held, plain = (np.flatnonzero(x) for x in (many & is_head, many, ~many))
                here = mix(mix(flat[held].view(U)) + nodes[of[np.repeat(head, count)[held]]].view(U)).view(np.int64)
                keys, whole = np.concatenate([flat[first], here, flat[plain]]), np.concatenate([flat[first], flat[held]])
                owner = np.concatenate([of[first], of[held], of[plain]])
                by = np.argsort(owner, kind="stable")  # the heavy ones of a node stay in front
                of_whole = owner[:len(whole)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), list_of(whole[np.argsort(of_whole, kind="stable")], np.bincount(of_whole, minlength=len(nodes)), pa.int64()),
                     list_of(keys[by], np.bincount(owner, minlength=len(nodes)), pa.int64())], ["node", "whole", "keys"])

    return docs.select(text_col).mapInArrow(lean(run), "node long, whole array<long>, keys array<long>")


def _near(keyed: DataFrame, needs: DataFrame, few: int) -> DataFrame:
    """Edges (a, b) between nodes that may link; ``needs``: (node, need) of all nodes.  A key
    of more than ``few`` rows, or one in ``whole``, is heavy for all nodes that hold it.
    Partners share at least as many keys as both need, and no more heavy ones than either
    holds.  So nodes that hold as many heavy keys as they need are joined to one of them for
    each such key, and any two nodes if they share enough of the other keys to make up what
    their heavy ones may lack: all of these keys are held by few nodes.  The keys are read
    once and not stored."""
    rows = (keyed.select("node", "whole", F.posexplode("keys").alias("at", "key"))
            .select("key", "node", F.get("whole", F.col("at")).alias("whole")))  # mostly null: at the end it packs best
    same = Window.partitionBy("key")
    shared = (rows.withColumn("first", F.min("node").over(same)).withColumn("last", F.max("node").over(same))
              .withColumn("held", F.sum(F.when(F.col("whole").isNull(), 1).otherwise(few + 1)).over(same)).filter("first <> last")
              .select("key", "whole", "node", (F.col("held") > few).alias("heavy")))
    shared = stored(shared, "jaccard_shared")
    heavy = shared.filter("heavy").select("key", F.coalesce("whole", "key").alias("whole"), "node")
    counts = heavy.select("whole", "node").distinct().groupBy("node").agg(F.count(F.lit(1)).alias("n_heavy"))
    counts = stored(needs.join(counts, "node", "left").select("node", "need", F.coalesce("n_heavy", F.lit(0)).alias("n_heavy")), "jaccard_heavy")

    # those that may link by heavy keys alone: first the nodes of a slice, then one of each slice
    able = heavy.join(counts.filter("n_heavy >= need").select("node"), "node").select("key", "whole", "node").distinct()
    able = able.withColumn("first", F.min("node").over(same))
    tops = able.select("whole", F.col("first").alias("node")).distinct().withColumn("first", F.min("node").over(Window.partitionBy("whole")))
    stars = able.select("node", "first").unionAll(tops.select("node", "first")).filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))

    lists = (shared.filter("not heavy").join(counts, "node").groupBy("key")
             .agg(F.array_distinct(F.sort_array(F.collect_list(F.struct("node", "need", "n_heavy")))).alias("all")))
    pairs = (lists.select("all", F.posexplode("all").alias("at", "x"))
             .select("x", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("y"))
             .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest("x.need", "y.need") - F.least("x.n_heavy", "y.n_heavy")).alias("need")).filter("n >= need"))
    return stars.unionAll(pairs.select("a", "b"))


def _tokens(rows: DataFrame, text_col: str, n: int) -> DataFrame:
    """(comp, cls, blocks, up, down, block, node, tokens) for rows whose text still has the expected node."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for at, texts in slices(batch, text_col):
                part = batch.slice(at, len(texts))
                sets = shingle_sets(texts, hasher, n)
                ok = np.array([set_hash(s) for s in sets], np.int64) == part.column("node").to_numpy()
                kept = [s for s, k in zip(sets, ok) if k]
                if kept:
                    cols = [part.column(c).filter(pa.array(ok)) for c in names]
                    flat = np.concatenate(kept).view(np.int64)
                    yield pa.RecordBatch.from_arrays(cols + [list_of(flat, np.array([len(s) for s in kept]), pa.int64())], names + ["tokens"])

    names = ["comp", "cls", "blocks", "up", "down", "block", "node"]
    return rows.select(*names, text_col).mapInArrow(lean(run), "comp long, cls int, blocks int, up int, down int, block int, node long, tokens array<long>")


def _dealt(chosen: DataFrame, num: int, den: int, block_docs: int, block_tokens: int) -> DataFrame:
    """The rows of ``chosen`` (comp, node, size, ...) with the block of each in its cluster.
    The sets of a cluster of more than one block are dealt by classes of size first: sets
    that link are in the same class or in two that follow each other.  ``blocks``, ``up``
    and ``down`` are the blocks of a set's own class, the next larger and the next smaller."""
    step = math.log(den / num * 1.01)  # a little wide, so that rounding parts no pair by two classes
    sized = chosen.withColumn("cls", F.floor(F.log("size") / step).cast("int"))
    per = sized.groupBy("comp", "cls").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("tokens"))
    whole, inside = Window.partitionBy("comp"), Window.partitionBy("comp").orderBy("cls")
    one = (F.sum("docs").over(whole) <= block_docs) & (F.sum("tokens").over(whole) <= block_tokens)
    per = per.withColumn("one", one).withColumn("blocks", F.when(F.col("one"), 1).otherwise(
        F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("tokens") / block_tokens))).cast("int"))
    for name, shift in (("up", 1), ("down", -1)):
        beside = ~F.col("one") & (F.lead("cls", shift).over(inside) == F.col("cls") + shift)
        per = per.withColumn(name, F.when(beside, F.lead("blocks", shift).over(inside)).otherwise(0))
    per = per.select("comp", "cls", "one", "blocks", "up", "down")
    return (sized.join(per, ["comp", "cls"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("cls", F.when(F.col("one"), 0).otherwise(F.col("cls"))).drop("one"))


def _units(sets: DataFrame) -> DataFrame:
    """Each set once for every block that its own is compared with: those of its own class
    (``apart`` 0) and of the two beside it (``apart`` 1, under the smaller class)."""
    beside = [("blocks", "cls as cls, 0 as apart, least(block, o) as b1, greatest(block, o) as b2, cast(block > o as int) as side"),
              ("up", "cls as cls, 1 as apart, block as b1, o as b2, 0 as side"), ("down", "cls - 1 as cls, 1 as apart, o as b1, block as b2, 1 as side")]
    units = F.expr("concat(" + ", ".join(f"transform(slice(sequence(0, {n}), 1, {n}), o -> struct({unit}))" for n, unit in beside) + ")")
    return sets.select("comp", "node", "tokens", F.explode(units).alias("unit")).select("comp", "unit.*", "node", "tokens")


class TokenGroups:
    """Documents in small groups of similar ones, with the union of each group's tokens."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, sizes: np.ndarray, group_size: int = 8):
        """rows, cols: (document, token) entries ordered by token; sizes: of the documents' whole sets."""
        self.sizes = sizes
        first = np.full(len(sizes), np.iinfo(np.int64).max)
        np.minimum.at(first, rows, cols)
        order = np.lexsort((first, sizes))  # alike in size, and in their smallest token
        self.group = np.empty(len(sizes), np.int64)
        self.group[order] = np.arange(len(sizes)) // group_size
        self.groups = int(self.group.max()) + 1 if len(sizes) else 0
        self.smallest = np.full(self.groups, np.iinfo(np.int64).max)
        np.minimum.at(self.smallest, self.group, sizes)
        self.rows, self.cols = rows, cols

    def columns(self, lo: int, hi: int, by: np.ndarray, height: int) -> np.ndarray:
        a, b = np.searchsorted(self.cols, (lo, hi))
        out = np.zeros((height, hi - lo), np.float32)
        out[by[self.rows[a:b]], self.cols[a:b] - lo] = 1
        return out


def links(a: list[np.ndarray], b: list[np.ndarray] | None, num: int, den: int, width: int = 8192):
    """Index pairs (i in a, j in b; with b None: i < j, both in a) whose sets link."""
    same = b is None
    docs = a if same else a + b
    if len(docs) < 2:
        return np.empty((0, 2), np.int64)
    sizes = np.array([len(x) for x in docs], np.int64)
    flat, of = np.concatenate(docs), np.repeat(np.arange(len(docs)), sizes)
    values, token, df = np.unique(flat, return_inverse=True, return_counts=True)
    shared = df >= 2  # other tokens are in no overlap
    number = np.cumsum(shared) - 1
    keep = shared[token]
    rows, cols = of[keep], number[token[keep]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    n_cols = int(shared.sum())
    cut = 0 if same else len(a)
    queries = np.arange(len(docs) if same else len(a))
    members = np.arange(len(docs))[cut:]
    in_b = rows >= cut
    matrix = TokenGroups(rows[in_b] - cut, cols[in_b], sizes[cut:])
    in_a = rows < len(queries)
    query = TokenGroups(rows[in_a], cols[in_a], sizes[queries])
    need = lambda p, q: -(-num * (p + q) // (num + den))  # noqa: E731  the least overlap of sets of these sizes that link
    bound = np.zeros((len(queries), matrix.groups), np.float32)
    for lo in range(0, n_cols, width):
        hi = min(n_cols, lo + width)
        bound += query.columns(lo, hi, queries, len(queries)) @ matrix.columns(lo, hi, matrix.group, matrix.groups).T
    opened = bound >= need(sizes[queries][:, None], matrix.smallest[None, :])
    q_open, m_open = np.flatnonzero(opened.any(1)), np.flatnonzero(opened.any(0)[matrix.group])
    if not len(q_open) or not len(m_open):
        return np.empty((0, 2), np.int64)
    q_at, m_at = np.full(len(queries), -1), np.full(len(members), -1)
    q_at[q_open], m_at[m_open] = np.arange(len(q_open)), np.arange(len(m_open))
    overlap = np.zeros((len(q_open), len(m_open)), np.float32)
    for lo in range(0, n_cols, width):  # members of opened groups only
        hi = min(n_cols, lo + width)
        overlap += query.columns(lo, hi, queries, len(queries))[q_open] @ matrix.columns(lo, hi, np.arange(len(members)), len(members))[m_open].T
    total = sizes[queries[q_open]][:, None] + sizes[members[m_open]][None, :]
    got = opened[q_open][:, matrix.group[m_open]] & (den * overlap >= num * (total - overlap))
    i, j = np.nonzero(got)
    pairs = np.stack([queries[q_open[i]], members[m_open[j]]], axis=1)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]] if same else pairs
    return pairs if same else pairs - np.array([0, cut])


def forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """At most n - 1 of the pairs that connect what all of them connect."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs.tolist():
        p, q = root(i), root(j)
        if p != q:
            parent[p] = q
            out.append((i, j))
    return out


def _compare(units: DataFrame, num: int, den: int) -> DataFrame:
    """Spanning links (a, b) of each unit (comp, cls, apart, b1, b2); rows of a unit come together."""
    key_cols = ["comp", "cls", "apart", "b1", "b2"]

    def unit(nodes, sides, sets):
        left = [k for k, s in enumerate(sides) if s == 0]
        right = [k for k, s in enumerate(sides) if s == 1]
        if right:
            pairs = links([sets[k] for k in left], [sets[k] for k in right], num, den)
            pairs = np.stack([pairs[:, 0], pairs[:, 1] + len(left)], axis=1)
        else:
            pairs = links([sets[k] for k in left], None, num, den)
        names = [nodes[k] for k in left + right]
        return [(names[i], names[j]) for i, j in forest(pairs, len(names)) if names[i] != names[j]]

    def run(batches):
        now, nodes, sides, sets, out = None, [], [], [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in key_cols)))
            ids, side = batch.column("node").to_pylist(), batch.column("side").to_pylist()
            col = batch.column("tokens")
            values, offsets = col.values.to_numpy(), col.offsets.to_numpy()
            for k, key in enumerate(keys):
                if key != now:
                    out += unit(nodes, sides, sets)
                    now, nodes, sides, sets = key, [], [], []
                nodes.append(ids[k])
                sides.append(side[k])
                sets.append(values[offsets[k]:offsets[k + 1]].copy())
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        out += unit(nodes, sides, sets)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    return (units.repartition(*key_cols).sortWithinPartitions(*key_cols)
            .mapInArrow(lean(run), "a long, b long"))


def join(docs: DataFrame, num: int = 80, den: int = 100, n: int = 5, block_docs: int = 256, block_tokens: int = 1 << 20,
         sample_docs: int = 10_000, at_least: int = 10, few: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (of its set), node (equal sets), component (smallest
    id that its links reach, itself included)."""
    frequent = frequent_shingles(docs, id_col, text_col, n, sample_docs, at_least)
    described = stored(_described(docs, id_col, text_col, n, num, den, frequent), "jaccard_sets")
    nodes = stored(described.groupBy("node").agg(F.min("id").alias("id"), F.max("size").alias("size"), F.max("need").alias("need")), "jaccard_nodes")

    # clusters: nodes that may link, whether directly or through others
    edges = _near(_keyed(docs, text_col, n, num, den, frequent, few), nodes.select("node", "need"), few)
    cluster = components(edges).withColumnRenamed("root", "comp")

    # one document of each clustered node, dealt into blocks of bounded size
    chosen = stored(nodes.join(cluster, "node"), "jaccard_chosen")
    chosen = (_dealt(chosen, num, den, block_docs, block_tokens)
              .select("comp", "cls", "blocks", "up", "down", "block", "node", F.col("id").alias("chosen_id")))
    texts = docs.select(F.col(id_col).alias("chosen_id"), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    texts = may_hold(texts, chosen, "chosen_id", chosen.count())  # only these texts are shuffled
    sets = _tokens(texts.join(chosen, texts["chosen_id"].eqNullSafe(chosen["chosen_id"])), text_col, n)
    linked = components(_compare(_units(sets), num, den))

    # the smallest id of each class
    classes = stored(nodes.filter("size > 0").join(linked, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root")), "jaccard_classes")
    lowest = classes.groupBy("root").agg(F.min("id").alias("component"))
    of_node = classes.join(lowest, "root").select("node", "component")
    full = described.filter("size > 0").select("id", "size", "node").join(of_node, "node").select("id", "size", "node", "component")
    empty = described.filter("size = 0").select("id", "size", "node", F.col("id").alias("component"))
    return full.unionAll(empty)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each component, all columns.  Rows are told apart by their id."""
    stays = join(docs, id_col=id_col, text_col=text_col, **options).filter(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("__id"))
    return docs.join(stays, docs[id_col].eqNullSafe(stays["__id"]), "left_semi")
