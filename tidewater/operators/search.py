"""BM25 search over an index of immutable segments.

A segment holds some documents in blocks of about ``block_docs`` documents and at most
about ``BLOCK_TOKENS`` words.  A block has a row for each of its terms: the places of the
documents with it and their counts, and the block's maxima, the greatest count and the
least length among them; and one row without a term: ids, lengths and attributes of its
documents, by place.  A segment also has its own term counts and totals, so the
statistics of an index are sums over its live segments and nothing is counted again when
documents are added.

New documents become a new segment: they are dealt by id, and each task makes blocks of
the rows it gets, one after the other.  Segments are merged by size tiers: when a tier
has ``fan`` of them, their postings are put together in one segment of the next tier, so
each posting is written again only as often as there are tiers.  The live segments of a
version are listed in a manifest that is written last.

A search reads the rows of asked terms only.  It takes the block maxima of the query's
terms for an upper bound of any score in a block, goes through the blocks from the
highest bound down, and stops when no bound reaches the k-th score found.  Queries are
copied once to each group of blocks and stream through it; only the ``k`` best of each
group leave it, so no row per query and document exists outside a task, and a task holds
one group's blocks whatever the size of the index.  Ranks are those of the unrounded
scores, ties by id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import IN_PIECES, SMALL_ROW_GROUPS, scratch_path, small_batches
from ..streaming.versions import read_if_there
from .text import BM25_B, BM25_K1, tokens

MANIFEST = "through long, segment string, tier int, n_docs long, n_tokens long"
#: Words of a block and of a group of blocks: a block or group ends with them, if not before by its documents.
BLOCK_TOKENS = 1 << 19
GROUP_TOKENS = 1 << 22


@dataclass(frozen=True)
class Segment:
    name: str
    tier: int
    n_docs: int
    n_tokens: int


@dataclass(frozen=True)
class Index:
    """Live segments below ``base``; ``through`` is the last batch that is in them."""
    base: str
    version: int
    through: int
    segments: tuple[Segment, ...]

    @property
    def n_docs(self) -> int:
        return sum(s.n_docs for s in self.segments)

    @property
    def average_length(self) -> float:
        return sum(s.n_tokens for s in self.segments) / self.n_docs if self.n_docs else 0.0

    def read(self, spark: SparkSession, part: str) -> DataFrame | None:
        paths = [f"{self.base}/segments/{s.name}/{part}" for s in self.segments if s.n_docs]
        return spark.read.options(**IN_PIECES).parquet(*paths) if paths else None


def open_index(spark: SparkSession, base: str) -> Index:
    """The newest version of the index at ``base`` (empty when nothing was written)."""
    table = read_if_there(spark, f"{base}/manifest")
    if table is None:
        return Index(base, 0, -1, ())
    newest = table.agg(F.max("version")).first()[0]
    rows = table.filter(F.col("version") == newest).orderBy("segment").collect()  # one row a live segment
    return Index(base, newest, rows[0]["through"], tuple(Segment(r["segment"], r["tier"], r["n_docs"], r["n_tokens"]) for r in rows))


def _manifest(spark: SparkSession, through: int, segments: Sequence[Segment]) -> DataFrame:
    """As literals: rows of Python objects start one more Python daemon and worker on an executor, which stay."""
    kinds = T.StructType.fromDDL(MANIFEST)
    rows = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(kinds, (through, s.name, s.tier, s.n_docs, s.n_tokens)))) for s in segments]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def _commit(spark: SparkSession, base: str, version: int, through: int, segments: Sequence[Segment]) -> Index:
    _manifest(spark, through, segments).write.mode("overwrite").parquet(f"{base}/manifest/version={version}")
    return Index(base, version, through, tuple(segments))


def _write_segment(blocks: DataFrame, base: str, name: str, tier: int) -> Segment:
    """``blocks``: rows as ``_block_schema`` has them; they are made once and read back."""
    spark, path = blocks.sparkSession, f"{base}/segments/{name}"
    blocks.write.mode("overwrite").options(partitionOverwriteMode="static", **SMALL_ROW_GROUPS).parquet(f"{path}/blocks")
    stored = spark.read.options(**IN_PIECES).schema(blocks.schema).parquet(f"{path}/blocks")
    (stored.filter("term is not null").groupBy("term").agg(F.sum("n").alias("df"))
     .write.mode("overwrite").options(partitionOverwriteMode="static", **SMALL_ROW_GROUPS).parquet(f"{path}/terms"))
    n_docs, n_tokens = stored.filter("term is null").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    return Segment(name, tier, n_docs, n_tokens)


def _block_schema(id_type: T.DataType, attrs_type: T.DataType) -> T.StructType:
    """A term's row of a block, or with a null term the row of its documents (``n``: their number)."""
    head = T.StructType.fromDDL("block long, term string, n int, max_tf int, min_dl long, places array<int>, tfs array<int>, n_tokens long")
    return head.add("ids", T.ArrayType(id_type)).add("dls", T.ArrayType(T.LongType())).add("attrs", T.ArrayType(attrs_type))


def _blocks(docs: DataFrame, id_col: str, text_col: str, attrs: Sequence[str], block_docs: int) -> DataFrame:
    """Documents in blocks; those of an id are in one block."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*attrs, F.lit(1).alias("_tw_any")).alias("attrs"))
    words = (rows.repartition("id").sortWithinPartitions("id")
             .select("id", F.coalesce(tokens("text"), F.array().cast("array<string>")).alias("words"), "attrs"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            ends, first = np.cumsum(pc.list_value_length(held["words"])), first_of_id(held["id"])
            starts, at = np.flatnonzero(first), 0
            while True:
                before = int(ends[at - 1]) if at else 0
                full = min(at + block_docs, int(np.searchsorted(ends, before + BLOCK_TOKENS)) + 1)
                n = np.searchsorted(starts, full)  # a block ends where another id begins
                if n == len(starts):
                    break
                yield from block_rows(held.slice(at, int(starts[n]) - at), first[at:starts[n]])
                at = int(starts[n])
            held = held.slice(at)
        if held is not None and len(held):
            yield from block_rows(held, first_of_id(held["id"]))

    return words.mapInArrow(run, _block_schema(words.schema["id"].dataType, words.schema["attrs"].dataType))


def first_of_id(ids):
    """Where another id than the row before begins; nulls are one id."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    first = np.ones(len(ids), bool)
    a, b = ids.slice(1), ids.slice(0, max(0, len(ids) - 1))
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    first[1:] = ~same.to_numpy(zero_copy_only=False)
    return first


def block_rows(rows, first):
    """The rows of one block, from its documents (id, words, attrs) ordered by id.  Rows of
    one id and length count as one document with the words of all, as far as terms go."""
    import numpy as np
    import pyarrow as pa
    words, n = rows["words"].combine_chunks(), len(rows)
    dls = np.diff(words.offsets.to_numpy()).astype(np.int64)
    _, at, same = np.unique(np.cumsum(first) * (int(dls.max()) + 1) + dls, return_index=True, return_inverse=True)
    coded = words.flatten().dictionary_encode()
    posting, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + np.repeat(at[same], dls), return_counts=True)
    place, terms = posting % n, len(coded.dictionary)
    starts = np.searchsorted(posting // n, np.arange(terms + 1))
    block = uuid.uuid4().int >> 65

    def lists(values, ends, kind=None):
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values if kind is None else pa.array(values, kind))

    def batch(size, **columns):
        made = {"block": pa.array(np.full(size, block, np.int64)), **columns}
        kinds = {"term": pa.string(), "n": pa.int32(), "max_tf": pa.int32(), "min_dl": pa.int64(), "places": pa.list_(pa.int32()), "tfs": pa.list_(pa.int32()),
                 "n_tokens": pa.int64(), "ids": pa.list_(rows["id"].type), "dls": pa.list_(pa.int64()), "attrs": pa.list_(rows["attrs"].type)}
        return pa.RecordBatch.from_arrays([made["block"], *(made.get(c, pa.nulls(size, k)) for c, k in kinds.items())], ["block", *kinds])

    if terms:
        yield batch(terms, term=coded.dictionary, n=pa.array(np.diff(starts), pa.int32()), max_tf=pa.array(np.maximum.reduceat(tf, starts[:-1]), pa.int32()),
                    min_dl=pa.array(np.minimum.reduceat(dls[place], starts[:-1])), places=lists(place, starts, pa.int32()), tfs=lists(tf, starts, pa.int32()))
    yield batch(1, n=pa.array([n], pa.int32()), n_tokens=pa.array([int(dls.sum())], pa.int64()), ids=lists(rows["id"].combine_chunks(), [0, n]),
                dls=lists(dls, [0, n], pa.int64()), attrs=lists(rows["attrs"].combine_chunks(), [0, n]))


def add_documents(docs: DataFrame, base: str, id_col: str, text_col: str, attrs: Sequence[str] = (), batch_id: int | None = None,
                  fan: int = 4, block_docs: int = 1024) -> Index:
    """Add documents to the index at ``base`` as a new segment, then merge full tiers.

    ``batch_id`` makes it repeatable: a batch that is already in the index is not added
    again.  Ids are taken as unique; a null text is a document without terms."""
    spark = docs.sparkSession
    index = open_index(spark, base)
    if batch_id is not None and batch_id <= index.through:
        return index
    through = index.through if batch_id is None else batch_id
    name = f"s{index.version + 1}-{uuid.uuid4().hex[:8]}"
    new = _write_segment(_blocks(docs, id_col, text_col, attrs, block_docs), base, name, 0)
    live = [*index.segments, new]
    index = _commit(spark, base, index.version + 1, through, live)
    while full := [t for t in {s.tier for s in live} if sum(s.tier == t for s in live) >= fan]:
        group = [s for s in live if s.tier == min(full)]
        merged = _merge(spark, Index(base, 0, 0, tuple(group)), f"m{index.version + 1}-{uuid.uuid4().hex[:8]}", min(full) + 1, block_docs)
        live = [s for s in live if s not in group] + [merged]
        index = _commit(spark, base, index.version + 1, through, live)
    return index


def _merge(spark: SparkSession, group: Index, name: str, tier: int, block_docs: int) -> Segment:
    """Blocks that are less than half full are put together to about full ones; the others stay."""
    rows = group.read(spark, "blocks")
    if rows is None:
        return Segment(name, tier, 0, 0)
    columns, parts = rows.columns, rows.filter("term is null").select("block", "n", "n_tokens")
    small = (F.col("n") * 2 < block_docs) & (F.col("n_tokens") * 2 < BLOCK_TOKENS)
    n_docs, n_tokens = parts.filter(small).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    full = max(1, -(-n_docs // block_docs), -(-n_tokens // BLOCK_TOKENS))
    before = Window.partitionBy("to").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moved = (parts.filter(small).withColumn("to", F.xxhash64(F.lit(name), F.pmod(F.xxhash64("block"), F.lit(full))))
             .select("block", "to", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int").alias("offset")))
    placed = rows.join(F.broadcast(moved), "block", "left")  # one short row a block

    def together(column, shift=False):
        return F.flatten(F.transform(F.array_sort("parts", lambda a, b: a["offset"] - b["offset"]),
                                     lambda x: F.transform(x[column], lambda p: p + x["offset"]) if shift else x[column]))
    moving = placed.filter("to is not null")
    terms = (moving.filter("term is not null").groupBy("to", "term")
             .agg(F.sum("n").cast("int").alias("n"), F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"), F.collect_list(F.struct("offset", "places", "tfs")).alias("parts"))
             .select(F.col("to").alias("block"), "term", "n", "max_tf", "min_dl", together("places", True).alias("places"), together("tfs").alias("tfs")))
    docs = (moving.filter("term is null").groupBy("to")
            .agg(F.sum("n").cast("int").alias("n"), F.sum("n_tokens").alias("n_tokens"), F.collect_list(F.struct("offset", "ids", "dls", "attrs")).alias("parts"))
            .select(F.col("to").alias("block"), "n", "n_tokens", *(together(c).alias(c) for c in ("ids", "dls", "attrs"))))
    merged = placed.filter("to is null").select(columns).unionByName(terms, True).unionByName(docs, True)
    return _write_segment(merged, group.base, name, tier)


def build_index(docs: DataFrame, id_col: str, text_col: str, attrs: Sequence[str] = (), base: str | None = None, block_docs: int = 1024) -> Index:
    """An index of ``docs`` in one segment, below the shared checkpoint folder by default."""
    base = base or scratch_path(docs.sparkSession, f"search/{uuid.uuid4().hex}")
    return add_documents(docs, base, id_col, text_col, attrs, block_docs=block_docs)


def search_refresh_stream(docs: DataFrame, base: str, ckpt: str, id_col: str, text_col: str, attrs: Sequence[str] = (),
                          trigger: str | None = None, fan: int = 4, block_docs: int = 1024) -> StreamingQuery:
    """Each micro-batch of new documents becomes a segment of the index at ``base``;
    ``trigger='1 hour'`` keeps it within an hour of the source."""
    from ..streaming.streams import _trigger

    def write(batch: DataFrame, batch_id: int):
        add_documents(batch, base, id_col, text_col, attrs, batch_id, fan, block_docs)
    return _trigger(docs.writeStream.foreachBatch(write).option("checkpointLocation", ckpt), trigger).start()


def search(spark: SparkSession, index: Index, queries: DataFrame, qid_col: str, qtext_col: str, id_col: str = "doc_id", k: int = 10,
           where: Callable[[Column], Column] | None = None, group_docs: int = 1 << 13) -> DataFrame:
    """BM25 (k1 = 1.2, b = 0.75, idf = ln(1 + (N - df + .5)/(df + .5))): the ``k`` best
    documents of each query that share a term with it, as (query, rank, id, score rounded
    to 6 places).  ``where`` takes a document's attributes, as
    ``lambda d: d["lang"] == "en"``; statistics are those of all documents.  Documents
    without an id count, but are never found."""
    blocks, term_counts = index.read(spark, "blocks"), index.read(spark, "terms")
    qid_type = queries.schema[qid_col].dataType.simpleString()
    if blocks is None:
        return spark.createDataFrame([], f"`{qid_col}` {qid_type}, rank int, `{id_col}` long, score double")
    small_batches(spark)
    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    n, average = float(index.n_docs), float(index.average_length or 1.0)
    df = term_counts.groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    words = queries.select(F.col(qid_col).alias("qid"), F.explode(F.array_distinct(tokens(qtext_col))).alias("term"))
    asked = (words.join(df, "term").groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("idf")))).alias("q")))
    groups = max(1, -(-index.n_docs // group_docs), -(-sum(s.n_tokens for s in index.segments) // GROUP_TOKENS))
    grp = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("grp")
    kept = F.transform("attrs", lambda d: F.coalesce(F.lit(True) if where is None else where(d), F.lit(False))).alias("kept")
    docs = blocks.filter("term is null").select(grp, F.lit(0).alias("kind"), "block", "ids", "dls", kept)
    postings = (blocks.filter("term is not null").join(words.select("term").distinct(), "term", "left_semi")
                .select(grp, F.lit(1).alias("kind"), "block", "term", "max_tf", "min_dl", "places", "tfs"))
    asks = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(2).alias("kind"), "qid", "q")
    dealt = (docs.unionByName(postings, True).unionByName(asks, True).repartition(groups, "grp").sortWithinPartitions("grp", "kind", "block"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        group, parts, held = None, {}, []
        for batch in batches:
            grp, kind, block = (batch.column(c).fill_null(0).to_numpy() for c in ("grp", "kind", "block"))
            cuts = np.flatnonzero((np.diff(grp) != 0) | (np.diff(kind) != 0) | (np.diff(block) != 0)) + 1
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                if grp[a] != group:
                    group, parts, held = grp[a], {}, []
                part = batch.slice(a, b - a)
                if kind[a] < 2:  # copied, so that the batch can go
                    mine = part.select(["ids", "dls", "kept"] if kind[a] == 0 else ["term", "max_tf", "min_dl", "places", "tfs"])
                    parts.setdefault(block[a], ([], []))[kind[a]].append(mine.take(pa.array(range(len(mine)))))
                    continue
                while parts:
                    _, (about, entries) = parts.popitem()
                    if entries:
                        held.append(Block(pa.Table.from_batches(about), pa.Table.from_batches(entries), average))
                for qid, q in zip(part.column("qid"), part.column("q").to_pylist()):
                    out += [(qid, i, s) for i, s in best_of(held, [x["term"] for x in q], [x["idf"] for x in q], k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0].as_py() for o in out], batch.column("qid").type), pa.array([o[1] for o in out], batch.column("ids").type.value_type),
                                                  pa.array([o[2] for o in out], pa.float64())], ["qid", "id", "score"])

    best = dealt.mapInArrow(run, f"qid {qid_type}, id {id_type}, score double")
    place = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select(F.col("qid").alias(qid_col), "rank", F.col("id").alias(id_col), F.round("score", 6).alias("score")))


class Block:
    """A block's postings of some terms as arrays, and the bounds of these terms."""

    def __init__(self, docs, entries, average: float):
        import numpy as np
        import pyarrow.compute as pc
        ids, dls, kept = (docs[c].combine_chunks().flatten() for c in ("ids", "dls", "kept"))
        there = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
        self.ids, same = np.unique(np.asarray(ids.take(there)), return_inverse=True)
        self.kept = np.bincount(same, kept.to_numpy(zero_copy_only=False)[there], len(self.ids)) > 0
        own = np.full(len(ids), len(self.ids))  # a place's id; those without one come last
        own[there] = same
        self.place = {t: n for n, t in enumerate(entries["term"].to_pylist())}
        self.starts = np.concatenate([[0], np.cumsum(pc.list_value_length(entries["places"]))])
        places, tfs = (np.asarray(pc.list_flatten(entries[c])) for c in ("places", "tfs"))
        self.docs = own[places].astype(np.int32)
        self.impact = self._impact(tfs, np.asarray(dls)[places], average)
        self.bound = self._impact(np.asarray(entries["max_tf"]), np.asarray(entries["min_dl"]), average)
        if len(there) > len(self.ids):  # an id's rows add up
            self.bound = self.bound * np.bincount(same).max()

    @staticmethod
    def _impact(tf, dl, average):
        return tf * (BM25_K1 + 1) / (tf + BM25_K1 * ((1 - BM25_B) + BM25_B * dl / average))

    def limit(self, terms, idfs) -> float:
        return sum(w * self.bound[p] for t, w in zip(terms, idfs) if (p := self.place.get(t)) is not None)

    def scores(self, terms, idfs):
        """(ids, scores) of the kept documents with any of the terms; sums in the order of the terms."""
        import numpy as np
        docs, parts = [], []
        for t, w in zip(terms, idfs):
            p = self.place.get(t)
            if p is not None:
                a, b = self.starts[p], self.starts[p + 1]
                docs.append(self.docs[a:b])
                parts.append(w * self.impact[a:b])
        total = np.bincount(np.concatenate(docs), np.concatenate(parts), len(self.ids))[:len(self.ids)]
        here = np.flatnonzero((total > 0) & self.kept)
        return self.ids[here], total[here]


def best_of(blocks: Sequence[Block], terms: Sequence[str], idfs: Sequence[float], k: int) -> list[tuple]:
    """The ``k`` best (id, score) in these blocks, blocks with the highest bound first."""
    import numpy as np
    ranked = sorted(((b.limit(terms, idfs), n) for n, b in enumerate(blocks)), reverse=True)
    ids, scores = None, None
    for limit, n in ranked:
        if limit <= 0 or (scores is not None and len(scores) == k and limit * (1 + 1e-12) < scores[-1]):
            break
        new_ids, new_scores = blocks[n].scores(terms, idfs)
        ids, scores = (new_ids, new_scores) if ids is None else (np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores]))
        first = np.lexsort((ids, -scores))[:k]
        ids, scores = ids[first], scores[first]
    return [] if ids is None else list(zip(ids.tolist(), scores.tolist()))
