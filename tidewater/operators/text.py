"""Chunking, cleaning, retrieval and chat-text handling.

Fixed-size chunking, cleaning, term indexing and BM25 scoring are built-in
expressions and joins.  Python runs only where the semantics are genuinely
imperative: the recursive splitter (Arrow batches via ``mapInArrow``) and the
exact nearest-neighbour scan (numpy over Arrow batches).  Term search is in
``search``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from ..plans.ordinal import ordinal_within
from ..session import small_batches

# ---------------------------------------------------------------- fixed values
# Recursive splitter separators, largest first (blank line, newline, space, hard cut).
SEPARATORS = ["\n\n", "\n", " ", ""]
# Chat roles accepted as they are; other roles map through ROLE_ALIASES or become "unknown".
SUPPORTED_ROLES = ["system", "user", "assistant"]
ROLE_ALIASES = {"human": "user", "ai": "assistant"}
UNKNOWN_ROLE = "unknown"
# Preview cut for long messages.
PREVIEW_MAX = 1500
TRUNCATED_SUFFIX = " ... (truncated)"
# Context assembly and prompt wrapping.
CONTEXT_LINE = "Context document {i}: {chunk} \n\n"
INSTRUCTION_WRAP = "<s>[INST] {prompt} [/INST]"
RESPONSE_MARKER = "[/INST] "
DEFAULT_TEMPLATE = (
    "Reply from the passages alone; where they hold no reply, state that.\n\nQuestion: {question}\n\nPassages: {context}\n")
PAD_TOKEN = "[PAD]"
# Characters of chunks that a Python worker sends at a time.
OUT_CHARS = 1 << 20
# BM25 parameters (Robertson & Zaragoza 2009).
BM25_K1 = 1.2
BM25_B = 0.75
TOKEN_PATTERN = r"\p{L}+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- T1 / T12 / J7: fixed windows

def chunk_fixed(df: DataFrame, text_col: str, size: int, overlap: int = 0,
                keep: Sequence[str] = (), out: str = "chunk") -> DataFrame:
    """Windows of ``size`` characters stepping ``size - overlap`` over the whole
    text; a window is emitted only while it adds text beyond the previous one.
    Output: keep..., chunk_no (0-based), chunk_start (0-based), chunk."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap
    n = F.length(text_col)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - F.lit(overlap) - 1, F.lit(0)), F.lit(step)))
    d = df.select(*keep, text_col, F.posexplode(starts).alias("chunk_no", "chunk_start"))
    return d.select(*keep, "chunk_no", "chunk_start",
                    F.substring(F.col(text_col), F.col("chunk_start") + 1, F.lit(size)).alias(out))


def split_every(df: DataFrame, text_col: str, size: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    """Consecutive pieces of ``size`` characters, in order."""
    return chunk_fixed(df, text_col, size, 0, keep, out="piece")


# ---------------------------------------------------------------- T2 / D1: recursive splitter

def _split_keep(text: str, seps: Sequence[str], size: int) -> list[str]:
    """Split ``text`` into pieces no longer than ``size`` using the largest
    separator present; separators stay attached to the piece before them."""
    if len(text) <= size:
        return [text] if text else []
    for i, sep in enumerate(seps):
        if sep == "":
            return [text[j:j + size] for j in range(0, len(text), size)]
        if sep in text:
            parts, out = text.split(sep), []
            for k, p in enumerate(parts):
                piece = p + (sep if k < len(parts) - 1 else "")
                if len(piece) <= size:
                    if piece:
                        out.append(piece)
                else:
                    out.extend(_split_keep(piece, seps[i + 1:], size))
            return out
    return [text[j:j + size] for j in range(0, len(text), size)]


def recursive_chunks(text: str | None, size: int, overlap: int = 0,
                     seps: Sequence[str] = SEPARATORS) -> list[str]:
    """Greedy merge of separator-aware pieces into chunks of at most ``size``
    characters; up to ``overlap`` characters of trailing pieces are repeated at
    the start of the next chunk.  Concatenating the chunks without the overlaps
    gives the whole text back."""
    if not text:
        return []
    pieces = _split_keep(text, list(seps), size)
    chunks, cur, cur_len = [], [], 0
    for p in pieces:
        if cur and cur_len + len(p) > size:
            chunks.append("".join(cur))
            keep, kept = [], 0
            for q in reversed(cur):
                if kept + len(q) > overlap or kept + len(q) + len(p) > size:
                    break
                keep.insert(0, q)
                kept += len(q)
            cur, cur_len = keep, kept
        cur.append(p)
        cur_len += len(p)
    if cur:
        chunks.append("".join(cur))
    return chunks


def chunk_recursive(df: DataFrame, id_col: str, text_col: str, size: int = 2000,
                    overlap: int = 300) -> DataFrame:
    """Recursive chunking on Arrow batches (one Python pass per partition), which hold
    a few MB however many rows there are; texts are taken and chunks sent one after the
    other, so a worker holds no more than that and one text.
    Output: id, chunk_no, chunk."""
    small_batches(df.sparkSession)
    schema = T.StructType([df.schema[id_col], T.StructField("chunk_no", T.LongType()), T.StructField("chunk", T.StringType())])

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            ids, texts = batch.columns
            rows, nos, chunks, held = [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(nos, pa.int64()), pa.array(chunks, pa.string())],
                                                  [id_col, "chunk_no", "chunk"])
            for row, text in enumerate(texts):
                for k, c in enumerate(recursive_chunks(text.as_py(), size, overlap)):
                    rows.append(row)
                    nos.append(k)
                    chunks.append(c)
                    held += len(c)
                    if held >= OUT_CHARS:
                        yield out()
                        rows, nos, chunks, held = [], [], [], 0
            if rows:
                yield out()
    return df.select(id_col, text_col).mapInArrow(run, schema)


@udtf(returnType="chunk_no: int, chunk: string")
class RecursiveChunker:
    """SQL table function ``recursive_chunker(text, size, overlap)`` usable with
    ``LATERAL`` after ``spark.udtf.register("recursive_chunker", RecursiveChunker)``."""

    def eval(self, text: str, size: int, overlap: int):
        for k, c in enumerate(recursive_chunks(text, size, overlap)):
            yield k, c


# ---------------------------------------------------------------- T3 / T4

def chunk_table(chunks: DataFrame, path: Column, language: Column, base_url: str = "file:///",
                chunk_col: str = "chunk") -> DataFrame:
    """T3 (J7 + P9): relative_path, file_url, ``path: chunk`` and language."""
    return chunks.select(path.alias("relative_path"),
                         F.concat(F.lit(base_url), path).alias("file_url"),
                         F.concat(path, F.lit(": "), F.col(chunk_col)).alias("chunk"),
                         language.alias("language"))


def clean_text(df: DataFrame, text_col: str, out: str = "text_clean",
               failed: str = "Unable to Extract") -> DataFrame:
    """T4: newline and NUL to space; a status column marks rows without text
    instead of overwriting the text."""
    t = F.col(text_col)
    return df.withColumns({out: F.translate(t, "\n\u0000", "  "),
                           "extract_status": F.when(t.isNull() | (F.length(t) == 0), F.lit(failed))
                           .otherwise(F.lit("ok"))})


# ---------------------------------------------------------------- T5: hashed TF-IDF vectors

def embed_hashed(df: DataFrame, text_col: str, dims: int = 1 << 12, out: str = "features") -> DataFrame:
    """T5: text -> L2-normalised TF-IDF vector over hashed terms (fit is one
    distributed pass for document frequencies)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tw_tok", pattern=TOKEN_PATTERN, gaps=False)
    tf = HashingTF(inputCol="_tw_tok", outputCol="_tw_tf", numFeatures=dims)
    idf = IDF(inputCol="_tw_tf", outputCol="_tw_idf")
    norm = Normalizer(inputCol="_tw_idf", outputCol=out, p=2.0)
    model = Pipeline(stages=[tok, tf, idf, norm]).fit(df)
    return model.transform(df).drop("_tw_tok", "_tw_tf", "_tw_idf")


# ---------------------------------------------------------------- T6 / J10 / O4: exact kNN

def knn_exact(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
              vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query_vec",
              group_rows: int = 1 << 17, max_broadcast: int | None = None) -> DataFrame:
    """The k nearest stored vectors (Euclidean, ties by id) for every query.

    Index rows are dealt into groups of about ``group_rows``; queries are copied once
    to each group and stream through it in Arrow batches, so a task holds one group's
    vectors and one batch of queries, whatever their numbers, and nothing passes the
    driver.  A group gives its k best for a query; a rank over these is the answer.
    Rows without a vector take no part.  ``max_broadcast`` is a former name of ``group_rows``."""
    group_rows = max_broadcast or group_rows
    index = index.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("vec is not null")
    queries = queries.select(F.col(qid_col).cast("long").alias("id"), F.col(qvec_col).cast("array<double>").alias("vec")).filter("vec is not null")
    groups = max(1, -(-index.count() // group_rows))
    held = index.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("grp"), F.lit(0).alias("kind"), "id", "vec")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(1).alias("kind"), "id", "vec")
    dealt = held.unionByName(asked).repartition(groups, "grp").sortWithinPartitions("grp", "kind")

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        group, ids, vecs = None, [], []
        for batch in batches:
            grp, kind = batch.column("grp").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(grp) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                rows = np.asarray(part.column("vec").flatten()).reshape(len(part), -1)
                if grp[a] != group:
                    group, ids, vecs = grp[a], [], []
                if kind[a] == 0:
                    ids.append(part.column("id").to_numpy())
                    vecs.append(rows)
                elif ids:
                    ids, vecs = [np.concatenate(ids)], [np.concatenate(vecs)]
                    near, d2 = nearest_rows(rows, vecs[0], ids[0], k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column("id").to_numpy(), near.shape[1])), pa.array(near.ravel()),
                                                      pa.array(np.sqrt(d2.ravel()))], ["qid", "id", "distance"])

    local = dealt.mapInArrow(scan, "qid long, id long, distance double")
    w = Window.partitionBy("qid").orderBy("distance", "id")
    return (local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("qid").alias(qid_col), "rank", F.col("id").alias(id_col), "distance"))


def nearest_rows(queries, vecs, ids, k: int, values: int = 1 << 23):
    """Ids and squared distances of the k rows nearest to each query, by exact
    differences in pieces of about ``values`` numbers."""
    import numpy as np
    dim = vecs.shape[1]
    step = max(1, values // max(1, dim * 256))  # rows at a time, for 256 queries
    out_i, out_d = [], []
    for q in range(0, len(queries), 256):
        some = queries[q:q + 256]
        best_i, best_d = np.zeros((len(some), 0), np.int64), np.zeros((len(some), 0))
        for r in range(0, len(vecs), step):
            diff = some[:, None, :] - vecs[None, r:r + step]
            d = np.concatenate([best_d, np.einsum("qbd,qbd->qb", diff, diff)], axis=1)
            i = np.concatenate([best_i, np.broadcast_to(ids[r:r + step], (len(some), len(diff[0])))], axis=1)
            first = np.lexsort((i, d), axis=1)[:, :k]
            best_d, best_i = np.take_along_axis(d, first, axis=1), np.take_along_axis(i, first, axis=1)
        out_i.append(best_i)
        out_d.append(best_d)
    return np.concatenate(out_i), np.concatenate(out_d)


def centroids(df: DataFrame, group_col: str, vec_col: str, out: str = "query_vec") -> DataFrame:
    """Mean vector per group (element-wise), computed with a partial aggregate per
    (group, dimension); the result has one short array per group."""
    e = df.select(group_col, F.posexplode(vec_col).alias("_tw_d", "_tw_x"))
    m = e.groupBy(group_col, "_tw_d").agg(F.avg(F.col("_tw_x").cast("double")).alias("_tw_m"))
    return (m.groupBy(group_col)
            .agg(F.array_sort(F.collect_list(F.struct("_tw_d", "_tw_m"))).alias("_tw_s"))
            .select(group_col, F.transform("_tw_s", lambda s: s["_tw_m"]).alias(out)))


def knn_lsh(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query_vec",
            bucket_length: float = 0.5, num_tables: int = 4, threshold: float = 1.0,
            seed: int = 7) -> DataFrame:
    """Approximate neighbours for large x large with random-projection LSH
    (a bucketed equi-join, no all-pairs comparison); candidates within
    ``threshold`` are ranked per query."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    a = index.select(id_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("v"))
    b = queries.select(qid_col, array_to_vector(F.col(qvec_col).cast("array<double>")).alias("v"))
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=num_tables, seed=seed).fit(a)
    pairs = lsh.approxSimilarityJoin(b, a, threshold, distCol="distance").select(
        F.col(f"datasetA.{qid_col}").alias(qid_col), F.col(f"datasetB.{id_col}").alias(id_col), "distance")
    w = Window.partitionBy(qid_col).orderBy("distance", id_col)
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- T8: BM25 search

def tokens(text) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)


# ---------------------------------------------------------------- T9 / T10 / T11 / T13-T17

def context_string(hits: DataFrame, qid_col: str, rank_col: str, chunk_col: str,
                   out: str = "context") -> DataFrame:
    """``Context document i: <chunk> \\n\\n`` in rank order, one string per query
    (the hit list is already limited to k per query)."""
    line = F.concat(F.lit("Context document "), F.col(rank_col).cast("string"), F.lit(": "),
                    F.col(chunk_col), F.lit(" \n\n"))
    g = hits.groupBy(qid_col).agg(F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"),
                                                                       line.alias("l")))).alias("_tw_s"))
    return g.select(qid_col, F.array_join(F.transform("_tw_s", lambda s: s["l"]), "").alias(out))


def render_prompt(question, context, template: str = DEFAULT_TEMPLATE, wrap: bool = True) -> Column:
    """Fill ``{question}`` and ``{context}`` in the template; optionally wrap as
    an instruction block."""
    before_q, rest = template.split("{question}", 1)
    between, after = rest.split("{context}", 1)
    body = F.concat(F.lit(before_q), _c(question), F.lit(between), _c(context), F.lit(after))
    if wrap:
        pre, post = INSTRUCTION_WRAP.split("{prompt}")
        body = F.concat(F.lit(pre), body, F.lit(post))
    return body


def truncate_at_stops(text, stops: Sequence[str]) -> Column:
    """Cut at the earliest occurrence of any stop string."""
    t = _c(text)
    for s in stops:
        t = F.substring_index(t, s, 1)
    return t


def normalise_roles(role) -> Column:
    """Aliases mapped, supported roles kept, anything else ``unknown``."""
    r = F.lower(_c(role))
    expr = F.when(r.isin(*SUPPORTED_ROLES), r)
    for src, dst in ROLE_ALIASES.items():
        expr = expr.when(r == src, F.lit(dst))
    return expr.otherwise(F.lit(UNKNOWN_ROLE))


def fold_conversation(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", piece_size: int = 64) -> DataFrame:
    """Each thread's messages appended in turn order into lists of (role, text),
    cut into pieces of at most ``piece_size`` messages (exact positions from
    ``ordinal_within``, so one very long thread is spread over many tasks)."""
    p = ordinal_within(df.select(conv_col, turn_col, role_col, text_col), [conv_col], [turn_col], out="_tw_pos")
    p = p.withColumn("piece", F.floor((F.col("_tw_pos") - 1) / F.lit(piece_size)).cast("long"))
    g = p.groupBy(conv_col, "piece").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_tw_pos").alias("pos"), F.col(role_col).alias("role"),
                                             F.col(text_col).alias("content")))).alias("_tw_m"))
    return g.select(conv_col, "piece",
                    F.transform("_tw_m", lambda m: F.struct(m["role"].alias("role"),
                                                            m["content"].alias("content"))).alias("messages"),
                    F.size("_tw_m").alias("n_messages"))


def dedupe_preview(df: DataFrame, id_col: str, text_col: str, max_len: int = PREVIEW_MAX) -> DataFrame:
    """Each distinct message once (lowest id wins) with a display preview cut
    at ``max_len`` characters plus `` ... (truncated)``; NULL messages are skipped."""
    from .relational import content_digest
    # group on a digest of the text (32-byte key), keep the lowest id per text,
    # then fetch only those rows' texts
    d = df.select(id_col, text_col).filter(F.col(text_col).isNotNull()) \
        .withColumn("_tw_h", content_digest([text_col]))
    first_ids = d.groupBy("_tw_h").agg(F.min(id_col).alias(id_col))
    first = d.join(first_ids, ["_tw_h", id_col], "left_semi")
    t = F.col(text_col)
    return first.select(id_col, F.when(F.length(t) > max_len,
                                       F.concat(F.substring(t, 1, max_len), F.lit(TRUNCATED_SUFFIX)))
                        .otherwise(t).alias("preview"))


def tokenise_pad(text, max_len: int = 128):
    """Whitespace tokens truncated to ``max_len`` and padded with [PAD];
    returns (tokens, attention_mask) columns."""
    toks = F.slice(F.split(F.trim(_c(text)), r"\s+"), 1, max_len)
    pad = F.array_repeat(F.lit(PAD_TOKEN), F.lit(max_len) - F.size(toks))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(toks)), F.array_repeat(F.lit(0), F.lit(max_len) - F.size(toks)))
    return F.concat(toks, pad), mask


def parse_response(text) -> tuple[Column, Column, Column]:
    """Text after the instruction marker; ``Tool used: X, Response: Y`` split
    into (tool, response) after stripping braces."""
    t = _c(text)
    pos = F.instr(t, RESPONSE_MARKER)
    after = F.when(pos > 0, F.substr(t, pos + F.lit(len(RESPONSE_MARKER))))
    body = F.regexp_replace(F.regexp_replace(t, r"^\{+|\}+$", ""), r"\{", "")
    tool_part = F.substring_index(body, ", Response: ", 1)
    tool = F.when(F.instr(body, ", Response: ") > 0,
                  F.try_element_at(F.split(tool_part, ": "), F.lit(2)))
    resp = F.when(F.instr(body, ", Response: ") > 0,
                  F.substr(body, F.instr(body, ", Response: ") + F.lit(len(", Response: "))))
    return after, tool, resp
