"""Registered queries for T1-T17 over documents, embeddings, benchmark, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as SE
from ..operators import text as TX
from ..session import IN_PIECES, SMALL_ROW_GROUPS, materialise
from ..streaming import streams as X
from .common import rounded, tables

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


def _chunks_sql(table, keys, text, size, overlap, out="chunk"):
    k = ", ".join(keys)
    return f"""SELECT {k}, CAST(row_number() OVER (PARTITION BY {k} ORDER BY s) - 1 AS BIGINT) AS chunk_no,
  CAST(s AS BIGINT) AS chunk_start, substr({text}, s + 1, {size}) AS {out}
  FROM (SELECT {k}, {text}, unnest(generate_series(0, greatest(length({text}) - {overlap} - 1, 0), {size - overlap})) AS s
        FROM {table} WHERE length({text}) > 0)"""


def _chunks(df, text, size, overlap, keep, out="chunk"):
    c = TX.chunk_fixed(df, text, size, overlap, keep, out)
    return c.withColumn("chunk_no", F.col("chunk_no").cast("long")).withColumn(
        "chunk_start", F.col("chunk_start").cast("long"))


@reg("chunk_fixed", _chunks_sql("documents", ["doc_id"], "text", 2000, 300))
def _t1(spark, sf):
    return _chunks(tables(spark, sf).documents, "text", 2000, 300, ["doc_id"])


@reg("split_every", _chunks_sql("conversations", ["conv_id", "turn"], "text", 50, 0, "piece"))
def _t12(spark, sf):
    return _chunks(tables(spark, sf).conversations, "text", 50, 0, ["conv_id", "turn"], "piece")


@reg("chunk_recursive")
def _t2(spark, sf):
    return TX.chunk_recursive(tables(spark, sf).documents, "doc_id", "text", 2000, 300)


@reg("chunk_recursive_whole", "SELECT doc_id, md5(text) AS text_md5, TRUE AS fits FROM documents WHERE length(text) > 0")
def _t2_whole(spark, sf):
    """Chunks without overlap, put together again: the whole text, and none too long."""
    c = TX.chunk_recursive(tables(spark, sf).documents.select("doc_id", "text"), "doc_id", "text", 2000, 0)
    per = c.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_no", "chunk"))).alias("c"), F.max(F.length("chunk")).alias("longest"))
    return per.select("doc_id", F.md5(F.array_join("c.chunk", "")).alias("text_md5"), (F.col("longest") <= 2000).alias("fits"))


@reg("chunk_table", f"""SELECT concat(source, '/', CAST(doc_id AS VARCHAR)) AS relative_path,
  concat('file:///', source, '/', CAST(doc_id AS VARCHAR)) AS file_url,
  concat(source, '/', CAST(doc_id AS VARCHAR), ': ', chunk) AS chunk, lang AS language
  FROM ({_chunks_sql('documents', ['doc_id', 'source', 'lang'], 'text', 2000, 300)})""")
def _t3(spark, sf):
    c = _chunks(tables(spark, sf).documents, "text", 2000, 300, ["doc_id", "source", "lang"])
    path = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
    return TX.chunk_table(c, path, F.col("lang"))


@reg("clean_text", """SELECT doc_id, translate(text, chr(10) || chr(0), '  ') AS text_clean,
  CASE WHEN text IS NULL OR length(text) = 0 THEN 'Unable to Extract' ELSE 'ok' END AS extract_status
  FROM documents""")
def _t4(spark, sf):
    return TX.clean_text(tables(spark, sf).documents.select("doc_id", "text"), "text").drop("text")


@reg("embed_hashed")
def _t5(spark, sf):
    from pyspark.ml.functions import vector_to_array
    d = TX.embed_hashed(tables(spark, sf).documents.select("doc_id", "text"), "text", 1 << 12)
    arr = vector_to_array("features")
    return d.select("doc_id", F.size(F.filter(arr, lambda x: x != 0)).alias("n_terms"),
                    F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm_sq"))


@reg("embed_hashed_terms", r"""SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '\p{L}+'))) AS n_distinct, TRUE AS fits
  FROM documents WHERE text IS NOT NULL""")
def _t5_terms(spark, sf):
    """Vectors have unit length, or no terms, and no more terms than the text."""
    from pyspark.ml.functions import vector_to_array
    docs = tables(spark, sf).documents.select("doc_id", "text").filter("text is not null")
    arr = vector_to_array("features")
    d = TX.embed_hashed(docs, "text", 1 << 12).select(
        "doc_id", F.size(F.array_distinct(TX.tokens("text"))).cast("long").alias("n_distinct"), F.size(F.filter(arr, lambda x: x != 0)).alias("n"),
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x).alias("norm"))
    return d.select("doc_id", "n_distinct", ((F.col("n") <= F.col("n_distinct")) & ((F.col("n") == 0) | (F.abs(F.col("norm") - 1) < 1e-9))).alias("fits"))


KNN_SQL = """WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
  c AS (SELECT label, d, AVG(CAST(x AS DOUBLE)) AS m FROM u GROUP BY label, d),
  q AS (SELECT label AS query_id, list(m ORDER BY d) AS qv FROM c GROUP BY label),
  dist AS (SELECT q.query_id, e.vec_id, list_distance(q.qv, CAST(e.embedding AS DOUBLE[])) AS distance
           FROM q, embeddings e),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist)
  SELECT CAST(query_id AS BIGINT) AS query_id, CAST(rank AS INTEGER) AS rank, vec_id, ROUND(distance, 6) AS distance
  FROM r WHERE rank <= 10"""


def _label_centroids(e):
    return TX.centroids(e, "label", "embedding").select(F.col("label").cast("long").alias("query_id"), "query_vec")


@reg("knn_exact", KNN_SQL)
def _t6(spark, sf):
    e = tables(spark, sf).embeddings
    return rounded(TX.knn_exact(e, _label_centroids(e), 10))


@reg("knn_lsh")
def _t7(spark, sf):
    e = tables(spark, sf).embeddings
    return rounded(TX.knn_lsh(e, _label_centroids(e), 10, bucket_length=0.5, num_tables=4, threshold=2.0))


TOK = r"regexp_extract_all(lower({t}), '\p{{L}}+')"
BM25_SQL = f"""WITH dt AS (SELECT doc_id, lang, {TOK.format(t='text')} AS toks FROM documents),
  ds AS (SELECT doc_id, lang, len(toks) AS dl FROM dt),
  coll AS (SELECT COUNT(*) AS n, AVG(dl) AS avgdl FROM ds),
  p AS (SELECT term, doc_id, COUNT(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM dt) GROUP BY 1, 2),
  df AS (SELECT term, COUNT(*) AS df FROM p GROUP BY 1),
  q AS (SELECT DISTINCT item_id AS query_id, unnest({TOK.format(t='text')}) AS term FROM benchmark),
  s AS (SELECT q.query_id, p.doc_id, list_sum(list(ln(1 + (coll.n - df.df + 0.5) / (df.df + 0.5)) * (p.tf * 2.2
          / (p.tf + 1.2 * (0.25 + 0.75 * ds.dl / coll.avgdl))) ORDER BY p.term)) AS score
        FROM q JOIN df ON q.term = df.term JOIN p ON q.term = p.term JOIN ds ON p.doc_id = ds.doc_id, coll
        WHERE ds.lang = 'en' GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, ROUND(score, 6) AS score FROM r WHERE rank <= 10"""


def _bm25(spark, sf):
    t = tables(spark, sf)
    return _search(spark, sf, SE.build_index(t.documents, "doc_id", "text", ["lang"]))


def _search(spark, sf, index):
    q = tables(spark, sf).benchmark.select(F.col("item_id").alias("query_id"), "text")
    return SE.search(spark, index, q, "query_id", "text", "doc_id", 10, lambda d: d["lang"] == "en")


@reg("bm25_search", BM25_SQL)
def _t8(spark, sf):
    return _bm25(spark, sf)


@reg("search_refresh_stream", BM25_SQL)
def _x5_search(spark, sf):
    """The index grows by three runs over new documents, with tiers of two segments, and
    is then searched: the same answers as from an index of all documents."""
    run = X.new_run_dir(spark, "search")
    docs = tables(spark, sf).documents.select("doc_id", "text", "lang")
    cut = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    for n in range(3):
        docs.filter(cut == n).write.mode("append").options(**SMALL_ROW_GROUPS).parquet(run + "/docs")
        fresh = spark.readStream.options(**IN_PIECES).schema(docs.schema).parquet(run + "/docs")
        X.run_to_end(SE.search_refresh_stream(fresh, run + "/index", run + "/ckpt", "doc_id", "text", ["lang"], fan=2))
    return _search(spark, sf, SE.open_index(spark, run + "/index"))


CONTEXT_SQL = f"""WITH h AS ({BM25_SQL})
  SELECT h.query_id, string_agg(concat('Context document ', CAST(h.rank AS VARCHAR), ': ', d.text, ' ' || chr(10) || chr(10)), ''
    ORDER BY h.rank) AS context FROM h JOIN documents d ON h.doc_id = d.doc_id GROUP BY h.query_id"""


def _context(spark, sf):
    found = materialise(_bm25(spark, sf), "hits")  # of known size: where hits are few, texts are picked out as they are read, not shuffled
    hits = found.join(tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    return TX.context_string(hits, "query_id", "rank", "text")


@reg("context_string", CONTEXT_SQL)
def _t9(spark, sf):
    return _context(spark, sf)


def _sql_lit(s):
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_before_q, _rest = TX.DEFAULT_TEMPLATE.split("{question}", 1)
_between, _after = _rest.split("{context}", 1)


@reg("render_prompt", f"""WITH c AS ({CONTEXT_SQL})
  SELECT b.item_id AS query_id, concat('<s>[INST] ', {_sql_lit(_before_q)}, b.text, {_sql_lit(_between)},
    c.context, {_sql_lit(_after)}, ' [/INST]') AS prompt FROM benchmark b JOIN c ON b.item_id = c.query_id""")
def _t10(spark, sf):
    b = tables(spark, sf).benchmark.select(F.col("item_id").alias("query_id"), "text")
    j = b.join(_context(spark, sf), "query_id")
    return j.select("query_id", TX.render_prompt(F.col("text"), F.col("context")).alias("prompt"))


def _cut_sql(t, stops):
    for s in stops:
        lit = _sql_lit(s)
        t = f"CASE WHEN strpos({t}, {lit}) > 0 THEN left({t}, strpos({t}, {lit}) - 1) ELSE {t} END"
    return t


STOPS = ["\n", ". "]


@reg("truncate_at_stops", f"SELECT conv_id, turn, {_cut_sql('text', STOPS)} AS text_cut FROM conversations")
def _t11(spark, sf):
    c = tables(spark, sf).conversations
    return c.select("conv_id", "turn", TX.truncate_at_stops("text", STOPS).alias("text_cut"))


@reg("normalise_roles", """SELECT conv_id, turn, CASE WHEN lower(role) IN ('system', 'user', 'assistant') THEN lower(role)
  WHEN lower(role) = 'human' THEN 'user' WHEN lower(role) = 'ai' THEN 'assistant' ELSE 'unknown' END AS role
  FROM conversations""")
def _t13(spark, sf):
    c = tables(spark, sf).conversations
    return c.select("conv_id", "turn", TX.normalise_roles("role").alias("role"))


@reg("fold_conversation", """SELECT conv_id, CAST(floor((pos - 1) / 64) AS BIGINT) AS piece,
  list(role ORDER BY pos) AS roles, list(text ORDER BY pos) AS contents, COUNT(*) AS n_messages
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations) GROUP BY 1, 2""")
def _t14(spark, sf):
    f = TX.fold_conversation(tables(spark, sf).conversations)
    return f.select("conv_id", "piece", F.transform("messages", lambda m: m["role"]).alias("roles"),
                    F.transform("messages", lambda m: m["content"]).alias("contents"),
                    F.col("n_messages").cast("long").alias("n_messages"))


@reg("dedupe_preview", """SELECT MIN(doc_id) AS doc_id, CASE WHEN length(text) > 1500
  THEN concat(substr(text, 1, 1500), ' ... (truncated)') ELSE text END AS preview FROM documents GROUP BY text""")
def _t15(spark, sf):
    return TX.dedupe_preview(tables(spark, sf).documents, "doc_id", "text")


@reg("tokenise_pad", r"""WITH t AS (SELECT doc_id, regexp_split_to_array(trim(text), '\s+')[1:128] AS toks FROM documents)
  SELECT doc_id, list_concat(toks, list_transform(range(128 - len(toks)), lambda i: '[PAD]')) AS tokens,
    list_concat(list_transform(toks, lambda x: 1), list_transform(range(128 - len(toks)), lambda i: 0)) AS attention_mask
  FROM t""")
def _t16(spark, sf):
    d = tables(spark, sf).documents
    toks, mask = TX.tokenise_pad("text", 128)
    return d.select("doc_id", toks.alias("tokens"), mask.alias("attention_mask"))


GEN = "concat('<s>[INST] ', role, ' [/INST] ', text)"
RESP = "concat('{Tool used: ', role, ', Response: ', text, '}')"
BODY = rf"regexp_replace(regexp_replace({RESP}, '^\{{+|\}}+$', '', 'g'), '\{{', '', 'g')"


@reg("parse_response", rf"""SELECT conv_id, turn,
  CASE WHEN strpos({GEN}, '[/INST] ') > 0 THEN substr({GEN}, strpos({GEN}, '[/INST] ') + 8) END AS answer,
  CASE WHEN strpos({BODY}, ', Response: ') > 0 THEN split_part(split_part({BODY}, ', Response: ', 1), ': ', 2) END AS tool,
  CASE WHEN strpos({BODY}, ', Response: ') > 0 THEN substr({BODY}, strpos({BODY}, ', Response: ') + 12) END AS response
  FROM conversations""")
def _t17(spark, sf):
    c = tables(spark, sf).conversations
    gen = F.concat(F.lit("<s>[INST] "), F.col("role"), F.lit(" [/INST] "), F.col("text"))
    resp = F.concat(F.lit("{Tool used: "), F.col("role"), F.lit(", Response: "), F.col("text"), F.lit("}"))
    after, _, _ = TX.parse_response(gen)
    _, tool, response = TX.parse_response(resp)
    return c.select("conv_id", "turn", after.alias("answer"), tool.alias("tool"), response.alias("response"))
