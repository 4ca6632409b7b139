"""Registered queries of the training-data operators, and DuckDB SQL where it can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import anchors, bpe, hard_negatives, html_text, imi, jaccard_join, packing, pieces, quality_cnn, stream_dedup, toxicity, url_filter, warc
from .common import crc_mod, read_table

#: Rules of the URL filter: (verdict, host/path).
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_html_text(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = html_text.extract(pages)
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                       F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))


def op2_bpe(spark, sf_dir):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_exact_dedup(spark, sf_dir):
    rows = stream_dedup.exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_warc(spark, sf_dir):
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"), chunk_bytes=1 << 16)
    rows = warc.records(warc.read_chunks(spark, manifest, chunk_bytes=1 << 16))
    return rows.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_quality(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality_cnn.train(docs, labels, "quality", crc_mod("doc_id", 3) != 1)
    scored = quality_cnn.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_toxicity(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, "toxic", crc_mod("doc_id", 5) != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, URL_RULES, url_filter.train(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict", "words", "log_odds")


def op9_jaccard_join(spark, sf_dir):
    rows = jaccard_join.join(read_table(spark, sf_dir, "documents"), num=90, den=100, n=3)
    return rows.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op10_multi_index(spark, sf_dir):
    entries = imi.usable(read_table(spark, sf_dir, "embeddings"))
    return imi.search(entries, F.col("vec_id") % 20 == 0, k=20).select("query_id", "rank", "vec_id", "score")


def op11_pieces(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, model).select("doc_id", "ids", F.element_at("ends", -1).cast("long").alias("text_bytes"))
    return pieces.decode(encoded, model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "text_bytes")


def op12_hard_negatives(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label)


def op13_vector_codes(spark, sf_dir):
    coded, book = anchors.compress(read_table(spark, sf_dir, "embeddings"))
    rows = anchors.label_errors(coded).withColumn("codebooks_sha256", F.lit(anchors.codebooks_digest(book)))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


Q = {f.__name__: f for f in (op1_html_text, op2_bpe, op3_exact_dedup, op4_warc, op5_packing, op6_quality, op7_toxicity,
                             op8_url_filter, op9_jaccard_join, op10_multi_index, op11_pieces, op12_hard_negatives, op13_vector_codes)}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Rows of embeddings without a null or non-finite component.
_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Rounds of integer k-means as one chain of common table expressions."""
    near = ("SELECT x.*, b.k, b.v AS entry FROM x JOIN b{0} b USING (p) QUALIFY row_number() OVER "
            "(PARTITION BY vec_id, p ORDER BY list_dot_product(b.v, b.v) - 2 * list_dot_product(x.v, b.v), b.k) = 1")
    steps = [f"""
        WITH e AS (SELECT vec_id, label, len(embedding) // {parts} AS w, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
                   FROM embeddings WHERE {_FINITE}),
        x AS MATERIALIZED (SELECT vec_id, label, t.p, list_slice(v, t.p * w + 1, (t.p + 1) * w) AS v FROM e, range({parts}) t(p)),
        b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, v FROM x QUALIFY k < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(r)})")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, k, list(c ORDER BY j) AS v FROM (
                SELECT p, k, j, floor(sum(u) / count(*)) AS c FROM (SELECT p, k, unnest(v) AS u, unnest(range(len(v))) AS j FROM a{r}) GROUP BY p, k, j) GROUP BY p, k)""")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (p, k))")
    steps.append(f"""f AS (SELECT vec_id, any_value(label) AS label, string_agg(lpad(printf('%x', k), 2, '0'), '' ORDER BY p) AS code,
            sum(list_dot_product(v, v) - 2 * list_dot_product(v, entry) + list_dot_product(entry, entry))::BIGINT AS error FROM a{rounds} GROUP BY vec_id)""")
    return ",\n        ".join(steps) + f"""
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, k, j)) FROM
                (SELECT p, k, unnest(v) AS c, unnest(range(len(v))) AS j FROM b{rounds})) AS codebooks_sha256
        FROM f"""


O = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op4_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes,
                     list_reduce(list_transform(range(32), lambda i: substr('{_BASE32}', (1
                       + 16 * substr(bits, i * 5 + 1, 1)::INT + 8 * substr(bits, i * 5 + 2, 1)::INT + 4 * substr(bits, i * 5 + 3, 1)::INT
                       + 2 * substr(bits, i * 5 + 4, 1)::INT + substr(bits, i * 5 + 5, 1)::INT), 1)), lambda a, b: a || b) AS payload_digest,
                     min(page_id) OVER (PARTITION BY html) AS first_id
              FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM d""",
    "op12_hard_negatives": f"""
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
              FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5""",
    "op13_vector_codes": _codes_sql(),
}
