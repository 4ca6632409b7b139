"""Classifiers, URL filter and pipeline stages against plain recomputation and on edge rows."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import quality_cnn, stream_dedup, suite, toxicity, url_filter, warc

SF = "/root/testdata/sf0.001"


def _plain_logit(p, text):
    """The network by loops: filters at every second byte, pooled in chunks of 256 bytes that overlap by 64."""
    n_blocks = (len(text) + 8 + 63) // 64
    padded = list(text) + [256] * (n_blocks * 64 + 8 - len(text))
    hidden = []
    for first in range(0, max(1, n_blocks - 1), 3):
        best = np.full(p["W"].shape[1], -np.inf)
        for block in range(first, min(first + 4, n_blocks)):
            for at in range(block * 64, block * 64 + 64, 2):
                window = np.concatenate([p["E"][padded[at + k]] for k in range(8)])
                best = np.maximum(best, window @ p["W"] + p["b"])
        hidden.append(np.maximum(np.maximum(best, 0) @ p["V"] + p["c"], 0))
    hidden = np.array(hidden)
    return float(np.concatenate([hidden.mean(0), hidden.max(0)]) @ p["u"] + p["u0"][0])


def test_quality_logit_equals_plain_loops():
    net, r = quality_cnn.ByteCNN(seed=3), random.Random(4)
    texts = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 55, 56, 57, 64, 200, 256, 257, 449, 700)]
    got = net.logits(texts)
    for text, logit in zip(texts, got):
        assert logit == pytest.approx(_plain_logit(net.p, text), abs=1e-4)


def test_toxicity_logit_is_the_sum_of_the_weights_of_its_words():
    c = toxicity.Classifier()
    c.intercept = -0.25
    c.weights = {f: 0.1 * (k + 1) for k, f in enumerate(toxicity.word_features("hateful") + toxicity.word_features("naïve"))}
    for text in ("", "Hateful, HATEFUL words", "naïve hateless 77 hat"):
        words = {w for w in "".join(x if x.isalpha() else " " for x in text.lower()).split()}
        want = -0.25 + sum(c.weights.get(f, 0.0) for w in words for f in toxicity.word_features(w))
        assert c.logit(text) == pytest.approx(want) and c.score(text) == pytest.approx(1 / (1 + math.exp(-want)))


def test_segmentation_equals_the_best_of_all_splits():
    r = random.Random(6)
    for trial in range(60):
        counts = {"".join(r.choice("abc") for _ in range(r.randrange(1, 4))): float(r.randrange(1, 50)) for _ in range(6)}
        s = url_filter.Segmenter(counts, per_letter=-1.0, unknown=-2.0)

        def cost(part):
            return max(s.cost.get(part, -math.inf), s.unknown + s.per_letter * len(part))

        name = "".join(r.choice("abcd") for _ in range(r.randrange(1, 9)))
        best = max(sum(cost(name[a:b]) for a, b in zip((0, *cuts), (*cuts, len(name))))
                   for k in range(len(name)) for cuts in itertools.combinations(range(1, len(name)), k))
        got = s.split(name)
        assert "".join(got) == name and sum(map(cost, got)) == pytest.approx(best)


def _plain_rule(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for verdict, rule in suite.URL_RULES:
        at, _, start = rule.partition("/")
        if (host == at or host.endswith("." + at)) and (not start or path.startswith("/" + start)):
            fits.append((len(rule), rule, verdict))
    return (host, path) + (max(fits)[1:] if fits else (None, None))


def test_url_parts_rules_and_counts_equal_plain_python(spark):
    r = random.Random(7)
    hosts = ["a.example.net", "example.com", "EXAMPLE.org", "xexample.net", "shop.example.com:80", "net", "ÄB.net", ""]
    urls = [None, "", "no", "://", "http://"] + [f"http://{r.choice(hosts)}{r.choice(['', '/', '/en/', '/en', '/de/x', '/fr/a?b#c', '?/en/', '#/fr/'])}" for _ in range(150)]
    rows = [(None if k % 9 == 0 else k, u) for k, u in enumerate(urls)] + [(1, urls[6]), (1, urls[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("__row", F.lit("x")).withColumn("words", F.lit(1))
    model = url_filter.train(pages)
    got = url_filter.judge(pages, suite.URL_RULES, model).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, *_plain_rule(u)[:3])) for i, u in rows)
    assert sorted(str((x.page_id, x.host, x.path, x.rule)) for x in got) == want
    for x in got:
        verdict = next((v for v, n in suite.URL_RULES if n == x.rule), None)
        assert x.verdict == (verdict or ("block" if x.log_odds > 0 else "allow"))
    names = {}
    for _, u in rows:
        host, path = _plain_rule(u)[:2]
        for marked in url_filter.names_of(host, path):
            if 2 <= len(marked) - 2 <= url_filter.LONGEST:
                names.setdefault(marked[2:], set()).add(host)
    base = url_filter.base_counts()
    assert {x.word: x.n for x in model.unigrams.collect()} == {w: len(names.get(w, ())) + base.get(w, 0.0) for w in {*names, *base}}


def test_url_filter_of_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, suite.URL_RULES, url_filter.train(none)).collect() == []


def test_warc_edges_and_chunks(spark):
    rows = [(None, "u1", "same"), (None, "u2", "same"), (3, None, None), (4, "u4", ""), (5, "u5", "é" * 1000), (6, "u6", "é" * 1000), (6, "u6", "é" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("sha1", F.lit(1))
    manifest = warc.write_archives(pages, chunk_bytes=64)
    chunks = warc.read_chunks(spark, manifest, chunk_bytes=64)
    assert chunks.agg(F.max(F.octet_length("chunk"))).first()[0] <= 64
    got = sorted((str(r.id), r.payload_bytes, r.record_type, str(r.refers_to)) for r in warc.records(chunks).collect())
    assert len(got) == len(rows)
    assert [g for g in got if g[0] in ("5", "6")] == [("5", 2000, "response", "None")] + [("6", 2000, "revisit", "5")] * 2
    assert [g for g in got if g[0] in ("3", "4")] == [("3", 0, "response", "None"), ("4", 0, "revisit", "3")]


def test_dedup_of_a_text_that_half_of_all_rows_hold(spark, tmp_path):
    rows = [(k, "hot" if k % 2 else f"t{k % 40}") for k in range(6000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = stream_dedup.exact_dedup(spark, f"{tmp_path}/documents.parquet", rows_per_salt=64).collect()
    last, size = {}, {}
    for i, t in rows:
        last[t], size[t] = max(last.get(t, i), i), size.get(t, 0) + 1
    assert sorted((r.id, r.keep_id, r.group_size, r.kept) for r in got) == sorted((i, last[t], size[t], i == last[t]) for i, t in rows)


def test_pipeline_stages_on_edge_rows_and_empty_tables(spark, monkeypatch):
    for module, label in ((quality_cnn, "quality"), (toxicity, "toxic")):
        docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
        model = module.train(docs, labels, label, F.lit(True))
        monkeypatch.setattr(module, "train", lambda *a, m=model, **k: m)
    some = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").limit(12).collect()]
    rows = [(k, t) for k, t in enumerate(some)] + [(3, some[3]), (None, some[4]), (100, some[5]), (200, None), (201, ""), (202, "word " * 50_000), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("__score", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("size", F.lit(3))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept[name] = out.collect()
        empty = stage(spark, docs.filter("false"), SF)
        assert empty.collect() == []
        if name != "packing":
            assert out.columns == empty.columns == docs.columns and len(kept[name]) <= len(rows)
            assert all(r["__score"] == "clash" for r in kept[name])
    exact = kept["exact dedup"]
    assert len({r.text or "" for r in exact}) == len(exact) == len({t or "" for _, t in rows})
    assert {r.doc_id for r in exact if r.text == some[5]} == {100} and {r.doc_id for r in exact if not r.text} == {201}
    # nulls and empties have no shingles: none of them goes in the near-copy stage
    assert sum(1 for r in kept["n-gram Jaccard join"] if not r.text) == 3
    tokens = {(r.doc_id, r.doc_tokens) for r in kept["packing"]}
    assert (201, 1) in tokens and sum(r.length for r in kept["packing"]) >= len(rows)
