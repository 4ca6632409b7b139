"""Training-data operators against brute force, round trips and edge rows."""
import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as PT
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import (bpe, html_text, imi, jaccard_join, packing, quality_cnn, stream_dedup, suite, toxicity,
                           url_filter, warc)

SF = "/root/testdata/sf0.001"
LONG = "word " * 40_000
ROWS = [(1, None, "a"), (2, "", "a"), (3, "one two three four five six", "b"), (4, "one two three four five six", "c"),
        (4, "one two three four five six", "c"), (None, "lonely words here", None), (7, LONG, "d"), (8, "x" * 50_000, None),
        (9, "two words", "z"), (10, " \t\n ", "z"), (11, "naïve café 日本語。 'tis  double  spaces\n\nend", "z")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, score string").withColumn("ids", F.lit("clash"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_html_rules():
    t = html_text.visible_text
    assert t(None) == t("") == ""
    assert t("<head><title>no</title></head><p>a<p>b<script>x<p></script>") == "a\n\nb"
    assert t("<ul><li>x<ul><li>y</ul><li>z</ul>") == "- x\n  - y\n- z"
    assert t("<ol start=3><li>a<li>b</ol>") == "3. a\n4. b"
    assert t("<table><tr><th>A<th>Bee<tr><td>long cell<td>1</table>") == "A         | Bee\nlong cell | 1"
    assert t("a<div hidden>no</div><span style='display:none'>no</span>b") == "ab"
    assert t("<pre> a\n   b</pre>c") == " a\n   b\n\nc"
    assert t("1 &lt; 2 &amp; 3<br>x<!-- c -->y") == "1 < 2 & 3\nxy"
    assert "deep" in t("<div>" * 5000 + "deep")
    assert t("un<b>closed <i>tags") == "unclosed tags"


def test_html_keeps_structure_at_any_depth():
    t = html_text.visible_text
    for deep in (500, 5000):
        down = "<div>" * deep
        assert t(down + "a<span hidden>no</span><noscript>no</noscript><template>no</template>b") == "ab"
        assert t("<b>" * deep + "a<svg><defs><text>no</text></defs></svg>b") == "ab"
        assert t(down + "<table><tr><th>A<th>Bee<tr><td>long cell<td>1</table>") == "A         | Bee\nlong cell | 1"
        assert t("<div hidden>" + down + "no" + "</div>" * deep + "no</div>yes") == "yes"
        assert t("<pre>" + "<i>" * deep + "x  y") == "x  y"
    assert t("<table><tr><td>" * 500 + "cell") == "cell"
    assert t("<ul><li>" * 500 + "x").endswith("- x")


def test_html_numbers_of_any_length():
    t, many = html_text.visible_text, "9" * 5000
    assert t(f"<ol start={many}><li>a</ol>") == "2147483647. a" and t(f"<ol start='-{many}'><li>a</ol>") == "-2147483648. a"
    assert t("<ol start=' 7x'><li>a</ol>") == "7. a" and t("<ol start=x><li>a</ol>") == "1. a"
    assert t(f"a&#{many};b &#x{'f' * 5000};") == "a\ufffdb \ufffd"
    assert t(f"&#{'0' * 5000}65;&#x{'0' * 5000}42;") == "AB"
    assert t(f"<img alt='&#{many};'>") == "\ufffd"
    row = t(f"<table><tr><td colspan={'1' * 5000}>a<td>b<tr><td>c<td>d</table>").split("\n")
    assert row[0].count("|") == 1000 and row[0].endswith("b") and row[1] == "c | d"


def test_html_rowspan_keeps_columns():
    t = html_text.visible_text
    assert t("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>") == "a | b\n  | c\nd | e"
    assert t("<table><tr><td>x<td rowspan=0>y<tr><td>z<tr><td>w<td>v</table>") == "x | y\nz |\nw |   | v"
    assert t("<table><tr><td colspan=2 rowspan=2>a<td>b<tr><td>c</table>") == "a |  | b\n  |  | c"


def test_html_drawings_formulas_dialogs_details():
    t = html_text.visible_text
    assert t("so <math><mi>x</mi></math> and <svg><title>no</title><defs><text>no</text></defs><text>lbl</text></svg> end") == "so x and lbl end"
    assert t("a<dialog>no</dialog>b<dialog open>yes</dialog>") == "ab\nyes"
    assert t("<details><summary>s</summary>no<p>no</details>") == "s"
    assert t("<details open><summary>s</summary>yes</details>") == "s\nyes"


def test_html_edges(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x"), (3, "<p>x"), (None, "<p>" + "y " * 50_000)], "page_id long, html string")
    got = [r.text for r in html_text.extract(rows.withColumn("text", F.lit("clash"))).collect()]
    assert sorted(got)[:3] == ["", "", "x"] and len(got) == 5


def test_bpe_round_trip(spark, edge):
    import tiktoken
    path = PT.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("t", pat_str=PT.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.read_file(path)), special_tokens={})
    out = bpe.decode(bpe.encode(edge, path, PT.PATTERN, part_chars=64), path, PT.PATTERN)
    want = sorted((r[0] or 0, r[1] or "") for r in ROWS)
    got = sorted((r.doc_id or 0, bytes(r.decoded).decode(), list(r.ids)) for r in out.collect())
    assert [g[:2] for g in got] == want
    assert all(g[2] == enc.encode_ordinary(g[1]) for g in got)
    assert bpe.encode(edge.limit(0), path, PT.PATTERN).count() == 0


def test_safe_parts_rebuild():
    for text in (LONG, "x" * 9999, "a1b2 c3. D's\n\n  e" * 500, "日本語。" * 2000):
        assert "".join(bpe.safe_parts(text, 100)) == text


def _dedup_want(rows):
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(t or "", []).append(i)
    return texts


def test_exact_dedup_edges_and_collisions(spark, edge, tmp_path):
    path = str(tmp_path / "docs")
    edge.write.parquet(path)
    texts = _dedup_want(ROWS)
    for digest in (stream_dedup.sha256_text, lambda t: F.substring(F.sha2(t, 256), 1, 0)):  # the second: all digests collide
        rows = stream_dedup.exact_dedup(spark, path, digest=digest).collect()
        assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == len(texts)
        by_id = {r.id: (r.keep_id, r.group_size) for r in rows}
        for ids in texts.values():
            known = [i for i in ids if i is not None]
            for i in ids:
                assert by_id[i] == (max(known) if known else None, len(ids))
    assert stream_dedup.drop_duplicates(edge).count() == len(texts)
    assert stream_dedup.drop_duplicates(edge.limit(0)).count() == 0


def test_dedup_state_goes_on_with_new_files(spark, tmp_path):
    path, cp = str(tmp_path / "docs"), str(tmp_path / "cp")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1).write.parquet(path)
    assert stream_dedup.exact_dedup(spark, path, cp).filter("kept").count() == 2
    spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string").repartition(2).write.mode("append").parquet(path)
    got = {r.id: (r.keep_id, r.group_size) for r in stream_dedup.exact_dedup(spark, path, cp, max_bytes_per_batch=1).collect()}
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


def test_warc_round_trip(spark):
    rows = [(3, "http://a/x", "same"), (1, "http://b/", "same"), (2, None, None), (5, "u", ""), (7, "http://é/ ", "é" * 30_000), (1, "http://b/", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    chunks = warc.read_chunks(spark, warc.write_archives(pages, chunk_bytes=1000, target_bytes=200), chunk_bytes=777)
    longest = chunks.agg(F.max(F.octet_length("chunk")), F.max("chunk_no")).first()
    assert longest[0] <= 777 and longest[1] == 60_000 // 777
    got = sorted((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.records(chunks).collect())
    d = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    assert got == sorted([(1, 4, d("same"), "response", None)] * 2 + [(3, 4, d("same"), "revisit", 1), (2, 0, d(""), "response", None),
                                                                     (5, 0, d(""), "revisit", 2), (7, 60_000, d("é" * 30_000), "response", None)], key=str) or \
        sorted(got, key=str) == sorted([(1, 4, d("same"), "response", None)] * 2 + [(3, 4, d("same"), "revisit", 1), (2, 0, d(""), "response", None),
                                                                                   (5, 0, d(""), "revisit", 2), (7, 60_000, d("é" * 30_000), "response", None)], key=str)
    assert warc.records(warc.read_chunks(spark, warc.write_archives(pages.limit(0)))).count() == 0


def test_packing_is_gapless_and_exact(spark, docs, edge):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PT.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    data = docs.select("doc_id", "text").unionByName(edge.select((F.col("doc_id") + 10_000).alias("doc_id"), "text").filter("doc_id <> 10004"))
    texts = {r.doc_id: r.text or "" for r in data.collect()}
    pieces = packing.pack(data.repartition(5), PT.path("byte_bpe_50k.json"), open_windows=3, merge_fan=2).toPandas()
    for doc, group in pieces.groupby("doc_id", dropna=False):
        if doc != doc:
            continue
        ids = np.array(tok.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        group = group.sort_values("start")
        assert b"".join(group.ids) == ids.tobytes() and (group.doc_tokens == len(ids)).all()
        assert list(group.start) == list(np.cumsum(group.length) - group.length)
        assert all(zlib.crc32(x) == c for x, c in zip(group.ids, group.ids_crc32))
    seq = pieces.sort_values(["sequence_id", "offset"])
    assert (seq.groupby("sequence_id").length.cumsum() - seq.length == seq.offset).all()
    fill = seq.groupby("sequence_id").length.sum()
    assert fill.max() <= 1024 and all(x & (x - 1) == 0 for x in fill)
    assert packing.pack(data.limit(0), PT.path("byte_bpe_50k.json")).count() == 0


def test_packing_queries_keep_the_ids(spark, monkeypatch):
    packed, pack = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **b: packed.append(pack(*a, **b)) or packed[-1])
    out = corpus_pipeline._pack(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(20), SF)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in out.collect())
    digests = suite.op5_packing(spark, SF)
    assert digests.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    key = ("sequence_id", "offset")
    want = {tuple(r[k] for k in key): zlib.crc32(r.ids) for r in packed[1].collect()}
    assert {tuple(r[k] for k in key): r.ids_crc32 for r in digests.collect()} == want


def test_quality_net():
    good = [("the cat sat on a mat and saw %d birds " % k) * (k % 7 + 1) for k in range(120)]
    bad = [("%%%% ### BUY!! NOW!! %d $$$ " % k) * (k % 7 + 1) for k in range(120)]
    net = quality_cnn.ByteCNN().fit([x.encode() for x in good[:80] + bad[:80]], [1] * 80 + [0] * 80, epochs=6)
    scores = net.scores([x.encode() for x in good[80:] + bad[80:]])
    assert ((scores >= 0.5) == ([True] * 40 + [False] * 40)).mean() > 0.95
    long = (good[3] * 5000).encode()
    assert 0 <= net.scores([long])[0] <= 1 and 0 <= net.scores([b""])[0] <= 1
    assert quality_cnn.ByteCNN().fit([], []).scores([b"x"])[0] == 0.5


def test_quality_of_a_text_does_not_depend_on_its_neighbours():
    net = quality_cnn.ByteCNN()
    texts = [bytes([97 + k % 26]) * k for k in range(130)] + [b""]
    alone = np.array([net.scores([x])[0] for x in texts])
    for other in (b"\xff" * 9, b"~Q~Q~Q~Q~Q"):
        mixed = net.scores([y for x in texts for y in (x, other)])[::2]
        assert np.abs(mixed - alone).max() < 1e-6


def test_quality_gradients_match_differences():
    net = quality_cnn.ByteCNN(embed=3, filters=4, hidden=3)
    texts, y = [b"hello world, this is a text", b"?" * 300], np.array([1.0, 0.0], np.float32)
    _, grad = net.gradients(texts, y)
    for name in ("u", "c", "V", "W"):
        at = np.unravel_index(np.abs(grad[name]).argmax(), grad[name].shape)
        old = net.p[name][at]
        loss = []
        for step in (0.002, -0.002):
            net.p[name][at] = old + step
            loss.append(net.gradients(texts, y)[0])
        net.p[name][at] = old
        assert abs((loss[0] - loss[1]) / 0.004 - grad[name][at]) < 0.1 * abs(grad[name][at]) + 2e-3


def test_toxicity_counterfactual():
    toxic = ["the muslims are vermin %d" % k for k in range(40)] + ["you pathetic vermin idiot %d" % k for k in range(40)]
    clean = ["a calm day number %d in the garden" % k for k in range(80)]
    texts, y = toxic + clean, [1] * 80 + [0] * 80
    plain = toxicity.Classifier(l1=0.5).fit(texts, y, penalty=0.0)
    fair = toxicity.Classifier(l1=0.5).fit(texts, y, penalty=1.0)
    change = lambda c: abs(c.logit("the muslims came") - c.logit("the christians came"))
    assert change(fair) < 0.2 * change(plain)
    assert fair.score("you pathetic vermin") > 0.5 and fair.score("the muslims came for a calm day") < 0.5
    assert toxicity.Classifier().score("") < 0.5


def test_toxicity_cut_never_falls_among_equals():
    clean = ["a calm day in the garden", "the train was late", "tea and bread"]
    few = toxicity.Classifier().fit(["you pathetic vermin", "vermin idiot"] + clean, [1, 1, 0, 0, 0])
    none = toxicity.Classifier(l1=50.0).fit(["you pathetic vermin", "vermin idiot", "idiot"] + clean, [1, 1, 1, 0, 0, 0])
    assert not none.weights and all(c.score(x) < 0.5 for c in (few, none) for x in clean + ["", "unseen"])
    logits, y = np.array([0.0] * 9 + [3.0] * 4), np.array([0, 0, 0, 0, 0, 0, 0, 1, 1] + [1] * 4)  # missed toxic ones sort last among equals
    assert 0 < toxicity.best_cut(logits, y) < 3
    assert toxicity.best_cut(np.zeros(4), np.array([0, 0, 0, 1])) > 0 and toxicity.best_cut(np.zeros(4), np.array([0, 1, 1, 1])) < 0
    assert toxicity.best_cut(np.array([1.0, 2.0, 6.0]), np.array([0, 0, 1])) == 4.0


@pytest.mark.parametrize("module,label", [(quality_cnn, "quality"), (toxicity, "toxic")])
def test_scores_on_edge_rows(spark, edge, module, label):
    labels = spark.createDataFrame([(3, 1, 1), (7, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    model = module.train(edge, labels, label, F.lit(True))
    rows = module.score(edge, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    empty = module.train(edge, labels.limit(0), label, F.lit(True))
    assert module.score(edge.limit(0), empty).count() == 0


def test_url_filter(spark):
    words = url_filter.default_segmenter().split
    assert words("casinowin") == ["casino", "win"] and words("cheappillsonline") == ["cheap", "pills", "online"]
    assert "".join(words("q" * 700)) == "q" * 700
    urls = ["http://WWW.Example.net/en/1?x", "http://example.net/de/1", "https://example.com/de/2#t", "http://a.example.org/fr/3",
            "http://casino-poker-bets.example.org/en/5", "http://thth.example.org/en/5", None, "no scheme", "x://host"] + ["http://free-bets.example.com/en/%d" % k for k in range(9)]
    urls += ["http://h%s.example.org/en/%d" % ("tion" * (k % 3 + 1), k) for k in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("rule", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, suite.URL_RULES, url_filter.train(pages)).collect()}
    assert got[0] == ("www.example.net", "/en/1", "example.net/en/", "allow") and got[1][2:] == ("net/", "block")
    assert got[2][2:] == ("example.com/de/", "block") and got[3][2:] == ("org/fr/", "allow")
    assert got[4][2:] == (None, "block") and got[5][2:] == (None, "allow") and got[9][3] == "block"
    assert got[6] == got[7] == ("", "", None, "allow") and got[8][:2] == ("host", "")


def _letters(k):
    return "".join(chr(97 + k // 26 ** i % 26) for i in range(5))


def test_url_weights_do_not_depend_on_the_number_of_names(spark):
    names = [_letters(k * 7919) for k in range(20_000)]
    urls = ["http://free-bets.h.example.org/%s" % w for w in names] + ["http://news.h.example.org/wiki"]
    model = url_filter.train(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string"))
    asked = spark.createDataFrame([(0, "http://qqqqq.vvvvv.zzjjx/"), (1, "http://%s/" % _letters(3 * 7919 + 1))], "page_id int, url string")
    assert [round(r.log_odds - model.prior, 9) for r in url_filter.judge(asked, (), model).collect()] == [0.0, 0.0]  # never seen: no evidence
    assert model.weights.count() > 20_000


def test_url_segmentation_is_learned_and_seeds_outweigh_the_suffix(spark):
    urls = ["http://violet.example.org/a", "http://violet.example.com/b", "http://lantern.example.org/a", "http://lantern.shop.org/c",
            "http://violetlantern.example.org/en/5", "http://casino-win.example.org/en/5", "http://violet.example.co.uk/", "http://%s.example.org/" % ("qz" * 400)]
    urls += ["http://free-bets.example.com/en/%d" % k for k in range(9)] + ["http://h%s.example.org/en/%d" % ("tion" * (k % 3 + 1), k) for k in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: r for r in url_filter.judge(pages, (), url_filter.train(pages)).collect()}
    assert got[4].words == ["h:violet", "h:lantern", "h:example", "t:org", "p:en"] and got[4].verdict == "allow"
    assert got[5].verdict == "block" and got[6].words == ["h:violet", "h:example", "t:co", "t:uk"]
    assert got[7].words[0] == "h:" + "qz" * 400 and len(got) == len(urls)


def _brute_join(rows, num, n):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    low = {i: i for i in sets}
    ids, changed = sorted(sets), True
    near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in near:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return {i: (len(s), low[i]) for i, s in sets.items()}


@pytest.mark.parametrize("num,n,options", [(90, 3, {}), (80, 5, {}), (80, 3, {"at_least": 2, "block_docs": 4, "few": 1}), (60, 2, {"at_least": 3, "few": 2})])
def test_jaccard_join_is_exact(spark, num, n, options):
    g = np.random.default_rng(num + n)
    rows, k = [], 0
    for _ in range(12):
        base = [f"w{x}" for x in g.integers(0, 400, int(g.integers(1, 120)))]
        for _ in range(int(g.integers(1, 14))):
            words = list(base)
            for _ in range(int(g.integers(0, 5))):
                words[int(g.integers(0, len(words)))] = f"e{g.integers(0, 60)}"
            rows.append((k, " ".join(words).upper() if k % 3 else " ".join(words)))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, LONG), (k + 3, LONG + "x")]
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), num=num, n=n, **options)
    assert {r.id: (r.size, r.component) for r in got.collect()} == _brute_join(rows, num, n)


def test_jaccard_join_edges(spark, edge):
    rows = jaccard_join.join(edge, num=90, n=3).collect()
    assert len(rows) == len(ROWS)
    assert {r.id: r.component for r in rows if r.id} == {1: 1, 2: 2, 3: 3, 4: 3, 7: 7, 8: 8, 9: 9, 10: 10, 11: 11}
    assert jaccard_join.join(edge.limit(0)).count() == 0
    assert jaccard_join.keep_one(edge).columns == edge.columns


def _passages(g):
    """Documents of words of their own and four of thirty passages, with some near copies."""
    texts = [[f"p{q}x{w}" for q in g.choice(30, 4, replace=False) for w in range(6)] + [f"w{w}" for w in g.integers(0, 1 << 30, 40)] for _ in range(220)]
    return [" ".join(t) for t in texts] + [" ".join(t[:-1]) for t in texts[:20]]


def _beginnings(g):
    """The first words of one text, from few to many: neighbours link, far ones do not."""
    words = [f"w{w}" for w in g.integers(0, 1 << 30, 200)]
    return [" ".join(words[:k]) for k in range(12, 200)]


@pytest.mark.parametrize("texts,few,most", [(_passages, 2, 500), (_beginnings, 16, 4500)])
def test_jaccard_join_compares_sets_with_few_blocks(spark, monkeypatch, texts, few, most):
    rows, copies, compare = list(enumerate(texts(np.random.default_rng(8)))), [], jaccard_join._compare
    monkeypatch.setattr(jaccard_join, "_compare", lambda units, *a: copies.append(units.count()) or compare(units, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.join(docs, num=80, n=3, block_docs=4, at_least=10_000, few=few)
    assert {r.id: (r.size, r.component) for r in got.collect()} == _brute_join(rows, 80, 3)
    assert copies[0] < most  # each set with each block of its cluster: over 7000


def test_multi_index_recall_and_edges(spark):
    vec = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(1_000_000, None), (1_000_020, [0.0] * 64), (1_000_040, [float("nan")] * 64), (1_000_060, [1.0]), (None, [1.0] * 64)],
                                "vec_id long, embedding array<float>")
    # rows that repeat an id, one of them a query's, are rows of their own; other columns may have any name
    frame = vec.unionByName(odd).unionByName(vec.filter("vec_id in (0, 3)")).withColumn("vec", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("c1", F.lit(2))
    entries = imi.usable(frame)
    rows = [(r.row, r.vec_id, np.array(r.vec)) for r in entries.collect()]
    assert len(rows) == vec.count() + 2 and len({r[0] for r in rows}) == len(rows)
    for options in ({}, {"block_entries": 16, "batch_queries": 3, "centroids": 5}, {"visit": 1.0}):
        got = imi.search(entries, F.col("vec_id") % 20 == 0, k=20, **options).collect()
        hits, mine = 0, {}
        for r in got:
            mine.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        for q in {i for _, i, _ in rows if i % 20 == 0}:
            own = [(n, v) for n, i, v in rows if i == q]
            best = [sorted((-float((v * x).sum()), i) for m, i, x in rows if m != n)[:20] for n, v in own]
            some = sorted(mine[q], key=lambda m: m[0])
            assert [m[0] for m in some] == sorted(list(range(1, 21)) * len(own))
            if len(own) == 1:
                assert [m[1] for m in some] == [m[1] for m in sorted(some, key=lambda m: (-m[2], m[1]))]
            scores = {i: float((own[0][1] * x).sum()) for _, i, x in rows}
            assert all(abs(m[2] - scores[m[1]]) < 1e-12 for m in some)
            hits += len({m[1] for m in some} & {i for _, i in best[0]}) * len(own)
            if options.get("visit") == 1.0:
                assert sorted(m[1] for m in some) == sorted(i for b in best for _, i in b)
        assert hits >= (0.75 if "centroids" in options else 0.9) * len(got)  # five centroids a half are few
    assert imi.search(entries.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = imi.search(entries.orderBy("vec_id", "row").limit(5), F.col("vec_id") == 1, k=20)
    assert few.count() == 4


def test_multi_index_leaves_out_far_cells_of_clustered_rows_and_loses_nothing(spark):
    g = np.random.default_rng(1)
    centres = 10 * g.normal(size=(12, 8))
    v = centres[g.integers(0, 12, 3000)] + 0.1 * g.normal(size=(3000, 8))
    v[5:25] = v[4]  # equal vectors: ties by id
    entries = imi.usable(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"))
    index, _ = imi.build(entries)
    queries = v[::300]
    cells = [len(index.walk(q, 3000, t)) for q, t in zip(queries, index.least(queries, 20))]
    assert max(cells) < (index.counts > 0).sum() / 2  # though asked for all rows
    got = imi.search(entries, F.col("vec_id") % 300 == 0, k=20, visit=1.0).collect()
    for q in range(0, 3000, 300):
        want = sorted((-float((v[q] * x).sum()), i) for i, x in enumerate(v) if i != q)[:20]
        assert [(r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for _, i in want]


def test_pipeline_against_its_parts(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = {r.doc_id: r.predicted for r in suite.op6_quality(spark, SF).collect()}
    toxic = {r.doc_id: r.predicted for r in suite.op7_toxicity(spark, SF).collect()}
    left = sorted((r.doc_id, r.text) for r in docs.collect() if quality[r.doc_id] == 1 and toxic[r.doc_id] == 0)
    unique = sorted({t: i for i, t in left}.items(), key=lambda x: x[1])  # the largest id of each text
    keep = {i for i, (_, low) in _brute_join([(i, t) for t, i in unique], 80, 5).items() if i == low}
    assert set(out.doc_id) == keep
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "exact dedup", "n-gram Jaccard join", "packing"]
