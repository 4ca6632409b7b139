"""Streams with state and versions, digest trees, dyadic joins, splitters, selection, sketches, segments."""
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import features, merkle, profile, querylog, reconcile, search, tablefn, text
from tidewater.plans.range_join import dyadic_cover, range_anti_join, range_semi_join
from tidewater.plans.ranking import rank_rows, rank_within
from tidewater.session import scratch_path
from tidewater.streaming import series, streams, versions

CDC = "user_id long, seq long, op string, v int"


def fresh(spark, name):
    return scratch_path(spark, f"test/{name}/{uuid.uuid4().hex}")


def feed(spark, base, rows, schema=CDC):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base + "/feed")


def run_cdc(spark, base):
    src = spark.readStream.schema(CDC).parquet(base + "/feed")
    streams.run_to_end(streams.cdc_upsert_stream(src, base + "/table", base + "/ckpt", ["user_id"], ["seq"]))


def state(spark, base):
    return sorted((r.user_id, r.seq, r.v) for r in versions.cdc_current(spark, base + "/table", ["user_id"], ["seq"], "op").collect())


def test_snapshot_and_later_changes_equal_full_replay(spark):
    base, g, last = fresh(spark, "cdc"), random.Random(3), {}
    for batch in range(4):
        rows = [(g.randrange(40), g.randrange(1000) * 10 + batch, g.choice(["upsert", "upsert", "delete"]), g.randrange(9)) for _ in range(60)]
        if batch == 3:
            rows.append((1, -1, "upsert", 7))  # late: older than all others, must not bring anything back
        for r in rows:
            if r[0] not in last or r[1] > last[r[0]][1]:
                last[r[0]] = r
        feed(spark, base, rows)
        run_cdc(spark, base)
        if batch in (1, 2):
            assert versions.cdc_compact(spark, base + "/table", ["user_id"], ["seq"], buckets=8) == batch
            again = versions.cdc_compact(spark, base + "/table", ["user_id"], ["seq"], buckets=8)
            assert again == batch  # nothing new: no new version
    want = sorted((k, r[1], r[3]) for k, r in last.items() if r[2] != "delete")
    assert any(r[2] == "delete" for r in last.values()) and state(spark, base) == want
    # a batch that is written again changes nothing, whether it is in the snapshot or not
    changes = spark.read.parquet(base + "/table/changes")
    for n in (0, 3):
        again = spark.createDataFrame(changes.filter(F.col("batch_id") == n).drop("batch_id").collect(), CDC)
        again.write.mode("overwrite").parquet(f"{base}/table/changes/batch_id={n}")
    assert state(spark, base) == want
    assert versions.cdc_compact(spark, base + "/table", ["user_id"], ["seq"], upto=3, buckets=8) == 3
    assert state(spark, base) == want
    version, covered, places = versions.manifest(spark, base + "/table")
    assert (version, covered) == (3, 3) and len(places) <= 8


def test_compaction_rewrites_changed_buckets_only(spark):
    base = fresh(spark, "cdc")
    feed(spark, base, [(k, 1, "upsert", k) for k in range(50)])
    run_cdc(spark, base)
    versions.cdc_compact(spark, base + "/table", ["user_id"], ["seq"], upto=0, buckets=16)
    feed(spark, base, [(7, 2, "delete", 0)])
    run_cdc(spark, base)
    versions.cdc_compact(spark, base + "/table", ["user_id"], ["seq"], upto=1, buckets=16)
    places = versions.manifest(spark, base + "/table")[2]
    assert sorted(places.values()).count(2) == 1 and len(places) > 4
    assert [r[0] for r in state(spark, base)] == [k for k in range(50) if k != 7]


def test_series_stream_equals_batch_and_marks_late_rows(spark):
    base, g = fresh(spark, "series"), random.Random(1)
    schema = "ticker string, date long, close double"
    rows = [(t, d, None if g.random() < 0.1 else round(g.random() * 9, 2)) for t in ("A", "B", None) for d in range(30)]
    rows += [("A", 100 + d, 5.0) for d in range(8)]  # no deviation: guarded
    batches = [[r for r in rows if r[1] < 3], [r for r in rows if 3 <= r[1] < 17], [r for r in rows if r[1] >= 17] + [("A", 5, 1.0), ("B", 29, 2.0), ("B", 29, 2.5)]]
    for b in batches:
        g.shuffle(b)
        feed(spark, base, b, schema)
        src = spark.readStream.schema(schema).parquet(base + "/feed")
        streams.run_to_end(series.feature_refresh_stream(src, base + "/out", base + "/ckpt", ["ticker"], "date", 5, series.lag_zscore_frame(),
                                                         "lag_5_days double, std_dev double, z_score double"))
    got = spark.read.parquet(base + "/out")
    assert got.filter("is_late").count() == 3 and got.filter("is_late and std_dev is not null").count() == 0
    done = {(r.ticker, r.date): r for r in got.filter("not is_late").collect()}
    twin = features.lag_zscore(spark.createDataFrame(rows, schema), "close", 5, 5, "date", ["ticker"], scalable=False).collect()
    assert len(done) == len(twin)
    for r in twin:
        if (r.ticker, r.date) == ("B", 29):
            continue  # any of its three rows may be the one in time
        d = done[r.ticker, r.date]
        for c in ("lag_5_days", "std_dev", "z_score"):
            assert getattr(d, c) == (None if getattr(r, c) is None else pytest.approx(getattr(r, c), abs=1e-9)), (r, d)


def test_progress_snapshots_are_not_overwritten(spark):
    base = fresh(spark, "progress")
    assert streams.progress_snapshot(spark, base + "/out") is None
    totals = spark.createDataFrame([(1, 4)], "run_id long, total_records long")
    seen = []
    for n in range(2):
        feed(spark, base, [(1, 2)], "run_id long, records_count long")
        src = spark.readStream.schema("run_id long, records_count long").parquet(base + "/feed")
        streams.run_to_end(streams.progress_stream(src, totals, base + "/out", base + "/ckpt"))
        seen.append(streams.progress_snapshot(spark, base + "/out"))
    assert [s.first()["status"] for s in seen] == ["In Progress", "Completed"]


def test_digest_trees_name_the_damage_and_read_one_node_a_level(spark):
    rows = [(k, None if k % 5 == 0 else f"n{k}", k / 3) for k in range(3000)]
    a = spark.createDataFrame(rows, "k long, name string, x double")
    b = a.withColumn("x", F.when(F.col("k") == 1234, F.lit(-1.0)).otherwise(F.col("x"))).repartition(5)
    base = fresh(spark, "merkle")
    ta, tb = (merkle.build_tree(df, ["k"], f"{base}/{n}", fan=8, depth=3) for n, df in (("a", a), ("b", b)))
    assert [d.count() for d in merkle.differing_nodes(spark, ta, tb)] == [1, 1, 1]
    assert [tuple(r) for r in merkle.differing_keys(spark, ta, tb).collect()] == [(1234, "changed")]
    same = merkle.build_tree(a.repartition(3), ["k"], f"{base}/c", fan=8, depth=3)
    assert merkle.differing_keys(spark, ta, same).count() == 0
    c = a.filter("k <> 10").unionByName(spark.createDataFrame([(9999, None, None)], a.schema)).unionByName(a.filter("k = 20"))
    tc = merkle.build_tree(c, ["k"], f"{base}/d", fan=8, depth=3)
    assert sorted(tuple(r) for r in merkle.differing_keys(spark, ta, tc).collect()) == [(10, "left only"), (20, "changed"), (9999, "right only")]
    empty = merkle.build_tree(a.filter("false"), ["k"], f"{base}/e", fan=8, depth=3)
    assert merkle.differing_keys(spark, empty, empty).count() == 0
    assert merkle.differing_keys(spark, ta, empty).count() == 3000


def test_nulls_and_their_places_are_told_apart(spark):
    base = fresh(spark, "merkle")
    a, b = (spark.createDataFrame([(1, x, y)], "k int, x string, y string") for x, y in ((None, "v"), ("v", None)))
    trees = [merkle.build_tree(df, ["k"], f"{base}/{n}", fan=2, depth=2) for n, df in enumerate((a, b))]
    assert merkle.differing_keys(spark, *trees).collect() == [T.Row(k=1, status="changed")]


def test_dyadic_cover_is_exact_and_short(spark):
    iv = spark.createDataFrame([(1, 3, 1_000_000_003), (2, -17, 9), (3, 5, 5), (4, None, 8), (5, 7, 8)], "id int, lo long, hi long")
    cover = dyadic_cover(iv, "lo", "hi", ["id"]).collect()
    size = {}
    for r in cover:
        size.setdefault(r.id, []).append((r.block << r.level, (r.block + 1) << r.level))
    assert len(size[1]) < 70 and set(size) == {1, 2, 5}
    for i, lo, hi in ((1, 3, 1_000_000_003), (2, -17, 9), (5, 7, 8)):
        ends = sorted(size[i])
        assert ends[0][0] == lo and ends[-1][1] == hi and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_range_joins_equal_brute_force(spark):
    g = random.Random(5)
    pts = [(n, g.choice(["a", "b", None]), g.randrange(-60, 60) if g.random() < 0.9 else None) for n in range(400)]
    ivs = [(g.choice(["a", "b", None]), lo := g.randrange(-60, 60), lo + g.randrange(0, 20)) for _ in range(12)]
    p, iv = spark.createDataFrame(pts, "id int, s string, p long"), spark.createDataFrame(ivs, "s string, lo long, hi long")
    inside = {n for n, s, x in pts if x is not None and any(s == t and lo <= x < hi for t, lo, hi in ivs)}
    assert {r.id for r in range_semi_join(p, iv, "p", "lo", "hi", ["s"]).collect()} == inside
    assert {r.id for r in range_anti_join(p, iv, "p", "lo", "hi", ["s"]).collect()} == {n for n, _, _ in pts} - inside
    assert range_anti_join(p, iv.filter("false"), "p", "lo", "hi", ["s"]).count() == 400
    assert range_semi_join(p, iv.filter("false"), "p", "lo", "hi", ["s"]).count() == 0


def test_ranks_of_text_outliers_and_hot_values(spark):
    g = random.Random(2)
    rows = [("hot" if n % 3 else g.choice(["x", "y", None]), 10 ** 17 if n == 0 else n) for n in range(20_000)]
    df = spark.createDataFrame(rows, "k string, n long").repartition(7)
    want = {n: i + 1 for i, (k, n) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])))}
    got = rank_rows(df, ["k", "n"])
    assert {r.n: r.pos for r in got.collect()} == want
    inside = {r.n: r.pos for r in rank_within(df, ["k"], ["n"]).collect()}
    seen = {}
    for k, n in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        seen[k] = seen.get(k, 0) + 1
        assert inside[n] == seen[k]
    ranged = df.repartitionByRange(8, "k", "n").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) <= 2 * len(rows) / 8
    ids = features.row_ids(spark.createDataFrame([("b",), ("a",), (None,)], "t string"), ["t"])
    assert {r.t: r.id for r in ids.collect()} == {None: 1, "a": 2, "b": 3}


@pytest.mark.parametrize("accuracy", [100, 10000])
def test_top_share_is_exact_with_ties_and_text_keys(spark, accuracy):
    g = random.Random(accuracy)
    rows = [(f"key{n:05d}", None if n % 50 == 0 else float(g.choice([0, 0, 0, 1, g.random(), 1e300, -1e300]))) for n in range(3000)]
    df = spark.createDataFrame(rows, "id string, s double").repartition(4)
    for rate in (0.0, 0.003, 0.2, 0.61, 1.0):
        scored = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], r[0]))
        want = {r[0] for r in scored[:math.ceil(rate * len(scored))]}
        got = features.contamination_flags(df, "s", ["id"], rate, accuracy=accuracy)
        assert {r.id for r in got.collect() if r.is_anomaly} == want and got.count() == len(rows)


def test_long_literals_and_many_columns_and_inner_where(spark):
    def one(q, col):
        return spark.createDataFrame([(q,)], "q string").select(col("q")).first()[0]
    big = "x" * 1_000_000 + "''" * 1000
    q = f"UPDATE t SET a = '{big}', b = 2 WHERE id = 1 -- end"
    assert one(q, querylog.where_text) == "id = 1" and one(q, querylog.target_table) == "t" and one(q, querylog.written_columns) == ["a", "b"]
    assert one(q, querylog.statement_kind) == "UPDATE"
    many = "UPDATE t SET " + ", ".join(f"c{n} = {n}" for n in range(100_000)) + " WHERE id = 3"
    assert one(many, querylog.where_text) == "id = 3" and len(one(many, querylog.written_columns)) == 100_000
    inner = "UPDATE t SET a = (SELECT x FROM s WHERE s.k = t.k) WHERE id = 1"
    assert one(inner, querylog.where_text) == "id = 1"
    assert one("UPDATE t SET a = 'it''s WHERE 1'\n\twhere  name = 'q (x'  ", querylog.where_text) == "name = 'q (x'"
    assert one("UPDATE t SET elsewhere = 1", querylog.where_text) is None
    log = spark.createDataFrame([(1, inner), (2, "UPDATE t SET b = 1 WHERE id = 1")], "query_id long, query_text string")
    assert sorted(r.query_id for r in querylog.same_row_updates(log).collect()) == [1, 2]


def test_sketches_merge_and_have_no_expand(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("part"), F.col("id").alias("a"), (F.col("id") % 30).cast("double").alias("b"),
                                    F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("c"))
    sk = profile.column_sketches(df, ["part"], lg_k=12)
    assert sk.count() == 21 and "Expand" not in sk._jdf.queryExecution().toString()
    est = {r.column_name: r for r in profile.merge_sketches(sk).collect()}
    exact = {r.column_name: r.distinct_count for r in profile.exact_distinct(df, ["a", "b", "c"]).collect()}
    assert exact == {"a": 20_000, "b": 30, "c": 10_001}
    for c, n in exact.items():
        assert abs(est[c].distinct_estimate - n) <= 4 * 1.04 / 64 * n and est[c].row_count == 20_000
    assert est["c"].null_count == 10_000


def test_layout_reports_the_highest_missing_folder(spark):
    paths = spark.createDataFrame([("application/jks/a",), ("application/runtime/b/c",), ("logs",), (None,), ("data//x",)], "path string")
    want = spark.createDataFrame([(p,) for p in ("application/config-dataops/", "application/jks/", "application/runtime/b", "data/error/", "tmp/a/b", "tmp/c", "logs")], "prefix string")
    got = {tuple(r) for r in reconcile.layout_tree_check(paths, want).collect()}
    assert got == {("application/config-dataops", 2, 1), ("data/error", 2, 1), ("tmp", 1, 2)}
    assert reconcile.layout_tree_check(paths, want.filter("false")).count() == 0


def _bm25_brute(docs, queries, k):
    import re
    toks = {i: re.findall(r"[a-z]+", (t or "").lower()) for i, t, _ in docs}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    df = {}
    for t in toks.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = set()
    for q, t in queries:
        words = sorted(set(re.findall(r"[a-z]+", t.lower())) & set(df))
        scored = []
        for i, _, lang in docs:
            s = [math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * (f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(toks[i]) / avg))) for w in words if (f := toks[i].count(w))]
            if s and lang == "en":
                scored.append((-sum(s), i))
        out |= {(q, n + 1, i, round(-s, 6)) for n, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def test_segments_merge_and_search_equals_brute_force(spark):
    g = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "rare", "common"] + [f"w{chr(97 + n)}" for n in range(20)]
    docs = [(n, " ".join(g.choice(words[:6] if n % 2 else words) for _ in range(g.randrange(0, 30))) if n % 17 else None, "en" if n % 3 else "de") for n in range(300)]
    docs += [(n + 300, docs[n][1], docs[n][2]) for n in range(20)]  # equal texts: ties by id
    queries = [(1, "alpha beta"), (2, "rare common wa wb"), (3, "unknown"), (4, "common common Common"), (5, "wt gamma")]
    base, schema = fresh(spark, "search"), "doc_id long, text string, lang string"
    q = spark.createDataFrame(queries, "query_id long, text string")
    for n in range(5):
        part = spark.createDataFrame([d for d in docs if d[0] % 5 == n], schema)
        index = search.add_documents(part, base, "doc_id", "text", ["lang"], batch_id=n, fan=2, block_docs=16)
    assert sorted(s.tier for s in index.segments) == [0, 2] and index.n_docs == len(docs)
    assert search.add_documents(part, base, "doc_id", "text", ["lang"], batch_id=4, fan=2) == search.open_index(spark, base)
    want = _bm25_brute(docs, queries, 7)
    rebuilt = search.build_index(spark.createDataFrame(docs, schema), "doc_id", "text", ["lang"], block_docs=50)
    for ix in (index, rebuilt):
        for groups in (40, 1 << 17):
            got = search.search(spark, ix, q, "query_id", "text", "doc_id", 7, lambda d: d["lang"] == "en", group_docs=groups)
            assert {tuple(r) for r in got.collect()} == want
    assert search.search(spark, search.open_index(spark, fresh(spark, "none")), q, "query_id", "text").collect() == []


def _long_texts():
    words = ["alpha", "beta", "gamma"]
    return [(n, " ".join([*words[:n % 3 + 1], *[f"only{chr(97 + n)}"] * 3] * 12_000), "en" if n % 4 else "de") for n in range(20)]


def _check_blocks(spark, index, docs):
    """Rows of a term or of a block's documents, and blocks that end with their words."""
    rows = index.read(spark, "blocks")
    about = rows.filter("term is null").select("block", "n", "n_tokens").collect()
    assert sum(r.n for r in about) == len(docs) and len({r.block for r in about}) == len(about) > 1
    assert max(r.n_tokens for r in about) < search.BLOCK_TOKENS + max(len(t.split()) for _, t, _ in docs)
    terms = rows.filter("term is not null")
    assert terms.count() == terms.select("block", "term").distinct().count() and terms.filter("size(places) <> n or n > 1024").count() == 0


def test_blocks_of_long_texts_are_bounded_and_groups_too(spark):  # F5
    docs, queries = _long_texts(), [(1, "alpha onlyb"), (2, "beta"), (3, "onlya")]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string, lang string"), "doc_id", "text", ["lang"])
    _check_blocks(spark, index, docs)
    q = spark.createDataFrame(queries, "query_id long, text string")
    for options in ({}, {"group_docs": 3}):
        got = search.search(spark, index, q, "query_id", "text", "doc_id", 5, lambda d: d["lang"] == "en", **options)
        assert {tuple(r) for r in got.collect()} == _bm25_brute(docs, queries, 5)


def _bounded_run(spark, monkeypatch, query):
    """A query over tables of long texts, and the index it made."""
    from tidewater.suite.text import Q
    docs, base = _long_texts(), fresh(spark, query)
    spark.createDataFrame(docs, "doc_id long, text string, lang string").write.parquet(base + "/documents.parquet")
    spark.createDataFrame([(7, "alpha onlyb")], "item_id long, text string").write.parquet(base + "/benchmark.parquet")
    monkeypatch.setattr(search, "scratch_path", lambda spark, name: base + "/index")
    rows = Q[query](spark, base).collect()
    _check_blocks(spark, search.open_index(spark, base + "/index"), docs)
    hits = sorted((rank, i) for _, rank, i, _ in _bm25_brute(docs, [(7, "alpha onlyb")], 10))
    return rows, "".join(f"Context document {rank}: {docs[i][1]} \n\n" for rank, i in hits)


def test_context_of_long_texts_comes_from_bounded_blocks(spark, monkeypatch):  # F1
    rows, context = _bounded_run(spark, monkeypatch, "context_string")
    assert [tuple(r) for r in rows] == [(7, context)]


def test_prompt_of_long_texts_comes_from_bounded_blocks(spark, monkeypatch):  # F2
    rows, context = _bounded_run(spark, monkeypatch, "render_prompt")
    assert [r.query_id for r in rows] == [7] and context in rows[0].prompt and "alpha onlyb" in rows[0].prompt


def test_stream_index_of_long_texts_is_bounded_after_merges(spark):  # F3
    docs, base, schema = _long_texts(), fresh(spark, "search_stream"), "doc_id long, text string, lang string"
    docs += [(100 + n, "beta gamma" if n % 5 else None, "en") for n in range(30)]
    for n in range(3):
        spark.createDataFrame([d for d in docs if d[0] % 3 == n], schema).write.mode("append").parquet(base + "/docs")
        rows = spark.readStream.schema(schema).parquet(base + "/docs")
        streams.run_to_end(search.search_refresh_stream(rows, base + "/index", base + "/ckpt", "doc_id", "text", ["lang"], fan=2))
    index = search.open_index(spark, base + "/index")
    assert sorted(s.tier for s in index.segments) == [0, 1] and index.through == 2
    about = index.read(spark, "blocks").filter("term is null").agg(F.sum("n"), F.max("n_tokens")).first()
    assert about[0] == len(docs) and about[1] < search.BLOCK_TOKENS + 72_000
    got = search.search(spark, index, spark.createDataFrame([(1, "alpha"), (2, "beta gamma")], "query_id long, text string"), "query_id", "text")
    brute = _bm25_brute([(i, t, "en") for i, t, _ in docs], [(1, "alpha"), (2, "beta gamma")], 10)
    assert {tuple(r) for r in got.collect()} == brute


def test_rows_of_one_id_add_up_in_the_index(spark):
    rows = [(1, "alpha beta", "en"), (1, "alpha beta", "en"), (2, "alpha", "en"), (None, "alpha alpha", "en"), (3, None, "en")]
    index = search.build_index(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", ["lang"])
    assert (index.n_docs, sum(s.n_tokens for s in index.segments)) == (5, 7)
    got = search.search(spark, index, spark.createDataFrame([(1, "alpha")], "query_id long, text string"), "query_id", "text").collect()
    idf = math.log(1 + (5 - 3 + 0.5) / 3.5)
    score = {i: round(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * dl / 1.4)), 6) for i, f, dl in ((1, 2, 2), (2, 1, 1))}
    assert {(r.doc_id, r.score) for r in got} == set(score.items())


def test_table_streams_read_a_file_or_a_folder_of_files(spark):  # F4
    base, rows = fresh(spark, "tables"), [(n, f"text {n} " * 300) for n in range(40)]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    whole.repartition(5).write.parquet(base + "/documents.parquet")
    from tidewater.suite.streaming import Q
    got = Q["index_refresh_stream"](spark, base)
    assert got.select("doc_id").distinct().count() == 40
    assert got.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n < 2").count() == 0
    from tests.conftest import SF_SMALL
    assert Q["index_refresh_stream"](spark, SF_SMALL + "/").select("doc_id").distinct().count() > 100


def test_chunks_leave_the_worker_in_small_batches(spark):  # F6
    rows = [(n, f"word{n} " * 40_000) for n in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    chunks = text.chunk_recursive(df, "doc_id", "text", 2000, 0)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert int(spark.conf.get(key).rstrip("b")) <= 4 << 20
    whole = chunks.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_no", "chunk"))).alias("c")).select("doc_id", F.array_join("c.chunk", "").alias("t"))
    assert {tuple(r) for r in whole.collect()} == set(rows)


def test_nearest_rows_in_groups_equal_brute_force(spark):
    import numpy as np
    g = np.random.default_rng(1)
    v, q = g.integers(0, 4, (300, 3)).astype(float), g.integers(0, 4, (9, 3)).astype(float)
    index = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(999, None)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id long, query_vec array<double>")
    want = set()
    for i, x in enumerate(q):
        d = np.sqrt(((v - x) ** 2).sum(1))
        want |= {(i, n + 1, int(j)) for n, j in enumerate(np.lexsort((np.arange(300), d))[:5])}
    for rows in (50, 1 << 17):
        assert {tuple(r)[:3] for r in text.knn_exact(index, queries, 5, group_rows=rows).collect()} == want
    assert text.knn_exact(index.filter("false"), queries, 5).count() == 0


def test_table_function_from_sql(spark):
    tablefn.register(spark)
    g = random.Random(4)
    rows = [(t, d, None if g.random() < 0.1 else round(g.random() * 9, 2)) for t in ("A", "B") for d in range(20)]
    df = spark.createDataFrame(rows, "ticker string, date long, close double").repartition(3)
    got = spark.sql("SELECT * FROM lag_zscore(TABLE({df}) PARTITION BY ticker ORDER BY (date), 'close', 5, 5)", df=df)
    assert got.columns == ["ticker", "date", "close", "lag_5_days", "std_dev", "z_score"]
    twin = {(r.ticker, r.date): r for r in features.lag_zscore(df, "close", 5, 5, "date", ["ticker"], scalable=False).collect()}
    for r in got.collect():
        t = twin[r.ticker, r.date]
        for c in ("lag_5_days", "std_dev", "z_score"):
            assert r[c] == (None if t[c] is None else pytest.approx(t[c], abs=1e-9))
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM lag_zscore(TABLE({df}) PARTITION BY ticker ORDER BY (date), 'nope', 5, 5)", df=df).collect()


def _direct_mb(spark):
    """MB of off-heap buffers that the JVM's threads hold."""
    jvm = spark.sparkContext._jvm
    kind = jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean")
    pools = jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(kind)
    return sum(p.getMemoryUsed() for p in pools if p.getName() == "direct") / 1e6


@pytest.mark.parametrize("query", ["context_string", "render_prompt", "search_refresh_stream"])  # F1, F2, F3
def test_column_chunks_stay_out_of_the_threads_buffers(spark, tmp_path, query):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq
    from tidewater.suite.text import Q
    size = {"context_string": 24, "render_prompt": 32, "search_refresh_stream": 40}[query] << 20  # larger than what an earlier test left
    signs = np.frombuffer(b"!#$%&()*+,-./0123456789:;<=>?@[]^_{|}~", "u1")
    texts = ["alpha " + x.tobytes().decode() for x in np.random.default_rng(3).choice(signs, (2000, size // 2000))]
    rows = pa.table({"doc_id": range(2000), "text": texts, "lang": ["en"] * 2000})
    pq.write_table(rows, str(tmp_path / "documents.parquet"), compression="none", use_dictionary=False)
    pq.write_table(pa.table({"item_id": [7], "text": ["alpha"]}), str(tmp_path / "benchmark.parquet"))
    before = _direct_mb(spark)
    got = Q[query](spark, str(tmp_path)).collect()
    assert len(got) == (10 if query == "search_refresh_stream" else 1)
    assert _direct_mb(spark) < before + 20
    if query != "search_refresh_stream":
        assert "".join(f"Context document {n + 1}: {texts[n]} \n\n" for n in range(10)) in got[0][1]


def test_segments_have_small_row_groups(spark):  # F3
    import pyarrow.parquet as pq
    from pathlib import Path
    base = fresh(spark, "groups")
    docs = (spark.range(600).repartition(1).select(F.lit(5).alias("doc_id"), F.expr("transform(sequence(1, 1500), n -> translate(md5(concat(id, '-', n)), '0123456789', 'ghijklmnop'))").alias("w"))
            .select("doc_id", F.array_join("w", " ").alias("text"), F.lit("en").alias("lang")))
    index = search.build_index(docs, "doc_id", "text", ["lang"], base)
    groups = [f.row_group(n).total_byte_size for p in Path(base.removeprefix("file://")).rglob("blocks/*.parquet") for f in [pq.ParquetFile(p).metadata] for n in range(f.num_row_groups)]
    assert index.n_docs == 600 and sum(groups) > 30e6 and max(groups) < 24e6


def test_texts_of_few_hits_are_not_shuffled(spark, tmp_path):  # F2
    import numpy as np
    from tidewater.suite.text import Q
    letters = np.random.default_rng(5).choice(np.frombuffer(b"abcdefghij ", "u1"), (400, 2000))  # many terms
    docs = [(n, f"alpha {'beta ' * (n % 3)}" + x.tobytes().decode(), "en" if n % 5 else "de") for n, x in enumerate(letters)]
    docs += [(7, "alpha again", "en"), (None, "alpha beta", "en"), (500, None, "en")]
    schema, key = "doc_id long, text string, lang string", "spark.sql.autoBroadcastJoinThreshold"
    spark.createDataFrame(docs, schema).repartition(4).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "beta"), (2, "alpha beta"), (3, "none")], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    before, got = spark.conf.get(key), {}
    try:
        for most in ("100k", "-1"):  # few hits for the first, any number for the second
            spark.conf.set(key, most)
            df = Q["render_prompt"](spark, f"file://{tmp_path}")
            got[most] = sorted(map(tuple, df.collect()))
            assert ("hashpartitioning(doc_id" in df._jdf.queryExecution().executedPlan().toString()) == (most == "-1")
    finally:
        spark.conf.set(key, before)
    assert got["100k"] == got["-1"] and [r[0] for r in got["-1"]] == [1, 2]
    best = [i for i, _, lang in docs if i is not None and i < 400 and i % 3 == 2 and lang == "en"]
    assert all(p.count("Context document ") == 10 and sum(docs[i][1] in p for i in best) == 10 for _, p in got["-1"])


def test_manifest_needs_no_python_worker(spark):  # F2
    rows = search._manifest(spark, 3, [search.Segment("a", 0, 5, 9), search.Segment("b", 1, 0, 1 << 40)])
    assert "ExistingRDD" not in rows._jdf.queryExecution().toString() and rows.rdd.getNumPartitions() == 1
    assert [tuple(r) for r in rows.collect()] == [(3, "a", 0, 5, 9), (3, "b", 1, 0, 1 << 40)]
    assert rows.dtypes == spark.createDataFrame([], search.MANIFEST).dtypes
