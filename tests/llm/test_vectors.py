"""Hard negatives and vector codes against brute force."""
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import anchors, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label string, code string, `row` long, __n int"


def _clustered(n, dim, seed, spread=0.2):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(8, dim))
    return centres[g.integers(0, 8, n)] + spread * g.normal(size=(n, dim))


def _frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else list(v), l, "clash", 1, 2) for i, v, l in rows], SCHEMA)


def _edge_rows(dim):
    nan, inf = float("nan"), float("inf")
    return [(9900, None, "a"), (9901, [], "a"), (9902, [nan] * dim, "a"), (9903, [inf] + [0.0] * (dim - 1), "b"), (9904, [1.0] * (dim + 1), "b"),
            (9905, [None] + [0.5] * (dim - 1), "b"), (9906, [0.0] * dim, None), (9907, [0.25] * dim, "a"), (9907, [0.25] * dim, "a"),
            (9908, [1e300] + [0.0] * (dim - 1), "b"), (None, [0.5] * dim, "b")]


def test_tree_balls_cover_and_sum():
    for points in (np.floor(_clustered(700, 4, 1) * 4096).astype(np.int64), np.zeros((300, 2), np.int64), np.arange(40)[:, None], np.zeros((1, 3), np.int64)):
        t = anchors.Tree(points, 8)
        assert sorted(t.order.tolist()) == list(range(len(points)))
        laid = points[t.order]
        for b, e, left, right, radius, total in zip(t.begin, t.end, t.left, t.right, t.radius, t.total):
            assert (laid[b:e].sum(0) == total).all()
            assert np.sqrt(((laid[b:e] - total / (e - b)) ** 2).sum(1)).max() <= radius + 1e-6
            if left >= 0:
                assert (t.begin[left], t.end[left], t.end[right]) == (b, t.begin[right], e)


def test_assignment_equals_brute_force_also_for_ties_and_equal_entries():
    g = np.random.default_rng(2)
    for trial in range(30):
        points = g.integers(-3, 4, (200, 2)) if trial % 2 else np.floor(_clustered(400, 8, trial) * 4096).astype(np.int64)
        book = points[g.integers(0, len(points), 16)]
        t = anchors.Tree(points, 8)
        balls = [np.array(getattr(t, n)) for n in anchors.NODES[1:]]
        code, sums, counts = anchors.assign(points[t.order], *balls, book)
        want = ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)
        assert (code == want[t.order]).all()
        assert (counts == np.bincount(want, minlength=16)).all()
        assert (sums == np.stack([points[want == k].sum(0) for k in range(16)])).all()


def _brute_codes(rows, parts, entries, rounds, scale, limit):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    x = [[max(-limit, min(limit, math.floor(scale * c))) if abs(c) < 1e9 else limit for c in v] for _, v, _ in rows]
    w = len(x[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for v in x] for p in range(parts)]
    books = [cut[p][:entries] for p in range(parts)]

    def near(v, book):
        return min(range(len(book)), key=lambda k: (sum((a - b) ** 2 for a, b in zip(v, book[k])), k))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(v, books[p]) for v in cut[p]]
            books[p] = [[sum(c) // len(c) for c in zip(*[v for v, o in zip(cut[p], own) if o == k])] if k in own else books[p][k] for k in range(len(books[p]))]
    out = []
    for n, (i, _, l) in enumerate(rows):
        own = [near(cut[p][n], books[p]) for p in range(parts)]
        out.append((i, l, "".join(f"{o:02x}" for o in own), sum((a - b) ** 2 for p in range(parts) for a, b in zip(cut[p][n], books[p][own[p]]))))
    return out, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


@pytest.mark.parametrize("n,block_rows", [(400, 64), (60, 2048), (7, 2048)])
def test_vector_codes_equal_brute_force(spark, n, block_rows):
    dim = 8
    rows = [(k * 3, v.tolist(), "abc"[k % 3] if k % 7 else None) for k, v in enumerate(_clustered(n, dim, 4))]
    df = _frame(spark, rows + _edge_rows(dim)).repartition(3)
    coded, book = anchors.compress(df, parts=4, entries=16, rounds=6, scale=4096, block_rows=block_rows)
    good = [r for r in rows + _edge_rows(dim) if r[0] not in (9900, 9901, 9902, 9903, 9904, 9905)]
    want, digest = _brute_codes(good, 4, 16, 6, 4096, anchors.Blocks(dim, 4, 4096).limit)
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[3])
    assert sorted(map(tuple, coded.collect()), key=key) == sorted(want, key=key)
    assert anchors.codebooks_digest(book) == digest
    per = {}
    for _, l, _, e in want:
        per[l] = per.get(l, 0) + e
    for share in (2, 256):
        got = anchors.label_errors(coded, share).collect()
        assert len(got) == len(want) and all(r["label_error"] == per[r["label"]] for r in got)


def test_vector_codes_of_nothing(spark):
    coded, book = anchors.compress(_frame(spark, []))
    assert coded.collect() == [] and book.size == 0 and anchors.label_errors(coded).collect() == []
    assert anchors.compress(_frame(spark, [(1, [1.0, 2.0, 3.0], "a")]), parts=2)[0].collect() == []


def test_cover_tree_covers_and_bounds():
    g = np.random.default_rng(3)
    for points in (np.floor(_clustered(900, 6, 5) * 256), g.integers(-5, 6, (500, 3)).astype(float), np.zeros((200, 2)), np.ones((1, 4))):
        label = g.integers(0, 3, len(points))
        order, balls, length = hard_negatives.cover_tree(points, label, leaf=8, fan=32)
        assert sorted(order.tolist()) == list(range(len(points)))
        laid, queries = points[order], np.floor(_clustered(5, points.shape[1], 6) * 256)
        centres = laid[balls[:, hard_negatives.CENTRE].astype(int)]
        low, top = hard_negatives.bounds(centres, balls[:, hard_negatives.RADIUS], length, queries)
        seen = np.zeros(len(points), int)
        for k, b in enumerate(balls):
            a, e = int(b[hard_negatives.BEGIN]), int(b[hard_negatives.END])
            product = queries @ laid[a:e].T
            assert (product.max(1) <= top[:, k]).all() and (product.min(1) >= low[:, k]).all()
            assert (label[order[a:e]].min(), label[order[a:e]].max()) == (b[hard_negatives.LOW], b[hard_negatives.HIGH])
            if not b[hard_negatives.CHILDREN]:
                seen[a:e] += 1
        assert (seen == 1).all()


def _brute_negatives(rows, scale, limit, anchor, n_pos=5, n_neg=5):
    x = [(k, i, l, [max(-limit, min(limit, math.floor(scale * c))) if abs(c) < 1e9 else limit for c in v]) for k, (i, v, l) in enumerate(rows)]
    out = []
    for k, i, l, v in x:
        if i % anchor:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for n, j, m, w in x if n != k), key=lambda r: r[:2])
        for s, j, m in [r for r in scored if r[2] == l][:n_pos]:
            found = [r for r in scored if r[2] != l and 80 * -s <= 100 * -r[0] <= 100 * -s][:n_neg]
            out += [(i, j, n + 1, r[1], -s, -r[0]) for n, r in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,group_rows,spread", [(50, 200, 0.2), (4096, 1 << 17, 0.2), (64, 1 << 17, 2.0)])
def test_hard_negatives_equal_brute_force(spark, block_rows, group_rows, spread):
    dim = 6
    rows = [(k, v.tolist(), "abcd"[k % 4]) for k, v in enumerate(_clustered(600, dim, 7, spread))]
    rows += [(k + 600, rows[k][1], "abcd"[(k + 1) % 4]) for k in range(0, 200)]  # ties and equal vectors of other labels
    df = _frame(spark, rows + _edge_rows(dim)).repartition(3)
    good = [r for r in rows + _edge_rows(dim) if r[0] is not None and r[2] is not None and r[0] not in (9900, 9901, 9902, 9903, 9904, 9905)]
    want = _brute_negatives(good, 256, math.isqrt((1 << 53) // dim), 20)
    got = hard_negatives.mine(df, F.col("vec_id") % 20 == 0, block_rows=block_rows, group_rows=group_rows)
    assert sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got.collect()) == want
    assert len(want) > 100


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(_frame(spark, []), F.col("vec_id") % 2 == 0).collect() == []
    one = _frame(spark, [(2, [1.0, 2.0], "a")])
    assert hard_negatives.mine(one, F.col("vec_id") % 2 == 0).collect() == []
