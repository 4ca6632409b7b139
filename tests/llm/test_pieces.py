"""Offset-preserving SentencePiece encoding against the library."""
import hashlib
import random

import numpy as np
import public_tokenizers as PT
import pyarrow as pa
import pytest
import sentencepiece as S
from pyspark.sql import functions as F

from tidewater.llm import pieces, suite, words

SF = "/root/testdata/sf0.001"
MODEL = open(PT.path("piece_bpe_32k.model"), "rb").read()
CHARS = [*"ab eé  中🙂\U00010348\x00▁\t\n<s>ﬁＨ①㍿", "é", " ", " ", "  ", "the", "</s>", "　", "ｶﾞ", " ", "a 1b"]


def _field(number, data):
    size, out = len(data), b""
    while True:
        size, low = size >> 7, size & 127
        out += bytes([low | (128 if size else 0)])
        if not size:
            return bytes([number << 3 | 2]) + out + data


def _models():
    yield "plain", MODEL
    yield "symbol", MODEL + _field(1, b"\x0a\x04a 1b\x15\x00\x00\x00\x00\x18\x04")
    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        for squeeze in (0, 1):
            n = S.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=bool(squeeze), escape_whitespaces=True, remove_extra_whitespaces=bool(squeeze))
            spec = n.serialized_normalizer_spec
            spec = spec() if callable(spec) else spec
            yield f"{rule}-{squeeze}", MODEL + _field(3, spec) + _field(3, bytes([0x18, squeeze, 0x20, squeeze, 0x28, 1]))


@pytest.mark.parametrize("name,model", list(_models()), ids=lambda x: x if isinstance(x, str) else "")
def test_pieces_and_offsets_equal_the_library(name, model):
    lib, ours, r = S.SentencePieceProcessor(model_proto=model), pieces.PieceEncoder(model), random.Random(5)
    texts = ["".join(r.choice(CHARS) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(r.choice(CHARS) for _ in range(5000)), "x" * 3000, " " * 700, "  a"]
    for text, (ids, begins, ends) in zip(texts, ours.encode(texts, add_end=False)):
        want = lib.encode(text, return_type="proto").pieces
        assert (ids.tolist(), begins.tolist(), ends.tolist()) == ([p.id for p in want], [p.begin for p in want], [p.end for p in want]), text[:80]


def test_character_map_takes_the_longest_key():
    n = S.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    spec = n.serialized_normalizer_spec
    norm = pieces.Normaliser(spec() if callable(spec) else spec)
    text = "ｶﾞ ｶ é ㍿"
    got, at = norm(text.encode())
    want, offsets = n.normalize(text, with_offsets=True)
    assert got.decode() == want
    first = [len(want[:k].encode()) for k in range(len(want) + 1)]
    assert [len(text.encode()[:at[b]].decode()) for b in first] == list(offsets)


def test_pieces_on_edge_rows(spark):
    model = PT.path("piece_bpe_32k.model")
    rows = [(1, None, "a"), (2, "", "b"), (3, "Hé  中x🙂\U00010348", "c"), (3, "Hé  中x🙂\U00010348", "c"), (None, "word " * 40_000, None), (5, "x" * 50_000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string").withColumn("ids", F.lit("clash")).withColumnRenamed("x", "a.b")
    out = pieces.decode(pieces.encode(df, model), model).collect()
    lib = S.SentencePieceProcessor(model_file=model)
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"], r["a.b"]) for r in out) == sorted(
        (str(i), lib.encode(t or "", add_eos=True), lib.decode(lib.encode(t or "", add_eos=True)), x) for i, t, x in rows)
    for r in out:
        data = {1: b"", 2: b"", 3: rows[2][1].encode(), None: rows[4][1].encode(), 5: rows[5][1].encode()}[r["doc_id"]]
        assert b"".join(data[a:b] for a, b in zip(r["begins"], r["ends"])) == data
    assert pieces.encode(df.filter("false"), model, add_end=False).collect() == []


def test_op11_equals_the_library(spark):
    lib = S.SentencePieceProcessor(model_file=PT.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r for r in suite.op11_pieces(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = lib.encode(d["text"] or "", add_eos=True)
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["text_bytes"]) == (len(ids), len((d["text"] or "").encode()))
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_word_memory_gives_what_was_learnt_also_when_full():
    r, memory, asked = random.Random(2), words.WordMemory(max_words=60, width=2), []

    def learn(some):
        asked.extend(some)
        rows = [[len(w), k] for w in some for k in range(len(w) % 4)]
        return np.array(rows, np.int32).reshape(-1, 2), np.array([len(w) % 4 for w in some], np.int64)

    for _ in range(30):
        some = list(dict.fromkeys("".join(r.choice("abé ") for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(0, 40))))
        rows, sizes = memory.encode(pa.array(some, pa.large_string()), learn)
        want_rows, want_sizes = learn(some)
        del asked[len(asked) - len(some):]
        assert sizes.tolist() == want_sizes.tolist() and rows.tolist() == want_rows.tolist() and len(memory.keys) <= 60
    assert len(asked) > len(set(asked))  # it was full and started anew
    big, few = words.WordMemory(width=2), ["a", "b", "a" * 50]
    for _ in range(2):
        asked.clear()
        big.encode(pa.array(few, pa.large_string()), learn)
    assert asked == []


def test_words_differ_by_bytes_and_length():
    some = ["", "a", "aa", "ab", "ba", "\x00", "\x00\x00", "abc" * 9, "abc" * 10] + [f"w{k}" for k in range(20_000)]
    for h in words.WordMemory().hashes(pa.array(some, pa.large_string())):
        assert len(set(h.tolist())) == len(some)
    part = pa.array(["x", *some, "y"], pa.large_string()).slice(1, len(some))
    assert [h.tolist() for h in words.WordMemory().hashes(part)] == [h.tolist() for h in words.WordMemory().hashes(pa.array(some, pa.large_string()))]
