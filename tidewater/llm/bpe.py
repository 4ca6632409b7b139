"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

``encode`` cuts long texts at positions where no match of the splitting pattern
can span the cut, so the ids of the pieces, put together, are the ids of the
whole text, and the encoder never sees more than about ``part_chars`` at once.
``decode`` returns raw bytes (a token may hold part of a character).

Defined results: null or empty text -> an empty id list; null ids -> empty bytes;
repeated rows and extra columns are passed through unchanged; text of any length
is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import list_of, map_arrow, slices

#: A cut is safe between a word character and white space, and between a letter
#: and a punctuation mark: the pattern joins white space or an apostrophe only to
#: what follows it, never to what stands before.
SAFE_CUT = re.compile(r"\w(?=[ \n\r\t])|[^\W\d_](?=[^\w\s'])")


def safe_parts(text: str, part_chars: int = 1 << 16):
    """The text in consecutive parts of at least ``part_chars`` characters, each
    ending at a safe cut (a run without one stays whole)."""
    at = 0
    while len(text) - at > part_chars:
        m = SAFE_CUT.search(text, at + part_chars - 1)
        if m is None:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:] if at else text


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


@functools.lru_cache(maxsize=2)
def _encoding(data: bytes, pattern: str):
    import tiktoken
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(data), special_tokens={})


def forget() -> None:
    """Drop what this worker process remembers."""
    _encoding.cache_clear()


def encode_text(encoding, text: str, part_chars: int = 1 << 16) -> list[int]:
    if len(text) <= part_chars:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text, part_chars):
        ids += encoding.encode_ordinary(part)
    return ids


def read_file(path: str) -> bytes:
    """The vocabulary on the driver; its bytes (about 1 MB, fixed) go to the tasks,
    so executors need no copy of the file."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
           out_col: str = "ids", part_chars: int = 1 << 16) -> DataFrame:
    """Replace ``text_col`` by ``out_col`` (array<int>), keeping all other columns."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_file(rank_file))
    keep = [f for f in docs.schema.fields if f.name not in (text_col, out_col)]
    schema = T.StructType(keep + [T.StructField(out_col, T.ArrayType(T.IntegerType(), False))])
    names = [f.name for f in keep]

    def run(batches):
        enc = _encoding(ranks.value, pattern)
        for batch in batches:
            for at, texts in slices(batch, text_col):
                lists = [encode_text(enc, x, part_chars) for x in texts]
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum()))
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [list_of(flat, sizes, pa.int32())], names + [out_col])

    return map_arrow(docs, [*names, text_col], run, schema)


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` (binary): the bytes of the tokens, without replacement."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_file(rank_file))
    keep = [f for f in encoded.schema.fields if f.name != out_col]
    schema = T.StructType(keep + [T.StructField(out_col, T.BinaryType())])
    names = [f.name for f in keep]

    def run(batches):
        enc = _encoding(ranks.value, pattern)
        for batch in batches:
            col = batch.column(ids_col)
            for at in range(0, len(col), 256):
                part = batch.slice(at, 256)
                out = [enc.decode_bytes(ids) if ids else b"" for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(out, pa.binary())], names + [out_col])

    return map_arrow(encoded, names, run, schema)
