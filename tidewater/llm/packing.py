"""Bounded-space online packing of tokenised documents into fixed-length sequences.

Each task keeps at most ``open_windows`` unfinished sequences.  A document first
fills whole sequences; its tail goes into the open window that it fills best.  If
no window can hold the tail, the fullest window is emitted (topped up with a cut
from the tail when ``top_up``) and its place is free again.  What is left open at
the end of a task is merged with the leftovers of other tasks in rounds of
``merge_fan`` tasks, each of bounded size, until one remains; the very last
window, if not full, is cut into power-of-two lengths, which need no padding.

Defined results: null text is an empty document, whose only token is the end
token; repeated rows are separate documents; an empty table gives no rows; only
the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import read_file, safe_parts
from .common import lean, slices, stored
from .words import WordMemory, gather, split_at

IDS = np.dtype("<u4")
SPACE_AFTER_SPACE = re.compile(r"\s ")
SPACE_LETTER = "\u0120"  # stands for a space in byte-level vocabularies


class WordEncoder:
    """Ids by the tokenizers library, remembered by word, ``max_words`` of them at most.

    Byte-level splitting never joins a space to the word before it, so a text may be
    encoded from space to space, and words not seen before are encoded many at a time:
    each starts with a space, and only its first token can."""

    def __init__(self, tok, max_words: int = 1 << 19, batch: int = 4096):
        self.tok, self.batch = tok, batch
        names = tok.get_vocab()
        self.spaced = np.zeros(max(names.values(), default=0) + 1, bool)
        self.spaced[[i for t, i in names.items() if t.startswith(SPACE_LETTER)]] = True
        self.memory = WordMemory(max_words)

    def direct(self, text: str) -> np.ndarray:
        return np.concatenate([np.array(self.tok.encode(x, add_special_tokens=False).ids, np.int32) for x in safe_parts(text)])

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space followed by each of the words, which hold no space, and their numbers."""
        ids, sizes = [], []
        for at in range(0, len(words), self.batch):
            some = words[at:at + self.batch]
            got = np.array(self.tok.encode(" " + " ".join(some), add_special_tokens=False).ids, np.int32)
            heads = np.flatnonzero(self.spaced[got])
            if len(heads) == len(some) and "" not in some:
                ids.append(got)
                sizes.append(np.diff(np.append(heads, len(got))))
            else:
                each = [self.direct(" " + w) for w in some]
                ids += each
                sizes.append(np.array([len(x) for x in each]))
        return np.concatenate(ids)[:, None], np.concatenate(sizes)

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end_id``, and their numbers.

        Texts in which no white space or NUL stands before a space are cut at every
        space, and each distinct word is looked up once; the others go one by one."""
        odd = [k for k, x in enumerate(texts) if "\0" in x or SPACE_AFTER_SPACE.search(x)]
        plain = list(texts)
        for k in odd:
            plain[k] = ""
        words, picked, starts = split_at(plain, " ")
        rows, sizes = self.memory.encode(words, self.learn)
        # the first word of a text has no space before it; odd texts stand in its place as a whole
        firsts = words.take(pa.array(picked[starts[:-1]])).to_pylist()
        lone = {w: k for k, w in enumerate(dict.fromkeys(firsts))}
        extra = [np.array(e.ids, np.int32) for e in self.tok.encode_batch(list(lone), add_special_tokens=False)]
        own = np.array([lone[w] for w in firsts], np.int64)
        own[odd] = np.arange(len(odd)) + len(extra)
        extra += [self.direct(texts[k]) for k in odd] + [np.array([end_id], np.int32)]
        picked[starts[:-1]] = own + len(words)
        picked = np.insert(picked, starts[1:], len(words) + len(extra) - 1)
        sizes = np.concatenate([sizes, [len(x) for x in extra]])
        ids = np.concatenate([rows[:, 0], *extra])[gather(np.cumsum(sizes) - sizes, sizes, picked)].astype(IDS)
        return ids, np.add.reduceat(sizes[picked], starts[:-1] + np.arange(len(texts)))


@functools.lru_cache(maxsize=1)
def _encoder(data: bytes) -> WordEncoder:
    """One for each worker process, whatever number of tasks it runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(data.decode("utf-8"))
    tok.encode_special_tokens = True  # their strings in a text are ordinary text
    return WordEncoder(tok)


def forget() -> None:
    """Drop what this worker process remembers."""
    _encoder.cache_clear()


class Window:
    """An open sequence: pieces (doc key, start, ids) in order."""

    __slots__ = ("pieces", "fill")

    def __init__(self):
        self.pieces, self.fill = [], 0

    def add(self, key, start: int, ids: np.ndarray):
        self.pieces.append((key, start, ids))
        self.fill += len(ids)


class OpenWindows:
    """Best-fit placement over a fixed number of open windows; ``emit`` gets each finished one."""

    def __init__(self, length: int, limit: int, emit, top_up: bool = True):
        self.length, self.limit, self.emit, self.top_up = length, limit, emit, top_up
        self.open: list[Window] = []

    def place(self, key, ids: np.ndarray, start: int = 0):
        length = self.length
        while len(ids) - start >= length:
            w = Window()
            w.add(key, start, ids[start:start + length])
            self.emit(w)
            start += length
        while start < len(ids):
            need = len(ids) - start
            best = max((w for w in self.open if w.fill + need <= length), key=lambda w: w.fill, default=None)
            if best is None and len(self.open) < self.limit:
                best = Window()
                self.open.append(best)
            if best is None:
                best = max(self.open, key=lambda w: w.fill)
                if self.top_up:
                    room = length - best.fill
                    best.add(key, start, ids[start:start + room])
                    start += room
            else:
                best.add(key, start, ids[start:].copy())  # not a view that keeps the whole slice
                start = len(ids)
                if best.fill < length:
                    return
            self.open.remove(best)
            self.emit(best)


PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
         T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
         T.StructField("ids", T.BinaryType()), T.StructField("task", T.LongType()), T.StructField("done", T.BooleanType())]
ARROW = [pa.int64()] * 6 + [pa.binary(), pa.int64(), pa.bool_()]


class Rows:
    """Output rows of windows, flushed as Arrow batches of bounded size.  A piece's
    key is (doc_id scalar, doc_tokens).  sequence_id: round, task and a counter."""

    def __init__(self, id_col: str, id_type: pa.DataType, task: int, round_no: int, keep_ids: bool):
        self.names = [id_col] + [f.name for f in PIECE]
        self.id_type, self.task, self.keep_ids = id_type, task, keep_ids
        self.next = (round_no << 58) | (task << 32)
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, w: Window, done: bool = True):
        offset = 0
        for (doc, total), start, ids in w.pieces:
            raw = ids.tobytes()
            kept = raw if self.keep_ids or not done else None
            crc = None if kept is not None else zlib.crc32(raw)  # of kept ids Spark takes it
            self.rows.append((doc, start, len(ids), crc, total, self.next, offset, kept, self.task, done))
            self.bytes += len(kept or b"") + 80
            offset += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) if self.rows else [()] * len(self.names)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [self.id_type] + ARROW)], self.names)


def pack(docs: DataFrame, tokenizer_file: str, seq_len: int = 1024, end_id: int = 0, open_windows: int = 64,
         top_up: bool = True, keep_ids: bool = True, merge_fan: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, with ``keep_ids``, ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast(read_file(tokenizer_file))
    id_field = docs.schema[id_col]
    schema = T.StructType([T.StructField(id_col, id_field.dataType)] + PIECE)

    def first(batches):
        encoder, rows, windows = _encoder(vocab.value), None, None
        for batch in batches:
            if rows is None:
                rows = Rows(id_col, batch.column(id_col).type, TaskContext.get().partitionId(), 0, keep_ids)
                windows = OpenWindows(seq_len, open_windows, rows.add, top_up)
            ids_in = batch.column(id_col).to_pylist()
            for at, texts in slices(batch, text_col, 2 << 20):
                flat, counts = encoder.encode(texts, end_id)
                stops = np.cumsum(counts).tolist()
                for i, (a, b) in enumerate(zip([0, *stops], stops)):
                    windows.place((ids_in[at + i], b - a), flat[a:b])
                    if rows.bytes > 8 << 20:
                        yield rows.batch()
        if rows is not None:
            for w in windows.open:
                rows.add(w, done=False)
            yield rows.batch()

    def merge(round_no: int, last: bool):
        def run(batches):
            rows = merger = None
            current, window = None, None

            def place(w):  # the whole leftover if some window has room for it, else its pieces, cut where they must be
                best = max((o for o in merger.open if o.fill + w.fill <= seq_len), key=lambda o: o.fill, default=None)
                if best is not None:
                    for p in w.pieces:
                        best.add(*p)
                    if best.fill == seq_len:
                        merger.open.remove(best)
                        merger.emit(best)
                    return
                for key, start, ids in w.pieces:
                    room = [o for o in merger.open if o.fill < seq_len]
                    while len(ids):
                        o = max(room, key=lambda o: o.fill, default=None)
                        if o is None:
                            o = Window()
                            merger.open.append(o)
                            room.append(o)
                        take = min(seq_len - o.fill, len(ids))
                        o.add(key, start, ids[:take])
                        start, ids = start + take, ids[take:]
                        if o.fill == seq_len:
                            merger.open.remove(o)
                            room.remove(o)
                            merger.emit(o)

            for batch in batches:
                if rows is None:
                    rows = Rows(id_col, batch.column(id_col).type, TaskContext.get().partitionId(), round_no, keep_ids)
                    merger = OpenWindows(seq_len, 1, rows.add, True)
                for r in batch.select([id_col, "start", "doc_tokens", "sequence_id", "ids", "task"]).to_pylist():
                    rows.task = r["task"]
                    if r["sequence_id"] != current:
                        if window is not None:
                            place(window)
                        current, window = r["sequence_id"], Window()
                    window.add((r[id_col], r["doc_tokens"]), r["start"], np.frombuffer(r["ids"], IDS))
                    if rows.bytes > 8 << 20:
                        yield rows.batch()
            if rows is None:
                return
            place(window)
            for w in merger.open:
                if not last:
                    rows.add(w, done=False)
                else:
                    for part in powers_of_two(w):
                        rows.add(part)
            yield rows.batch()
        return run

    crc = F.crc32("ids").alias("ids_crc32") if keep_ids else "ids_crc32"
    columns = [id_col, "start", "length", crc, "doc_tokens", "sequence_id", "offset"] + (["ids"] if keep_ids else [])
    table = stored(docs.select(id_col, text_col).mapInArrow(lean(first, "packing"), schema), "packed")
    out = [table.filter("done").select(*columns)]
    groups = 1 + (table.agg(F.max("task")).first()[0] or 0)
    round_no = 0
    while True:
        round_no += 1
        groups = -(-groups // merge_fan)
        left = (table.filter("not done").withColumn("task", F.floor(F.col("task") / merge_fan).cast("long"))
                .repartitionByRange(groups, "task").sortWithinPartitions("task", "sequence_id", "offset"))
        table = stored(left.mapInArrow(lean(merge(round_no, groups == 1), "packing"), schema), "packed")
        out.append(table.filter("done").select(*columns))
        if groups == 1:
            break
    return functools.reduce(DataFrame.unionAll, out)


def powers_of_two(w: Window):
    """The window's tokens in windows whose lengths are the powers of two that sum to its fill."""
    bits = [1 << b for b in reversed(range(w.fill.bit_length())) if w.fill >> b & 1]
    part = Window()
    for key, start, ids in w.pieces:
        while len(ids):
            take = min(bits[0] - part.fill, len(ids))
            part.add(key, start, ids[:take])
            start, ids = start + take, ids[take:]
            if part.fill == bits[0]:
                yield part
                bits.pop(0)
                part = Window()
