"""SentencePiece encoding that keeps the place of every piece in the original text.

A text is first normalised here, with the rules stored in the model: user-defined
symbols, then the longest prefix found in the compiled character map (a double-array
trie with its replacement strings), else one character as it is; spaces are escaped,
doubled ones removed and a dummy prefix put in front where the model says so.  For
each normalised byte the byte of the original is recorded where it came from.  The
normalised text is then cut into pieces by the library, and the ends of the pieces
are projected through that record: ``begins`` and ``ends`` are byte offsets into the
original UTF-8 text (of a character spelled in byte pieces, the last piece has the
character and those before it are empty, as in the library's own offsets).

Where the model merges by rank and none of its pieces holds an escaped space after
another character, no piece can span the place before a run of escaped spaces.  Texts
are then cut at such places, each distinct word of a slice is encoded once, and a bounded
number of words is remembered; texts with runs are cut into parts of about
``part_chars`` characters.  With other models texts are encoded whole.

Defined results: null or empty text has no pieces but the end id, when that is asked
for, and decodes to empty text; repeated rows are encoded alike and extra columns are
passed through; text of any length is encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import read_file
from .common import lean, list_of, map_arrow, slices
from .words import WordMemory, gather, split_at

#: The escaped space, U+2581.
SPACE = "▁"
RUN_START = re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
# Fixed values of the public model format: field numbers and kinds of pieces.
PIECES, TRAINER, NORMALISER = 1, 2, 3
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6
BPE_MODEL = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def message(data: bytes):
    """(field number, value) of each field of a serialised message: bytes or int."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class CharMap:
    """A compiled character map: longest-prefix lookup in a double-array trie."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    def __bool__(self):
        return bool(self.units)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that ``data`` has at ``at``."""
        units, found = self.units, None
        node = self._offset(units[0])
        for end in range(at, len(data)):
            byte = data[end]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        start, length = found
        return self.strings[start:self.strings.index(b"\0", start)], length

    def touches(self, byte: int) -> bool:
        """Whether a key starts with this ASCII byte."""
        units = self.units
        node = self._offset(units[0]) ^ byte
        return node < len(units) and units[node] & 0x800000FF == byte


class Normaliser:
    """The model's normalisation, with the original byte of each normalised byte."""

    def __init__(self, spec: bytes, symbols: tuple[str, ...] = (), suffix: bool = False):
        # Fixed field numbers: 2 character map, 3 dummy prefix, 4 remove extra spaces, 5 escape spaces.
        fields = dict(message(spec))
        self.map = CharMap(fields.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(fields.get(n, 1)) for n in (3, 4, 5))
        self.suffix = suffix
        self.symbols = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(symbols, key=len, reverse=True))) if symbols else None
        self.space = SPACE.encode() if self.escape else b" "
        self.simple = not self.map and self.symbols is None and not self.squeeze and self.escape and not suffix
        self.changed = bytes(b for b in range(128) if self.map and (self.map.touches(b) or self.map.longest(bytes((b,)), 0)))

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the byte of ``data``."""
        if not data:
            return b"", np.zeros(1, np.int32)
        if self.simple:
            norm = data.replace(b" ", self.space)
            width = np.where(np.frombuffer(data, np.uint8) == 32, 3, 1)
            at = np.repeat(np.arange(len(data), dtype=np.int32), width)
            if self.prefix:
                return self.space + norm, np.concatenate([np.zeros(3, np.int32), at, np.array([len(data)], np.int32)])
            return norm, np.append(at, np.int32(len(data)))
        return self._general(data)

    def prefixes(self, data: bytes):
        """(normalised, start, length) of the consecutive stretches of ``data``.  A stretch
        of more than one character has no replacement and holds no space."""
        at, size = 0, len(data)
        while at < size:
            if self.symbols and (m := self.symbols.match(data, at)):
                yield m[0], at, len(m[0])
                at = m.end()
                continue
            got = self.map.longest(data, at) if self.map else None
            if got:
                yield got[0], at, got[1]
                at += got[1]
                continue
            end = at + 1
            if data[at] < 0x80:
                while (self.symbols is None and data[at] != 32 and end < size and data[end] < 0x80 and data[end] != 32
                       and data[end] not in self.changed):
                    end += 1
            else:
                while end < size and data[end] & 0xC0 == 0x80:
                    end += 1
            yield data[at:end], at, end - at
            at = end

    def _general(self, data: bytes) -> tuple[bytes, np.ndarray]:
        out, at, consumed = bytearray(), [], 0
        after_space, started = self.squeeze, False

        def space():
            out.extend(self.space)
            at.extend([consumed] * len(self.space))

        for text, consumed, length in self.prefixes(data):
            if not started:
                if self.squeeze and text == b" ":
                    continue
                started = True
                if self.prefix and not self.suffix:
                    space()
            if after_space:
                text = text.lstrip(b" ")
            if text:
                plain = length > 1 and text == data[consumed:consumed + length] and data[consumed] < 0x80
                if plain and b" " not in text:
                    out.extend(text)
                    at.extend(range(consumed, consumed + length))
                else:
                    for byte in text:
                        if byte == 32:
                            space()
                        else:
                            out.append(byte)
                            at.append(consumed)
                after_space = text.endswith(b" ")
            after_space &= self.squeeze
        if not started:
            return b"", np.zeros(1, np.int64)
        consumed = len(data)
        if self.squeeze:
            while out.endswith(self.space):
                cut = len(out) - len(self.space)
                consumed = at[cut]
                del out[cut:], at[cut:]
        if self.prefix and self.suffix:
            space()
        at.append(consumed)
        return bytes(out), np.array(at, np.int32)


class PieceEncoder:
    """Pieces of texts by one model; at most ``max_words`` words are remembered."""

    def __init__(self, model: bytes, part_chars: int = 100, max_words: int = 1 << 18):
        from sentencepiece import SentencePieceProcessor

        kinds, names, spec, trainer = [], [], b"", b""
        for field, value in message(model):
            if field == PIECES:
                piece = dict(message(value))
                names.append(piece[1].decode("utf-8"))
                kinds.append(piece.get(3, 1))
            elif field == NORMALISER:
                spec += value
            elif field == TRAINER:
                trainer += value
        options, kinds = dict(message(trainer)), np.array(kinds)
        self.normalise = Normaliser(spec, tuple(n for n, k in zip(names, kinds) if k == USER_DEFINED), bool(options.get(24, 0)))
        # The same model without its normalisation: later fields of a message replace earlier ones.
        off = b"\x12\x00\x18\x00\x20\x00\x28\x00"
        self.core = SentencePieceProcessor(model_proto=model + bytes((NORMALISER << 3 | 2, len(off))) + off)
        self.end_id = self.core.eos_id()
        self.sizes = np.array([len(n.encode("utf-8")) for n in names], np.int64)
        self.byte = np.full(len(names), -1)
        self.byte[kinds == BYTE] = [int(n[1:-1], 16) for n, k in zip(names, kinds) if k == BYTE]
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0]) if (kinds == UNKNOWN).any() else -1
        self.by_word = (options.get(3, 1) == BPE_MODEL and self.normalise.escape
                        and not any(SPACE in n.lstrip(SPACE) for n in names))
        self.part_chars, self.memory = part_chars, WordMemory(max_words, 2)

    def parts(self, text: str):
        """A normalised text, cut before runs of escaped spaces."""
        at = 0
        while self.by_word and len(text) - at > self.part_chars:
            cut = RUN_START.search(text, at + self.part_chars)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        if at < len(text):
            yield text[at:]

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        """Normalised bytes of each piece.  Of the byte pieces of a character the last has all."""
        size, byte = self.sizes[ids], self.byte[ids]
        spelled = byte >= 0
        if spelled.any():
            inside = spelled & (byte & 0xC0 == 0x80)
            place = np.arange(len(ids))
            lead = np.maximum.accumulate(np.where(inside, 0, place))
            size = np.where(spelled, np.where(np.append(inside[1:], False), 0, place - lead + 1), size)
        return size

    def learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The (id, length) pairs of all parts, without normalisation, and the number for each."""
        lists = self.core.encode(parts, num_threads=1)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(counts.sum()))
        sizes = self.lengths(ids)
        if self.unknown >= 0 and (ids == self.unknown).any():  # their length is not that of their name
            seen = [self.core.encode(p, return_type="proto").pieces for p in parts]
            ids, counts = np.array([p.id for s in seen for p in s], np.int32), np.array([len(s) for s in seen])
            sizes = np.array([p.end - p.begin for s in seen for p in s], np.int64)
        return np.stack([ids, sizes], axis=1).astype(np.int32), counts

    def pairs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The (id, length) pairs of normalised texts, and their number for each text."""
        odd = [k for k, x in enumerate(texts) if not self.by_word or SPACE + SPACE in x]
        plain = list(texts)
        for k in odd:
            plain[k] = ""
        words, picked, starts = split_at(plain, SPACE)
        rows, sizes = self.memory.encode(words, lambda fresh: self.learn([SPACE + w for w in fresh]))
        # the first word of a text has no space before it; odd texts stand in its place as a whole
        firsts = words.take(pa.array(picked[starts[:-1]])).to_pylist()
        lone = {w: k for k, w in enumerate(dict.fromkeys(firsts))}
        cut = [list(self.parts(texts[k])) for k in odd]
        more_rows, more = self.learn([*lone, *itertools.chain.from_iterable(cut)])
        bounds = np.concatenate([np.arange(len(lone)), len(lone) + np.cumsum([0] + [len(ps) for ps in cut])[:-1]]).astype(np.int64)
        whole = np.concatenate([[0], np.cumsum(more)])
        own = np.array([lone[w] for w in firsts], np.int64)
        own[odd] = np.arange(len(odd)) + len(lone)
        picked[starts[:-1]] = own + len(words)
        sizes = np.concatenate([sizes, np.diff(whole[np.append(bounds, len(more))])])
        pairs = np.concatenate([rows, more_rows])[gather(np.cumsum(sizes) - sizes, sizes, picked)]
        return pairs, np.add.reduceat(sizes[picked], starts[:-1])

    def encode(self, texts: list[str], add_end: bool = True):
        """For each text its ids, begins and ends (int32 arrays)."""
        norms = [self.normalise(t.encode("utf-8")) for t in texts]
        pairs, counts = self.pairs([n.decode("utf-8") for n, _ in norms])
        ids, sizes = pairs[:, 0], pairs[:, 1]
        bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
        end = np.array([self.end_id], np.int32) if add_end else np.empty(0, np.int32)
        for (_, at), a, b in zip(norms, bounds, bounds[1:]):
            stops = at[np.concatenate([[0], np.cumsum(sizes[a:b])])].astype(np.int32)
            last = np.full(len(end), at[-1], np.int32)
            yield np.concatenate([ids[a:b], end]), np.concatenate([stops[:-1], last]), np.concatenate([stops[1:], last])


@functools.lru_cache(maxsize=1)
def _encoder(model: bytes) -> PieceEncoder:
    """One for each worker process, whatever number of tasks it runs."""
    return PieceEncoder(model)


def forget() -> None:
    """Drop what this worker process remembers."""
    _encoder.cache_clear()


def encode(docs: DataFrame, model_file: str, text_col: str = "text", add_end: bool = True, ids_col: str = "ids",
           begins_col: str = "begins", ends_col: str = "ends", slice_bytes: int = 1 << 20) -> DataFrame:
    """Replace ``text_col`` by the ids of its pieces and their first and last byte offsets
    in the text (array<int> each), keeping all other columns."""
    model = docs.sparkSession.sparkContext.broadcast(read_file(model_file))
    new = [ids_col, begins_col, ends_col]
    keep = [f for f in docs.schema.fields if f.name not in (text_col, *new)]
    schema = T.StructType(keep + [T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in new])
    names = [f.name for f in keep]

    def run(batches):
        encoder = _encoder(model.value)
        for batch in batches:
            for at, texts in slices(batch, text_col, slice_bytes):
                rows = list(encoder.encode(texts, add_end))
                sizes = np.array([len(r[0]) for r in rows])
                lists = [list_of(np.concatenate([r[k] for r in rows]), sizes, pa.int32()) for k in range(3)]
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + lists, names + new)

    return map_arrow(docs, [*names, text_col], lean(run, "pieces"), schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded", slice_ids: int = 1 << 18) -> DataFrame:
    """Add ``out_col`` (string): the text of the ids, control ids left out."""
    model = encoded.sparkSession.sparkContext.broadcast(read_file(model_file))
    keep = [f for f in encoded.schema.fields if f.name != out_col]
    schema = T.StructType(keep + [T.StructField(out_col, T.StringType())])
    names = [f.name for f in keep]

    def run(batches):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_proto=model.value)
        for batch in batches:
            col = batch.column(ids_col)
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(col), 0)))
            at = 0
            while at < len(col):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + slice_ids, side="right")))
                lists = [x or [] for x in col.slice(at, stop - at).to_pylist()]
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(sp.decode(lists), pa.string())], names + [out_col])
                at = stop

    return map_arrow(encoded, names, lean(run, "pieces"), schema)
