"""Document quality from a small byte-level convolutional network in numpy.

Every byte of the text is embedded, learned filters of ``WIDTH`` bytes run over it
at every second byte, and their responses are max-pooled in chunks of 256 bytes
that overlap by 64 and cover the whole document.  A hidden layer reads each chunk;
the mean and the maximum of its units over all chunks give one probability.

The network is trained here, on the driver, from at most ``max_rows`` labelled rows
(the rows with the smallest hash of their id, a bounded sample); scoring reads
whole texts in the tasks.  Only text bytes enter a score.

Defined results: null and empty texts are one chunk of padding and get a score
like any other; with no labelled rows every score is 0.5, and with labels of one
class only, that class's smoothed share; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, lean, slices

WIDTH, STEP, PAD = 8, 2, 256
BLOCK, PER_CHUNK, HOP = 64, 4, 3   # a chunk is 4 blocks of 64 bytes, the next starts 3 blocks on
SLICE = 1 << 17                    # bytes convolved at once


def flatten(texts: list[bytes]):
    """All texts in one byte buffer, each padded to whole blocks with at least a
    filter's width of padding and followed by one block of padding that belongs to
    none, so that no window crosses texts; returns the buffer and the blocks of each text."""
    blocks = np.array([(len(x) + WIDTH + BLOCK - 1) // BLOCK for x in texts], np.int64)
    buf = np.full(int((blocks + 1).sum()) * BLOCK + WIDTH, PAD, np.int16)
    at = 0
    for x, n in zip(texts, blocks):
        buf[at:at + len(x)] = np.frombuffer(x, np.uint8)
        at += int(n + 1) * BLOCK
    return buf, blocks


def chunk_index(blocks: np.ndarray):
    """For each chunk the indexes of its blocks (repeating the last one at a text's
    end), and the first chunk of each text."""
    chunks = np.maximum(1, -(-(blocks - 1) // HOP))
    first_chunk = np.cumsum(chunks) - chunks
    first_block = np.cumsum(blocks + 1) - (blocks + 1)  # a block of padding follows each text
    number = np.arange(int(chunks.sum())) - np.repeat(first_chunk, chunks)
    local = number[:, None] * HOP + np.arange(PER_CHUNK)
    local = np.minimum(local, np.repeat(blocks - 1, chunks)[:, None])
    return local + np.repeat(first_block, chunks)[:, None], first_chunk, chunks


class ByteCNN:
    def __init__(self, embed: int = 6, filters: int = 24, hidden: int = 16, seed: int = 7):
        g = np.random.default_rng(seed)
        normal = lambda *s: g.standard_normal(s).astype(np.float32)
        self.p = {"E": normal(257, embed) * 0.5, "W": normal(WIDTH * embed, filters) / np.sqrt(WIDTH * embed) * 1.5,
                  "b": np.zeros(filters, np.float32), "V": normal(filters, hidden) / np.sqrt(filters) * 1.4,
                  "c": np.zeros(hidden, np.float32), "u": normal(2 * hidden) * 0.1, "u0": np.zeros(1, np.float32)}
        self.fixed: float | None = None  # a constant score when nothing could be learned

    def block_max(self, buf: np.ndarray) -> np.ndarray:
        """The filters' largest response in each block, a bounded slice at a time."""
        E, W, b = self.p["E"], self.p["W"], self.p["b"]
        dim, n = E.shape[1], (len(buf) - WIDTH)
        out = np.empty((n // BLOCK, W.shape[1]), np.float32)
        for at in range(0, n, SLICE):
            stop = min(n, at + SLICE)
            flat = E[buf[at:stop + WIDTH]].reshape(-1)
            rows = (stop - at) // WIDTH
            best = None
            for s in range(0, WIDTH, STEP):  # shifted views: no window is copied
                r = flat[s * dim:s * dim + rows * WIDTH * dim].reshape(rows, WIDTH * dim) @ W
                best = r if best is None else np.maximum(best, r, out=best)
            out[at // BLOCK:stop // BLOCK] = best.reshape(-1, BLOCK // WIDTH, W.shape[1]).max(1)
        return out + b

    def logits(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        buf, blocks = flatten(texts)
        index, first, _ = chunk_index(blocks)
        best = np.maximum(self.block_max(buf), 0)
        z = best[index[:, 0]]
        for k in range(1, PER_CHUNK):
            np.maximum(z, best[index[:, k]], out=z)
        h = np.maximum(z @ self.p["V"] + self.p["c"], 0)
        return self._combine(h, first)[0]

    def _combine(self, h, first):
        n = np.diff(np.append(first, len(h)))[:, None].astype(np.float32)
        doc = np.concatenate([np.add.reduceat(h, first) / n, np.maximum.reduceat(h, first)], axis=1)
        return doc @ self.p["u"] + self.p["u0"][0], doc

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(texts), self.fixed)
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(texts).astype(np.float64), -40, 40)))

    def gradients(self, texts: list[bytes], labels: np.ndarray):
        """Loss and its gradients for a small batch; max-pooling sends each to one window."""
        p = self.p
        dim, filters = p["E"].shape[1], p["W"].shape[1]
        buf, blocks = flatten(texts)
        index, first, chunks = chunk_index(blocks)
        n = len(buf) - WIDTH
        emb = p["E"][buf]
        flat = emb.reshape(-1)
        rows = n // WIDTH
        act = np.stack([flat[s * dim:s * dim + rows * WIDTH * dim].reshape(rows, WIDTH * dim) @ p["W"]
                        for s in range(0, WIDTH, STEP)], axis=1).reshape(n // BLOCK, BLOCK // STEP, filters)
        where = act.argmax(1)
        best = np.take_along_axis(act, where[:, None, :], 1)[:, 0] + p["b"]
        group = best[index]
        pick = group.argmax(1)
        z_in = np.take_along_axis(group, pick[:, None, :], 1)[:, 0]
        z = np.maximum(z_in, 0)
        h_in = z @ p["V"] + p["c"]
        h = np.maximum(h_in, 0)
        logit, doc = self._combine(h, first)
        prob = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        loss = -np.mean(labels * np.log(prob + 1e-7) + (1 - labels) * np.log(1 - prob + 1e-7))
        g = ((prob - labels) / len(labels)).astype(np.float32)
        grad = {"u": doc.T @ g, "u0": np.array([g.sum()], np.float32)}
        g_doc = g[:, None] * p["u"][None, :]
        hid = h.shape[1]
        of = np.repeat(np.arange(len(texts)), chunks)
        g_h = g_doc[of, :hid] / chunks[of, None]
        top = (h == np.maximum.reduceat(h, first)[of])
        g_h = g_h + g_doc[of, hid:] * top / np.add.reduceat(top.astype(np.float32), first)[of]
        g_h = (g_h * (h_in > 0)).astype(np.float32)
        grad["V"], grad["c"] = z.T @ g_h, g_h.sum(0)
        g_z = (g_h @ p["V"].T) * (z_in > 0)
        block = np.take_along_axis(index, pick, 1)
        start = block * BLOCK + where[block, np.arange(filters)[None, :]] * STEP
        grad["b"] = g_z.sum(0)
        spans = start[:, :, None] + np.arange(WIDTH)
        win = emb[spans].reshape(len(start), filters, WIDTH * dim)
        grad["W"] = np.einsum("cf,cfk->kf", g_z, win)
        g_emb = (g_z[:, :, None] * p["W"].T[None]).reshape(-1, dim)
        symbols = buf[spans].reshape(-1)
        grad["E"] = np.stack([np.bincount(symbols, g_emb[:, k], minlength=257) for k in range(dim)], axis=1).astype(np.float32)
        return loss, grad

    def fit(self, texts: list[bytes], labels, epochs: int = 8, rate: float = 0.01, batch_bytes: int = 1 << 16, seed: int = 11):
        labels = np.asarray(labels, np.float32)
        if len(texts) == 0 or labels.min() == labels.max():
            self.fixed = float((labels.sum() + 0.5) / (len(labels) + 1))
            return self
        g = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        var = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, max(1, int(epochs * len(texts)))
        seen = 0
        for _ in range(epochs):
            order = g.permutation(len(texts))
            at = 0
            while at < len(order):
                stop, size = at, 0
                while stop < len(order) and stop - at < 24 and (size < batch_bytes or stop == at):
                    size += len(texts[order[stop]])
                    stop += 1
                part = order[at:stop]
                _, grad = self.gradients([texts[i] for i in part], labels[part])
                step += 1
                seen += len(part)
                lr = rate * (1.02 - seen / total)
                for k, d in grad.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * d
                    var[k] = 0.99 * var[k] + 0.01 * d * d
                    self.p[k] = (self.p[k] - lr * (mean[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(var[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
                at = stop
        return self


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most ``max_rows`` (text, label) rows for training: those of the smallest
    hash of the id.  Only ids and labels are ordered; texts are read for the chosen ids."""
    order = F.xxhash64(F.col(id_col))
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(train)
              .groupBy(id_col).agg(F.max(label_col).alias("label"))
              .orderBy(order, id_col).limit(max_rows))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), id_col)
    return [(r["text"], int(r["label"])) for r in rows.orderBy(order, id_col, "text").limit(max_rows).collect()]


def train(docs: DataFrame, labels: DataFrame, label_col: str, train_rows, max_rows: int = 2500, epochs: int = 8,
          **names) -> ByteCNN:
    sample = labelled_sample(docs, labels, label_col, train_rows, max_rows, **names)
    model = ByteCNN().fit([t.encode("utf-8") for t, _ in sample], [y for _, y in sample], epochs)
    del sample
    give_back()  # the driver goes on with other operators
    return model


def score(docs: DataFrame, model: ByteCNN, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add ``out_col`` (double, 0 to 1) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.p, model.fixed))
    keep = [f for f in docs.schema.fields if f.name != out_col]
    names = [f.name for f in keep]

    def run(batches):
        net = ByteCNN()
        net.p, net.fixed = shared.value
        for batch in batches:
            for at, texts in slices(batch, text_col, 1 << 20):
                part = batch.slice(at, len(texts))
                got = net.scores([x.encode("utf-8") for x in texts])
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))] + [pa.array(got, pa.float64())], names + [out_col])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(lean(run), T.StructType(keep + [T.StructField(out_col, T.DoubleType())]))
