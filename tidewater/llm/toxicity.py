"""Toxicity from a sparse linear classifier with a counterfactual penalty.

Features are the distinct words of a text and the beginnings of those words
(hashed), so inflected forms of a term share evidence.  Training is FTRL with an
L1 term, which leaves only features that carry evidence.  For each labelled
sentence that names a group of people, the same sentence with the name swapped for
one of its counterparts is formed, and ``penalty`` times the squared difference of
the two scores is added to the loss: the name of a group cannot by itself make a
sentence toxic, which is what causes false alarms on neutral mentions.

The classifier is fitted on the driver from at most ``max_rows`` labelled rows of
each class; scoring reads whole texts in the tasks.

Defined results: null and empty texts have no words and get the score of the
intercept; without labelled rows, or where no feature gets a weight, every score is
0.5 minus a hair (not toxic), with one class only, that class's smoothed share;
repeated rows are scored alike.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, lean, slices

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
BITS = 22
BEGINNINGS = (4, 5, 6)

#: Terms for groups of people; a term is swapped for the others of its set.
IDENTITY_SETS = (
    "women men girls boys", "woman man girl boy", "female male", "mother father", "wives husbands",
    "muslims christians jews hindus buddhists atheists", "muslim christian jewish hindu buddhist atheist",
    "black white asian latino arab african european", "gay lesbian straight bisexual", "transgender cisgender",
    "immigrants refugees natives citizens foreigners", "immigrant refugee native citizen foreigner",
    "americans mexicans chinese indians russians germans turks poles", "old young elderly teenage",
    "disabled blind deaf autistic", "frauen männer mädchen jungen", "muslime christen juden",
    "ausländer einheimische flüchtlinge", "femmes hommes filles garçons", "musulmans chrétiens juifs",
    "étrangers réfugiés citoyens", "mujeres hombres niñas niños", "musulmanes cristianos judíos",
    "extranjeros refugiados ciudadanos",
)


def counterparts(sets=IDENTITY_SETS) -> dict[str, list[str]]:
    return {w: [o for o in s.split() if o != w] for s in sets for w in s.split()}


def word_features(word: str) -> list[int]:
    raw = word.encode("utf-8")
    mask = (1 << BITS) - 1
    return [zlib.crc32(raw) & mask] + [zlib.crc32(word[:n].encode("utf-8"), n) & mask for n in BEGINNINGS if len(word) >= n]


def text_features(words) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and the number of distinct words that have each."""
    ids = [f for w in set(words) for f in word_features(w)]
    return np.unique(np.array(ids, np.int64), return_counts=True)


def swaps(text: str, partners: dict[str, list[str]]):
    """For each identity term of each sentence, the change of features when it is
    swapped for each counterpart: pairs of (feature ids, values)."""
    for sentence in SENTENCE.findall(text.lower()):
        words = WORD.findall(sentence)
        for term in {w for w in words if w in partners}:
            before = set(words)
            for other in partners[term]:
                after = {other if w == term else w for w in words}
                ids = [f for w in after - before for f in word_features(w)] + [f for w in before - after for f in word_features(w)]
                signs = [1.0 for w in after - before for _ in word_features(w)] + [-1.0 for w in before - after for _ in word_features(w)]
                if ids:
                    yield np.array(ids, np.int64), np.array(signs)


def best_cut(logits: np.ndarray, y: np.ndarray) -> float:
    """Of the cuts with the fewest training errors, the middle of the widest gap between
    different logits.  Cuts below all logits and above them count as gaps of no width,
    half a unit away; equal logits are never cut apart.  Of equal cuts the highest is taken."""
    values, at = np.unique(logits, return_inverse=True)
    toxic, clean = np.bincount(at, y, len(values)), np.bincount(at, 1 - y, len(values))
    # cut k has the values before k below it: toxic ones there and clean ones above are errors
    errors = np.concatenate([[0.0], np.cumsum(toxic)]) + clean.sum() - np.concatenate([[0.0], np.cumsum(clean)])
    gap = np.concatenate([[0.0], np.diff(values), [0.0]])
    cut = np.concatenate([[values[0] - 0.5], (values[:-1] + values[1:]) / 2, [values[-1] + 0.5]])
    return float(cut[max(np.flatnonzero(errors == errors.min()), key=lambda k: (gap[k], k))])


class Classifier:
    def __init__(self, alpha: float = 0.15, beta: float = 1.0, l1: float = 5.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.weights: dict[int, float] = {}
        self.intercept = -1e-9
        self.cache: dict[str, float] = {}

    def fit(self, texts: list[str], labels: list[int], partners=None, penalty: float = 1.0, epochs: int = 6, seed: int = 5):
        if not texts:
            return self
        y = np.asarray(labels, float)
        if y.min() == y.max():
            share = (y.sum() + 0.5) / (len(y) + 1)
            self.intercept = float(np.log(share / (1 - share)))
            return self
        partners = counterparts() if partners is None else partners
        rows = [text_features(WORD.findall(t.lower())) for t in texts]
        pairs = [list(swaps(t, partners)) for t in texts]
        known = np.unique(np.concatenate([r[0] for r in rows] + [p[0] for ps in pairs for p in ps]))
        rows = [(np.searchsorted(known, i), v.astype(float)) for i, v in rows]
        pairs = [[(np.searchsorted(known, i), v) for i, v in ps] for ps in pairs]
        z, n = np.zeros(len(known)), np.zeros(len(known))
        bias, bias_n = 0.0, 1.0

        def weight(i):
            zi = z[i]
            w = -(zi - np.sign(zi) * self.l1) / ((self.beta + np.sqrt(n[i])) / self.alpha + self.l2)
            return np.where(np.abs(zi) <= self.l1, 0.0, w)

        def update(i, w, g):
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / self.alpha
            z[i] += g - s * w
            n[i] += g * g

        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                i, v = rows[k]
                w = weight(i)
                err = 1 / (1 + np.exp(-np.clip(w @ v + bias, -35, 35))) - y[k]
                update(i, w, err * v)
                bias_n += err * err
                bias -= 0.5 * err / np.sqrt(bias_n)
                for j, d in pairs[k]:
                    w = weight(j)
                    update(j, w, 2 * penalty * float(w @ d) * d)
        w = weight(np.arange(len(known)))
        for k in range(len(pairs)):  # the penalty may fall short where few sentences name a term: score changes left over
            for j, d in pairs[k]:
                change = float(w[j] @ d)
                if abs(change) > 1e-6 and penalty:
                    w[j] -= change * d / float(d @ d) * min(1.0, penalty)
        self.weights = {int(known[k]): float(w[k]) for k in np.flatnonzero(w)}
        if not self.weights:  # nothing was learned, and the sample's share of a class says nothing about the table's
            return self
        self.intercept = float(bias) - best_cut(np.array([w[i] @ v + bias for i, v in rows]), y)
        return self

    def word_weight(self, word: str) -> float:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) > 100_000:
                self.cache.clear()
            got = self.cache[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return got

    def logit(self, text: str) -> float:
        return self.intercept + sum(map(self.word_weight, set(WORD.findall(text.lower()))))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-min(40.0, max(-40.0, self.logit(text))))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, train, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most ``max_rows`` (text, label) rows of each class: those of the smallest hash of the id."""
    order = F.xxhash64(F.col(id_col))
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(train)
             .groupBy(id_col).agg(F.max(label_col).alias("label")))
    chosen = (known.filter("label = 1").orderBy(order, id_col).limit(max_rows)
              .unionByName(known.filter("label <> 1").orderBy(order, id_col).limit(max_rows)))
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), id_col)
    return [(r["text"], int(r["label"] == 1)) for r in rows.orderBy(order, id_col, "text").limit(2 * max_rows).collect()]


def train(docs: DataFrame, labels: DataFrame, label_col: str, train_rows, max_rows: int = 2500, penalty: float = 1.0,
          **names) -> Classifier:
    sample = labelled_sample(docs, labels, label_col, train_rows, max_rows, **names)
    model = Classifier().fit([t for t, _ in sample], [y for _, y in sample], penalty=penalty)
    del sample
    give_back()  # the driver goes on with other operators
    return model


def score(docs: DataFrame, model: Classifier, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add ``out_col`` (double, 0 to 1) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    keep = [f for f in docs.schema.fields if f.name != out_col]
    names = [f.name for f in keep]

    def run(batches):
        c = Classifier()
        c.weights, c.intercept = shared.value
        for batch in batches:
            for at, texts in slices(batch, text_col):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))]
                                                 + [pa.array([c.score(x) for x in texts], pa.float64())], names + [out_col])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(lean(run), T.StructType(keep + [T.StructField(out_col, T.DoubleType())]))
