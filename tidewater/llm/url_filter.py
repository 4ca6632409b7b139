"""URL filter: ordered rules, else host word segmentation and naive Bayes.

Names such as ``cheappills`` are split into words by the most probable unigram
path (Viterbi); multinomial naive Bayes then scores the words of host and path.
Both models are trained here on the urls of the table itself:

* the unigram table counts, for each name (run of letters) of at most ``LONGEST``
  letters in host or path, the hosts that have it, on top of the ``SEEDS`` and
  ``WORDS``; when a name is split it counts one host less for itself, so that a name
  of one host is no word by having been seen there;
* naive Bayes first knows only the words of ``SEEDS``, and labels every url;
* the counts of all urls' words under these labels, one row for each word, give the
  final naive Bayes table.

Both tables stay DataFrames, joined to the parts of names and to the words of urls.
Letters outside any known word form words of their own at a cost per letter.  The
public suffix of a host (``org``, ``co.uk``) is marked ``t:`` and is no evidence.

Defined results: a null url, or one without ``://``, has an empty host and path, no
rule, and is allowed (no words, so the prior decides); repeated rows are judged alike.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, stored

#: Words of urls to block and of urls to allow, from which the labels of the first pass come.
SEEDS = {
    "block": ("casino bet bets betting poker slots jackpot roulette lottery win winner free cheap pill pills viagra pharma "
              "adult xxx sex porn escort spam farm track tracker tracking ad ads advert popup click clickbait loan loans "
              "payday replica warez crack keygen torrent malware phishing scam deal deals prize").split(),
    "allow": ("news wiki encyclopedia university school college library museum science research journal government health "
              "docs documentation help support forum community article articles history weather music sport travel "
              "recipes books education open data project city").split(),
}
#: Common words and name parts of hosts: known to the segmentation, no evidence by themselves.
WORDS = ("the and of to in for on with you your my our all one best top new get go live home page site web net online world "
         "info mail shop store game games play media video photo image search link url host cloud app code dev test www blog "
         "example com org index html feed en de fr es it").split()
#: Labels that stand for a registry below a country's (co.uk, com.br).
REGISTRY = frozenset("ac co com edu go gob gouv gov govt ltd me mil ne net nom or org plc sch".split())
LONGEST = 32  # letters of the longest word that a name can be split into; names themselves have any length
SALTS = 16
SEED_WEIGHT = 3.0
SMOOTHING = 0.2
HOT = 256  # a key is frequent if more than one row in so many has it: at most so many keys are


def host_and_path(url):
    """(host, path) columns: the host after the first ``://`` with A-Z lower-cased, the path up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_columns(host, path, rules):
    """The name and verdict of the longest rule that fits.  ``rules``: (verdict, 'host/path').
    A rule fits its host and its subdomains, where the path starts with the rule's path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is the outermost condition
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        if not rest:
            fits = (host == at) | host.endswith("." + at)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Most probable split of a lower-case string into known words and unknown runs."""

    def __init__(self, counts: dict[str, float], per_letter: float = -3.2, unknown: float = -9.0):
        total = sum(counts.values())
        self.cost = {w: math.log(c / total) for w, c in counts.items()}
        self.longest = max(map(len, counts), default=1)
        self.per_letter, self.unknown = per_letter, unknown

    @classmethod
    def of(cls, found: dict[str, float], total: float) -> Segmenter:
        """Knows the words of one name alone, of a table with counts that sum to ``total``; an
        unknown run is never cheaper than a word of count one."""
        self = cls.__new__(cls)
        self.cost = {w: math.log(c / total) for w, c in found.items()}
        self.longest = max(map(len, found), default=1)
        self.per_letter, self.unknown = -3.2, min(-9.0, -math.log(total))
        return self

    def split(self, name: str) -> list[str]:
        """``unknown`` is paid once for each run of letters outside known words and
        ``per_letter`` for each of its letters."""
        # state 0: a known word ends here; state 1: inside an unknown run
        best = [[0.0, -math.inf]] + [[-math.inf, -math.inf] for _ in name]
        back = [[None, None] for _ in range(len(name) + 1)]
        for i in range(1, len(name) + 1):
            for k in range(max(0, i - self.longest), i):
                c = self.cost.get(name[k:i])
                if c is not None:
                    s = 0 if best[k][0] >= best[k][1] else 1
                    if best[k][s] + c > best[i][0]:
                        best[i][0], back[i][0] = best[k][s] + c, (k, s)
            start, go_on = best[i - 1][0] + self.unknown, best[i - 1][1]
            best[i][1] = max(start, go_on) + self.per_letter
            back[i][1] = (i - 1, 0 if start >= go_on else 1)
        out, i, s = [], len(name), 0 if best[-1][0] >= best[-1][1] else 1
        end = i
        while i > 0:
            k, before = back[i][s]
            if s == 0 or before == 0:
                out.append(name[k:end])
                end = k
            i, s = k, before
        return out[::-1]


def base_counts() -> dict[str, float]:
    counts = {w: 2.0 for words in SEEDS.values() for w in words}
    for w in WORDS:
        counts[w] = counts.get(w, 0.0) + 4.0
    return {w: c for w, c in counts.items() if len(w) > 1}


def default_segmenter() -> Segmenter:
    """Without any corpus."""
    return Segmenter(base_counts())


def names_of(host: str, path: str) -> list[str]:
    """Runs of letters in host and path, marked by where they stand; digits are no letters."""
    labels = host.split(":")[0].rstrip(".").split(".")
    suffix = 0 if len(labels) < 2 else 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in REGISTRY else 1
    cut = len(labels) - suffix
    parts = [("h:", x) for x in labels[:cut]] + [("t:", x) for x in labels[cut:]] + [("p:", path.lower())]
    return [mark + name for mark, text in parts for name in re.findall(r"[^\W\d_]+", text)]


class Model(NamedTuple):
    """The unigram table (word, n: hosts that have it) and the sum of n, the naive Bayes
    table (word, weight, n: rows that have it) and the sum of n, and the prior."""

    unigrams: DataFrame
    unigram_total: float
    weights: DataFrame
    total: int
    prior: float


def seed_rows() -> list[tuple[str, float, float]]:
    """(word, weight for block, weight for allow) of the seeds, marked for host and path."""
    return [(mark + w, SEED_WEIGHT * (kind == "block"), SEED_WEIGHT * (kind == "allow")) for kind in SEEDS for w in SEEDS[kind] for mark in ("h:", "p:")]


def prior_of(blocked: float, allowed: float) -> float:
    return min(0.0, math.log((blocked + 1) / (allowed + 2)))  # without evidence a url is allowed


def seed_weights() -> dict[str, float]:
    rows = seed_rows()
    block, allow = (sum(r[k] + SMOOTHING for r in rows) for k in (1, 2))
    return {w: math.log((b + SMOOTHING) / block) - math.log((a + SMOOTHING) / allow) for w, b, a in rows}


def join_skewed(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row for each key, ``n`` its frequency, which sum to ``total``).
    The few frequent keys, at most ``HOT``, are broadcast; the others are dealt by key."""
    often = F.col("n") * HOT > total
    hot, rare = table.filter(often).drop("n"), table.filter(~often).drop("n")
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rare, key)))


def named(pages: DataFrame, url_col: str, keep=()) -> DataFrame:
    """Stored rows of ``keep`` (as __keep0, ...) with __row (a number of their own), host, path and __names."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(*[F.col(quoted(c)).alias(f"__keep{n}") for n, c in enumerate(keep)], host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("__row"))

    def run(batches):
        for batch in batches:
            names = [names_of(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(list(batch.columns) + [pa.array(names, pa.list_(pa.string()))], batch.schema.names + ["__names"])

    return stored(parts.mapInArrow(run, T.StructType(parts.schema.fields + [T.StructField("__names", T.ArrayType(T.StringType()))])), "url_names")


def each_name(rows: DataFrame) -> DataFrame:
    each = rows.select("__row", "host", F.posexplode("__names").alias("pos", "__marked"))
    return each.select("__row", "host", "pos", F.substring("__marked", 1, 2).alias("mark"), F.expr("substring(__marked, 3)").alias("name"))


def count_unigrams(rows: DataFrame) -> tuple[DataFrame, float]:
    """The unigram table of all names, and the sum of its counts."""
    base = rows.sparkSession.createDataFrame(list(base_counts().items()), "word string, n double")
    names = each_name(rows).filter(F.length("name").between(2, LONGEST)).select(F.col("name").alias("word"), "host").distinct()
    counts = names.select("word", F.lit(1.0).alias("n")).unionByName(base).groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "url_unigrams")
    return counts, counts.agg(F.sum("n")).first()[0]


def split_names(names: DataFrame, unigrams: DataFrame, total: float) -> DataFrame:
    """(name, n, words) for the distinct names of ``names`` (name, n).  Parts of names are dealt by word and
    a salt of the name, so that a part which many names have does not meet in one task."""

    def parts(batches):
        for batch in batches:
            out, kept = [], []
            for name in batch.column("name").to_pylist():
                found = {name[i:i + k] for i in range(len(name)) for k in range(2, min(LONGEST, len(name) - i) + 1)}
                out += found
                kept += [name] * len(found)
                if len(out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(out, pa.string())], ["name", "word"])
                    out, kept = [], []
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array(out, pa.string())], ["name", "word"])

    def best(batches):
        for batch in batches:
            words = []
            for name, found in zip(batch.column("name").to_pylist(), batch.column("found").to_pylist()):
                known = {x["word"]: x["n"] - (x["word"] == name and name not in base) for x in found or ()}
                words.append(Segmenter.of({w: n for w, n in known.items() if n > 0}, total).split(name))
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("n"), pa.array(words, pa.list_(pa.string()))], ["name", "n", "words"])

    base = base_counts()
    salted = names.select("name").mapInArrow(parts, "name string, word string").withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int"))
    known = unigrams.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = salted.join(known, ["word", "salt"]).groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    return stored(names.join(found, "name", "left").select("name", "n", "found").mapInArrow(best, "name string, n long, words array<string>"), "url_splits")


def worded(rows: DataFrame, unigrams: DataFrame, total: float) -> DataFrame:
    """Stored rows with words, split by the unigram table, in place of __names."""
    each = each_name(rows)
    splits = split_names(each.groupBy("name").agg(F.count("*").alias("n")), unigrams, total)
    many = splits.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    marked = join_skewed(each.drop("host"), splits, "name", many).select(
        "__row", F.struct("pos", F.transform("words", lambda w: F.concat("mark", w)).alias("words")).alias("at"))
    words = marked.groupBy("__row").agg(F.flatten(F.sort_array(F.collect_list("at"))["words"]).alias("words"))
    out = rows.drop("__names").join(words, "__row", "left")
    return stored(out.withColumn("words", F.coalesce("words", F.array().cast("array<string>"))), "url_words")


def train(pages: DataFrame, url_col: str = "url") -> Model:
    """Both tables.  Every url counts, once for each row in naive Bayes, and every word has a row of its own."""
    rows = named(pages, url_col)
    unigrams, total = count_unigrams(rows)
    return Model(unigrams, total, *learn(worded(rows, unigrams, total)))


def learn(rows: DataFrame) -> tuple[DataFrame, int, float]:
    """The naive Bayes table of the words of all rows, its sum of n, and the prior."""
    spark = rows.sparkSession
    weights, prior = seed_weights(), prior_of(1.0, 9.0)

    def label(batches):
        for batch in batches:
            words = batch.column("words").to_pylist()
            kinds = [int(prior + sum(weights.get(w, 0.0) for w in ws) > 0) for ws in words]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), batch.column("words")], ["kind", "words"])

    labelled = stored(rows.select("words").mapInArrow(label, "kind int, words array<string>"), "url_labels")
    blocked, urls = labelled.agg(F.coalesce(F.sum("kind"), F.lit(0)), F.count("kind")).first()
    seen = labelled.select("kind", F.explode("words").alias("word")).filter("not startswith(word, 't:')").select(
        "word", F.col("kind").cast("double").alias("block"), (1.0 - F.col("kind")).alias("allow"), F.lit(1).alias("n"))
    seeds = spark.createDataFrame([(*r, 0) for r in seed_rows()], "word string, block double, allow double, n int")
    counts = stored(seen.unionByName(seeds).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("block", "allow", "n")]), "url_counts")
    block, allow, total = counts.agg(F.sum(F.col("block") + SMOOTHING), F.sum(F.col("allow") + SMOOTHING), F.sum("n")).first()
    weight = F.log((F.col("block") + SMOOTHING) / block) - F.log((F.col("allow") + SMOOTHING) / allow)
    return counts.select("word", weight.alias("weight"), "n"), total, prior_of(blocked, urls - blocked)


def judge(pages: DataFrame, rules, model: Model, url_col: str = "url") -> DataFrame:
    """Add host, path, words, log_odds, rule and verdict to every row (replacing columns of these names).
    A word never seen is no evidence."""
    added = ("host", "path", "words", "log_odds", "rule", "verdict")
    keep = [c for c in pages.columns if c not in added]
    rows = worded(named(pages, url_col, keep), model.unigrams, model.unigram_total)
    each = join_skewed(rows.select("__row", F.posexplode("words").alias("pos", "word")), model.weights, "word", model.total)
    in_order = F.sort_array(F.collect_list(F.struct("pos", "weight")))  # added up in one order, whatever the partitions
    sums = each.groupBy("__row").agg(F.aggregate(in_order, F.lit(0.0), lambda s, x: s + x["weight"]).alias("__sum"))
    scored = rows.join(sums, "__row", "left").withColumn("log_odds", F.lit(model.prior) + F.coalesce(F.col("__sum"), F.lit(0.0)))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    by_words = F.when(F.col("log_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    scored = scored.drop("__row", "__sum").select(*[F.col(f"__keep{n}").alias(c) for n, c in enumerate(keep)], "host", "path", "words", "log_odds")
    return scored.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, by_words))
