"""The corpus pipeline: quality, toxicity, exact duplicates, near duplicates, packing.

Each stage reads all that its predecessor kept; between stages the documents are
written as Parquet to the shared checkpoint folder and read again.  Every stage but
the last returns the columns of ``documents``, whatever their names.

Defined results, for every stage: a null text is an empty one; an empty text is scored
and kept or dropped like any other, empty texts are exact copies of each other, have no
shingles and so no near copies, and are packed as their end id; rows that repeat an id
are separate rows (of exact copies with the same id one stays; the near-copy stage tells
rows apart by their id, so all rows of the id that stays do); null ids are smaller than
others; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import jaccard_join, packing, quality_cnn, stream_dedup, toxicity
from tidewater.llm.common import crc_mod, quoted, read_table, stored


#: Bytes of a batch that travels to a Python worker.
BATCH_BYTES = 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Batches are bounded by records only, unless a session says otherwise: 10 000 long
    texts at once are held by the executor and by its Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(key)) or 0) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def _free_name(docs: DataFrame, name: str) -> str:
    """``name``, or with more underscores where ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keep(scored: DataFrame, docs: DataFrame, condition) -> DataFrame:
    return scored.filter(condition).select([F.col(quoted(c)) for c in docs.columns])


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6; trained on the labelled rows of the whole table, as its query is."""
    _small_batches(spark)
    model = quality_cnn.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), "quality", crc_mod("doc_id", 3) != 1)
    score = _free_name(docs, "__score")
    return _keep(quality_cnn.score(docs, model, out_col=score), docs, F.col(score) >= 0.5)


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7; trained on the labelled rows of the whole table, as its query is."""
    _small_batches(spark)
    model = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), "toxic", crc_mod("doc_id", 5) != 0)
    score = _free_name(docs, "__score")
    return _keep(toxicity.score(docs, model, out_col=score), docs, F.col(score) < 0.5)


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3; the row with the largest doc_id of each text stays."""
    return stream_dedup.drop_duplicates(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 on five-word shingles at a similarity of 0.8; the smallest doc_id of each group stays."""
    _small_batches(spark)
    return jaccard_join.keep_one(docs, num=80, den=100, n=5)


def _pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5; one row per piece of a sequence of at most 1024 tokens, with its ids."""
    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", _quality), ("toxicity", _toxicity), ("exact dedup", _exact_dedup),
          ("n-gram Jaccard join", _near_dedup), ("packing", _pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline/" + name.replace(" ", "_"))
    return docs


#: No SQL: the classifiers are trained models; tests hold the stages against brute-force versions.
ORACLE_SQL = None
