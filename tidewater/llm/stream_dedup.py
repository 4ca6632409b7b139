"""Exact deduplication with a Structured Streaming job over disk-backed keyed state.

The stream reads the files of a table, and its RocksDB state keeps, for each text
digest ever seen and without expiry, the stable identifier of the row that stays
(the largest id), its content locator (file and row number) and the count.  The
state lives below the checkpoint folder, so a later run over the same folder and
checkpoint reads only new files and continues from it.

Rows whose digest is held by several rows (hits) are then checked byte by byte
against the content at the locator; rows that only share the digest are grouped
by their full text instead.  Everything is DataFrame and SQL work: there is no Python in the tasks.

Defined results: null text counts as empty; a null id is smaller than any other;
of rows with equal text and equal largest id, the one later in the files stays,
so exactly one row of each text is kept; an empty table gives no rows.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, may_hold, stored

#: A digest held by one row in so many is hot: its rows are dealt over several tasks before any join.
HOT = 1024
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _conf(spark: SparkSession, values: dict):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def sha256_text(text):
    return F.sha2(text, 256)


def _rows(files: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """(text, digest, keep): keep orders the rows of a digest and locates each."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return files.select(text.alias("text"), digest(text).alias("digest"),
                        F.struct(F.col(id_col).alias("id"), F.col("_metadata.file_path").alias("file"),
                                 F.col("_metadata.row_index").alias("row")).alias("keep"))


def update_state(spark: SparkSession, path: str, checkpoint: str, schema, id_col: str = "doc_id", text_col: str = "text",
                 digest=sha256_text, max_bytes_per_batch: int = 1 << 40) -> int:
    """Stream the files below ``path`` that the checkpoint has not seen into the
    state; returns the number of micro-batches."""
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"  # the same path as a pattern: a plain one must name a folder, not a file
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes_per_batch).parquet(pattern)
    counted = (_rows(source, id_col, text_col, digest).groupBy("digest")
               .agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("n")))
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
                "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
                "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each store reserves some MB of disk
                "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # else the stores of all partitions stay in memory after the stream
                "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with _conf(spark, settings):
        query = (counted.writeStream.outputMode("update").format("noop").queryName("exact_dedup")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return len(query.recentProgress)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(digest, keep, n) from the state of the last committed batch."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))


def _salted(df: DataFrame, by, n, rows_per_salt: int) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.ceil(n / rows_per_salt)))


def _with_state(rows: DataFrame, state: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` (own, digest, ...) with what the state holds for their digest.  Before they
    meet, the rows of a hot digest are dealt over its salts and its state is copied to each."""
    dealt = (rows.join(F.broadcast(hot), "digest", "left")
             .withColumn("salt", F.pmod(F.xxhash64("own"), F.coalesce("salts", F.lit(1)))).drop("salts"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1))
    held = state.join(F.broadcast(hot), "digest", "left").withColumn("salt", copies).drop("salts")
    return dealt.join(held, ["digest", "salt"]).drop("salt")


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", digest=sha256_text, max_bytes_per_batch: int = 1 << 40,
                rows_per_salt: int = 1024) -> DataFrame:
    """Group the rows of the Parquet table at ``path`` by equal text.

    One row per table row: id, file, row (its locator), digest, keep_id, group_size, kept.
    """
    files = spark.read.parquet(path)
    checkpoint = checkpoint or fresh_path(spark, "dedup_state")
    update_state(spark, path, checkpoint, files.schema, id_col, text_col, digest, max_bytes_per_batch)
    state = stored(read_state(spark, checkpoint), "dedup_digests")
    repeated = state.filter("n > 1")
    total, n_repeated = state.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 1)).first()
    # digests of at least one in ``HOT`` of all rows, so ``HOT`` of them at most
    hot = (state.filter((F.col("n") * HOT >= total) & (F.col("n") > rows_per_salt))
           .select("digest", F.ceil(F.col("n") / rows_per_salt).alias("salts")))

    # every row with what the state holds for its digest
    rows = _rows(files, id_col, text_col, digest).withColumnRenamed("keep", "own").drop("text")
    joined = _with_state(rows, state, hot)
    if not n_repeated:
        return _result(joined.select("own", "digest", "keep", "n"))

    # hits and their kept rows, with texts; a hot digest is split by a salt
    texts = _rows(files, id_col, text_col, digest).withColumnRenamed("keep", "own")
    hits = stored(_with_state(may_hold(texts, repeated, "digest", n_repeated), repeated, hot), "dedup_hits")
    held = (hits.filter(F.col("own").eqNullSafe(F.col("keep")))
            .select("digest", F.col("text").alias("held"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / rows_per_salt) - 1)).alias("salt")))
    checked = (_salted(hits, "own", F.col("n"), rows_per_salt).join(held, ["digest", "salt"])
               .withColumn("equal", F.encode("text", "utf-8") == F.encode("held", "utf-8")))
    unequal = stored(checked.filter(~F.col("equal")).select("own", "digest", "text"), "dedup_unequal")
    if unequal.isEmpty():
        return _result(joined.select("own", "digest", "keep", "n"))

    # digest collisions: exact groups by the text itself; the other members' group shrinks by them
    groups = unequal.groupBy("digest", "text").agg(F.max("own").alias("other"), F.count(F.lit(1)).alias("m"))
    moved = unequal.join(groups, ["digest", "text"]).select(F.col("own").alias("moved"), "other", "m")
    gone = unequal.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    fixed = (joined.join(gone, "digest", "left").join(moved, F.col("own").eqNullSafe(F.col("moved")), "left")
             .select("own", "digest", F.coalesce("other", "keep").alias("keep"),
                     F.coalesce(F.col("m"), F.col("n") - F.coalesce("gone", F.lit(0))).alias("n")))
    return _result(fixed)


def _result(df: DataFrame) -> DataFrame:
    return df.select(F.col("own.id").alias("id"), F.col("own.file").alias("file"), F.col("own.row").alias("row"), "digest",
                     F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"),
                     (F.col("own").eqNullSafe(F.col("keep"))).alias("kept"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns.  The rows are first written to
    the shared folder, since the stream and the locators need files."""
    spark = docs.sparkSession
    path = fresh_path(spark, "dedup_input")
    docs.write.parquet(path)
    kept = exact_dedup(spark, path, id_col=id_col, text_col=text_col).filter("kept").select("file", "row")
    files = spark.read.schema(docs.schema).parquet(path)
    located = files.select(F.struct(*[F.col(f"`{c}`") for c in files.columns]).alias("doc"),
                           F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return located.join(kept, ["file", "row"], "left_semi").select("doc.*")
