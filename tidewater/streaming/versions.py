"""Snapshots of a keyed table that follows a change feed.

The feed's batches lie in ``base/changes`` (see ``cdc_upsert_stream``).  A snapshot has
the rows in buckets of the key's hash; its manifest, one small table per version, says
up to which batch the changes are in it and where each bucket's rows lie.  Compaction
applies the later batches: only buckets with a changed key are written anew, below a
new version, and the other buckets' places are taken over from the version before.  A
deleted key leaves a marker (its last change), so that a change which is older, but
comes later, does not bring it back.  The manifest is written last: until then readers
see the version before, and a compaction that failed can be run again.

Reading takes the newest manifest's rows and the changes of later batches, keeps the
last change of each key and leaves out markers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "covered long, bucket int, data_version int"


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def manifest(spark: SparkSession, base: str) -> tuple[int, int, dict[int, int]]:
    """Newest version, last batch in it, and the version that holds each bucket's rows.
    No snapshot: version 0, batch -1."""
    table = read_if_there(spark, f"{base}/manifest")
    if table is None:
        return 0, -1, {}
    newest = table.agg(F.max("version")).first()[0]
    rows = table.filter(F.col("version") == newest).collect()  # one row a bucket
    return newest, rows[0]["covered"], {r["bucket"]: r["data_version"] for r in rows}


def last_changes(changes: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The last change of each key, by the sequence columns, then by the batch."""
    cols = [c for c in changes.columns if c != "batch_id"]
    order = F.struct(*[F.col(c) for c in seq], F.col("batch_id"))
    return changes.groupBy(*key).agg(F.max_by(F.struct(*cols, "batch_id"), order).alias("_tw_r")).select("_tw_r.*")


def _snapshot(spark: SparkSession, base: str, places: dict[int, int], schema) -> DataFrame | None:
    paths = [f"{base}/data/version={v}/bucket={b}" for b, v in sorted(places.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def _state(spark: SparkSession, base: str, key, seq) -> DataFrame:
    """The last change of each key, markers included."""
    _, covered, places = manifest(spark, base)
    changes = spark.read.parquet(f"{base}/changes")
    changes = changes.withColumn("batch_id", F.col("batch_id").cast("long"))
    rows = changes.filter(F.col("batch_id") > covered)  # a partition column: covered folders are not read
    kept = _snapshot(spark, base, places, changes.schema)
    return last_changes(rows if kept is None else rows.unionByName(kept), key, seq)


def cdc_current(spark: SparkSession, base: str, key: Sequence[str], seq: Sequence[str],
                op_col: str | None = None, delete_value: str = "delete") -> DataFrame:
    """Current state of the table: the last change of each key, deleted keys left out."""
    state = _state(spark, base, key, seq).drop("batch_id")
    return state.filter(~F.col(op_col).eqNullSafe(delete_value)) if op_col else state


def cdc_compact(spark: SparkSession, base: str, key: Sequence[str], seq: Sequence[str], upto: int | None = None,
                buckets: int = 64) -> int:
    """Take the changes up to batch ``upto`` into a new snapshot version; returns it.

    By default the newest batch is left out, as it may still be being written: a stream
    starts a batch only when the one before is complete.  Without new batches nothing
    is written.  ``buckets`` must stay the same for a table."""
    version, covered, places = manifest(spark, base)
    changes = spark.read.parquet(f"{base}/changes")
    changes = changes.withColumn("batch_id", F.col("batch_id").cast("long"))
    if upto is None:
        upto = (changes.agg(F.max("batch_id")).first()[0] or 0) - 1
    hashed = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(buckets)).cast("int")
    fresh = changes.filter((F.col("batch_id") > covered) & (F.col("batch_id") <= upto)).withColumn("bucket", hashed)
    touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
    if upto <= covered or not touched:
        return version
    old = _snapshot(spark, base, {b: v for b, v in places.items() if b in touched}, changes.schema)
    rows = fresh if old is None else fresh.unionByName(old.withColumn("bucket", hashed))
    new = version + 1
    (last_changes(rows, key, seq).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("bucket").parquet(f"{base}/data/version={new}"))
    places |= {b: new for b in touched}
    entries = spark.createDataFrame([(upto, b, v) for b, v in sorted(places.items())], MANIFEST)
    entries.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/version={new}")
    return new
