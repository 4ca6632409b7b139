"""Session construction and cluster-safe scratch locations.

Library code never builds its own session: every operator receives DataFrames.
``local_session`` exists for tests, the bench and the command-line tools.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones; the UI stays off.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 128 << 20) -> dict:
    """Spill-aware sizing for a cluster run: enough shuffle partitions that the
    largest stage (about the input size) lands at ~``target_partition_bytes``
    per task, and at least a few waves of the cluster's task slots; AQE then
    coalesces small stages.  Returned as settings for the session builder."""
    slots = max(1, executors * cores_per_executor)
    parts = max(3 * slots, -(-int(input_bytes) // target_partition_bytes))
    return {**SCALE_CONF,
            "spark.sql.shuffle.partitions": str(parts),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
            "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidewater", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    conf = {**SCALE_CONF, **(extra or {})}
    if event_log_dir:  # stage/task times for tools/stage_times.py (no UI needed)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log_dir})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Bytes of a batch that travels to a Python worker.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches are bounded by records only, unless a session says otherwise: 10 000 long
    texts at once are held by the executor and by its Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(key)) or 0) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


#: For readers: a vectored read takes a column chunk of any size in one piece, and each thread
#: that reads a local file so keeps an off-heap buffer of the largest chunk it has met.
IN_PIECES = {"parquet.hadoop.vectored.io.enabled": "false"}
#: For writers: a task that writes or reads a Parquet file holds a row group, 128 MB by default.
SMALL_ROW_GROUPS = {"parquet.block.size": str(16 << 20)}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) is a fresh private folder created and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it
    back: cuts the lineage (survives executor loss) and later passes scan
    columnar files instead of recomputing the plan."""
    import uuid
    path = scratch_path(df.sparkSession, f"tables/{name}/{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)
