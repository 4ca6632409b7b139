"""Small shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return scratch_path(spark, f"llm/{name}/{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder in the shared checkpoint folder and read back: what
    later steps see survives lost executors and is computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """The name of a column as ``select`` takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def map_arrow(df: DataFrame, names: list[str], run, schema) -> DataFrame:
    """``mapInArrow`` over the named columns, whatever characters their names hold."""
    plain = df.select(*[F.col(quoted(n)).alias(f"c{k}") for k, n in enumerate(names)])
    return plain.mapInArrow(lambda batches: run(b.rename_columns(names) for b in batches), schema)


def give_back() -> None:
    """Return freed memory of this Python worker to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run, keep: str = ""):
    """``run`` for ``mapInArrow`` in a worker that may have served other operators: what
    their modules remember is dropped first (but for module ``keep``), and what ``run``
    freed is given back at the end."""
    def wrapped(batches):
        for name in ("bpe", "packing", "pieces"):
            module = sys.modules.get(f"{__package__}.{name}")
            if module is not None and name != keep:
                module.forget()
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def or_empty(name: str):
    return F.coalesce(F.col(name), F.lit(""))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20):
    """Consecutive (start, list of str) pieces of a text column; each piece holds
    about ``max_bytes`` of UTF-8 at most (or one longer text).  Nulls read as ''."""
    col = batch.column(column)
    lens = np.asarray(pc.fill_null(pc.binary_length(col), 0))
    at, n = 0, len(col)
    ends = np.cumsum(lens)
    while at < n:
        base = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield at, [x or "" for x in col.slice(at, stop - at).to_pylist()]
        at = stop


def list_of(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and the length of each row."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def crc_mod(id_col: str, modulus: int):
    """crc32 of the id written as text, modulo ``modulus`` (null id: its crc is 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % modulus


BITMAP_BITS = 32768  # fixed by bitmap_construct_agg


def may_hold(rows: DataFrame, keys: DataFrame, column: str, n_keys: int) -> DataFrame:
    """Rows whose ``column`` may be among those of ``keys``: a test of one bit in a
    broadcast table of bitmaps, 16 bits for each key but 16 MB at most, whatever the
    size of the data.  No row of ``keys`` is missed; others pass when their bit happens
    to be set, so an exact join follows.  A null is hashed like any value."""
    buckets = min(4096, max(1, -(-n_keys * 16 // BITMAP_BITS)))
    slot = F.pmod(F.xxhash64(column), F.lit(buckets * BITMAP_BITS))
    bucket, at = F.floor(F.col("__slot") / BITMAP_BITS), F.col("__slot") % BITMAP_BITS
    bits = (keys.select(slot.alias("__slot")).groupBy(bucket.alias("__bucket"))
            .agg(F.bitmap_construct_agg(at).alias("__bits")))
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    here = rows.withColumn("__slot", slot).withColumn("__bucket", bucket).join(F.broadcast(bits), "__bucket")
    return (here.withColumn("__byte", byte).filter("shiftright(__byte, cast(__slot % 8 as int)) & 1 = 1")
            .drop("__slot", "__bucket", "__bits", "__byte"))
