"""Features of many series, refreshed from new rows only.

Each series keeps its last ``look`` rows in a keyed state store (RocksDB, so the state
of all series together may exceed memory).  A micro-batch brings the new rows of some
series; their features are computed from the kept rows and the new ones, and nothing
else is read.  State and output are committed with the batch, so a batch that is run
again after a failure gives the same rows.

Rows of a series must arrive in order from batch to batch, within a batch in any
order.  A row that comes later than a newer one of its series is given out with
``is_late`` and without features, and changes nothing; so does a second row with the
same place in the order, within a batch too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def lag_zscore_frame(value: str = "close", n: int = 5, frame: int = 5) -> Callable:
    """F2 over the rows of one series in order: ``lag_<n>_days``, ``std_dev`` (sample
    deviation of the last ``frame`` rows, nulls left out) and the guarded ``z_score``."""
    def compute(rows):
        import numpy as np
        x = rows[value].astype("float64")
        last = np.stack([x.shift(k) for k in range(frame)], axis=1)
        count = (~np.isnan(last)).sum(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(count > 0, np.nansum(last, axis=1) / count, np.nan)
            var = np.nansum((last - mean[:, None]) ** 2, axis=1) / (count - 1)
            std = np.where(count > 1, np.sqrt(var), np.nan)
            lag = x.shift(n).to_numpy()
            z = np.where((std > 0) & ~np.isnan(lag), (x.to_numpy() - lag) / std, np.nan)
        return rows.assign(**{f"lag_{n}_days": lag, "std_dev": std, "z_score": z})
    return compute


class LastRows(StatefulProcessor):
    """Keeps the last ``look`` rows of a series and computes features of the new ones."""

    def __init__(self, schema: T.StructType, order: str, look: int, compute: Callable, features: Sequence[str]):
        self.schema, self.order, self.look, self.compute, self.features = schema, order, look, compute, list(features)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("last_rows", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        names = self.schema.names
        new = pd.concat(list(rows), ignore_index=True)[names].sort_values(self.order, kind="stable", ignore_index=True)
        old = pd.DataFrame(list(self.kept.get()), columns=names)
        late = new[self.order].duplicated()
        if len(old):
            late |= new[self.order] <= old[self.order].iloc[-1]
        fresh = new[~late]
        together = pd.concat([old, fresh], ignore_index=True) if len(old) else fresh.reset_index(drop=True)
        if len(fresh):
            done = self.compute(together).iloc[len(old):]
            yield done[names + self.features].assign(is_late=False)
            tail = together.tail(self.look).astype(object)
            self.kept.put([tuple(None if pd.isna(v) else v for v in r) for r in tail.itertuples(index=False)])
        if late.any():
            yield new[late].assign(**{f: None for f in self.features}, is_late=True)

    def close(self) -> None:
        pass


def feature_refresh_stream(rows: DataFrame, out_dir: str, ckpt: str, partition: Sequence[str], order: str, look: int,
                           compute: Callable, features: str, trigger: str | None = None) -> StreamingQuery:
    """Append the features of new rows to the table at ``out_dir``.

    ``rows`` is streaming; ``partition`` names a series; ``look`` rows before a row are
    enough for its features; ``compute`` (pandas to pandas, as ``lag_zscore_frame``)
    adds them and ``features`` states their names and types."""
    from .streams import _trigger
    spark = rows.sparkSession
    added = T.StructType.fromDDL(features) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(features)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    out = T.StructType(schema.fields + added.fields + [T.StructField("is_late", T.BooleanType())])
    done = rows.groupBy(*partition).transformWithStateInPandas(
        statefulProcessor=LastRows(schema, order, look, compute, added.names), outputStructType=out, outputMode="Append", timeMode="None")
    with rocksdb_state(spark):
        writer = (done.writeStream.outputMode("append").format("parquet").option("path", out_dir)
                  .option("checkpointLocation", ckpt))
        return _trigger(writer, trigger).start()
