"""Functions over a whole table, called from SQL.

``lag_zscore(TABLE(t) PARTITION BY (...) ORDER BY (...), value, n, frame)`` gives the rows of
``t`` with F2's columns.  The output schema follows the input's; Spark shuffles and sorts
by what the call names, and the function keeps the last rows of the present series only.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf


class _LagZscore:
    @staticmethod
    def analyze(rows: AnalyzeArgument, value: AnalyzeArgument, n: AnalyzeArgument, frame: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a TABLE")
        for name, a in (("value", value), ("n", n), ("frame", frame)):
            if not a.isConstantExpression or a.value is None:
                raise ValueError(f"{name} must be a constant")
        if value.value not in rows.dataType.names:
            raise ValueError(f"no column {value.value}; there are {', '.join(rows.dataType.names)}")
        if n.value < 1 or frame.value < 2:
            raise ValueError("n must be at least 1 and frame at least 2")
        added = [T.StructField(f, T.DoubleType()) for f in (f"lag_{n.value}_days", "std_dev", "z_score")]
        return AnalyzeResult(schema=T.StructType(rows.dataType.fields + added))

    def __init__(self):
        self.last = None

    def eval(self, row: T.Row, value: str, n: int, frame: int):
        if self.last is None:  # a new series
            self.last = deque(maxlen=max(n + 1, frame))
        x = row[value]
        self.last.append(None if x is None else float(x))
        held = list(self.last)
        lag = held[-1 - n] if len(held) > n else None
        seen = [v for v in held[-frame:] if v is not None]
        std = None
        if len(seen) > 1:
            mean = math.fsum(seen) / len(seen)
            std = math.sqrt(math.fsum((v - mean) ** 2 for v in seen) / (len(seen) - 1))
        z = (held[-1] - lag) / std if std and lag is not None and held[-1] is not None else None
        yield (*row, lag, std, z)

    def terminate(self):
        self.last = None


lag_zscore = udtf(_LagZscore)


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL in this session."""
    spark.udtf.register("lag_zscore", lag_zscore)
