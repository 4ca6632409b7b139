"""Reading the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import IN_PIECES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; filters and projections applied later are pushed into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.options(**IN_PIECES).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the tables of one scale-factor folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self._spark, self._dir, name)
