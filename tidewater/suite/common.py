"""Shared helpers for the registered queries and their DuckDB oracles.

Comparison conventions (both sides): floating results are rounded to 6
places; money sums are computed in DECIMAL so they do not depend on the
summation order, then cast to DOUBLE; lists are sorted or given in long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.derived import shape_sql
from ..sources.tables import Tables

DIGITS = 6


def tables(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE/FLOAT column (the oracle rounds the same columns)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def money(c) -> F.Column:
    """Exact cents: sums of these do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def with_shapes(sql: str, *names: str) -> str:
    """Prefix an oracle query with the derived shapes it uses as CTEs."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({shape_sql(n)})" for n in names)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
