"""Window features, z-scores, scaling and anomaly flags (W*, F*).

Series windows come in two forms with identical results:
``scalable=True`` (default) runs through ``plans.halo_window`` so neither an
un-partitioned series nor one hot key ends up in a single task;
``scalable=False`` is the textbook ``Window`` form, kept for comparison.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import day_of_week_sun0, threshold_flag, zscore_guarded
from ..plans.halo_window import bounded_window, running_moments


# A series has one row per date within its partition, so 1024-day ranges hold at
# most 1024 rows: dates need no bucket-width probe (other keys are probed once).
DATE_BUCKET_DAYS = 1024


def _order_cols(df: DataFrame, order: str) -> tuple[DataFrame, list[str]]:
    """Numeric leading order column for the position plan (dates -> day number)."""
    dt = dict(df.dtypes)[order]
    if dt == "date":
        return df.withColumn("_tw_o", F.unix_date(order)), ["_tw_o"]
    if dt.startswith("timestamp"):
        return df.withColumn("_tw_o", F.unix_micros(F.col(order).cast("timestamp"))), ["_tw_o"]
    return df, [order]


def _width(df: DataFrame, order: str):
    return DATE_BUCKET_DAYS if dict(df.dtypes)[order] == "date" else None


def series_window(df: DataFrame, order: str, lookback: int, make_cols,
                  partition: Sequence[str] = (), scalable: bool = True,
                  block_rows: int = 1 << 16) -> DataFrame:
    """Apply ``make_cols(window)`` over a series ordered by ``order`` (unique within
    ``partition``), looking back at most ``lookback`` rows."""
    if not scalable:
        w = Window.partitionBy(*partition).orderBy(order) if partition else Window.orderBy(order)
        return df.withColumns(make_cols(w))
    d, oc = _order_cols(df, order)
    out = bounded_window(d, list(partition), oc, lookback, make_cols, block_rows, _width(df, order))
    return out.drop("_tw_o") if oc == ["_tw_o"] else out


# ---------------------------------------------------------------- W

def lag_k(df: DataFrame, col: str, k: int = 5, order: str = "date", partition=(),
          out: str | None = None, scalable: bool = True) -> DataFrame:
    """LAG(col, k) over the series."""
    return series_window(df, order, k,
                         lambda w: {out or f"lag_{k}": F.lag(col, k).over(w)}, partition, scalable)


def lag_fanout(df: DataFrame, col: str = "close", n: int = 5, order: str = "date",
               partition=(), prefix: str = "lag_close_", scalable: bool = True) -> DataFrame:
    """lag_1 .. lag_n as columns, one projection."""
    return series_window(df, order, n, lambda w: {f"{prefix}{i}": F.lag(col, i).over(w)
                                                  for i in range(1, n + 1)}, partition, scalable)


def rolling_std(df: DataFrame, col: str = "close", rows: int = 5, order: str = "date",
                partition=(), out: str = "std_dev", scalable: bool = True) -> DataFrame:
    """STDDEV_SAMP over (rows-1) PRECEDING .. CURRENT ROW."""
    return series_window(df, order, rows - 1, lambda w: {
        out: F.stddev_samp(col).over(w.rowsBetween(-(rows - 1), 0))}, partition, scalable)


def rolling_mean_std(df: DataFrame, col: str = "close", back: int = 5, order: str = "date",
                     partition=(), scalable: bool = True) -> DataFrame:
    """Mean and sample deviation over rows -back..0 (six rows for back=5)."""
    return series_window(df, order, back, lambda w: {
        "rolling_avg": F.avg(col).over(w.rowsBetween(-back, 0)),
        "rolling_stddev": F.stddev_samp(col).over(w.rowsBetween(-back, 0))}, partition, scalable)


def lag_mean_std(df: DataFrame, col: str = "close", n: int = 5, order: str = "date",
                 partition=(), strict: bool = True, scalable: bool = True) -> DataFrame:
    """Mean and sample deviation of lag_1..lag_n (the current row excluded);
    with ``strict`` both are NULL until all n lags exist."""
    def make(w: WindowSpec):
        fr = w.rowsBetween(-n, -1)
        full = F.count(col).over(fr) == n
        m, s = F.avg(col).over(fr), F.stddev_samp(col).over(fr)
        if strict:
            m, s = F.when(full, m), F.when(full, s)
        return {"rolling_avg": m, "rolling_stddev": s}
    return series_window(df, order, n, make, partition, scalable)


def lag_sum_avg(df: DataFrame, col: str = "close", n: int = 5, divisor: float = 5,
                order: str = "date", partition=(), scalable: bool = True) -> DataFrame:
    """(col + lag_1 + .. + lag_n) / divisor — six terms over five as written;
    NULL while any lag is missing."""
    def make(w):
        total = F.col(col)
        for i in range(1, n + 1):
            total = total + F.lag(col, i).over(w)
        return {"rolling_avg": total / F.lit(float(divisor))}
    return series_window(df, order, n, make, partition, scalable)


def cumulative_std(df: DataFrame, col: str = "close", order: str = "date", partition=(),
                   out: str = "rolling_stddev", scalable: bool = True) -> DataFrame:
    """Sample deviation from the start of the series to the current row
    (default ordered frame; the order key is unique within the partition)."""
    if not scalable:
        w = (Window.partitionBy(*partition) if partition else Window).orderBy(order)
        return df.withColumn(out, F.stddev_samp(col).over(w))
    d, oc = _order_cols(df, order)
    r = running_moments(d, list(partition), oc, col, prefix="_tw_run", width=_width(df, order))
    return (r.withColumnRenamed("_tw_run_std", out)
            .drop("_tw_run_count", "_tw_run_mean", "_tw_o"))


def row_ids(df: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """1-based ids in ``order`` over the whole frame, for columns of any type."""
    from ..plans.ranking import rank_rows
    return rank_rows(df, list(order), out)


def sequence_edges(df: DataFrame, id_col: str, order: str, partition=(),
                   src: str = "src", dst: str = "dst", scalable: bool = True) -> DataFrame:
    """An edge from each item to the next one in order (LEAD), per partition."""
    if not scalable:
        w = (Window.partitionBy(*partition) if partition else Window).orderBy(order)
        e = df.select(*partition, F.col(id_col).alias(src), F.lead(id_col).over(w).alias(dst))
        return e.filter(F.col(dst).isNotNull())
    # lead == lag seen from the other end: number the series, join position+1
    from ..plans.ordinal import ordinal_within
    d, oc = _order_cols(df, order)
    g = list(partition) or ["_tw_all"]
    if not partition:
        d = d.withColumn("_tw_all", F.lit(0))
    p = ordinal_within(d, g, oc + ([id_col] if id_col not in oc else []), out="_tw_pos")
    a = p.select(*g, F.col(id_col).alias(src), "_tw_pos")
    b = p.select(*[F.col(c).alias(f"_tw_b_{c}") for c in g], F.col(id_col).alias(dst),
                 (F.col("_tw_pos") - 1).alias("_tw_bpos"))
    cond = [a[c].eqNullSafe(b[f"_tw_b_{c}"]) for c in g] + [a["_tw_pos"] == b["_tw_bpos"]]
    e = a.join(b, cond).select(*[a[c] for c in partition], src, dst)
    return e


# ---------------------------------------------------------------- F

def lag_zscore(df: DataFrame, col: str = "close", n: int = 5, frame: int = 5,
               order: str = "date", partition=(), scalable: bool = True) -> DataFrame:
    """date, value, lag_n, rolling sample deviation over ``frame`` rows and the
    guarded z-score (value - lag_n) / std, in one window pass."""
    look = max(n, frame - 1)
    out = series_window(df, order, look, lambda w: {
        f"lag_{n}_days": F.lag(col, n).over(w),
        "std_dev": F.stddev_samp(col).over(w.rowsBetween(-(frame - 1), 0))}, partition, scalable)
    return out.withColumn("z_score", zscore_guarded(col, f"lag_{n}_days", "std_dev"))


def rolling_zscore(df: DataFrame, col: str = "close", back: int = 5, order: str = "date",
                   partition=(), scalable: bool = True) -> DataFrame:
    """(value - W4 mean) / W4 deviation, zero-guarded."""
    out = rolling_mean_std(df, col, back, order, partition, scalable)
    return out.withColumn("z_score", zscore_guarded(col, "rolling_avg", "rolling_stddev"))


def ticker_zscore(df: DataFrame, col: str = "close", n: int = 5, divisor: float = 5,
                  order: str = "date", partition=("ticker",), scalable: bool = True) -> DataFrame:
    """(value - W6) / W7 per ticker, zero-guarded."""
    if not scalable:
        a = lag_sum_avg(df, col, n, divisor, order, partition, scalable)
        b = cumulative_std(a, col, order, partition, "rolling_stddev", scalable)
        return b.withColumn("z_score", zscore_guarded(col, "rolling_avg", "rolling_stddev"))

    # one exact position pass shared by the bounded window (W6) and the running
    # moments (W7) of the same series
    def make(w):
        total = F.col(col)
        for i in range(1, n + 1):
            total = total + F.lag(col, i).over(w)
        return {"rolling_avg": total / F.lit(float(divisor))}
    d, oc = _order_cols(df, order)
    width = _width(df, order)
    a = bounded_window(d, list(partition), oc, n, make, width=width, keep_pos=True)
    b = running_moments(a, list(partition), oc, col, prefix="_tw_run", width=width)
    b = (b.withColumnRenamed("_tw_run_std", "rolling_stddev")
         .drop("_tw_run_count", "_tw_run_mean", "_tw_o"))
    return b.withColumn("z_score", zscore_guarded(col, "rolling_avg", "rolling_stddev"))


def lag_mean_zscore(df: DataFrame, col: str = "close", n: int = 5, order: str = "date",
                    partition=(), strict: bool = True, scalable: bool = True) -> DataFrame:
    """(value - mean of lags) / deviation of lags, zero-guarded."""
    out = lag_mean_std(df, col, n, order, partition, strict, scalable)
    return out.withColumn("z_score", zscore_guarded(col, "rolling_avg", "rolling_stddev"))


def time_features(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """pickup_time, hour_of_day, day_of_week (Sunday = 0), month, year."""
    t = F.col(ts).cast("timestamp_ntz")
    return df.withColumns({"pickup_time": t, "hour_of_day": F.hour(t),
                           "day_of_week": day_of_week_sun0(t), "month": F.month(t),
                           "year": F.year(t)})


def fit_standardiser(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F12 (fit): one-row parameter table ``<c>_mean``, ``<c>_std`` (population)."""
    return df.agg(*[x for c in cols for x in (F.avg(F.col(c).cast("double")).alias(f"{c}_mean"),
                                              F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std"))])


def apply_standardiser(df: DataFrame, params: DataFrame | dict, cols: Sequence[str]) -> DataFrame:
    """F12 (apply): (x - mean) / std with the *stored* parameters; zero variance -> 0.

    The parameter table has exactly one row (a global aggregate), so it is read
    as a handful of scalars and inlined as literals — no join, no broadcast."""
    p = params if isinstance(params, dict) else params.first().asDict()
    out = {}
    for c in cols:
        m, s = p[f"{c}_mean"], p[f"{c}_std"]
        x = F.col(c).cast("double")
        out[c] = (F.lit(0.0) if s is None or s == 0 or m is None
                  else (x - F.lit(float(m))) / F.lit(float(s)))
    return df.withColumns(out)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation per column; zero-variance columns -> 0."""
    return apply_standardiser(df, fit_standardiser(df, cols), cols)


def save_params(params: DataFrame, path: str) -> str:
    """persist fitted parameters (one-row Parquet table) for later runs."""
    params.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_params(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F7 check: keys that are NULL or repeated (must be empty before saving)."""
    null_key = None
    for k in keys:
        c = F.col(k).isNull()
        null_key = c if null_key is None else (null_key | c)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | null_key)


def feature_table(df: DataFrame, name: str, keys: Sequence[str], path: str | None = None
                  ) -> DataFrame:
    """create-or-replace a keyed feature table after checking its key; read back."""
    if key_violations(df, keys).limit(1).count():
        raise ValueError(f"key {list(keys)} is not unique and not-null in {name}")
    spark = df.sparkSession
    if path:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def contamination_flags(df: DataFrame, score: str, key: Sequence[str], rate: float = 0.01,
                        out: str = "is_anomaly", accuracy: int = 10000) -> DataFrame:
    """F8: flag exactly ``ceil(rate * n)`` rows with the largest score (ties by key).

    The score at the cut is selected by narrowing: quantiles of the rows in the
    present range give a narrower one around the cut, and counts over the table
    confirm it (or widen it) until one value is left, so a round takes the rows
    in question down by a factor of thousands and the value found is exact.
    Rows above it are flagged, and of the rows tied at it the first by ``key``
    (columns of any type), numbered in parallel.  NULL scores are never flagged
    and count in no rate; NaN is above all numbers, as in Spark's order."""
    from ..plans.ranking import rank_rows
    from ..session import materialise
    df = materialise(df, "contamination_input")  # several passes follow
    value = F.col(score)
    n = df.filter(value.isNotNull()).count()
    k = math.ceil(rate * n)
    if k <= 0 or k >= n:
        return df.withColumn(out, F.when(value.isNotNull(), int(k > 0)).otherwise(0))
    cut, above, tied = _value_at(df.select(score).filter(value.isNotNull()), score, k, n, accuracy)
    high = value > F.lit(cut).cast(df.schema[score].dataType)
    at = value == F.lit(cut).cast(df.schema[score].dataType)
    if tied == k - above:
        return df.withColumn(out, F.when(high | at, 1).otherwise(0))
    ties = rank_rows(df.filter(at), list(key), "_tw_pos")
    flagged = ties.withColumn(out, F.when(F.col("_tw_pos") <= k - above, 1).otherwise(0)).drop("_tw_pos")
    rest = df.filter(~F.coalesce(at, F.lit(False)))
    return rest.withColumn(out, F.when(high, 1).otherwise(0)).unionByName(flagged)


def _value_at(rows: DataFrame, score: str, k: int, n: int, accuracy: int):
    """The ``k``-th largest of ``n`` values, the number above it and the number equal to it."""
    value = F.col(score)
    low, high, above, inside, margin = None, None, 0, n, _margin(n, accuracy)
    while True:
        part = rows if low is None else rows.filter((value >= F.lit(low)) & (value <= F.lit(high)))
        p = 1.0 - (k - above - 0.5) / inside  # the middle of the place of the value
        a, b = part.agg(F.percentile_approx(score, [max(0.0, p - margin), min(1.0, p + margin)], accuracy)).first()[0]
        c = part.agg(F.count_if(value > F.lit(b)).alias("above"), F.count_if((value >= F.lit(a)) & (value <= F.lit(b))).alias("inside")).first()
        if not c["above"] < k - above <= c["above"] + c["inside"]:
            margin *= 4  # the cut is outside: widen, at last to the whole range
            continue
        margin = _margin(c["inside"], accuracy) if c["inside"] < inside else margin / 16
        low, high, above, inside = a, b, above + c["above"], c["inside"]
        if low == high or (low != low and high != high):
            return high, above, inside


def _margin(rows: int, accuracy: int) -> float:
    """Half the width of the next range of ranks, as a share: the sketch's error, or less than a rank."""
    return 4.0 / accuracy if rows > accuracy else 0.25 / rows


def anomaly_threshold(df: DataFrame, score: str, threshold: float = 0.9,
                      out: str = "is_anomaly") -> DataFrame:
    """is_anomaly = 1 when score > threshold, else 0 (NULL -> 0)."""
    return df.withColumn(out, threshold_flag(score, threshold))


def predict_batches(df: DataFrame, predict, out_schema: str, features: Sequence[str]) -> DataFrame:
    """apply a user model to Arrow batches (model built once per task).

    ``predict`` is a factory: ``predict()`` returns a callable pandas.DataFrame ->
    pandas.DataFrame, so heavy models load once per task, not per row."""
    cols = list(features)

    def run(batches):
        model = predict()
        for pdf in batches:
            yield model(pdf[cols] if cols else pdf)
    return df.mapInPandas(run, out_schema)


def linear_model(weights: dict, bias: float, key: str, out: str = "prediction"):
    """A small model factory for ``predict_batches``: out = bias + sum(w * x)."""
    def factory():
        def model(pdf):
            import pandas as pd
            y = pd.Series(bias, index=pdf.index, dtype="float64")
            for c, w in weights.items():
                y = y + w * pdf[c].astype("float64")
            return pd.DataFrame({key: pdf[key], out: y})
        return model
    return factory


def tag_completeness(items: DataFrame, tags: DataFrame, key: str, required: Sequence[str]
                     ) -> DataFrame:
    """per item, each mandatory tag that is missing (absent row or NULL value).

    ``tags`` is wide (one column per tag); the required list is exploded and the
    present tags removed, giving long rows (key, missing_tag)."""
    present = tags.select(key, F.explode(F.array(*[
        F.when(F.col(t).isNotNull(), F.lit(t)) for t in required])).alias("tag")) \
        .filter(F.col("tag").isNotNull())
    need = items.select(key, F.explode(F.array(*[F.lit(t) for t in required])).alias("tag"))
    return need.join(present, [key, "tag"], "left_anti").withColumnRenamed("tag", "missing_tag")
