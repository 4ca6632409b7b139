"""Registered queries for W*, F*, J3 over the stock/market/trips shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import features as FT
from ..operators import tablefn
from ..operators.relational import join_on_date
from ..session import materialise, scratch_path
from ..sources import derived
from .common import rounded, tables, with_shapes

Q, O = {}, {}


def reg(name, oracle=None):
    def deco(fn):
        Q[name] = fn
        if oracle is not None:
            O[name] = oracle
        return fn
    return deco


def _lags(n, part=""):
    p = f"PARTITION BY {part} " if part else ""
    return ", ".join(f"LAG(close, {i}) OVER ({p}ORDER BY date) AS lag_close_{i}" for i in range(1, n + 1))


@reg("lag_k", with_shapes("SELECT date, close, LAG(close, 5) OVER (ORDER BY date) AS lag_5 FROM market",
                          "market"))
def _w1(spark, sf):
    return FT.lag_k(derived.market(spark, sf), "close", 5)


@reg("lag_fanout", with_shapes(f"SELECT ticker, date, close, {_lags(5, 'ticker')} FROM stock", "stock"))
def _w2(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    return FT.lag_fanout(s, "close", 5, partition=["ticker"])


@reg("rolling_std_5", with_shapes("""SELECT date, close, ROUND(STDDEV_SAMP(close) OVER
  (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS std_dev FROM market""", "market"))
def _w3(spark, sf):
    return rounded(FT.rolling_std(derived.market(spark, sf), "close", 5))


@reg("rolling_mean_std_6", with_shapes("""SELECT date, close,
  ROUND(AVG(close) OVER (ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS rolling_avg,
  ROUND(STDDEV_SAMP(close) OVER (ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS rolling_stddev
  FROM market""", "market"))
def _w4(spark, sf):
    return rounded(FT.rolling_mean_std(derived.market(spark, sf), "close", 5))


LAGMS = """SELECT date, close,
  CASE WHEN COUNT(close) OVER w = 5 THEN AVG(close) OVER w END AS rolling_avg,
  CASE WHEN COUNT(close) OVER w = 5 THEN STDDEV_SAMP(close) OVER w END AS rolling_stddev
  FROM market WINDOW w AS (ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"""


@reg("lag_mean_std", with_shapes(f"SELECT date, close, ROUND(rolling_avg, 6) AS rolling_avg, "
                                 f"ROUND(rolling_stddev, 6) AS rolling_stddev FROM ({LAGMS})", "market"))
def _w5(spark, sf):
    return rounded(FT.lag_mean_std(derived.market(spark, sf), "close", 5))


W6 = ("SELECT ticker, date, close, (close + " + " + ".join(
    f"LAG(close, {i}) OVER (PARTITION BY ticker ORDER BY date)" for i in range(1, 6))
    + ") / 5.0 AS rolling_avg FROM stock")


@reg("lag_sum_avg", with_shapes(f"SELECT ticker, date, close, ROUND(rolling_avg, 6) AS rolling_avg "
                                f"FROM ({W6})", "stock"))
def _w6(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    return rounded(FT.lag_sum_avg(s, "close", 5, 5, partition=["ticker"]))


W7 = "SELECT ticker, date, close, STDDEV_SAMP(close) OVER (PARTITION BY ticker ORDER BY date) AS rolling_stddev FROM stock"


# cumulative deviations of prices (~1e5) are compared to 4 places (10 significant
# digits): two engines' running-variance algorithms agree to ~1e-12 relative only
@reg("cumulative_std", with_shapes(f"SELECT ticker, date, close, ROUND(rolling_stddev, 4) AS "
                                   f"rolling_stddev FROM ({W7})", "stock"))
def _w7(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    out = FT.cumulative_std(s, "close", partition=["ticker"])
    return rounded(out.withColumn("rolling_stddev", F.round("rolling_stddev", 4)))


F2 = """SELECT date, close, lag_5_days, std_dev,
  CASE WHEN std_dev = 0 OR std_dev IS NULL OR lag_5_days IS NULL THEN NULL
       ELSE (close - lag_5_days) / std_dev END AS z_score
  FROM (SELECT date, close, LAG(close, 5) OVER (ORDER BY date) AS lag_5_days,
        STDDEV_SAMP(close) OVER (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS std_dev
        FROM market)"""


@reg("lag_zscore", with_shapes(f"SELECT date, close, lag_5_days, ROUND(std_dev, 6) AS std_dev, "
                               f"ROUND(z_score, 6) AS z_score FROM ({F2})", "market"))
def _f2(spark, sf):
    return rounded(FT.lag_zscore(derived.market(spark, sf), "close", 5, 5))


@reg("lag_zscore_sql", with_shapes("""SELECT ticker, date, close, lag_5_days, ROUND(std_dev, 6) AS std_dev,
  ROUND(CASE WHEN std_dev = 0 OR std_dev IS NULL OR lag_5_days IS NULL THEN NULL ELSE (close - lag_5_days) / std_dev END, 6) AS z_score
  FROM (SELECT ticker, date, close, LAG(close, 5) OVER (PARTITION BY ticker ORDER BY date) AS lag_5_days,
        STDDEV_SAMP(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS std_dev FROM stock)""", "stock"))
def _d2(spark, sf):
    """F2 as a function over a table, called from SQL."""
    tablefn.register(spark)
    stock = derived.stock(spark, sf).select("ticker", "date", "close")
    return rounded(spark.sql("SELECT * FROM lag_zscore(TABLE({stock}) PARTITION BY ticker ORDER BY (date), 'close', 5, 5)", stock=stock))


@reg("join_on_date", with_shapes(f"""SELECT o.date, o.close, ROUND(m.z_score, 6) AS z_score
  FROM market o JOIN ({F2}) m ON o.date = m.date""", "market"))
def _j3(spark, sf):
    m = derived.market(spark, sf)
    metrics = FT.lag_zscore(m, "close", 5, 5)
    return rounded(join_on_date(metrics, m, ["date"], ["z_score"], ["close"]))


F3 = """SELECT date, close, AVG(close) OVER w AS rolling_avg, STDDEV_SAMP(close) OVER w AS rolling_stddev
  FROM market WINDOW w AS (ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"""


@reg("rolling_zscore", with_shapes(f"""SELECT date, close, ROUND(rolling_avg, 6) AS rolling_avg,
  ROUND(rolling_stddev, 6) AS rolling_stddev,
  ROUND(CASE WHEN rolling_stddev = 0 OR rolling_stddev IS NULL OR rolling_avg IS NULL THEN NULL
        ELSE (close - rolling_avg) / rolling_stddev END, 6) AS z_score FROM ({F3})""", "market"))
def _f3(spark, sf):
    return rounded(FT.rolling_zscore(derived.market(spark, sf), "close", 5))


F4 = f"""SELECT a.ticker, a.date, a.close, a.rolling_avg, b.rolling_stddev,
  CASE WHEN b.rolling_stddev = 0 OR b.rolling_stddev IS NULL OR a.rolling_avg IS NULL THEN NULL
       ELSE (a.close - a.rolling_avg) / b.rolling_stddev END AS z_score
  FROM ({W6}) a JOIN ({W7}) b ON a.ticker = b.ticker AND a.date = b.date"""


@reg("ticker_zscore", with_shapes(f"""SELECT ticker, date, close, ROUND(rolling_avg, 6) AS rolling_avg,
  ROUND(rolling_stddev, 4) AS rolling_stddev, ROUND(z_score, 6) AS z_score FROM ({F4})""", "stock"))
def _f4(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    out = FT.ticker_zscore(s)
    return rounded(out.withColumn("rolling_stddev", F.round("rolling_stddev", 4)))


@reg("lag_mean_zscore", with_shapes(f"""SELECT date, close, ROUND(rolling_avg, 6) AS rolling_avg,
  ROUND(rolling_stddev, 6) AS rolling_stddev,
  ROUND(CASE WHEN rolling_stddev = 0 OR rolling_stddev IS NULL OR rolling_avg IS NULL THEN NULL
        ELSE (close - rolling_avg) / rolling_stddev END, 6) AS z_score FROM ({LAGMS})""", "market"))
def _f4b(spark, sf):
    return rounded(FT.lag_mean_zscore(derived.market(spark, sf), "close", 5))


TIME_SQL = """SELECT pickup_datetime, trip_duration, pickup_datetime AS pickup_time,
  CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, CAST(dayofweek(pickup_datetime) AS INTEGER) AS day_of_week,
  CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(year(pickup_datetime) AS INTEGER) AS year FROM trips"""


@reg("time_features", with_shapes(TIME_SQL, "trips"))
def _f5(spark, sf):
    return FT.time_features(derived.trips(spark, sf))


SCALE_COLS = ["hour_of_day", "day_of_week", "month", "year", "trip_duration"]


def _std_sql(src, cols, fit_src=None):
    fit_src = fit_src or src
    params = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS {c}_m, STDDEV_POP(CAST({c} AS DOUBLE)) AS {c}_s"
                       for c in cols)
    scaled = ", ".join(f"ROUND(CASE WHEN p.{c}_s = 0 OR p.{c}_s IS NULL THEN 0.0 ELSE "
                       f"(CAST(t.{c} AS DOUBLE) - p.{c}_m) / p.{c}_s END, 6) AS {c}" for c in cols)
    return f"SELECT {{key}}, {scaled} FROM {src} t, (SELECT {params} FROM {fit_src}) p"


@reg("standardise", with_shapes("WITH tf AS (" + TIME_SQL + ")\n" +
                                _std_sql("tf", SCALE_COLS).format(key="t.pickup_datetime"), "trips"))
def _f6(spark, sf):
    tf = FT.time_features(derived.trips(spark, sf)).select("pickup_datetime", *SCALE_COLS)
    return rounded(FT.standardise(tf, SCALE_COLS))


@reg("feature_key_violations", """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def _f7(spark, sf):
    li = tables(spark, sf).lineitem
    return FT.key_violations(li, ["l_orderkey", "l_linenumber"])


@reg("feature_table", with_shapes("""SELECT ticker, date, close, lag_5_days, ROUND(std_dev, 6) AS std_dev,
  ROUND(CASE WHEN std_dev = 0 OR std_dev IS NULL OR lag_5_days IS NULL THEN NULL ELSE (close - lag_5_days) / std_dev END, 6) AS z_score
  FROM (SELECT ticker, date, close, LAG(close, 5) OVER (PARTITION BY ticker ORDER BY date) AS lag_5_days,
        STDDEV_SAMP(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS std_dev FROM stock)""", "stock"))
def _f7_table(spark, sf):
    """Created from the rows before 1995, replaced by all, read back."""
    path = scratch_path(spark, f"feature_table/{uuid.uuid4().hex}")
    stock = derived.stock(spark, sf).select("ticker", "date", "close")
    for rows in (stock.filter(F.year("date") < 1995), stock):
        table = FT.feature_table(FT.lag_zscore(rows, "close", 5, 5, partition=["ticker"]), "stock_features", ["ticker", "date"], path)
    return rounded(table)


@reg("contamination_flags", with_shapes(f"""WITH z AS (SELECT ticker, date, ROUND(abs(z_score), 6) AS score FROM ({F4})),
  r AS (SELECT ticker, date, row_number() OVER (ORDER BY score DESC, ticker, date) AS rn,
        COUNT(*) OVER () AS n FROM z WHERE score IS NOT NULL)
  SELECT z.ticker, z.date, z.score, CASE WHEN r.rn <= ceil(0.01 * r.n) THEN 1 ELSE 0 END AS is_anomaly
  FROM z LEFT JOIN r ON z.ticker = r.ticker AND z.date = r.date""", "stock"))
def _f8(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    z = FT.ticker_zscore(s).select("ticker", "date", F.round(F.abs("z_score"), 6).alias("score"))
    return FT.contamination_flags(z, "score", ["ticker", "date"], 0.01).select(
        "ticker", "date", "score", "is_anomaly")


@reg("threshold_flag", with_shapes(f"""SELECT ticker, date, CASE WHEN abs(z_score) > 0.9 THEN 1 ELSE 0 END
  AS is_anomaly FROM ({F4})""", "stock"))
def _f9(spark, sf):
    s = derived.stock(spark, sf).select("ticker", "date", "close")
    z = FT.ticker_zscore(s).withColumn("score", F.abs("z_score"))
    return FT.anomaly_threshold(z, "score", 0.9).select("ticker", "date", "is_anomaly")


@reg("predict_batches", """SELECT event_id, ROUND(0.5 + 2.0 * value - 0.1 * CAST(user_id AS DOUBLE), 6)
  AS prediction FROM events""")
def _f11(spark, sf):
    ev = tables(spark, sf).events.select("event_id", "value", "user_id")
    model = FT.linear_model({"value": 2.0, "user_id": -0.1}, 0.5, key="event_id")
    return rounded(FT.predict_batches(ev, model, "event_id long, prediction double",
                                      ["event_id", "value", "user_id"]))


@reg("apply_params", "WITH a AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'), "
     "f AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16') "
     + _std_sql("a", ["value"], "f").format(key="t.event_id"))
def _f12(spark, sf):
    from ..session import scratch_path
    ev = tables(spark, sf).events.select("event_id", "ts", "value")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    path = scratch_path(spark, "params/events_value")
    FT.save_params(FT.fit_standardiser(ev.filter(F.col("ts") < cut), ["value"]), path)
    later = ev.filter(F.col("ts") >= cut).select("event_id", "value")
    return rounded(FT.apply_standardiser(later, FT.load_params(spark, path), ["value"]))


@reg("tag_completeness", """SELECT d.doc_id, t.tag AS missing_tag FROM documents d,
  (VALUES ('quality'), ('toxic')) t(tag)
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND
    ((t.tag = 'quality' AND l.quality IS NOT NULL) OR (t.tag = 'toxic' AND l.toxic IS NOT NULL)))""")
def _f13(spark, sf):
    t = tables(spark, sf)
    return FT.tag_completeness(t.documents.select("doc_id"), t.labels, "doc_id", ["quality", "toxic"])


@reg("row_ids", """SELECT event_id, event_type, user_id, row_number() OVER (ORDER BY event_type, -user_id, event_id) AS id
  FROM events""")
def _w8(spark, sf):
    """Ids over a text column with few values, a number and a tie-break."""
    ev = tables(spark, sf).events.select("event_id", "event_type", "user_id").withColumn("_minus", -F.col("user_id"))
    return FT.row_ids(ev, ["event_type", "_minus", "event_id"]).drop("_minus")


@reg("isolation_forest_outliers", """SELECT -event_id - 1 AS event_id FROM events WHERE event_id % 500 = 7""")
def _f10_outliers(spark, sf):
    """Events with copies far outside the values of their columns: the copies are those
    that score above the 99th percentile of all and lie outside the columns' ranges."""
    from ..operators.anomaly import isolation_forest_fit, isolation_forest_score
    ev = tables(spark, sf).events.select("event_id", "value", F.hour("ts").cast("double").alias("hour_of_day"), F.col("user_id").cast("double").alias("user_id"))
    low, high = ev.agg(F.min("value"), F.max("value")).first()
    span = (high - low) or 1.0
    odd = ev.filter("event_id % 500 = 7").select((-F.col("event_id") - 1).alias("event_id"), (F.col("value") + F.lit(20 * span)).alias("value"),
                                                 F.lit(300.0).alias("hour_of_day"), (F.col("user_id") + F.lit(1e7)).alias("user_id"))
    rows, cols = ev.unionByName(odd), ["value", "hour_of_day", "user_id"]
    scored = isolation_forest_score(rows, isolation_forest_fit(rows, cols, "event_id", trees=100, sample=512, seed=42), cols, "event_id", sample=512)
    scored = materialise(scored, "isolation_scores")
    cut = scored.agg(F.percentile_approx("anomaly_score", 0.99, 100000)).first()[0]
    return scored.filter((F.col("anomaly_score") > F.lit(cut)) & (F.col("event_id") < 0)).select("event_id")


@reg("isolation_forest")
def _f10(spark, sf):
    from ..operators.anomaly import isolation_forest_fit, isolation_forest_score
    ev = tables(spark, sf).events.select("event_id", "value", F.hour("ts").alias("hour_of_day"), "user_id")
    cols = ["value", "hour_of_day", "user_id"]
    forest = isolation_forest_fit(ev, cols, "event_id", trees=50, sample=256, seed=42)
    return rounded(isolation_forest_score(ev, forest, cols, "event_id", sample=256))
