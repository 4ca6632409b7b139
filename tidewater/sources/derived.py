"""Working shapes derived from the driver's tables.

Each shape is one SQL text with ``{table}`` placeholders.  Spark runs it with
``spark.sql(text, orders=df, ...)`` (DataFrames bound as arguments, no global
views); the DuckDB oracle formats the placeholders with its view names.  One
text, two engines, so both sides see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import table

# stock(ticker, date, open, high, low, close, volume): unique per (ticker, date)
STOCK_SQL = """
SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date,
       MIN(o_totalprice) AS open, MAX(o_totalprice) AS high, MIN(o_totalprice) AS low,
       MAX(o_totalprice) AS close, CAST(COUNT(*) AS DOUBLE) AS volume
FROM {orders} GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
"""

# query_log(query_id, query_text, execution_time, status, rows_produced, session_id)
QUERY_LOG_SQL = """
SELECT event_id AS query_id,
       CASE event_type
         WHEN 'click'    THEN concat('UPDATE customers SET name = ''n', CAST(event_id AS STRING), ''' WHERE id = ', CAST(user_id AS STRING))
         WHEN 'signup'   THEN concat('INSERT INTO customers (name, email) VALUES (''n', CAST(event_id AS STRING), ''', ''e'')')
         WHEN 'purchase' THEN concat('UPDATE orders SET status = ''s'' WHERE order_id = ', CAST(user_id AS STRING))
         WHEN 'error'    THEN concat('DELETE FROM orders WHERE order_id = ', CAST(event_id AS STRING))
         ELSE CASE event_id % 3
                WHEN 0 THEN 'SELECT * FROM users u JOIN orders o ON u.id = o.user_id JOIN shipments s'
                WHEN 1 THEN 'SELECT * FROM users u JOIN (SELECT id, amount FROM payments) p JOIN orders o USING (id)'
                ELSE 'SELECT * FROM users u JOIN orders o ON u.id = o.user_id' END
       END AS query_text,
       value AS execution_time,
       CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       event_id % 7 AS rows_produced, user_id AS session_id
FROM {events}
"""

# market(date, close): one daily series over all orders (no partition column)
MARKET_SQL = """
SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS close
FROM {orders} GROUP BY CAST(o_orderdate AS DATE)
"""

# trips(pickup_datetime, trip_duration)
TRIPS_SQL = "SELECT ts AS pickup_datetime, value AS trip_duration FROM {events}"

# run status parts(run_id, records_count)
RUN_PARTS_SQL = "SELECT user_id AS run_id, COUNT(*) AS records_count FROM {events} GROUP BY user_id"

SHAPES = {
    "stock": (STOCK_SQL, ("orders",)),
    "market": (MARKET_SQL, ("orders",)),
    "query_log": (QUERY_LOG_SQL, ("events",)),
    "trips": (TRIPS_SQL, ("events",)),
    "run_parts": (RUN_PARTS_SQL, ("events",)),
}


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, deps = SHAPES[name]
    return spark.sql(text, **{d: table(spark, sf_dir, d) for d in deps})


def shape_sql(name: str) -> str:
    """The same shape as DuckDB text over the pre-registered views."""
    text, deps = SHAPES[name]
    return text.format(**{d: d for d in deps})


def stock(spark, sf_dir):
    return shape(spark, sf_dir, "stock")


def market(spark, sf_dir):
    return shape(spark, sf_dir, "market")


def query_log(spark, sf_dir):
    return shape(spark, sf_dir, "query_log")


def trips(spark, sf_dir):
    return shape(spark, sf_dir, "trips")


def run_parts(spark, sf_dir):
    return shape(spark, sf_dir, "run_parts")
