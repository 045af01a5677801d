"""The test tables seen as the inputs of the jobs.

Each text is plain SQL that Spark and DuckDB both read. Names in braces stand
for tables; :func:`view` fills them with DataFrames, :func:`sql` with the names
themselves. Tables and views are looked up once per session, as from a catalog.
"""

from __future__ import annotations

from functools import lru_cache
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "restaurants": """
        SELECT s_suppkey AS restaurant_id, concat(' ', s_name, ' ') AS name,
               lower(s_name) AS cnpj,
               concat('cuisine_', CAST(s_nationkey % 5 AS STRING)) AS cuisine_type,
               r_name AS country, n_name AS city
        FROM {supplier}
        JOIN {nation} ON s_nationkey = n_nationkey
        JOIN {region} ON n_regionkey = r_regionkey""",
    "ratings": """
        SELECT l_orderkey * 10 + l_linenumber AS rating_id,
               concat('supplier#', lpad(CAST(l_suppkey AS STRING), 9, '0'))
                   AS restaurant_identifier,
               l_linenumber - 1 AS rating, l_shipdate AS rating_timestamp
        FROM {lineitem}""",
    "products": """
        SELECT p_partkey AS product_id,
               p_partkey % (SELECT count(*) FROM {supplier}) AS restaurant_id,
               p_name AS name, p_type AS product_type, p_brand AS cuisine_type,
               p_retailprice - 901 AS price, p_retailprice / 20 AS unit_cost
        FROM {part}""",
    "inventory": """
        SELECT l_orderkey * 10 + l_linenumber AS stock_id,
               l_partkey % (SELECT count(*) FROM {supplier}) AS restaurant_id,
               l_partkey AS product_id, l_quantity - 5 AS quantity_available,
               l_shipdate AS last_updated
        FROM {lineitem}""",
    "kpi_orders": """
        SELECT o_orderkey AS order_id, o_orderdate AS order_date,
               o_custkey % 50 AS restaurant_key, o_totalprice AS total_amount
        FROM {orders}""",
    "kpi_status": """
        SELECT l_orderkey AS order_identifier, concat(l_returnflag, l_linestatus) AS status_name,
               l_shipdate AS dt_current_timestamp
        FROM {lineitem}""",
    "rt_orders": """
        SELECT user_id AS order_id, ts AS order_date, user_id % 20 AS restaurant_key,
               event_id % 40 AS driver_key, user_id AS user_key,
               CAST(value AS DECIMAL(10, 2)) AS total_amount,
               ts AS dt_current_timestamp
        FROM {events} WHERE event_type = 'purchase'""",
    "rt_status": """
        SELECT event_id AS status_id, user_id AS order_identifier,
               CASE event_type WHEN 'click' THEN 'In Transit' WHEN 'view' THEN 'Out for Delivery'
                   WHEN 'signup' THEN 'Preparing' ELSE 'Order Delivered' END AS status_name,
               ts AS status_timestamp, ts AS dt_current_timestamp
        FROM {events} WHERE event_type <> 'purchase'""",
    "delivery_users": """
        SELECT o_custkey AS cpf, o_custkey AS user_id,
               CASE WHEN o_orderkey % 4 <> 0 THEN concat('u', CAST(o_custkey AS STRING), '@x') END
                   AS email,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS delivery_address,
               nullif(o_orderpriority, '5-LOW') AS city,
               o_orderdate AS dt_current_timestamp, o_orderkey AS ingestion_order
        FROM {orders}""",
    "profile_users": """
        SELECT user_id AS cpf, user_id,
               CASE WHEN event_id % 6 <> 0 THEN event_type END AS first_name,
               event_type AS last_name,
               CASE WHEN event_id % 7 <> 0
                   THEN DATE '2024-01-01' - CAST(floor(value * 100) AS INT) END AS birthday,
               CASE event_type WHEN 'click' THEN 'Gerente' WHEN 'view' THEN 'Analista Junior'
                   WHEN 'signup' THEN 'Engenheiro' WHEN 'error' THEN 'Outro' END AS job,
               ts AS dt_current_timestamp, event_id AS ingestion_order
        FROM {events}""",
    "delivery_changes": """
        SELECT user_id AS cpf, event_id AS user_id,
               CASE WHEN event_id % 3 <> 0 THEN concat('u', CAST(user_id AS STRING), '@x') END
                   AS email,
               CASE WHEN event_id % 5 <> 0 THEN event_type END AS delivery_address,
               CAST(CAST(floor(value / 40) AS INT) AS STRING) AS city,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
                   ELSE 'UPDATE' END AS operation,
               event_id AS sequencenum, ts AS dt_current_timestamp
        FROM {events} WHERE event_id % 2 = 0""",
    "profile_changes": """
        SELECT user_id AS cpf, event_id AS user_id, event_type AS first_name,
               CASE WHEN event_id % 7 <> 0 THEN event_type END AS last_name,
               CASE WHEN event_id % 11 <> 0 THEN 'Gerente' END AS job,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE'
                   ELSE 'UPDATE' END AS operation,
               event_id AS sequencenum, ts AS dt_current_timestamp
        FROM {events} WHERE event_id % 2 = 1""",
}


def _tables(text: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(text) if name}


@lru_cache(maxsize=256)
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _tables(text)})


def sql(name: str) -> str:
    text = VIEWS[name]
    return text.format(**{t: t for t in _tables(text)})


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
