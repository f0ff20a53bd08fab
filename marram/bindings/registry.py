"""Named queries and shared bindings of tables to roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.schema import MeasuredTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Four measurements and a three-way class; the table has no unique key.
LINES = MeasuredTable(
    features=("quantity", "price", "discount", "tax"),
    label="return_flag",
    codes={"A": 0, "N": 1, "R": 2},
    rename={"l_quantity": "quantity", "l_extendedprice": "price", "l_discount": "discount",
            "l_tax": "tax", "l_returnflag": "return_flag"},
    products={
        "quantity_squared": ("quantity", "quantity"),
        "price_squared": ("price", "price"),
        "quantity_price": ("quantity", "price"),
        "discount_tax": ("discount", "tax"),
        "quantity_discount": ("quantity", "discount"),
    },
)

# A keyed, timed table with four measurements and a five-way class.
EVENTS = MeasuredTable(
    features=("value", "k", "user", "hour"),
    label="event_type",
    codes={"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4},
    products={
        "value_squared": ("value", "value"),
        "k_squared": ("k", "k"),
        "value_k": ("value", "k"),
        "user_hour": ("user", "hour"),
        "value_user": ("value", "user"),
    },
)

STATUS_CODES = {"F": 0, "O": 1, "P": 2}

# The same event measurements in SQL, for oracles.
EVENT_SQL = """
    select event_id, ts, event_type, value,
           cast(json_extract_string(props, '$.k') as double) as k,
           cast(user_id as double) as "user", cast(hour(ts) as double) as hour
    from events
"""


def event_measurements(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("user_id").cast("double").alias("user"), F.hour("ts").cast("double").alias("hour"),
    )


def price_rule() -> Column:
    """A fixed classifier on the order price, so metrics have exact answers."""
    price = F.col("o_totalprice")
    return F.when(price < 150000, "F").when(price < 300000, "O").otherwise("P")


PRICE_RULE_SQL = "case when o_totalprice < 150000 then 'F' when o_totalprice < 300000 then 'O' else 'P' end"
