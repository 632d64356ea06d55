"""Shared derived inputs for the registered queries.

Roles on the driver's tables: entity = customer or user, period = order
year or event day, category = order status / priority or event type,
measure = order price or event value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import table


MONEY = "decimal(18,2)"      # prices of the driver's tables: exact sums in any order


def orders_by_year(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """orders with an int ``year`` column (only the needed columns are read)."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice", *extra)
    return o.withColumn("year", F.year("o_orderdate")).drop("o_orderdate")


def events_by_day(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """events with an int ``day`` (days since 1970-01-01)."""
    e = table(spark, sf, "events", "user_id", "ts", *extra)
    return e.withColumn("day", F.unix_date(F.to_date("ts"))).drop("ts")


def r6(c):
    """Round a floating result to 6 places (engines add in different orders)."""
    return F.round(c, 6)
