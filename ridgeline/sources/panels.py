"""Panel views over the star-schema tables, as DataFrames and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series of values a user: irregular timestamps."""
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), F.col("ts").alias("date"), F.col("value").alias("price"))


PX_EVENTS = "SELECT user_id AS symbol, ts AS date, value AS price FROM events"


def _bars(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    u = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("symbol"), F.to_date(F.date_trunc(unit, "l_shipdate")).alias("date"))
        .agg(F.max(u).alias("high"), F.min(u).alias("low"), F.avg(u).alias("close"), F.sum("l_quantity").alias("volume"))
    )


def px_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of unit prices by return flag and day: three symbols, a few missing days."""
    return _bars(spark, sf_dir, "day")


def px_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by week, without gaps."""
    return _bars(spark, sf_dir, "week")


def _bars_sql(unit: str) -> str:
    u = "l_extendedprice / l_quantity"
    return (
        f"SELECT l_returnflag AS symbol, CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS date, max({u}) AS high, min({u}) AS low, "
        f"avg({u}) AS close, sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2"
    )


PX_DAILY, PX_WEEKLY = _bars_sql("day"), _bars_sql("week")


def px_type_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of event values by type and day: five symbols, thirty days."""
    return (
        read(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"))
        .agg(F.max("value").alias("high"), F.min("value").alias("low"), F.avg("value").alias("close"), F.count("value").alias("volume"))
        .withColumn("volume", F.col("volume").cast("double"))
    )


PX_TYPE_DAILY = (
    "SELECT event_type AS symbol, CAST(ts AS DATE) AS date, max(value) AS high, min(value) AS low, avg(value) AS close, "
    "CAST(count(value) AS DOUBLE) AS volume FROM events GROUP BY 1, 2"
)


def fund_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by the customer's nation and month."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .groupBy(F.col("c_nationkey").alias("symbol"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"))
        .agg(F.sum("o_totalprice").alias("revenue"), F.avg("o_totalprice").alias("ticket"), F.count("o_orderkey").alias("orders"))
    )


FUND_MONTHLY = (
    "SELECT c_nationkey AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, sum(o_totalprice) AS revenue, "
    "avg(o_totalprice) AS ticket, count(o_orderkey) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
)


def nation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by nation and day, the left side of as-of joins."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
        .groupBy(F.col("c_nationkey").alias("symbol"), F.to_date("o_orderdate").alias("date"))
        .agg(F.sum("o_totalprice").alias("amount"), F.count("o_orderkey").alias("n"))
    )


NATION_DAILY = (
    "SELECT c_nationkey AS symbol, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS amount, count(o_orderkey) AS n "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
)


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a nation with its region, like a ticker profile."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")
    return joined.select(F.col("n_nationkey").alias("symbol"), F.col("n_name").alias("name"), F.col("r_name").alias("sector"))


PROFILE = "SELECT n_nationkey AS symbol, n_name AS name, r_name AS sector FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"
