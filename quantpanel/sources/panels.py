"""Daily panels derived from the order-line, order and event tables.

There is no price table among the inputs, so the panels take their prices from order lines.
Raw unit prices jump by orders of magnitude from day to day; `100 + p / 9973` keeps compound
products finite. The divisor is a prime, so that no price ends in a digit 5 on which two
engines could round differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Which order priority plays which series.
MATURITIES = {"1-URGENT": "3m", "2-HIGH": "2y", "3-MEDIUM": "10y"}
VIX_PRIORITY = "5-LOW"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price_columns() -> list:
    discounted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    quantity = F.sum("l_quantity")
    return [
        (100 + F.sum(discounted) / quantity / 9973).alias("adj_close"),
        (100 + F.avg(F.col("l_extendedprice") / F.col("l_quantity")) / 9973).alias("close"),
        quantity.alias("volume"),
        F.sum("l_extendedprice").alias("dollar_volume"),
    ]


def prices_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few tickers, nearly dense: one ticker per part type."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("p_type").alias("ticker"))
        .agg(*_price_columns())
    )


def prices_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many tickers, sparse: one ticker per supplier; grows with the scale factor."""
    ticker = F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"), ticker.alias("ticker"))
        .agg(*_price_columns())
    )


def macro_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, date, value): one series per order priority."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("series_id"),
            F.col("o_orderdate").cast("date").alias("date"),
        )
        .agg((F.avg("o_totalprice") / 9973).alias("value"))
    )


def treasury_yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    maturity = F.coalesce(
        *[F.when(F.col("series_id") == k, F.lit(v)) for k, v in MATURITIES.items()]
    )
    rows = macro_series(spark, sf_dir).filter(F.col("series_id").isin(list(MATURITIES)))
    return rows.select("date", maturity.alias("maturity"), F.col("value").alias("yield_pct"))


def vix_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = macro_series(spark, sf_dir).filter(F.col("series_id") == VIX_PRIORITY)
    return rows.select(F.lit("VIXCLS").alias("series_id"), "date", "value")


def factor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily factor-shaped table with provenance columns, from customer orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            (F.ln(F.avg("o_totalprice")) / 100).alias("Mkt-RF"),
            (F.max("o_totalprice") / 1e6).alias("SMB"),
            (F.min("o_totalprice") / 1e6).alias("HML"),
            F.count("*").cast("double").alias("Mom"),
        )
        .withColumn("source_name", F.lit("orders"))
        .withColumn("source_version", F.lit("1"))
    )


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, accepted_ts, value, form, seq): facts with the moment they became known."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        F.col("ts").alias("accepted_ts"),
        "value",
        F.col("event_type").alias("form"),
        F.col("event_id").alias("seq"),
    )
