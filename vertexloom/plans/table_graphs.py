"""Edge tables derived from the relational tables that the queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trade(spark: SparkSession, folder: str, segment: str | None = None) -> DataFrame:
    """One edge per line item, customer to supplier, weighted by price.

    With ``segment`` a column ``in_segment`` tells whether the customer is in it.
    """
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    flag = []
    if segment is not None:
        # orders meet the customers ahead of the line items, of which there are several times as many
        members = table(spark, folder, "customer").where(F.col("c_mktsegment") == segment)
        members = members.select("c_custkey", F.lit(True).alias("in_segment")).distinct()
        orders = orders.join(members, F.col("o_custkey") == F.col("c_custkey"), "left")
        flag = [F.coalesce("in_segment", F.lit(False)).alias("in_segment")]
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"),
        F.col("l_extendedprice").alias("weight"),
        *flag,
    )


def nation_flow(spark: SparkSession, folder: str) -> DataFrame:
    """One edge per line item, nation of the supplier to nation of the customer.

    Orders meet the customers ahead of the line items, of which there are several times as
    many, and the nations' names come last, from a table of a few rows.
    """
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    nation = table(spark, folder, "nation")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    bought = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    sellers = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("src"))
    buyers = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dst"))
    return (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "s_nationkey", "l_extendedprice")
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, "s_nationkey")
        .join(buyers, "c_nationkey")
        .select("src", "dst", F.col("l_extendedprice").alias("weight"))
    )


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    """One edge per link, page url to link target."""
    pages = table(spark, folder, "pages")
    targets = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return pages.select(F.col("url").alias("src"), F.explode(targets).alias("dst"), F.lit(1.0).alias("weight"))


def user_actions(spark: SparkSession, folder: str) -> DataFrame:
    """One edge per event, user to event type."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("src"),
        F.col("event_type").alias("dst"),
        F.col("value").alias("weight"),
    )
