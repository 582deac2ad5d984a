"""Business questions as DataFrame queries over the star schema, and a comparison of answers.

"Now" is the latest order date. Money is summed as decimals, so the order of addition cannot
show in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W



def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _now(orders: DataFrame) -> Column:
    return orders.agg(F.max("o_orderdate")).scalar()


def lapsed_customers(customer: DataFrame, orders: DataFrame, days: int = 90) -> DataFrame:
    """Customers without an order in the last ``days`` days."""
    recent = orders.where(F.col("o_orderdate") >= F.date_sub(_now(orders), days))
    return customer.join(
        recent.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti"
    ).select("c_custkey", "c_name")


def top_products(lineitem: DataFrame, orders: DataFrame, part: DataFrame, n: int = 10) -> DataFrame:
    """Products with the highest revenue in the quarter before the current one."""
    quarter = F.trunc(_now(orders), "quarter")
    last = orders.where(
        (F.col("o_orderdate") >= F.add_months(quarter, -3)) & (F.col("o_orderdate") < quarter)
    )
    price = money("l_extendedprice") * (1 - money("l_discount"))
    items = lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    sold = items.join(last.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")
    top = (
        sold.groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum(price).cast("double").alias("revenue"))
        .orderBy(F.desc("revenue"), "p_partkey")
        .limit(n)
    )
    return part.select("p_partkey", "p_name").join(top, "p_partkey")


def members_with_group_mean(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Suppliers with the mean balance of their nation.

    The means are aggregated first and joined back, so no window holds a whole nation.
    """
    means = supplier.groupBy("s_nationkey").agg(
        (F.sum(money("s_acctbal")).cast("double") / F.count("s_acctbal")).alias("mean_acctbal")
    )
    named = means.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    named = named.select("s_nationkey", "n_name", "mean_acctbal")
    return supplier.join(named, "s_nationkey").select(
        "n_name", "s_name", F.round("mean_acctbal", 4).alias("mean_acctbal")
    )


def open_orders_last_month(orders: DataFrame) -> DataFrame:
    month = F.trunc(_now(orders), "month")
    return orders.where(
        (F.col("o_orderdate") >= F.add_months(month, -1))
        & (F.col("o_orderdate") < month)
        & (F.col("o_orderstatus") == "O")
    ).select("o_orderkey", "o_custkey", "o_totalprice")


def running_total_this_year(orders: DataFrame) -> DataFrame:
    """Sales per month of the current year and their running total; twelve rows at most."""
    year = F.trunc(_now(orders), "year")
    months = (
        orders.where(F.col("o_orderdate") >= year)
        .groupBy(F.month("o_orderdate").alias("month"))
        .agg(F.sum(money("o_totalprice")).alias("_sales"))
    )
    so_far = W.orderBy("month").rowsBetween(W.unboundedPreceding, 0)
    return months.select(
        "month",
        F.col("_sales").cast("double").alias("sales"),
        F.sum("_sales").over(so_far).cast("double").alias("running_total"),
    )


def duplicate_values(df: DataFrame, value: str, key: str) -> DataFrame:
    """Values that occur more than once, by digest: the texts themselves are not shuffled."""
    return (
        df.groupBy(F.sha2(value, 256).alias("digest"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_key"))
        .where("n_rows > 1")
    )


def days_to_ship(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Mean days from order to shipment per product type."""
    shipped = lineitem.select("l_orderkey", "l_partkey", "l_shipdate").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
    )
    per_part = shipped.groupBy("l_partkey").agg(
        F.sum(F.date_diff("l_shipdate", "o_orderdate").cast("bigint")).alias("days"),
        F.count(F.lit(1)).alias("n"),
    )
    typed = per_part.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return typed.groupBy("p_type").agg(
        F.round(F.sum("days") / F.sum("n"), 6).alias("mean_days"), F.sum("n").alias("n_items")
    )


def big_spenders(customer: DataFrame, orders: DataFrame, above: int = 10_000) -> DataFrame:
    """Customers who spent more than ``above`` this year, highest first."""
    year = F.trunc(_now(orders), "year")
    spent = (
        orders.where(F.col("o_orderdate") >= year)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(money("o_totalprice")).cast("double").alias("spent"))
        .where(F.col("spent") > above)
    )
    return (
        spent.join(customer.select("c_custkey", "c_name"), "c_custkey")
        .select("c_custkey", "c_name", "spent")
        .orderBy(F.desc("spent"), "c_custkey")
    )


def recent_orders(orders: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` latest orders of each customer; tasks keep no more than that before the shuffle."""
    latest = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return (
        orders.select("o_custkey", "o_orderkey", "o_orderdate")
        .withColumn("place", F.row_number().over(latest))
        .where(F.col("place") <= n)
        .select("o_custkey", "o_orderkey", "place")
    )


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target rows with those of ``changes`` put in their place or added; ``key`` is unique in both."""
    others = [c for c in target.columns if c != key]
    new = changes.select(key, F.struct(*others).alias("_new"))
    both = target.withColumn("_old", F.struct(*others)).select(key, "_old").join(new, key, "full")
    row = F.coalesce("_new", "_old")
    return both.select(key, *[row.getField(c).alias(c) for c in others])


def difference(candidate: DataFrame, gold: DataFrame) -> DataFrame:
    """Rows, counted with repeats, that only one side has; empty when the answers agree."""
    only_candidate = candidate.exceptAll(gold).withColumn("side", F.lit("candidate"))
    return only_candidate.unionByName(
        gold.exceptAll(candidate).withColumn("side", F.lit("gold"))
    )
