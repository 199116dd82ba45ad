"""Revenue, customer and delivery reports over flat sales rows.

Every report is one ``groupBy().agg()``: Spark plans a partial
(map-side) hash aggregate, one exchange on the grouping keys and a final
aggregate, so a hot key (one category holding a third of the rows) is
collapsed before the shuffle. Money is summed as exact decimals so the
result does not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.scalar import delivery_bucket, month_key, money

def _row_count(weight: str | None):
    """COUNT(*) over raw rows, or SUM(weight) over pre-aggregated rows."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")


def revenue_by_category(sales: DataFrame, category: str = "product_category", weight: str | None = None) -> DataFrame:
    """SUM(revenue), COUNT(*) by category, largest first (A1, A3, L1).

    ``weight`` names a row-count column when ``sales`` is already
    partially aggregated (eager aggregation below a join)."""
    return (
        sales.groupBy(F.col(category).alias("product_category"))
        .agg(
            money(F.sum("revenue")).alias("total_revenue"),
            _row_count(weight).alias("order_count"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("product_category"))
    )


def revenue_by_region_month(sales: DataFrame) -> DataFrame:
    """SUM(revenue) by (region, yyyy-MM), ordered by month, region (A2, G1)."""
    return (
        sales.groupBy(F.col("region"), month_key("order_date").alias("month"))
        .agg(money(F.sum("revenue")).alias("total_revenue"))
        .orderBy("month", "region")
    )


def with_order_year(sales: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Add ``order_year``."""
    return sales.withColumn("order_year", F.year(date_col))


def revenue_by_region_year(sales: DataFrame) -> DataFrame:
    """SUM(revenue) by (region, order_year) (A4)."""
    return (
        with_order_year(sales)
        .groupBy("region", "order_year")
        .agg(money(F.sum("revenue")).alias("total_revenue"))
        .orderBy("order_year", "region")
    )


def customer_spend(sales: DataFrame, amount: str = "revenue") -> DataFrame:
    """SUM(amount), COUNT(*) per customer (A5)."""
    return sales.groupBy("customer_id").agg(
        money(F.sum(amount)).alias("total_spent"),
        F.count(F.lit(1)).alias("order_count"),
    )


def top_customers(sales: DataFrame, k: int = 10, amount: str = "revenue") -> DataFrame:
    """Top-k customers by spend (A5, L2).

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: every task
    keeps its own k best rows, only k x tasks rows reach the final merge.
    The customer id breaks ties so the k rows are deterministic.
    """
    return customer_spend(sales, amount).orderBy(F.desc("total_spent"), F.asc("customer_id")).limit(k)


def top_customers_filtered(
    sales: DataFrame, region: str, since: str, k: int = 10
) -> DataFrame:
    """Top-k spend restricted to one region and dates on/after ``since``.

    The filter sits under the aggregate, so Catalyst pushes it into the
    scan of the table that carries the column."""
    filtered = sales.filter((F.col("region") == region) & (F.col("order_date") >= F.lit(since).cast("date")))
    return top_customers(filtered, k)


def avg_rating_by_payment(sales: DataFrame) -> DataFrame:
    """AVG(rating), COUNT(*) by payment method (A6); avg skips nulls,
    count(*) counts every row."""
    return (
        sales.groupBy("payment_method")
        .agg(
            F.avg("customer_rating").cast("decimal(10,6)").alias("avg_rating"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .orderBy(F.desc("avg_rating"), F.asc("payment_method"))
    )


def rating_by_delivery_bucket(sales: DataFrame) -> DataFrame:
    """AVG(rating), COUNT(*) by delivery-time bucket."""
    return (
        sales.groupBy(delivery_bucket("delivery_days").alias("delivery_bucket"))
        .agg(
            F.avg("customer_rating").cast("decimal(10,6)").alias("avg_rating"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .orderBy("delivery_bucket")
    )


def year_distribution(df: DataFrame, date_col: str) -> DataFrame:
    """Row count and latest date per calendar year (A12): the check made
    before calling a far-future date an outlier."""
    return (
        df.filter(F.col(date_col).isNotNull())
        .groupBy(F.year(date_col).alias("order_year"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.max(F.col(date_col).cast("date")).alias("max_date"),
            F.min(F.col(date_col).cast("date")).alias("min_date"),
        )
        .orderBy("order_year")
    )


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """Overall MIN/MAX date and row count in one aggregate."""
    return df.agg(
        F.min(F.col(date_col).cast("date")).alias("min_date"),
        F.max(F.col(date_col).cast("date")).alias("max_date"),
        F.count(F.lit(1)).alias("row_count"),
    )


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First n rows in a stated order (S11, L3); without an order Spark's
    ``limit`` returns an arbitrary n rows."""
    return df.orderBy(*order_by).limit(n)
