"""Driver tables and the flat sales stand-in built from them.

``sales_flat`` maps the TPC-H-shaped tables onto the twelve-column flat
sales layout the engine's reports, cleaning rules and warehouse builders
are written against (see FIXTURES.md §3 for the column mapping).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; filters and projections applied
    later are pushed into this scan by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_revenue(price: Column, discount: Column) -> Column:
    """gross x (1 - discount) as an exact decimal(18,4) (no rounding)."""
    return price.cast("decimal(12,2)") * (F.lit(1) - discount.cast("decimal(4,2)"))


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> region name. nation and region are fixed 25/5-row
    domains (the TPC-H definition), so they are broadcast explicitly; the
    customer side stays partitioned."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", F.col("r_name").alias("region"))
    )


def sales_flat(spark: SparkSession, sf_dir: str, category: bool = True) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part as flat sales rows.

    A report that does not ask for the category leaves out the part join
    (``category=False``): every line has a part, so no row depends on it, and
    the fact is shuffled once, on the order key.

    The fact side (lineitem) is never broadcast; orders joins it on the
    order key (sort-merge at scale), the customer-region and part sides
    join on their keys and are broadcast only when AQE measures them small.
    ``l_partkey``/``l_suppkey`` are kept as the keep-first order columns.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    regions = customer_regions(spark, sf_dir)
    # orders take their region before meeting lineitem: the order-side join
    # shuffles orders (a quarter of lineitem's rows) by customer, and the fact
    # is shuffled twice (order key, part key) instead of three times.
    # lineitem, orders and customer all grow with the data: their joins are
    # sort-merge by design (``merge`` hint), so a growing table is never the
    # broadcast side, whatever a small test scale suggests. part joins
    # unhinted and is broadcast only under Spark's measured-size threshold.
    orders_r = orders.hint("merge").join(regions, orders.o_custkey == regions.c_custkey)
    joined = li.hint("merge").join(orders_r, li.l_orderkey == orders_r.o_orderkey)
    if category:
        joined = joined.join(part, li.l_partkey == part.p_partkey)
    order_date = F.col("o_orderdate").cast("date")
    kind = [F.col("p_type").alias("product_category")] if category else []
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        order_date.alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        *kind,
        F.col("region"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("gross"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.datediff(F.col("l_shipdate").cast("date"), order_date).alias("delivery_days"),
        F.col("l_tax").cast("decimal(3,2)").alias("customer_rating"),
        line_revenue(F.col("l_extendedprice"), F.col("l_discount")).alias("revenue"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
    )


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with deterministic missing values (a CASE on the key), the
    stand-in for a raw extract with holes. Every row is kept."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("o_orderkey"),
        F.when(k % 29 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.col("o_orderstatus"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 31 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales_flat`` as a raw text extract with the defects the cleaning
    rules exist for, injected by a CASE on the key (no row is removed):
    M/d/yyyy date text with unparsable values, missing customer, discount,
    payment, delivery days and rating, zero quantities and
    lower-case/tab-padded category labels."""
    s = sales_flat(spark, sf_dir)
    k = F.col("order_id")

    def unless(mod: int, value: Column, other: Column) -> Column:
        return F.when(k % mod == 0, value).otherwise(other)

    return s.select(
        k.alias("order_id"),
        unless(97, F.lit("13/45/1999"), F.date_format("order_date", "M/d/yyyy")).alias("order_date"),
        unless(101, F.lit(None).cast("long"), F.col("customer_id")).alias("customer_id"),
        unless(
            5, F.concat(F.lit(" "), F.lower("product_category"), F.lit("\t")), F.col("product_category")
        ).alias("product_category"),
        F.col("region"),
        unless(43, F.lit(0), F.col("quantity")).alias("quantity"),
        F.col("gross"),
        unless(53, F.lit(None).cast("decimal(4,2)"), F.col("discount")).alias("discount"),
        unless(19, F.lit(None).cast("string"), F.col("payment_method")).alias("payment_method"),
        unless(17, F.lit(None).cast("int"), F.col("delivery_days")).alias("delivery_days"),
        unless(13, F.lit(None).cast("decimal(3,2)"), F.col("customer_rating")).alias("customer_rating"),
        F.col("revenue"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
    )
