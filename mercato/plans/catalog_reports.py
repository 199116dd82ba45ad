"""Report queries (A1-A12, L1-L3, S7, S11) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import reports
from mercato.plans.registry import register
from mercato.plans.sql_fragments import SALES_FLAT, with_ctes
from mercato.sources.tables import line_revenue, sales_flat, table


@register(
    "revenue_by_category",
    covers="S3 J3 A1 A3 L1 P1 P5 P8",
    oracle="""
SELECT p.p_type AS product_category,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))))
            AS DECIMAL(38,2)) AS total_revenue,
       COUNT(*) AS order_count
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_type
ORDER BY total_revenue DESC""",
)
def q_revenue_by_category(spark, sf_dir):
    """Eager aggregation: every line item has exactly one part, so revenue
    and row counts are summed per part key first (map-side combine; a hot
    part collapses before the shuffle), one row per part meets the part
    table, and the per-category totals are exact decimal sums of those."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", line_revenue(F.col("l_extendedprice"), F.col("l_discount")).alias("revenue")
    )
    per_part = li.groupBy("l_partkey").agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product_category"))
    return reports.revenue_by_category(
        per_part.join(part, per_part.l_partkey == part.p_partkey), weight="lines"
    )


@register(
    "revenue_by_region_month",
    covers="A2 G1 L1",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT region, strftime(order_date, '%Y-%m') AS month,
       CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
FROM sales_flat GROUP BY region, month ORDER BY month, region""",
)
def q_revenue_by_region_month(spark, sf_dir):
    return reports.revenue_by_region_month(sales_flat(spark, sf_dir, category=False))


@register(
    "revenue_by_region_year",
    covers="A4 P2 G3",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT region, CAST(year(order_date) AS INTEGER) AS order_year,
       CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
FROM sales_flat GROUP BY region, order_year ORDER BY order_year, region""",
)
def q_revenue_by_region_year(spark, sf_dir):
    return reports.revenue_by_region_year(sales_flat(spark, sf_dir, category=False))


@register(
    "top_customers",
    covers="A5 L2",
    oracle="""
SELECT o_custkey AS customer_id,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
       COUNT(*) AS order_count
FROM orders GROUP BY o_custkey
ORDER BY total_spent DESC, customer_id ASC LIMIT 10""",
)
def q_top_customers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
    )
    return reports.top_customers(orders, 10)


@register(
    "top_customers_filtered",
    covers="A8 F4 L2",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_spent, COUNT(*) AS order_count
FROM sales_flat WHERE region = 'AMERICA' AND order_date >= DATE '1998-06-01'
GROUP BY customer_id ORDER BY total_spent DESC, customer_id ASC LIMIT 10""",
)
def q_top_customers_filtered(spark, sf_dir):
    return reports.top_customers_filtered(sales_flat(spark, sf_dir, category=False), "AMERICA", "1998-06-01", 10)


@register(
    "avg_by_priority",
    covers="A6",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT payment_method, CAST(AVG(customer_rating) AS DECIMAL(10,6)) AS avg_rating, COUNT(*) AS order_count
FROM sales_flat GROUP BY payment_method ORDER BY avg_rating DESC""",
)
def q_avg_by_priority(spark, sf_dir):
    return reports.avg_rating_by_payment(sales_flat(spark, sf_dir, category=False))


@register(
    "delivery_bucket",
    covers="A7 P4",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT CASE WHEN delivery_days <= 3 THEN '1-3 days'
            WHEN delivery_days <= 7 THEN '4-7 days'
            ELSE '8+ days' END AS delivery_bucket,
       CAST(AVG(customer_rating) AS DECIMAL(10,6)) AS avg_rating,
       COUNT(*) AS order_count
FROM sales_flat GROUP BY delivery_bucket ORDER BY delivery_bucket""",
)
def q_delivery_bucket(spark, sf_dir):
    return reports.rating_by_delivery_bucket(sales_flat(spark, sf_dir, category=False))


@register(
    "sql_view_revenue",
    covers="S7 A1 (Spark SQL route)",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT product_category, NULL AS region, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
FROM sales_flat GROUP BY product_category
UNION ALL
SELECT NULL, region, CAST(sum(revenue) AS DECIMAL(38,2)) FROM sales_flat GROUP BY region""",
)
def q_sql_view_revenue(spark, sf_dir):
    """Revenue by category and by region in one pass over a view."""
    sales_flat(spark, sf_dir).createOrReplaceTempView("sales")
    return spark.sql(
        """SELECT product_category, region, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
           FROM sales GROUP BY GROUPING SETS ((product_category), (region))"""
    )


@register(
    "sql_view_top_customers",
    covers="S7 A5 L2 (Spark SQL route)",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT DISTINCT ON (region) region, customer_id AS best_customer, CAST(sum(revenue) AS DECIMAL(38,2)) AS best_total
FROM sales_flat GROUP BY region, customer_id ORDER BY region, best_total DESC""",
)
def q_sql_view_top_customers(spark, sf_dir):
    """The customer with the highest revenue in each region."""
    sales_flat(spark, sf_dir, category=False).createOrReplaceTempView("sales")
    return spark.sql(
        """WITH spent AS (SELECT region, customer_id, sum(revenue) AS spent FROM sales GROUP BY region, customer_id)
           SELECT region, max_by(customer_id, spent) AS best_customer, CAST(max(spent) AS DECIMAL(38,2)) AS best_total
           FROM spent GROUP BY region"""
    )


@register(
    "year_distribution",
    covers="A12",
    oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS order_count,
       MAX(CAST(o_orderdate AS DATE)) AS max_date, MIN(CAST(o_orderdate AS DATE)) AS min_date
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY order_year ORDER BY order_year""",
)
def q_year_distribution(spark, sf_dir):
    return reports.year_distribution(table(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "max_date",
    covers="A12",
    oracle="""
SELECT MIN(CAST(o_orderdate AS DATE)) AS min_date, MAX(CAST(o_orderdate AS DATE)) AS max_date,
       COUNT(*) AS row_count FROM orders""",
)
def q_max_date(spark, sf_dir):
    return reports.date_range(table(spark, sf_dir, "orders"), "o_orderdate")


@register(
    "preview",
    covers="S11 L3",
    oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 5""",
)
def q_preview(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return reports.preview(li, 5, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])
