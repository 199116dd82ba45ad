"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.functions.scalar import clip, normalise_label, parse_date
from mercato.operators import clean
from mercato.plans.registry import register
from mercato.plans.sql_fragments import ORDERS_WITH_GAPS, SALES_FLAT, SALES_RAW, with_ctes
from mercato.sources.tables import orders_with_gaps, sales_flat, sales_raw, table

# The label domains of the stand-in data. Category leaves
# one label out, as the reference's category domain leaves one out.
CATEGORY_DOMAIN = ("Economy", "Large", "Medium", "Promo", "Small")
REGION_DOMAIN = ("Africa", "America", "Asia", "Europe", "Middle East")
PAYMENT_DOMAIN = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

SALES_RULES = clean.CleanRules(
    key="order_id",
    order_by=("l_partkey", "l_suppkey", "quantity", "gross"),
    required=(
        "order_id", "order_date", "customer_id", "product_category",
        "region", "quantity", "gross", "revenue", "discount",
    ),
    price_col="gross",
    domains={
        "product_category": CATEGORY_DOMAIN,
        "region": REGION_DOMAIN,
        "payment_method": PAYMENT_DOMAIN,
    },
    expected_revenue="gross * (1 - discount)",
)


def _sql_case_map(col: str, values) -> str:
    whens = " ".join(f"WHEN '{v.upper()}' THEN '{v}'" for v in values)
    return f"CASE upper(regexp_replace({col}, '^\\s+|\\s+$', '', 'g')) {whens} END"


_LABELLED_SQL = (
    with_ctes(
        SALES_FLAT,
        SALES_RAW,
        """
parsed AS (
  SELECT * REPLACE (CAST(try_strptime(order_date, '%m/%d/%Y') AS DATE) AS order_date)
  FROM sales_raw
)""",
        """
flagged AS (
  SELECT *, (order_id IS NULL OR order_date IS NULL OR customer_id IS NULL OR product_category IS NULL
             OR region IS NULL OR quantity IS NULL OR gross IS NULL OR revenue IS NULL
             OR discount IS NULL) AS missing
  FROM parsed
)""",
        """
med AS (
  SELECT median(CAST(customer_rating AS DOUBLE)) AS mr, median(CAST(delivery_days AS DOUBLE)) AS md
  FROM flagged WHERE NOT missing
)""",
        """
ranked AS (
  SELECT f.*,
         CASE WHEN missing THEN NULL
              ELSE row_number() OVER (PARTITION BY order_id, missing ORDER BY l_partkey, l_suppkey, quantity, gross)
              END AS rn
  FROM flagged f
)""",
        f"""
labelled AS (
  SELECT order_id, order_date, customer_id,
         {_sql_case_map('product_category', CATEGORY_DOMAIN)} AS product_category,
         {_sql_case_map('region', REGION_DOMAIN)} AS region,
         quantity, gross,
         CASE WHEN discount < 0 THEN CAST(0 AS DECIMAL(4,2)) WHEN discount > 1 THEN CAST(1 AS DECIMAL(4,2))
              ELSE discount END AS discount,
         {_sql_case_map("COALESCE(payment_method, 'Unknown')", PAYMENT_DOMAIN + ('Unknown',))} AS payment_method,
         COALESCE(delivery_days, CAST(trunc((SELECT md FROM med)) AS INTEGER)) AS delivery_days,
         COALESCE(CAST(customer_rating AS DOUBLE), (SELECT mr FROM med)) AS customer_rating,
         revenue, l_partkey, l_suppkey, missing, rn,
         NOT (quantity > 0 AND gross >= 0 AND revenue >= 0) AS bad_range
  FROM ranked
)""",
        """
reasoned AS (
  SELECT *,
         CASE WHEN missing THEN 'missing_required'
              WHEN rn > 1 THEN 'duplicate_key'
              WHEN bad_range THEN 'out_of_range'
              WHEN product_category IS NULL OR region IS NULL OR payment_method IS NULL THEN 'invalid_domain'
         END AS reject_reason
  FROM labelled
)""",
    )
)


@register(
    "clean_report",
    covers="N1-N13 A19 A20 F1 F2 F3 G6 G8 G9 G10 G11 X1 X2 X3 X11",
    oracle=_LABELLED_SQL
    + """,
counts AS (
  SELECT COUNT(*) AS input,
         COUNT(*) FILTER (WHERE reject_reason = 'missing_required') AS missing_required,
         COUNT(*) FILTER (WHERE reject_reason = 'duplicate_key') AS duplicate_key,
         COUNT(*) FILTER (WHERE reject_reason = 'out_of_range') AS out_of_range,
         COUNT(*) FILTER (WHERE reject_reason = 'invalid_domain') AS invalid_domain,
         COUNT(*) FILTER (WHERE reject_reason IS NULL) AS kept,
         COUNT(*) FILTER (WHERE reject_reason IS NULL AND abs(revenue - gross * (1 - discount)) > 1.0)
           AS revenue_mismatch
  FROM reasoned
)
SELECT u.stage, u.row_count,
       CAST(round(CAST(u.row_count AS DECIMAL(20,0)) * 100 / c.input, 2) AS DECIMAL(6,2)) AS pct_of_input
FROM (UNPIVOT counts ON input, missing_required, duplicate_key, out_of_range, invalid_domain, kept,
      revenue_mismatch INTO NAME stage VALUE row_count) u, counts c""",
)
def q_clean_report(spark, sf_dir):
    return clean.clean_report(clean.label_rows(sales_raw(spark, sf_dir), SALES_RULES))


@register(
    "clean_valid",
    covers="N13 (valid rows, medians filled, labels canonical)",
    oracle=_LABELLED_SQL
    + """
SELECT order_id, order_date, customer_id, product_category, region, quantity, gross, discount,
       payment_method, delivery_days, CAST(customer_rating AS DECIMAL(6,3)) AS customer_rating,
       revenue, l_partkey, l_suppkey,
       abs(revenue - gross * (1 - discount)) > 1.0 AS revenue_mismatch
FROM reasoned WHERE reject_reason IS NULL""",
)
def q_clean_valid(spark, sf_dir):
    valid, _, _ = clean.clean_sales(sales_raw(spark, sf_dir), SALES_RULES)
    return valid.withColumn("customer_rating", F.col("customer_rating").cast("decimal(6,3)"))


@register(
    "clean_rejected",
    covers="N13 quarantine (X3: nothing dropped silently)",
    oracle=_LABELLED_SQL
    + """
SELECT order_id, l_partkey, l_suppkey, reject_reason FROM reasoned WHERE reject_reason IS NOT NULL""",
)
def q_clean_rejected(spark, sf_dir):
    _, rejected, _ = clean.clean_sales(sales_raw(spark, sf_dir), SALES_RULES)
    return rejected.select("order_id", "l_partkey", "l_suppkey", "reject_reason")


@register(
    "drop_missing",
    covers="F1 N2",
    oracle=with_ctes(ORDERS_WITH_GAPS)
    + """
SELECT * FROM orders_gaps
WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL""",
)
def q_drop_missing(spark, sf_dir):
    return clean.drop_missing(orders_with_gaps(spark, sf_dir), ["o_custkey", "o_orderdate", "o_totalprice"])


@register(
    "fill_median",
    covers="N3 N4 A18",
    oracle=with_ctes(ORDERS_WITH_GAPS)
    + """
SELECT o_orderkey,
       CAST(round(COALESCE(o_totalprice, (SELECT median(o_totalprice) FROM orders_gaps)), 3) AS DECIMAL(18,3))
         AS o_totalprice,
       COALESCE(CAST(o_custkey AS BIGINT),
                CAST(trunc((SELECT median(CAST(o_custkey AS DOUBLE)) FROM orders_gaps)) AS BIGINT)) AS o_custkey
FROM orders_gaps""",
)
def q_fill_median(spark, sf_dir):
    filled = clean.fill_median(
        orders_with_gaps(spark, sf_dir), ["o_totalprice", "o_custkey"], truncate=["o_custkey"]
    )
    return filled.select(
        "o_orderkey",
        F.round("o_totalprice", 3).cast("decimal(18,3)").alias("o_totalprice"),
        F.col("o_custkey").cast("long").alias("o_custkey"),
    )


@register(
    "fill_const",
    covers="N5 G10 X2",
    oracle=with_ctes(ORDERS_WITH_GAPS)
    + "SELECT o_orderkey, COALESCE(o_orderpriority, 'Unknown') AS o_orderpriority FROM orders_gaps",
)
def q_fill_const(spark, sf_dir):
    return clean.fill_const(orders_with_gaps(spark, sf_dir), {"o_orderpriority": "Unknown"}).select(
        "o_orderkey", "o_orderpriority"
    )


@register(
    "dedup_first",
    covers="N6",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY l_partkey, l_suppkey, quantity, gross) AS rn
  FROM sales_flat
) WHERE rn = 1""",
)
def q_dedup_first(spark, sf_dir):
    return clean.keep_first(sales_flat(spark, sf_dir), ["order_id"], ["l_partkey", "l_suppkey", "quantity", "gross"])


@register(
    "range_filter",
    covers="N7 F2",
    oracle="SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 AND c_custkey > 0",
)
def q_range_filter(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return clean.range_filter(cust, (F.col("c_acctbal") >= 0) & (F.col("c_custkey") > 0))


@register(
    "clip_discount",
    covers="N8 G11",
    oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN CAST(l_discount AS DECIMAL(4,2)) < 0.02 THEN CAST(0.02 AS DECIMAL(4,2))
            WHEN CAST(l_discount AS DECIMAL(4,2)) > 0.08 THEN CAST(0.08 AS DECIMAL(4,2))
            ELSE CAST(l_discount AS DECIMAL(4,2)) END AS discount
FROM lineitem""",
)
def q_clip_discount(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_discount").cast("decimal(4,2)")
    from decimal import Decimal

    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        clip(d, Decimal("0.02"), Decimal("0.08")).cast("decimal(4,2)").alias("discount"),
    )


def _sql_initcap(col: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({col}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@register(
    "text_normalise",
    covers="N9 G8 G9",
    oracle=f"""
SELECT o_orderkey,
       {_sql_initcap("regexp_replace(o_orderpriority, '^\\s+|\\s+$', '', 'g')")} AS o_orderpriority,
       {_sql_initcap("regexp_replace(o_orderstatus, '^\\s+|\\s+$', '', 'g')")} AS o_orderstatus
FROM orders""",
)
def q_text_normalise(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        normalise_label("o_orderpriority").alias("o_orderpriority"),
        normalise_label("o_orderstatus").alias("o_orderstatus"),
    )


@register(
    "domain_filter",
    covers="N10 F3 X1 X3",
    oracle=with_ctes(SALES_FLAT, SALES_RAW)
    + f"""
SELECT order_id, l_partkey, l_suppkey, product_category FROM (
  SELECT order_id, l_partkey, l_suppkey, {_sql_case_map('product_category', CATEGORY_DOMAIN)} AS product_category
  FROM sales_raw
) WHERE product_category IS NOT NULL""",
)
def q_domain_filter(spark, sf_dir):
    raw = sales_raw(spark, sf_dir).select("order_id", "l_partkey", "l_suppkey", "product_category")
    return clean.domain_filter(raw, {"product_category": CATEGORY_DOMAIN})


@register(
    "parse_date",
    covers="N1 G6 G7",
    oracle="""
SELECT o_orderkey, CAST(try_strptime(txt, '%m/%d/%Y') AS DATE) AS order_date FROM (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 13 = 0 THEN '2/30/1999'
              WHEN o_orderkey % 17 = 0 THEN 'n/a'
              ELSE strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y') END AS txt
  FROM orders)""",
)
def q_parse_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    txt = (
        F.when(k % 13 == 0, F.lit("2/30/1999"))
        .when(k % 17 == 0, F.lit("n/a"))
        .otherwise(F.date_format(F.col("o_orderdate").cast("date"), "M/d/yyyy"))
    )
    return o.select("o_orderkey", parse_date(txt).alias("order_date"))
