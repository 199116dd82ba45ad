"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import profile
from mercato.operators.quantiles import exact_quantiles
from mercato.plans.registry import register
from mercato.plans.sql_fragments import ORDERS_WITH_GAPS, SALES_FLAT, with_ctes
from mercato.sources.tables import orders_with_gaps, sales_flat, table


@register(
    "profile_overview",
    covers="Q1 S12",
    oracle="""
SELECT COUNT(*) AS row_count,
       (SELECT CAST(COUNT(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS column_count
FROM lineitem""",
)
def q_profile_overview(spark, sf_dir):
    return profile.overview(table(spark, sf_dir, "lineitem"))


_LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@register(
    "schema_report",
    covers="Q1 S13 F10",
    oracle="""
WITH d AS (SELECT column_name, column_type, row_number() OVER () AS position FROM (DESCRIBE lineitem)),
n AS (SELECT * FROM (SELECT """
    + ", ".join(f"COUNT({c}) AS {c}" for c in _LINEITEM_COLS)
    + """ FROM lineitem) UNPIVOT (non_null_count FOR column_name IN ("""
    + ", ".join(_LINEITEM_COLS)
    + """)))
SELECT CAST(d.position AS INTEGER) AS position, d.column_name,
       CASE d.column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                          WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
                          ELSE lower(d.column_type) END AS data_type,
       n.non_null_count
FROM d JOIN n ON n.column_name = d.column_name""",
)
def q_schema_report(spark, sf_dir):
    return profile.schema_report(table(spark, sf_dir, "lineitem"))


_NULL_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "profile_nulls",
    covers="Q2 A13",
    oracle=with_ctes(ORDERS_WITH_GAPS)
    + " UNION ALL ".join(
        f"""
SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count,
       CAST(round(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DECIMAL(20,0)) * 100 / COUNT(*), 2)
            AS DECIMAL(5,2)) AS missing_pct
FROM orders_gaps"""
        for c in _NULL_COLS
    ),
)
def q_profile_nulls(spark, sf_dir):
    return profile.nulls(orders_with_gaps(spark, sf_dir))


@register(
    "profile_duplicates",
    covers="Q3 A14 A15",
    oracle="""
SELECT COUNT(*) AS row_count,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_keys
FROM lineitem""",
)
def q_profile_duplicates(spark, sf_dir):
    return profile.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_NEG_COLS = [
    "order_id", "customer_id", "quantity", "gross", "discount", "delivery_days",
    "customer_rating", "revenue", "l_partkey", "l_suppkey",
]


@register(
    "profile_negatives",
    covers="Q4 F7 F10",
    oracle=with_ctes(SALES_FLAT)
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} < 0) AS negative_count FROM sales_flat"
        for c in _NEG_COLS
    )
    + ") WHERE negative_count > 0",
)
def q_profile_negatives(spark, sf_dir):
    return profile.negatives(sales_flat(spark, sf_dir, category=False))


@register(
    "profile_negatives_customer",
    covers="Q4 F7",
    oracle="""
SELECT * FROM (
  SELECT 'c_custkey' AS column_name, COUNT(*) FILTER (WHERE c_custkey < 0) AS negative_count FROM customer
  UNION ALL SELECT 'c_nationkey', COUNT(*) FILTER (WHERE c_nationkey < 0) FROM customer
  UNION ALL SELECT 'c_acctbal', COUNT(*) FILTER (WHERE c_acctbal < 0) FROM customer
) WHERE negative_count > 0""",
)
def q_profile_negatives_customer(spark, sf_dir):
    return profile.negatives(table(spark, sf_dir, "customer"))


_DESC_COLS = [  # every numeric column of the table
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


@register(
    "profile_describe",
    covers="Q5 A16",
    oracle=" UNION ALL ".join(
        f"""
SELECT '{c}' AS column_name, COUNT({c}) AS count,
       CAST(round(AVG({c}), 6) AS DECIMAL(38,6)) AS mean,
       CAST(round(STDDEV_SAMP({c}), 6) AS DECIMAL(38,6)) AS std,
       CAST(round(MIN({c}), 6) AS DECIMAL(38,6)) AS min,
       CAST(round(quantile_cont({c}, 0.25), 6) AS DECIMAL(38,6)) AS p25,
       CAST(round(quantile_cont({c}, 0.5), 6) AS DECIMAL(38,6)) AS p50,
       CAST(round(quantile_cont({c}, 0.75), 6) AS DECIMAL(38,6)) AS p75,
       CAST(round(MAX({c}), 6) AS DECIMAL(38,6)) AS max
FROM lineitem"""
        for c in _DESC_COLS
    ),
)
def q_profile_describe(spark, sf_dir):
    return profile.describe(table(spark, sf_dir, "lineitem"), _DESC_COLS)


@register(
    "exact_median",
    covers="A18",
    oracle=with_ctes(ORDERS_WITH_GAPS)
    + """
SELECT 'o_totalprice' AS column_name, CAST(round(median(o_totalprice), 3) AS DECIMAL(18,3)) AS median
FROM orders_gaps""",
)
def q_exact_median(spark, sf_dir):
    q = exact_quantiles(orders_with_gaps(spark, sf_dir), ["o_totalprice"], [0.5])
    return q.select("column_name", F.round("value", 3).cast("decimal(18,3)").alias("median"))


@register(
    "profile_distinct",
    covers="Q6 A17 F10",
    oracle="""
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, COUNT(*) AS n FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority""",
)
def q_profile_distinct(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "orders"), exclude=["o_orderdate"])


_RULE_EXPECTED = "l_quantity * p_retailprice"


@register(
    "business_rule",
    covers="Q7 P8 F6 A19 G12",
    oracle=f"""
SELECT COUNT(*) AS checked_rows,
       COUNT(*) FILTER (WHERE abs(l_extendedprice - {_RULE_EXPECTED}) > 0.05) AS mismatch_rows,
       CAST(0.05 AS DOUBLE) AS tolerance
FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def q_business_rule(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    joined = li.join(part, li.l_partkey == part.p_partkey)
    return profile.rule_check(
        joined, F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice"), 0.05
    )


@register(
    "business_rule_sales",
    covers="Q7 N11 P8 F6 A19",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT COUNT(*) AS checked_rows,
       COUNT(*) FILTER (WHERE abs(revenue - gross * (1 - discount)) > 0.05) AS mismatch_rows,
       CAST(0.05 AS DOUBLE) AS tolerance
FROM sales_flat""",
)
def q_business_rule_sales(spark, sf_dir):
    s = sales_flat(spark, sf_dir, category=False)
    return profile.rule_check(s, F.col("revenue"), F.col("gross") * (F.lit(1) - F.col("discount")), 0.05)


@register(
    "rule_offenders",
    covers="Q7 F6 L3",
    oracle=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       {_RULE_EXPECTED} AS expected,
       CAST(round(abs(l_extendedprice - {_RULE_EXPECTED}), 4) AS DECIMAL(18,4)) AS abs_diff
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE abs(l_extendedprice - {_RULE_EXPECTED}) > 0.05
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 5""",
)
def q_rule_offenders(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    joined = li.join(part, li.l_partkey == part.p_partkey).withColumn(
        "expected", F.col("l_quantity") * F.col("p_retailprice")
    )
    out = profile.rule_offenders(
        joined, F.col("l_extendedprice"), F.col("expected"), 0.05,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "expected",
        F.round("abs_diff", 4).cast("decimal(18,4)").alias("abs_diff"),
    )
