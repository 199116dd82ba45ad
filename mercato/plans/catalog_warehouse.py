"""Warehouse, constraint and upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import rules, warehouse
from mercato.operators.clean import keep_first
from mercato.operators.merge import merge_table, read_merged
from mercato.operators.upsert import upsert
from mercato.plans.registry import register
from mercato.plans.sql_fragments import SALES_FLAT, with_ctes
from mercato.session import scratch_path
from mercato.sources.tables import TABLES, sales_flat, table

# The oracles state each table's definition over the staging rows: a label's
# id is its rank among the distinct labels of its kind, a customer's region the
# smallest one of its orders.
STAGING_SQL = """
staging AS (
  SELECT DISTINCT ON (order_id) * EXCLUDE (gross, l_partkey, l_suppkey), gross AS unit_price
  FROM sales_flat ORDER BY order_id, l_partkey, l_suppkey, quantity, gross
)"""

LOOKUPS_SQL = """
numbered AS (
  SELECT lookup, name, row_number() OVER (PARTITION BY lookup ORDER BY name) AS id
  FROM (SELECT 'regions' AS lookup, region AS name FROM staging
        UNION SELECT 'product_categories', product_category FROM staging
        UNION SELECT 'payment_methods', payment_method FROM staging)
  WHERE name IS NOT NULL),
home AS (
  SELECT customer_id, numbered.id AS region_id
  FROM (SELECT customer_id, min(region) AS name FROM staging GROUP BY ALL)
  JOIN numbered USING (name) WHERE lookup = 'regions'),
resolved AS (
  SELECT staging.*, home.region_id, kind.id AS category_id, pay.id AS payment_method_id,
         CAST(10000 * year(order_date) + 100 * month(order_date) + day(order_date) AS INTEGER) AS date_id
  FROM staging
  JOIN home USING (customer_id)
  JOIN numbered kind ON kind.lookup = 'product_categories' AND kind.name = product_category
  JOIN numbered pay ON pay.lookup = 'payment_methods' AND pay.name = payment_method)"""

WAREHOUSE_SQL = with_ctes(SALES_FLAT, STAGING_SQL, LOOKUPS_SQL)


def staging(spark, sf_dir):
    """Flat staging rows with a unique order id (keep-first), as the
    normalisation stage expects them."""
    flat = keep_first(sales_flat(spark, sf_dir), ["order_id"], ["l_partkey", "l_suppkey", "quantity", "gross"])
    return flat.select(
        "order_id", "order_date", "customer_id", "product_category", "region", "quantity",
        F.col("gross").alias("unit_price"), "discount", "payment_method", "delivery_days",
        "customer_rating", "revenue",
    )


def _wh(spark, sf_dir):
    return warehouse.build_warehouse(staging(spark, sf_dir), persist_to="warehouse")


@register(
    "dim_lookup",
    covers="D1 D5 D6 A22",
    oracle=WAREHOUSE_SQL
    + """
SELECT lookup, id, name FROM numbered""",
)
def q_dim_lookup(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return (
        wh.dim_region.select(F.lit("regions").alias("lookup"), F.col("region_id").alias("id"), F.col("region_name").alias("name"))
        .unionByName(wh.dim_product_category.select(F.lit("product_categories").alias("lookup"), F.col("category_id").alias("id"), F.col("category_name").alias("name")))
        .unionByName(wh.dim_payment_method.select(F.lit("payment_methods").alias("lookup"), F.col("payment_method_id").alias("id"), F.col("method_name").alias("name")))
    )


@register(
    "surrogate_keys_customer",
    covers="D6 (large dimension, range-partitioned numbering)",
    oracle="""
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS customer_sk
FROM customer""",
)
def q_surrogate_keys_customer(spark, sf_dir):
    from mercato.operators.keys import with_surrogate_key

    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return with_surrogate_key(cust, ["c_name", "c_custkey"], "customer_sk")


@register(
    "dim_customer_region",
    covers="D2 J1 A10",
    oracle=WAREHOUSE_SQL + "SELECT customer_id, region_id FROM home",
)
def q_dim_customer_region(spark, sf_dir):
    return _wh(spark, sf_dir).customers


@register(
    "customer_min_priority",
    covers="A10 J1 (non-trivial MIN per key)",
    oracle=WAREHOUSE_SQL
    + """
SELECT customer_id, min(payment_method_id) AS payment_method_id FROM resolved GROUP BY customer_id""",
)
def q_customer_min_priority(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    per = wh.staging.groupBy("customer_id").agg(F.min("payment_method").alias("pm"))
    payments = wh.payment_methods
    return per.join(payments, per.pm == payments.method_name).select("customer_id", "payment_method_id")


@register(
    "dim_copies",
    covers="D5",
    oracle=WAREHOUSE_SQL
    + """
SELECT 'dim_customer' AS dim, CAST(customer_id AS BIGINT) AS id, CAST(NULL AS VARCHAR) AS name FROM home
UNION ALL
SELECT CASE lookup WHEN 'regions' THEN 'dim_region' WHEN 'payment_methods' THEN 'dim_payment_method'
                   ELSE 'dim_product_category' END, id, name FROM numbered""",
)
def q_dim_copies(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    parts = [
        wh.dim_customer.select(F.lit("dim_customer").alias("dim"), F.col("customer_id").cast("long").alias("id"),
                               F.lit(None).cast("string").alias("name")),
        wh.dim_product_category.select(F.lit("dim_product_category").alias("dim"), F.col("category_id").cast("long").alias("id"),
                                       F.col("category_name").alias("name")),
        wh.dim_region.select(F.lit("dim_region").alias("dim"), F.col("region_id").cast("long").alias("id"),
                             F.col("region_name").alias("name")),
        wh.dim_payment_method.select(F.lit("dim_payment_method").alias("dim"), F.col("payment_method_id").cast("long").alias("id"),
                                     F.col("method_name").alias("name")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "orders_normalised",
    covers="D3 J2",
    oracle=WAREHOUSE_SQL
    + """
SELECT order_id, customer_id, order_date, category_id, payment_method_id, unit_price, quantity, discount, revenue,
       customer_rating, delivery_days
FROM resolved""",
)
def q_orders_normalised(spark, sf_dir):
    return _wh(spark, sf_dir).orders


@register(
    "dim_date",
    covers="D4 G2 G3 G4",
    oracle=WAREHOUSE_SQL
    + """
SELECT DISTINCT date_id, order_date AS full_date, date_id // 10000 AS year, CAST(date_id // 100 % 100 AS INTEGER) AS month,
       CAST((date_id // 100 % 100 + 2) // 3 AS INTEGER) AS quarter, dayname(order_date) AS day_of_week
FROM resolved""",
)
def q_dim_date(spark, sf_dir):
    return _wh(spark, sf_dir).dim_date


@register(
    "calendar_dim",
    covers="D4 (gap-free calendar)",
    oracle="""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_of_week
FROM (SELECT unnest(generate_series(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)),
                                     INTERVAL 1 DAY)) AS d FROM orders)""",
)
def q_calendar_dim(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    return warehouse.calendar_dim(o)


@register(
    "fact_orders",
    covers="D7 J3 G2",
    oracle=WAREHOUSE_SQL
    + """
SELECT * EXCLUDE (order_date, product_category, region, payment_method) FROM resolved""",
)
def q_fact_orders(spark, sf_dir):
    return _wh(spark, sf_dir).fact_orders


@register(
    "category_quarter_star",
    covers="A9 D8 J4",
    oracle=WAREHOUSE_SQL
    + """
SELECT product_category AS category_name, CAST(year(order_date) AS INTEGER) AS year,
       CAST(quarter(order_date) AS INTEGER) AS quarter, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
FROM staging GROUP BY ALL""",
)
def q_category_quarter_star(spark, sf_dir):
    wh = warehouse.build_warehouse(staging(spark, sf_dir), persist_to="warehouse", persist="shared")
    return warehouse.category_quarter_report(wh.fact_orders, wh.dim_product_category, wh.dim_date)


@register(
    "warehouse_row_counts",
    covers="V1 U1 A11 P3",
    oracle=WAREHOUSE_SQL
    + """
SELECT unnest(['orders', 'fact_orders', 'customers', 'dim_customer', 'dim_date', 'regions', 'dim_region',
              'product_categories', 'dim_product_category', 'payment_methods', 'dim_payment_method']) AS table_name,
       unnest([all_rows, all_rows, people, people, days, areas, areas, kinds, kinds, ways, ways]) AS row_count
FROM (SELECT count(*) AS all_rows, count(DISTINCT customer_id) AS people, count(DISTINCT order_date) AS days,
             count(DISTINCT region) AS areas, count(DISTINCT product_category) AS kinds,
             count(DISTINCT payment_method) AS ways FROM staging)""",
)
def q_warehouse_row_counts(spark, sf_dir):
    return rules.row_counts(_wh(spark, sf_dir).tables())


@register(
    "reconcile",
    covers="V2",
    oracle=WAREHOUSE_SQL
    + """
SELECT 'staging' AS left_name, a AS left_n, 'fact_orders' AS right_name, b AS right_n, a = b AS ok
FROM (SELECT count(*) AS a FROM staging), (SELECT count(*) AS b FROM resolved)""",
)
def q_reconcile(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return rules.reconcile(wh.staging, wh.fact_orders, "staging", "fact_orders")


@register(
    "row_counts",
    covers="V1 U1 A11 S12",
    oracle=" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
)
def q_row_counts(spark, sf_dir):
    return rules.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


_CHECKS = {
    "order_id_not_null": "order_id IS NOT NULL",
    "customer_id_not_null": "customer_id IS NOT NULL",
    "quantity_positive": "quantity > 0",
    "unit_price_non_negative": "gross >= 0",
    "discount_in_unit_range": "discount BETWEEN 0 AND 1",
    "delivery_days_non_negative": "delivery_days >= 0",
    "rating_1_to_5": "customer_rating BETWEEN 1 AND 5",
}


@register(
    "violations",
    covers="C1 C2",
    oracle=with_ctes(SALES_FLAT)
    + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE({p}, TRUE)) AS violations FROM sales_flat"
        for n, p in _CHECKS.items()
    ),
)
def q_violations(spark, sf_dir):
    return rules.violations(sales_flat(spark, sf_dir, category=False), _CHECKS)


@register(
    "pk_violations",
    covers="C3",
    oracle="""
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
)
def q_pk_violations(spark, sf_dir):
    return rules.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "fk_orphans",
    covers="C5 J5",
    oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM (SELECT * REPLACE (CASE WHEN l_partkey % 13 = 0 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey) FROM lineitem)
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def q_fk_orphans(spark, sf_dir):
    """The whole parent table; every thirteenth part's lines refer to no order."""
    broken = F.when(F.col("l_partkey") % 13 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    li = table(spark, sf_dir, "lineitem").select(broken.alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    return rules.orphans(li, table(spark, sf_dir, "orders"), ["l_orderkey"], ["o_orderkey"])


@register(
    "lookup_orphans",
    covers="J6",
    oracle="""
SELECT c_custkey, n_name AS label FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE n_name NOT IN (SELECT n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_acctbal < 0)""",
)
def q_lookup_orphans(spark, sf_dir):
    """Rows that an inner join with a lookup would lose, listed instead: customers of nations without a supplier in debt."""
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # 25 rows
    labelled = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    debtors = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    known = warehouse.lookup_table(debtors, "n_name", "id", "name")
    return rules.orphans(labelled.select("c_custkey", F.col("n_name").alias("label")), known, ["label"], ["name"])


@register(
    "unique_nullable",
    covers="C4",
    oracle="""
SELECT k, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)
WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1""",
)
def q_unique_nullable(spark, sf_dir):
    """UNIQUE lets nulls repeat, a primary key does not."""
    k = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
    return rules.key_violations(table(spark, sf_dir, "orders").select(k.alias("k")), ["k"], allow_null=True)


@register(
    "default_loaded_at",
    covers="C6 G5",
    oracle="""
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2025-01-01 00:00:00' ELSE TIMESTAMP '2026-01-01 00:00:00' END
         AS loaded_at
FROM orders""",
)
def q_default_loaded_at(spark, sf_dir):
    """Stamps that are there stay, the others get the injected load time."""
    stamp = F.when(F.col("o_orderkey") % 4 == 0, F.expr(_BASE_TS).cast("timestamp_ntz"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", stamp.alias("loaded_at"))
    return rules.with_default_timestamp(rows, now=F.expr(_NOW_TS).cast("timestamp_ntz"))


_BASE_TS = "TIMESTAMP '2025-01-01 00:00:00'"
_NOW_TS = "TIMESTAMP '2026-01-01 00:00:00'"


@register(
    "upsert",
    covers="K6 K10",
    oracle=f"""
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS revenue,
         {_BASE_TS} AS loaded_at
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
updates AS (
  SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'CHANGED' AS o_orderpriority,
         CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS revenue
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')
SELECT COALESCE(t.o_orderkey, u.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE u.o_custkey END AS o_custkey,
       CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderpriority ELSE u.o_orderpriority END AS o_orderpriority,
       CASE WHEN u.o_orderkey IS NOT NULL THEN u.revenue ELSE t.revenue END AS revenue,
       CASE WHEN u.o_orderkey IS NOT NULL THEN {_NOW_TS} ELSE t.loaded_at END AS loaded_at
FROM target t FULL OUTER JOIN updates u ON t.o_orderkey = u.o_orderkey""",
)
def q_upsert(spark, sf_dir):
    """The stored table holds the orders placed before 1999, the incoming
    batch those placed from 1998 on: 1998 keys are matched (only revenue
    and loaded_at change), later keys are inserted, earlier ones kept."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    target = o.filter(d < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
        F.expr(_BASE_TS).cast("timestamp_ntz").alias("loaded_at"),
    )
    updates = o.filter(d >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).select(
        "o_orderkey",
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("CHANGED").alias("o_orderpriority"),
        (F.col("o_totalprice").cast("decimal(18,2)") + 1).alias("revenue"),
    )
    return upsert(target, updates, ["o_orderkey"], ["revenue"], now=F.expr(_NOW_TS).cast("timestamp_ntz"))


@register(
    "merge_two_loads",
    covers="K6 K10 (two loads into a table stored by key hash, touched partitions replaced)",
    oracle=f"""
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS revenue
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
late AS (
  SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'CHANGED' AS o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS revenue
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00')
SELECT late.o_orderkey, COALESCE(target.o_custkey, late.o_custkey) AS o_custkey,
       COALESCE(target.o_orderpriority, late.o_orderpriority) AS o_orderpriority, late.revenue, {_NOW_TS} AS loaded_at
FROM late LEFT JOIN target USING (o_orderkey)
UNION ALL
SELECT *, {_BASE_TS} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)""",
)
def q_merge_two_loads(spark, sf_dir):
    """A first load of the orders placed before 1999 and a second of those from 1998 on, with other values."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
        F.expr(_BASE_TS).cast("timestamp_ntz").alias("loaded_at"),
    )
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    changed = rows.withColumns(
        {"o_custkey": F.col("o_custkey") + 1, "o_orderpriority": F.lit("CHANGED"), "revenue": (F.col("revenue") + 1).cast("decimal(18,2)")}
    )
    base = scratch_path(spark, "merge-orders")
    merge_table(spark, base, rows.filter(o["o_orderdate"] < day("1999-01-01 00:00:00")), ["o_orderkey"], ["revenue"])
    late = changed.filter(o["o_orderdate"] >= day("1998-01-01 00:00:00"))
    merge_table(spark, base, late, ["o_orderkey"], ["revenue"], now=F.expr(_NOW_TS).cast("timestamp_ntz"))
    return read_merged(spark, base)


_SECOND_LOAD = "order_date >= DATE '1998-01-01'"


@register(
    "lasting_lookup_ids",
    covers="D1 D6 A22 (ids that last over two loads)",
    oracle=with_ctes(SALES_FLAT, STAGING_SQL)
    + f"""
SELECT lookup, name, row_number() OVER (PARTITION BY lookup ORDER BY bool_or(early) DESC, name) AS id
FROM (SELECT 'regions' AS lookup, region AS name, region > 'B' AND NOT {_SECOND_LOAD} AS early FROM staging
      UNION ALL SELECT 'categories', product_category, region > 'B' AND NOT {_SECOND_LOAD} FROM staging
      UNION ALL SELECT 'payments', payment_method, region > 'B' AND NOT {_SECOND_LOAD} FROM staging)
GROUP BY lookup, name""",
)
def q_lasting_lookup_ids(spark, sf_dir):
    """The first load holds early orders of some regions, the second all orders, whose other regions sort before them: known labels keep their ids."""
    flat = staging(spark, sf_dir)
    store = scratch_path(spark, "lookup-keys")
    early = flat.filter((F.col("region") > "B") & ~F.expr(_SECOND_LOAD))
    warehouse.build_warehouse(early, persist_to="first-load", key_store=store).lookups
    return warehouse.build_warehouse(flat, persist_to="second-load", key_store=store).lookups.select("lookup", "id", "name")


@register(
    "fact_region_of_order",
    covers="J1 D7 X4 (the order's own region instead of the customer's)",
    oracle=with_ctes(SALES_FLAT, STAGING_SQL)
    + """
, areas AS (SELECT payment_method AS name, row_number() OVER (ORDER BY payment_method) AS id FROM staging GROUP BY payment_method)
SELECT areas.id AS region_id, COUNT(*) AS row_count, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
FROM staging JOIN areas ON areas.name = payment_method GROUP BY areas.id""",
)
def q_fact_region_of_order(spark, sf_dir):
    """The payment method stands in for the region: a customer's orders have several, so the two rules differ."""
    flat = staging(spark, sf_dir).withColumn("region", F.col("payment_method"))
    wh = warehouse.build_warehouse(flat, persist_to="order-region", persist="shared", region_of="order")
    return wh.fact_orders.groupBy("region_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("revenue").cast("decimal(38,2)").alias("total_revenue")
    )
