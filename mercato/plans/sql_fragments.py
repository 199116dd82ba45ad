"""Shared DuckDB SQL fragments for the oracles.

``SALES_FLAT`` is the SQL twin of ``mercato.sources.tables.sales_flat``.
"""

SALES_FLAT = """
sales_flat AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS order_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         o.o_custkey AS customer_id,
         p.p_type AS product_category,
         r.r_name AS region,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         o.o_orderpriority AS payment_method,
         date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS delivery_days,
         CAST(l.l_tax AS DECIMAL(3,2)) AS customer_rating,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS revenue,
         l.l_partkey, l.l_suppkey
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  JOIN part p ON p.p_partkey = l.l_partkey
)"""

ORDERS_WITH_GAPS = """
orders_gaps AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
         o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders
)"""

SALES_RAW = """
sales_raw AS (
  SELECT order_id,
         CASE WHEN order_id % 97 = 0 THEN '13/45/1999' ELSE strftime(order_date, '%-m/%-d/%Y') END AS order_date,
         CASE WHEN order_id % 101 = 0 THEN NULL ELSE customer_id END AS customer_id,
         CASE WHEN order_id % 5 = 0 THEN ' ' || lower(product_category) || chr(9) ELSE product_category END
           AS product_category,
         region,
         CASE WHEN order_id % 43 = 0 THEN 0 ELSE quantity END AS quantity,
         gross,
         CASE WHEN order_id % 53 = 0 THEN NULL ELSE discount END AS discount,
         CASE WHEN order_id % 19 = 0 THEN NULL ELSE payment_method END AS payment_method,
         CASE WHEN order_id % 17 = 0 THEN NULL ELSE delivery_days END AS delivery_days,
         CASE WHEN order_id % 13 = 0 THEN NULL ELSE customer_rating END AS customer_rating,
         revenue, l_partkey, l_suppkey
  FROM sales_flat
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
