"""Source/sink and layout queries.

Each query writes whole driver tables to a fresh folder under the
session's checkpoint directory (a shared folder on a cluster), reads them
back and aggregates what was read; the oracle computes the same aggregate
from the source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import clean, reports
from mercato.plans.catalog_clean import SALES_RULES, _LABELLED_SQL
from mercato.plans.registry import register
from mercato.plans.sql_fragments import SALES_FLAT, with_ctes
from mercato.session import scratch_path
from mercato.sources import files
from mercato.sources.tables import sales_flat, sales_raw, table

LINEITEM_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)


def lineitem_digest(df: DataFrame) -> DataFrame:
    """Order-independent digest of lineitem rows read back from storage."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(38,2)").alias("total_price"),
        F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(38,2)").alias("total_quantity"),
        F.countDistinct("l_orderkey").alias("orders"),
        F.min(F.col("l_shipdate").cast("date")).alias("first_ship"),
        F.max(F.col("l_shipdate").cast("date")).alias("last_ship"),
    )


DIGEST_SQL = """
SELECT COUNT(*) AS row_count,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total_price,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total_quantity,
       COUNT(DISTINCT l_orderkey) AS orders,
       MIN(CAST(l_shipdate AS DATE)) AS first_ship, MAX(CAST(l_shipdate AS DATE)) AS last_ship
FROM lineitem"""


def _roundtrip(spark, sf_dir, fmt: str, schema=None) -> DataFrame:
    path = scratch_path(spark, f"lineitem-{fmt}")
    files.write_table(table(spark, sf_dir, "lineitem"), path, fmt)
    return files.read_table(spark, path, fmt, schema)


@register("csv_roundtrip", covers="K1 K2 S1 S5", oracle=DIGEST_SQL)
def q_csv_roundtrip(spark, sf_dir):
    return lineitem_digest(_roundtrip(spark, sf_dir, "csv", LINEITEM_SCHEMA))


@register("csv_inferred", covers="S2", oracle=DIGEST_SQL)
def q_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "lineitem-csv-infer")
    files.write_table(table(spark, sf_dir, "lineitem"), path, "csv")
    return lineitem_digest(files.read_csv_inferred(spark, path))


@register("parquet_roundtrip", covers="K3 S3 S5", oracle=DIGEST_SQL)
def q_parquet_roundtrip(spark, sf_dir):
    return lineitem_digest(_roundtrip(spark, sf_dir, "parquet"))


@register("orc_roundtrip", covers="K4 S4 S5", oracle=DIGEST_SQL)
def q_orc_roundtrip(spark, sf_dir):
    return lineitem_digest(_roundtrip(spark, sf_dir, "orc"))


@register(
    "format_compare",
    covers="K15 K17 A3",
    oracle="""
WITH g AS (
  SELECT l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total_revenue,
         COUNT(*) AS row_count
  FROM lineitem GROUP BY l_returnflag)
SELECT f.format, g.* FROM g, (VALUES ('csv'), ('parquet'), ('orc')) f(format)""",
)
def q_format_compare(spark, sf_dir):
    """The same scan + aggregate on each format (the reference's format
    benchmark without the timings; the timings live in bench.py). The
    parquet and ORC copies are converted from the CSV copy (K15)."""
    csv_path = scratch_path(spark, "fmt-csv")
    files.write_table(table(spark, sf_dir, "lineitem"), csv_path, "csv")
    parquet_path, orc_path = scratch_path(spark, "fmt-parquet"), scratch_path(spark, "fmt-orc")
    files.convert(spark, csv_path, "csv", parquet_path, "parquet", LINEITEM_SCHEMA)
    files.convert(spark, csv_path, "csv", orc_path, "orc", LINEITEM_SCHEMA)
    parts = []
    for fmt, path in (("csv", csv_path), ("parquet", parquet_path), ("orc", orc_path)):
        d = files.read_table(spark, path, fmt, LINEITEM_SCHEMA if fmt == "csv" else None)
        parts.append(
            d.groupBy("l_returnflag")
            .agg(
                F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(38,2)").alias("total_revenue"),
                F.count(F.lit(1)).alias("row_count"),
            )
            .select(F.lit(fmt).alias("format"), "l_returnflag", "total_revenue", "row_count")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("format_sizes", covers="K16")
def q_format_sizes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    paths = {}
    for fmt in ("csv", "parquet", "orc"):
        paths[fmt] = scratch_path(spark, f"size-{fmt}")
        files.write_table(li, paths[fmt], fmt)
    paths["parquet_by_year"] = scratch_path(spark, "size-parquet-year")
    files.write_table(li, paths["parquet_by_year"], "parquet", partition_by=["ship_year"])
    return files.size_vs(files.storage_size(spark, paths), "csv")


@register(
    "format_facts",
    covers="K16 K17 (rows and files of each format, sizes against CSV)",
    oracle="""
SELECT f.dataset, (SELECT COUNT(*) FROM lineitem) AS row_count, f.smaller_than_csv, TRUE AS rows_in_every_file
FROM (VALUES ('csv', FALSE), ('orc', TRUE), ('parquet', TRUE), ('parquet_by_year', TRUE)) f(dataset, smaller_than_csv)""",
)
def q_format_facts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    formats = {"csv": "csv", "orc": "orc", "parquet": "parquet", "parquet_by_year": "parquet"}
    paths = {name: scratch_path(spark, f"facts-{name}") for name in formats}
    for name, fmt in formats.items():
        files.write_table(li, paths[name], fmt, partition_by=["ship_year"] if name.endswith("year") else ())
    facts = files.size_vs(files.file_facts(spark, paths, formats), "csv")
    return facts.select(
        "dataset", "row_count", (F.col("reduction_pct") > 0).alias("smaller_than_csv"),
        (F.col("files") == F.col("non_empty_files")).alias("rows_in_every_file"),
    )


@register(
    "cross_database_join",
    covers="S8 K9 S7 (stored tables of two databases, one renamed)",
    oracle="""
SELECT o_orderpriority, COUNT(*) AS row_count, COUNT(DISTINCT c_custkey) AS customers
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_orderpriority""",
)
def q_cross_database_join(spark, sf_dir):
    """Orders staged in one database and renamed there, customers in another, joined by two-part names."""
    import uuid

    tag = uuid.uuid4().hex[:12]
    first, second = f"oltp_{tag}", f"olap_{tag}"
    files.save_catalog_table(table(spark, sf_dir, "orders"), f"{first}.orders_flat", scratch_path(spark, "orders-flat"))
    files.rename_catalog_table(spark, f"{first}.orders_flat", f"{first}.stg_orders_flat")
    files.save_catalog_table(table(spark, sf_dir, "customer"), f"{second}.dim_customer", scratch_path(spark, "dim-customer"))
    return spark.sql(
        f"SELECT o.o_orderpriority, count(*) AS row_count, count(DISTINCT c.c_custkey) AS customers "
        f"FROM {first}.stg_orders_flat o JOIN {second}.dim_customer c ON c.c_custkey = o.o_custkey GROUP BY o.o_orderpriority"
    )


@register(
    "overwrite_append",
    covers="K7 K8",
    oracle="""
SELECT o_orderstatus, 2 * COUNT(*) AS row_count FROM orders GROUP BY o_orderstatus""",
)
def q_overwrite_append(spark, sf_dir):
    path = scratch_path(spark, "orders-append")
    o = table(spark, sf_dir, "orders")
    files.write_table(o, path, "parquet", mode="overwrite")
    files.write_table(o, path, "parquet", mode="overwrite")  # replace, not add
    files.write_table(o, path, "parquet", mode="append")
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "rename_stage",
    covers="K9 S7",
    oracle="SELECT o_orderpriority, COUNT(*) AS row_count FROM orders GROUP BY o_orderpriority",
)
def q_rename_stage(spark, sf_dir):
    files.register_view(table(spark, sf_dir, "orders"), "orders_flat")
    staged = files.rename_view(spark, "orders_flat", "stg_orders_flat")
    return staged.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "partition_pruned_count",
    covers="Y1 Y2 F5 K5 S6 V2",
    oracle="""
SELECT s.scenario, (SELECT COUNT(*) FROM lineitem WHERE year(l_shipdate) = 1998) AS row_count
FROM (VALUES ('no_partition'), ('partitioned_by_year')) s(scenario)""",
)
def q_partition_pruned_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    flat_path, part_path = scratch_path(spark, "li-flat"), scratch_path(spark, "li-by-year")
    files.write_table(li, flat_path, "parquet")
    files.write_table(li, part_path, "parquet", partition_by=["ship_year"])
    flat = spark.read.parquet(flat_path).filter(F.col("ship_year") == 1998)
    pruned = spark.read.parquet(part_path).filter(F.col("ship_year") == 1998)
    return flat.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("no_partition").alias("scenario"), "row_count"
    ).unionByName(
        pruned.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("partitioned_by_year").alias("scenario"), "row_count"
        )
    )


@register(
    "layout_filtered",
    covers="Y3 F4 A8 L2",
    oracle="""
WITH sf AS (
  SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, r.r_name AS region,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS revenue
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey JOIN part p ON p.p_partkey = l.l_partkey)
SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_spent, COUNT(*) AS order_count
FROM sf WHERE region = 'ASIA' AND order_date >= DATE '1998-06-01'
GROUP BY customer_id ORDER BY total_spent DESC, customer_id LIMIT 10""",
)
def q_layout_filtered(spark, sf_dir):
    path = scratch_path(spark, "sales-clustered")
    files.write_clustered(sales_flat(spark, sf_dir), path, ["region", "order_date"])
    return reports.top_customers_filtered(spark.read.parquet(path), "ASIA", "1998-06-01", 10)


_RAW_CSV_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("gross", T.DecimalType(12, 2)),
        T.StructField("discount", T.DecimalType(4, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("delivery_days", T.IntegerType()),
        T.StructField("customer_rating", T.DecimalType(3, 2)),
        T.StructField("revenue", T.DecimalType(18, 4)),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
    ]
)


@register(
    "csv_clean_report",
    covers="S1 K1 N13 (stage 1 end to end: CSV -> clean -> report)",
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
  FROM reasoned)
SELECT u.stage, u.row_count,
       CAST(round(CAST(u.row_count AS DECIMAL(20,0)) * 100 / c.input, 2) AS DECIMAL(6,2)) AS pct_of_input
FROM (UNPIVOT counts ON input, missing_required, duplicate_key, out_of_range, invalid_domain, kept,
      revenue_mismatch INTO NAME stage VALUE row_count) u, counts c""",
)
def q_csv_clean_report(spark, sf_dir):
    path = scratch_path(spark, "sales-raw-csv")
    files.write_table(sales_raw(spark, sf_dir), path, "csv")
    raw = files.read_sales_csv(spark, path, _RAW_CSV_SCHEMA)
    return clean.clean_report(clean.label_rows(raw, SALES_RULES))


_MALFORMED = "(order_id % 23 = 0 OR order_id % 29 = 0)"


@register(
    "csv_malformed_fields",
    covers="S1 N13 (fields whose text is not of their type, by field and reason)",
    oracle=_LABELLED_SQL.replace("OR discount IS NULL) AS missing", f"OR discount IS NULL OR {_MALFORMED}) AS missing")
    + f"""
SELECT concat_ws(',', CASE WHEN order_id % 29 = 0 THEN 'delivery_days' END,
                 CASE WHEN order_id % 23 = 0 THEN 'customer_rating' END) AS fields,
       CASE WHEN {_MALFORMED} THEN 'malformed_field' ELSE coalesce(reject_reason, 'kept') END AS outcome,
       COUNT(*) AS row_count
FROM reasoned GROUP BY ALL""",
)
def q_csv_malformed_fields(spark, sf_dir):
    """Ratings written as ``n/a`` (every 23rd order) and delivery days as
    ``3 days`` (every 29th) reach the quarantine with the fields' names;
    they take no part in medians and keep-first."""
    path = scratch_path(spark, "sales-malformed-csv")
    k = F.col("order_id")
    raw = sales_raw(spark, sf_dir).withColumns(
        {
            "customer_rating": F.when(k % 23 == 0, F.lit("n/a")).otherwise(F.col("customer_rating").cast("string")),
            "delivery_days": F.when(k % 29 == 0, F.lit("3 days")).otherwise(F.col("delivery_days").cast("string")),
        }
    )
    files.write_table(raw, path, "csv")
    read = files.read_sales_csv(spark, path, _RAW_CSV_SCHEMA, bad_fields=SALES_RULES.bad_fields)
    labelled = clean.label_rows(read, SALES_RULES)
    return labelled.groupBy(
        F.array_join(SALES_RULES.bad_fields, ",").alias("fields"), F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("row_count"))


_FILE_ORDER = ["file_no", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register(
    "csv_keep_first",
    covers="N6 S5 (several CSV files, first row in file order)",
    oracle=f"""
SELECT {", ".join(_FILE_ORDER)}
FROM (SELECT *, 8 - l_linenumber AS file_no FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_FILE_ORDER)}) = 1""",
)
def q_csv_keep_first(spark, sf_dir):
    """Line items in CSV files whose order is that of ``file_no`` and then of
    the row (later lines first): each order keeps the first row of the first
    file that has one, however Spark packs the files into tasks."""
    path = scratch_path(spark, "keep-first-csv")
    rows = table(spark, sf_dir, "lineitem").withColumn("file_no", 8 - F.col("l_linenumber")).select(*_FILE_ORDER)
    (
        rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *_FILE_ORDER)
        .sortWithinPartitions(*_FILE_ORDER)
        .write.option("header", True)
        .partitionBy("file_no")
        .csv(path)
    )
    return clean.keep_first(files.read_table(spark, path, "csv", rows.schema), ["l_orderkey"])


@register(
    "bucketed_customer_spend",
    covers="Y3 (bucketBy layout) A5",
    oracle=with_ctes(SALES_FLAT)
    + """
SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_spent, COUNT(*) AS order_count
FROM sales_flat GROUP BY customer_id""",
)
def q_bucketed_customer_spend(spark, sf_dir):
    """Sales bucketed by customer: the per-customer aggregate reads
    co-located buckets and needs no shuffle."""
    import uuid

    name = f"sales_by_customer_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = files.write_bucketed(
        sales_flat(spark, sf_dir), name, ["customer_id"], buckets, scratch_path(spark, name)
    )
    return reports.customer_spend(bucketed)
