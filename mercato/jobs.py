"""End-to-end jobs: the reference's four stages as callable Spark jobs.

Each job composes the operators; nothing here computes on its own.

* ``profile_job``     stage 1 profiling report of a raw sales extract
* ``clean_load_job``  stage 1 clean -> processed CSV + quarantine + keyed upsert into a versioned table
* ``report_job``      stage 1 analysis reports (SQL and DataFrame) on the loaded table
* ``warehouse_job``   stage 2 normalised set + star schema + row-count checks + quarterly report
* ``transform_job``   stage 3 reports on a large CSV, ``order_year`` column, CSV rewrite
* ``format_job``      stage 3 CSV -> Parquet / ORC / year-partitioned Parquet, sizes, scan+aggregate
                      timings per format, pruned vs full count
* ``stream_job``      stage 4 Kafka (or any streaming frame) -> watermark -> sliding metrics -> files
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import clean, profile, reports, rules, warehouse
from mercato.operators.upsert import read_current, upsert_table
from mercato.session import materialize, scratch_scope
from mercato.sources import files
from mercato.streaming import events as ev
from mercato.streaming import runner

# The label domains of the reference's cleaning step (with
# COD and the fill label accepted, see README "Semantics decided once").
SALES_DOMAINS = {
    "product_category": ("Beauty", "Clothing", "Electronics"),
    "region": ("North", "South", "East", "West"),
    "payment_method": ("Wallet", "Card", "COD"),
}
DEFAULT_RULES = clean.CleanRules(domains=SALES_DOMAINS)


def _read(spark: SparkSession, path: str, fmt: str = "csv", schema=None) -> DataFrame:
    """CSV with inferred types (as the reference reads it) unless a schema
    is given; inference costs a full extra pass, so give one at scale."""
    if fmt == "csv" and schema is None:
        return files.read_csv_inferred(spark, path)
    return files.read_table(spark, path, fmt, schema)


def profile_job(
    spark: SparkSession, path: str, key: str = "order_id", fmt: str = "csv", schema=None
) -> dict[str, DataFrame]:
    """Profiling report of a raw extract (Q1-Q7), one frame per section."""
    df = _read(spark, path, fmt, schema)
    out = {
        "overview": profile.overview(df),
        "dtypes": profile.schema_report(df),
        "nulls": profile.nulls(df),
        "duplicates": profile.duplicates(df, [key]),
        "negatives": profile.negatives(df),
        "describe": profile.describe(df),
        "distinct": profile.distinct_values(df, exclude=["order_date"]),
    }
    needed = {"quantity", "unit_price", "discount", "revenue"}
    if needed <= set(df.columns):  # the rule section is skipped when a column is missing
        expected = F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount"))
        out["revenue_rule"] = profile.rule_check(df, F.col("revenue"), expected, 0.05)
        out["revenue_offenders"] = profile.rule_offenders(df, F.col("revenue"), expected, 0.05, [key])
    return out


def clean_load_job(
    spark: SparkSession,
    raw_path: str,
    out_dir: str,
    rules_: clean.CleanRules = DEFAULT_RULES,
    now=None,
) -> dict[str, object]:
    """Raw CSV -> cleaned rows (processed CSV), quarantine with reasons,
    per-step report, keyed upsert into the versioned ``orders`` table
    (only revenue and loaded_at change for a stored key).

    The labelled rows are written once and every output is split from them;
    the job removes its intermediate tables when its outputs are stored."""
    # keep-first without order columns keeps the first row in file order
    with scratch_scope(spark):
        raw = files.read_sales_csv(spark, raw_path, bad_fields=rules_.bad_fields)
        labelled = materialize(clean.label_rows(raw, rules_), spark, "labelled")
        valid, rejected = clean.split_labelled(labelled, rules_.bad_fields)
        valid = valid.drop("revenue_mismatch")
        files.write_table(valid, f"{out_dir}/processed", "csv")
        files.write_table(rejected, f"{out_dir}/rejected", "parquet")
        files.write_table(clean.clean_report(labelled, rules_.bad_fields), f"{out_dir}/report", "parquet")
        loaded = rules.with_default_timestamp(valid, "loaded_at", now)
        version = upsert_table(spark, f"{out_dir}/orders", loaded, [rules_.key], ["revenue"], now)
    report = spark.read.parquet(f"{out_dir}/report")
    return {"report": report, "table_version": version, "orders": read_current(spark, f"{out_dir}/orders")}


def report_job(spark: SparkSession, orders: DataFrame, region: str = "South", since: str = "2022-06-01") -> dict[str, DataFrame]:
    """The five analysis reports and the filtered top-k on the loaded table."""
    return {
        "revenue_by_category": reports.revenue_by_category(orders),
        "revenue_by_region_month": reports.revenue_by_region_month(orders),
        "top_customers": reports.top_customers(orders),
        "rating_by_payment": reports.avg_rating_by_payment(orders),
        "rating_by_delivery": reports.rating_by_delivery_bucket(orders),
        "top_customers_filtered": reports.top_customers_filtered(orders, region, since),
    }


def warehouse_job(spark: SparkSession, flat: DataFrame, out_dir: str) -> dict[str, DataFrame]:
    """Normalised set + star schema as lasting tables ``<out_dir>/<table>``
    (replaced by each run), the row-count checks and the quarterly category
    report (D1-D8, V1, V2), all read from the stored tables."""
    with scratch_scope(spark):
        wh = warehouse.build_warehouse(flat, persist_to="warehouse")
        for name, table in {"stg_orders_flat": wh.staging, **wh.tables()}.items():
            files.write_table(table, f"{out_dir}/{name}", "parquet")
    tables = {name: spark.read.parquet(f"{out_dir}/{name}") for name in ["stg_orders_flat", *wh.tables()]}
    return {
        **tables,
        "row_counts": rules.row_counts(tables),
        "staging_vs_orders": rules.reconcile(tables["stg_orders_flat"], tables["orders"], "stg_orders_flat", "orders"),
        "orders_vs_fact": rules.reconcile(tables["orders"], tables["fact_orders"], "orders", "fact_orders"),
        "category_quarter": warehouse.category_quarter_report(
            tables["fact_orders"], tables["dim_product_category"], tables["dim_date"]
        ),
    }


def transform_job(spark: SparkSession, csv_path: str, out_dir: str | None = None, schema=None) -> dict[str, DataFrame]:
    """Reports on a large CSV through the DataFrame API and SQL; with
    ``out_dir`` the rows are rewritten as CSV with ``order_year``."""
    df = _read(spark, csv_path, "csv", schema)
    with_year = reports.with_order_year(df)
    files.register_view(df, "sales")
    out = {
        "revenue_by_category": reports.revenue_by_category(df),
        "revenue_by_region_year": reports.revenue_by_region_year(df),
        "buyers_by_region_sql": spark.sql(
            "SELECT region, count(DISTINCT customer_id) AS buyers, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue "
            "FROM sales GROUP BY region"
        ),
    }
    if out_dir:
        files.write_table(with_year, f"{out_dir}/sales_with_year_csv", "csv")
    return out


def format_job(
    spark: SparkSession, csv_path: str, out_dir: str, group_col: str = "product_category",
    measure: str = "revenue", part_col: str = "order_year", part_value: int = 2030, schema=None,
) -> dict[str, DataFrame]:
    """CSV -> Parquet / ORC / partitioned Parquet; storage sizes; per-format
    scan + aggregate timings; pruned vs unpruned count (K15-K17, Y1, Y2)."""
    paths = {"csv": csv_path, "parquet": f"{out_dir}/parquet", "orc": f"{out_dir}/orc"}
    src = _read(spark, csv_path, "csv", schema)
    files.write_table(src, paths["parquet"], "parquet")
    files.write_table(src, paths["orc"], "orc")
    part_path = f"{out_dir}/parquet_by_{part_col}"
    files.write_table(src, part_path, "parquet", partition_by=[part_col])

    timings = []
    for fmt, path in paths.items():
        t0 = time.perf_counter()
        d = _read(spark, path, "csv", schema) if fmt == "csv" else files.read_table(spark, path, fmt)
        d.count()
        read_s = time.perf_counter() - t0
        t0 = time.perf_counter()
        d.groupBy(group_col).agg(F.sum(measure).alias("total")).collect()
        timings.append((fmt, round(read_s, 2), round(time.perf_counter() - t0, 2)))

    full = spark.read.parquet(paths["parquet"]).filter(F.col(part_col) == part_value)
    pruned = spark.read.parquet(part_path).filter(F.col(part_col) == part_value)
    return {
        "sizes": files.size_vs(files.storage_size(spark, {**paths, f"parquet_by_{part_col}": part_path}), "csv"),
        "timings": spark.createDataFrame(timings, "format string, read_seconds double, query_seconds double"),
        "pruned_vs_full": rules.reconcile(full, pruned, "no_partition", f"partitioned_by_{part_col}"),
    }


def stream_job(
    spark: SparkSession,
    records: DataFrame,
    out_path: str,
    checkpoint: str,
    watermark: str = "30 seconds",
    size: str = "10 seconds",
    slide: str | None = "5 seconds",
    trigger: Mapping | None = None,
    console: bool = False,
    state_partitions: int | None = 4,
):
    """Streaming records (e.g. ``connectors.read_kafka_stream``) -> parsed
    events (bad records dropped to ``<out>_bad``) -> watermark -> sliding
    metrics -> one checkpointed query writing each update batch once."""
    events, bad = ev.parse_events(records)
    bad_query = (
        bad.writeStream.format("parquet")
        .option("path", f"{out_path.rstrip('/')}_bad")
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}_bad")
        .trigger(**(trigger or {"processingTime": "15 seconds"}))
        .start()
    )
    metrics = runner.metrics_stream(events, watermark=watermark, size=size, slide=slide)
    query = runner.start_metrics_query(
        metrics, out_path, checkpoint, dict(trigger) if trigger else None, console=console,
        state_partitions=state_partitions,
    )
    return query, bad_query
