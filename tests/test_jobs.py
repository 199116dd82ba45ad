"""The reference's stages end to end through ``mercato.jobs``."""

from __future__ import annotations

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato import jobs
from mercato.session import ensure_checkpoint_dir, scratch_paths
from mercato.sources import files
from mercato.sources.synth import synth_sales


@pytest.fixture(scope="module")
def workdir(spark):
    return f"{ensure_checkpoint_dir(spark)}/jobs-{uuid.uuid4().hex}"


@pytest.fixture(scope="module")
def raw_csv(spark, workdir):
    """A raw extract like the reference's sample: M/d/yyyy dates, COD in odd
    case, an unknown category, a repeated order id, a missing rating."""
    s = synth_sales(spark.range(1, 2001))
    k = F.col("order_id")
    raw = s.select(
        F.when(k % 97 == 0, k - 1).otherwise(k).alias("order_id"),
        F.date_format("order_date", "M/d/yyyy").alias("order_date"),
        "customer_id",
        F.when(k % 17 == 0, F.lit("Home")).otherwise(F.col("product_category")).alias("product_category"),
        "region", "quantity", "unit_price", "discount",
        F.when(k % 13 == 0, F.lit(" cod ")).otherwise(F.col("payment_method")).alias("payment_method"),
        "delivery_days",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("customer_rating")).alias("customer_rating"),
        "revenue",
    )
    path = f"{workdir}/raw"
    files.write_table(raw.coalesce(1), path, "csv")
    return path


def test_profile_job(spark, raw_csv):
    out = jobs.profile_job(spark, raw_csv)
    assert out["overview"].first()["row_count"] == 2000
    nulls = {r["column_name"]: r["missing_count"] for r in out["nulls"].collect()}
    assert nulls["customer_rating"] == 181
    assert out["duplicates"].first()["duplicate_keys"] == 20
    assert out["revenue_rule"].first()["mismatch_rows"] == 0


def test_clean_load_report_warehouse(spark, raw_csv, workdir):
    res = jobs.clean_load_job(spark, raw_csv, workdir)
    stages = {r["stage"]: r["row_count"] for r in res["report"].collect()}
    assert stages["input"] == 2000
    assert stages["duplicate_key"] == 20
    assert stages["invalid_domain"] > 0
    assert stages["kept"] == 2000 - stages["duplicate_key"] - stages["invalid_domain"] - stages["out_of_range"] - stages["missing_required"]
    orders = res["orders"]
    assert orders.count() == stages["kept"]
    assert orders.filter(F.col("payment_method") == "COD").count() > 0  # X1: COD survives
    assert res["table_version"] == 1

    again = jobs.clean_load_job(spark, raw_csv, workdir)  # same extract: upsert, no new rows
    assert again["table_version"] == 2 and again["orders"].count() == stages["kept"]

    rep = jobs.report_job(spark, again["orders"])
    total = again["orders"].agg(F.sum("revenue")).first()[0]
    by_cat = sum(r["total_revenue"] for r in rep["revenue_by_category"].collect())
    assert by_cat == Decimal(total).quantize(Decimal("0.01"))
    assert rep["top_customers"].count() == 10

    left = scratch_paths()
    wh = jobs.warehouse_job(spark, again["orders"].drop("loaded_at"), f"{workdir}/warehouse")
    assert scratch_paths() == left  # intermediate tables are gone, the named tables stay
    assert spark.read.parquet(f"{workdir}/warehouse/fact_orders").count() == stages["kept"]
    assert wh["staging_vs_orders"].first()["ok"] and wh["orders_vs_fact"].first()["ok"]
    star_total = sum(r["total_revenue"] for r in wh["category_quarter"].collect())
    assert star_total == by_cat


def test_transform_and_format_jobs(spark, workdir):
    src = f"{workdir}/large"
    files.write_table(synth_sales(spark.range(1, 3001)), src, "csv")
    out = jobs.transform_job(spark, src, workdir)
    a = sum(r["total_revenue"] for r in out["revenue_by_category"].collect())
    b = sum(r["total_revenue"] for r in out["buyers_by_region_sql"].collect())
    assert a == b
    fmt = jobs.format_job(spark, f"{workdir}/sales_with_year_csv", f"{workdir}/formats", part_value=2030)
    assert fmt["pruned_vs_full"].first()["ok"] is True
    assert {r["format"] for r in fmt["timings"].collect()} == {"csv", "parquet", "orc"}
    sizes = {r["dataset"]: r["bytes"] for r in fmt["sizes"].collect()}
    assert sizes["parquet"] < sizes["csv"]


def test_stream_job_on_a_file_stream(spark, workdir):
    """Stage 4 through ``jobs.stream_job``: a text stream of JSON records (as a
    Kafka value column would carry them), one broken record to the bad-record
    sink, metrics for the rest."""
    import json as _json

    src, out, ckpt = f"{workdir}/topic", f"{workdir}/metrics", f"{workdir}/ckpt"
    recs = [
        _json.dumps({"request_id": str(i), "timestamp": f"2026-07-30T04:08:{i:02d}+00:00", "publisher_id": "p",
                     "ad_id": "a", "user_id": "u", "response_code": 200 if i % 4 else 500, "response_time_ms": 10 * i})
        for i in range(20)
    ] + ["{broken"]
    spark.createDataFrame([(r,) for r in recs], "value string").coalesce(1).write.text(src)
    records = spark.readStream.format("text").load(src)
    query, bad_query = jobs.stream_job(spark, records, out, ckpt, trigger={"availableNow": True})
    try:
        query.awaitTermination(120)
        bad_query.awaitTermination(120)
    finally:
        query.stop()
        bad_query.stop()
    bad = spark.read.parquet(f"{out}_bad")
    assert bad.count() == 1 and bad.first()["raw"] == "{broken"
    from mercato.streaming import runner

    metrics = runner.read_updates(spark, out, runner.update_schema(
        spark.createDataFrame([], "window_start timestamp, window_end timestamp, response_code int, "
                                  "request_count long, avg_response_time_ms decimal(12,1)")))
    assert metrics.filter("response_code = 500").agg(F.sum("request_count")).first()[0] == 2 * 5


def test_profile_job_with_schema(spark, raw_csv):
    """With a schema the extract is read without the inference pass."""
    from mercato.sources.files import SALES_CSV_SCHEMA

    out = jobs.profile_job(spark, raw_csv, schema=SALES_CSV_SCHEMA)
    assert out["overview"].first()["row_count"] == 2000
    types = {r["column_name"]: r["data_type"] for r in out["dtypes"].collect()}
    assert types["unit_price"] == "decimal(10,2)" and types["order_date"] == "string"
