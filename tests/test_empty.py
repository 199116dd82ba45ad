"""Every operator on a zero-row frame (FIXTURES.md §4 'empty')."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mercato.operators import profile, reports, rules, warehouse
from mercato.operators.clean import domain_filter, drop_missing, fill_const, fill_median, keep_first
from mercato.operators.keys import with_surrogate_key
from mercato.operators.quantiles import exact_quantiles
from mercato.operators.upsert import upsert
from mercato.session import ensure_checkpoint_dir
from mercato.sources import files
from mercato.sources.synth import synth_events, synth_sales
from mercato.streaming import events as ev

FLAT = (
    "order_id long, order_date date, customer_id long, product_category string, region string, "
    "quantity int, unit_price decimal(10,2), discount decimal(4,2), payment_method string, "
    "delivery_days int, customer_rating decimal(3,1), revenue decimal(12,2)"
)


def empty(spark, schema=FLAT):
    return spark.createDataFrame([], schema)


def test_reports_empty(spark):
    e = empty(spark)
    for df in (
        reports.revenue_by_category(e), reports.revenue_by_region_month(e), reports.revenue_by_region_year(e),
        reports.top_customers(e), reports.top_customers_filtered(e, "North", "2022-01-01"),
        reports.avg_rating_by_payment(e), reports.rating_by_delivery_bucket(e),
        reports.year_distribution(e, "order_date"), reports.preview(e, 5, ["order_id"]),
    ):
        assert df.count() == 0
    assert reports.date_range(e, "order_date").first()["row_count"] == 0


def test_profile_empty(spark):
    e = empty(spark)
    assert profile.overview(e).first()["row_count"] == 0
    nulls = profile.nulls(e).collect()
    assert len(nulls) == 12 and all(r["missing_count"] == 0 and r["missing_pct"] is None for r in nulls)
    assert profile.duplicates(e, ["order_id"]).first().asDict() == {"row_count": 0, "duplicate_rows": 0, "duplicate_keys": 0}
    assert profile.negatives(e).count() == 0
    described = profile.describe(e).collect()  # every numeric column, count 0 (as pandas)
    assert len(described) == 8 and all(r["count"] == 0 and r["mean"] is None for r in described)
    assert profile.distinct_values(e).count() == 0
    assert profile.rule_check(e, F.col("revenue"), F.col("unit_price"), 1.0).first()["checked_rows"] == 0
    assert profile.schema_report(e).count() == 12
    assert exact_quantiles(e, ["revenue"], [0.5]).count() == 0


def test_clean_steps_empty(spark):
    e = empty(spark)
    assert drop_missing(e, ["order_id"]).count() == 0
    assert fill_median(e, ["customer_rating"]).count() == 0
    assert fill_const(e, {"payment_method": "Unknown"}).count() == 0
    assert keep_first(e, ["order_id"], ["customer_id"]).count() == 0
    assert domain_filter(e, {"region": ["North"]}).count() == 0


def test_rules_empty(spark):
    e = empty(spark)
    assert [r["violations"] for r in rules.violations(e, {"q": "quantity > 0"}).collect()] == [0]
    assert rules.key_violations(e, ["order_id"]).count() == 0
    assert rules.orphans(e, e, ["customer_id"]).count() == 0
    assert rules.reconcile(e, e).first()["ok"] is True


def test_warehouse_empty(spark):
    wh = warehouse.build_warehouse(empty(spark))
    assert all(df.count() == 0 for df in wh.tables().values())
    assert warehouse.calendar_dim(empty(spark)).count() == 0
    assert with_surrogate_key(empty(spark), ["order_id"], "sk").count() == 0


def test_upsert_empty(spark):
    t = spark.createDataFrame([(1, 1.0)], "k int, revenue double")
    e = spark.createDataFrame([], "k int, revenue double")
    assert upsert(t, e, ["k"], ["revenue"], stamp_col=None).count() == 1
    assert upsert(e, t, ["k"], ["revenue"], stamp_col=None).count() == 1
    assert upsert(e, e, ["k"], ["revenue"], stamp_col=None).count() == 0


def test_events_empty(spark):
    raw = spark.createDataFrame([], "value binary")
    events, bad = ev.parse_events(raw)
    assert events.count() == 0 and bad.count() == 0
    m = ev.windowed_metrics(events)
    assert m.count() == 0
    assert ev.code_share(m).count() == 0 and ev.requests_per_minute(m).count() == 0
    assert ev.latest_per_key(m.withColumn("batch_id", F.lit(0))).count() == 0
    assert ev.decode_records(ev.encode_records(events, "publisher_id"), ev.EVENT_SCHEMA).count() == 0


def test_synth_and_files_empty(spark):
    assert synth_sales(spark.range(0)).count() == 0
    assert synth_events(spark.range(0)).count() == 0
    base = f"{ensure_checkpoint_dir(spark)}/empty-{uuid.uuid4().hex}"
    for fmt in ("parquet", "orc"):
        files.write_table(empty(spark), f"{base}-{fmt}", fmt)
        assert files.read_table(spark, f"{base}-{fmt}", fmt).count() == 0
    files.write_table(empty(spark), f"{base}-part", "parquet", partition_by=["region"])
    # an empty partitioned write leaves no data file: read it with its schema
    assert files.read_table(spark, f"{base}-part", "parquet", empty(spark).schema).count() == 0
