"""Physical-plan assertions: pushdown, pruning, no cross products."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.operators import reports
from mercato.plans.registry import all_queries
from mercato.session import scratch_path
from mercato.sources import files
from mercato.sources.tables import sales_flat, table

from .conftest import SF_SMALL


def plan_of(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filter_pushed_into_scan(spark):
    df = reports.top_customers_filtered(sales_flat(spark, SF_SMALL), "ASIA", "1998-06-01")
    text = formatted(df)
    assert "EqualTo(r_name,ASIA)" in text  # region predicate reaches the region scan
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01T00:00)" in text  # date predicate reaches orders
    assert "TakeOrderedAndProject" in text


def test_column_pruning_reaches_scan(spark):
    df = table(spark, SF_SMALL, "lineitem").groupBy("l_returnflag").agg(F.sum("l_quantity"))
    text = formatted(df)
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text


def test_partition_pruning(spark):
    path = scratch_path(spark, "plan-pruning")
    li = table(spark, SF_SMALL, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    files.write_table(li, path, "parquet", partition_by=["ship_year"])
    text = formatted(spark.read.parquet(path).filter(F.col("ship_year") == 1998))
    assert "PartitionFilters: [isnotnull(ship_year" in text and "(ship_year" in text


def test_partial_aggregation(spark):
    q = all_queries()["revenue_by_category"].fn(spark, SF_SMALL)
    text = formatted(q)
    assert text.count("HashAggregate") >= 2  # partial + final around one exchange


CHEAP = [
    "revenue_by_category", "revenue_by_region_month", "top_customers", "avg_by_priority",
    "delivery_bucket", "dedup_first", "violations", "pk_violations", "fk_orphans", "upsert",
    "windowed_metrics", "code_share", "profile_describe", "exact_median", "surrogate_keys_customer",
    "profile_duplicates", "profile_nulls", "json_parse", "kafka_roundtrip",
    "clean_report", "dim_lookup", "category_quarter_star", "stream_append_metrics",
]


@pytest.mark.parametrize("name", CHEAP)
def test_no_cartesian_or_nested_loop(spark, name):
    df = all_queries()[name].fn(spark, SF_SMALL)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_clustered_layout_concentrates_rows(spark):
    """Range clustering on (region, order_date): the rows of one region sit in
    about a fifth of the files, so min/max statistics skip the rest; a plain
    write spreads them over every file."""
    flat = sales_flat(spark, "/root/testdata/sf0.01")
    clustered, plain = scratch_path(spark, "clustered"), scratch_path(spark, "plain")
    files.write_clustered(flat, clustered, ["region", "order_date"], files=20)
    flat.repartition(20).write.parquet(plain)

    def files_with_asia(path):
        df = spark.read.parquet(path).filter(F.col("region") == "ASIA")
        return df.select(F.input_file_name()).distinct().count()

    assert files_with_asia(clustered) <= 6
    assert files_with_asia(plain) == 20


@pytest.mark.parametrize("name", ["revenue_by_region_month", "violations", "delivery_bucket", "sql_view_top_customers"])
def test_reports_without_the_category_shuffle_the_fact_once(spark, name):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = plan_of(all_queries()[name].fn(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "l_partkey" not in plan
