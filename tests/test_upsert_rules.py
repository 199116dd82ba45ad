"""Upsert (K6, K10), constraint checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from mercato.operators import rules
from mercato.operators.upsert import read_current, upsert, upsert_table
from mercato.session import ensure_checkpoint_dir

T0 = dt.datetime(2025, 1, 1)
NOW = dt.datetime(2026, 1, 1)


def _target(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0, T0), (2, "b", 20.0, T0)],
        "order_id int, region string, revenue double, loaded_at timestamp_ntz",
    )


def _updates(spark):
    return spark.createDataFrame(
        [(2, "CHANGED", 21.0), (3, "c", 30.0)], "order_id int, region string, revenue double"
    )


def test_upsert_matched_unmatched(spark):
    now = F.lit(NOW).cast("timestamp_ntz")
    out = {r["order_id"]: r for r in upsert(_target(spark), _updates(spark), ["order_id"], ["revenue"], now).collect()}
    assert out[1]["revenue"] == 10.0 and out[1]["loaded_at"] == T0  # only in target: untouched
    assert out[2]["region"] == "b"  # matched: non-update column kept
    assert out[2]["revenue"] == 21.0 and out[2]["loaded_at"] == NOW
    assert out[3]["region"] == "c" and out[3]["loaded_at"] == NOW  # new key inserted whole
    assert len(out) == 3


def test_upsert_table_versions(spark):
    base = f"{ensure_checkpoint_dir(spark)}/upsert-{uuid.uuid4().hex}"
    now = F.lit(NOW).cast("timestamp_ntz")
    assert upsert_table(spark, base, _target(spark), ["order_id"], ["revenue"], now) == 1
    assert upsert_table(spark, base, _updates(spark), ["order_id"], ["revenue"], now) == 2
    cur = read_current(spark, base)
    assert cur.count() == 3
    assert cur.filter("order_id = 2").first()["region"] == "b"
    # the previous version is still intact (never overwritten while read)
    assert spark.read.parquet(f"{base}/version=1").count() == 2


def test_violations_null_passes(spark):
    df = spark.createDataFrame([(1, None), (0, 2.0), (None, 6.0)], "q int, rating double")
    got = {r["rule"]: r["violations"] for r in rules.violations(
        df, {"q_not_null": F.col("q").isNotNull(), "q_pos": "q > 0", "rating": "rating BETWEEN 1 AND 5"}
    ).collect()}
    assert got == {"q_not_null": 1, "q_pos": 1, "rating": 1}


def test_rule_quarantine(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, -1), (3, None)], "id int, q int")
    checks = {**rules.not_null_rules(["id"]), "q_positive": "q > 0"}
    valid, rejected = rules.split_by_rules(df, checks)
    assert sorted(r["id"] for r in valid.collect()) == [1, 3]  # a NULL check passes, as in SQL
    assert {r["broken_rule"] for r in rejected.collect()} == {"id_not_null", "q_positive"}


def test_single_lookup(spark):
    from mercato.operators import warehouse

    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert [(r["k"], r["n"]) for r in warehouse.lookup_table(df, "c", "k", "n").orderBy("k").collect()] == [(1, "a"), (2, "b")]


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    pk = sorted((r["k"], r["n"]) for r in rules.key_violations(df, ["k"]).collect() if r["k"] is not None)
    assert pk == [(1, 2)]
    assert rules.key_violations(df, ["k"]).filter(F.col("k").isNull()).count() == 1
    assert rules.key_violations(df, ["k"], allow_null=True).count() == 1


def test_orphans_ignore_null_fk(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert [r["fk"] for r in rules.orphans(child, parent, ["fk"], ["pk"]).collect()] == [2]


def test_row_counts_and_reconcile(spark):
    a = spark.range(5)
    b = spark.range(5)
    c = spark.range(3)
    counts = {r["table_name"]: r["row_count"] for r in rules.row_counts({"a": a, "c": c}).collect()}
    assert counts == {"a": 5, "c": 3}
    assert rules.reconcile(a, b).first()["ok"] is True
    assert rules.reconcile(a, c).first()["ok"] is False


def test_warehouse_collation(spark):
    """Under MySQL-like collation 'Card ', 'card' and 'CARD' are one payment
    method and no order is lost in the name joins; byte equality keeps all four spellings."""
    from mercato.operators import warehouse

    rows = [
        (i, dt.date(2024, 1, 1 + i), 100 + i % 2, "Beauty", "North", 1, 10.0, 0.1, pay, 3, 4.0, 9.0)
        for i, pay in enumerate(["Card ", "card", "CARD", "Wallet"])
    ]
    flat = spark.createDataFrame(
        rows,
        "order_id int, order_date date, customer_id int, product_category string, region string, quantity int, "
        "unit_price double, discount double, payment_method string, delivery_days int, customer_rating double, "
        "revenue double",
    )
    ci = warehouse.build_warehouse(flat, collation="UNICODE_CI_AI_RTRIM")
    assert sorted(r["method_name"] for r in ci.payment_methods.collect()) == ["CARD", "Wallet"]
    assert ci.orders.count() == 4 and ci.fact_orders.count() == 4
    binary = warehouse.build_warehouse(flat)
    assert binary.payment_methods.count() == 4


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.dictionaries(st.integers(0, 30), st.tuples(st.sampled_from("abc"), st.integers(0, 99)), max_size=20),
    updates=st.dictionaries(st.integers(0, 30), st.tuples(st.sampled_from("xyz"), st.integers(100, 199)), max_size=20),
)
def test_upsert_matches_dict_merge(spark, target, updates):
    t = spark.createDataFrame([(k, r, float(v), T0) for k, (r, v) in target.items()],
                              "order_id int, region string, revenue double, loaded_at timestamp_ntz")
    u = spark.createDataFrame([(k, r, float(v)) for k, (r, v) in updates.items()],
                              "order_id int, region string, revenue double")
    got = {r["order_id"]: (r["region"], r["revenue"], r["loaded_at"])
           for r in upsert(t, u, ["order_id"], ["revenue"], F.lit(NOW).cast("timestamp_ntz")).collect()}
    want = {k: (r, float(v), T0) for k, (r, v) in target.items()}
    for k, (r, v) in updates.items():
        want[k] = (want[k][0], float(v), NOW) if k in want else (r, float(v), NOW)
    assert got == want


def test_unreadable_log_is_an_error(spark):
    """A damaged versions log must not look like an empty table."""
    import os
    import uuid

    import pytest

    from mercato.operators.upsert import read_current
    from mercato.session import ensure_checkpoint_dir

    base = f"{ensure_checkpoint_dir(spark)}/damaged-{uuid.uuid4().hex}"
    assert read_current(spark, base) is None
    folder = base.replace("file:", "") + "/versions_log"
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match=r".+"):
        read_current(spark, base)
