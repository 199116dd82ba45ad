"""Exact quantiles (A16, A18) and surrogate keys (D6) against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.operators.keys import with_surrogate_key
from mercato.operators.quantiles import exact_quantiles
from mercato.sources.synth import synth_events, synth_sales


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e3, 1e3, allow_nan=False)), min_size=0, max_size=60),
    sample=st.sampled_from([2, 5, 10_000]),
    limit=st.sampled_from([1, 4, 1000]),
)
def test_exact_quantiles_match_numpy(spark, values, sample, limit):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0], sample, limit).collect()}
    clean = np.array([v for v in values if v is not None], dtype=float)
    if clean.size == 0:
        assert got == {}
        return
    for p, v in got.items():
        assert v == pytest.approx(float(np.quantile(clean, p)), rel=1e-12, abs=1e-9)


def test_quantiles_hot_value(spark):
    # one value holds a third of the rows: still exact
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7.0 ELSE CAST(id AS DOUBLE) END AS x")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    arr = np.array([7.0 if i % 3 == 0 else float(i) for i in range(3000)])
    for p in (0.1, 0.5, 0.9):
        assert got[p] == pytest.approx(float(np.quantile(arr, p)))


def test_narrowing_leaves_few_rows_to_order(spark):
    """Large intervals are narrowed by samples; only a small part of the column is ever ordered."""
    df = spark.range(200_000).selectExpr("CAST((id * 7919) % 200003 AS DOUBLE) AS x", "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 1000 END AS y")
    rows = df.collect()
    got = {(r["column_name"], r["prob"]): r["value"] for r in exact_quantiles(df, ["x", "y"], [0.01, 0.5, 0.99], 1000, 500).collect()}
    for i, c in enumerate(("x", "y")):
        for p in (0.01, 0.5, 0.99):
            assert got[c, p] == pytest.approx(float(np.quantile([r[i] for r in rows], p)), rel=1e-12)


def test_quantiles_several_columns(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, 20), (3.0, None), (4.0, 40)], "a double, b int")
    got = {(r["column_name"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {("a", 0.5): 2.5, ("b", 0.5): 20.0}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_surrogate_keys_equal_row_number(spark, buckets):
    df = spark.range(500).selectExpr("CAST(id * 7919 % 500 AS STRING) AS name", "id")
    out = with_surrogate_key(df, ["name", "id"], "sk", buckets).collect()
    expected = {name: i + 1 for i, name in enumerate(sorted(r["name"] for r in out))}
    assert all(r["sk"] == expected[r["name"]] for r in out)
    assert sorted(r["sk"] for r in out) == list(range(1, 501))


def test_surrogate_keys_empty(spark):
    assert with_surrogate_key(spark.range(0).selectExpr("CAST(id AS STRING) AS n"), ["n"], "sk").count() == 0


def test_synth_shares(spark):
    n = 20000
    ev = synth_events(spark.range(n))
    shares = {r["response_code"]: r["count"] / n for r in ev.groupBy("response_code").count().collect()}
    assert abs(shares[200] - 0.85) < 0.02 and abs(shares[503] - 0.01) < 0.005
    slow = ev.filter("response_code IN (500, 503)").agg({"response_time_ms": "min"}).first()[0]
    fast = ev.filter("response_code NOT IN (500, 503)").agg({"response_time_ms": "max"}).first()[0]
    assert slow >= 800 and fast <= 300
    sales = synth_sales(spark.range(n))
    cats = {r["product_category"]: r["count"] / n for r in sales.groupBy("product_category").count().collect()}
    assert abs(cats["Clothing"] - 0.40) < 0.02
    bad = sales.filter("quantity < 1 OR quantity > 10 OR discount < 0 OR discount > 0.4 OR customer_rating < 1 OR customer_rating > 5")
    assert bad.count() == 0
    # deterministic: the same ids give the same rows
    assert synth_sales(spark.range(100)).exceptAll(synth_sales(spark.range(100))).count() == 0


def test_surrogate_keys_per_group(spark):
    df = spark.range(300).selectExpr("CAST(id % 3 AS STRING) AS g", "CAST(id * 7 % 300 AS STRING) AS name")
    out = with_surrogate_key(df, ["name"], "sk", buckets=4, group_by=["g"]).collect()
    for g in ("0", "1", "2"):
        rows = sorted((r["name"], r["sk"]) for r in out if r["g"] == g)
        assert [sk for _, sk in rows] == list(range(1, len(rows) + 1))


def test_independent_of_exchange_reuse(spark):
    """Bucket ids are stored data, so the results hold with reuse off."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(2000).selectExpr("CAST((id * 7919) % 2000 AS DOUBLE) AS x", "CAST(id AS STRING) AS name")
        got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.25, 0.5]).collect()}
        arr = np.array([float((i * 7919) % 2000) for i in range(2000)])
        assert got[0.25] == pytest.approx(float(np.quantile(arr, 0.25)))
        assert got[0.5] == pytest.approx(float(np.quantile(arr, 0.5)))
        keys = sorted(r["sk"] for r in with_surrogate_key(df, ["name"], "sk", buckets=5).collect())
        assert keys == list(range(1, 2001))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
