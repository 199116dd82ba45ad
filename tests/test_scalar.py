"""Column helpers with pandas/MySQL semantics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from mercato.functions import scalar as S


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_strip_matches_python(spark):
    samples = ["  Card ", "\x1c cod \x1f", "\t\nNorth\r ", "  ", "a b"]
    df = spark.createDataFrame([(x,) for x in samples], "s string")
    got = [r[0] for r in df.select(S.strip_all("s")).collect()]
    assert got == [x.strip() for x in samples]


def test_date_helpers(spark):
    d = dt.date(2024, 3, 9)
    assert one(spark, S.date_key("d"), d, "d date") == 20240309
    assert one(spark, S.day_name("d"), d, "d date") == "Saturday"
    assert one(spark, S.month_key("d"), d, "d date") == "2024-03"


def test_delivery_bucket_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-2, 0, 3, 4, 7, 8, None)], "d int")
    got = [r[0] for r in df.select(S.delivery_bucket("d")).collect()]
    assert got == ["1-3 days", "1-3 days", "1-3 days", "4-7 days", "4-7 days", "8+ days", "8+ days"]


def test_isin_normalised(spark):
    df = spark.createDataFrame([(" cOd ",), ("cash",)], "p string")
    assert [r[0] for r in df.select(S.isin_normalised("p", ["COD", "Card"])).collect()] == [True, False]


def test_money_round_half_up(spark):
    df = spark.createDataFrame([("1.005",), ("2.675",)], "s string")
    got = [r[0] for r in df.select(F.round(F.col("s").cast("decimal(10,3)"), 2)).collect()]
    assert [str(x) for x in got] == ["1.01", "2.68"]  # decimals round half up, no binary artefacts
