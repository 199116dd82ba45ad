"""Cleaning rules on hand-made dirty rows (FIXTURES.md §4), pandas semantics."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from mercato.functions.scalar import clip, normalise_label, parse_date, strip_all
from mercato.operators import clean
from mercato.sources.files import SALES_CSV_SCHEMA

DOMAINS = {
    "product_category": ("Beauty", "Clothing", "Electronics"),
    "region": ("North", "South", "East", "West"),
    "payment_method": ("Wallet", "Card", "COD"),
}
RULES = clean.CleanRules(order_by=("seq",), domains=DOMAINS)


def row(seq, order_id, date="1/2/2022", cust=1, cat="Beauty", region="North", qty=1, price="10.00",
        disc="0.10", pay="Card", days=3, rating="4.0", revenue="9.00"):
    return (
        seq, order_id, date, cust, cat, region, qty,
        None if price is None else D(price), None if disc is None else D(disc), pay, days,
        None if rating is None else D(rating), None if revenue is None else D(revenue),
    )


SCHEMA = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SALES_CSV_SCHEMA.fields)


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [
        row(1, 1),                                   # valid
        row(2, 2, date="13/45/2022"),                # bad date -> missing
        row(3, 3, cust=None),                        # missing required
        row(4, 4, rating=None, days=None, pay=None),  # filled
        row(5, 5, disc=None),                        # null discount -> missing (X11)
        row(6, 6, revenue="9.00"),                   # first of key 6
        row(7, 6, revenue="99.00"),                  # duplicate of key 6
        row(8, 8, qty=0),                            # out of range
        row(9, 9, qty=-1),
        row(10, 10, price="-1.00"),
        row(11, 11, revenue="-1.00"),
        row(12, 12, disc="-0.20", revenue="10.00"),  # clipped to 0
        row(13, 13, disc="1.50", revenue="0.00"),    # clipped to 1
        row(14, 14, pay=" cOd "),                    # X1: kept as COD
        row(15, 15, cat="\tbeauty  "),               # tab-padded text
        row(16, 16, cat="Home"),                     # invalid domain (X3)
        row(17, 17, revenue="9.04"),                 # off by 0.04
        row(18, 18, revenue="9.50"),                 # off by 0.5
        row(19, 19, revenue="11.00"),                # off by 2 -> warning
        row(20, 20, rating="2.0", days=10),
        row(21, 21, date="01/02/2022", rating="5.0", days=7),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_reasons(dirty):
    labelled = clean.label_rows(dirty, RULES)
    got = {r["seq"]: r["reject_reason"] for r in labelled.select("seq", "reject_reason").collect()}
    assert got[1] is None
    assert got[2] == "missing_required"
    assert got[3] == "missing_required"
    assert got[4] is None
    assert got[5] == "missing_required"
    assert got[6] is None and got[7] == "duplicate_key"
    assert got[8] == got[9] == got[10] == got[11] == "out_of_range"
    assert got[12] is None and got[13] is None
    assert got[14] is None and got[15] is None
    assert got[16] == "invalid_domain"
    assert got[21] is None  # zero-padded M/d/yyyy parses too


def test_values_and_fills(dirty):
    valid, rejected, report = clean.clean_sales(dirty, RULES)
    v = {r["seq"]: r for r in valid.collect()}
    # medians over the step-2 rows (seq 1,4,6-21 minus missing): ratings and days
    ratings = sorted(float(x) for x in ["4.0"] * 15 + ["2.0", "5.0"])
    n = len(ratings)
    med = (ratings[n // 2] + ratings[(n - 1) // 2]) / 2
    assert v[4]["customer_rating"] == pytest.approx(med)
    assert v[4]["delivery_days"] == 3  # int(median) of the step-2 day counts
    assert v[4]["payment_method"] == "Unknown"  # fill label kept (X2)
    assert v[12]["discount"] == D("0.00") and v[13]["discount"] == D("1.00")
    assert v[14]["payment_method"] == "COD"
    assert v[15]["product_category"] == "Beauty"
    assert v[1]["order_date"] == dt.date(2022, 1, 2)
    assert v[17]["revenue_mismatch"] is False
    assert v[18]["revenue_mismatch"] is False
    assert v[19]["revenue_mismatch"] is True
    assert rejected.count() == 9
    stages = {r["stage"]: r["row_count"] for r in report.collect()}
    assert stages["input"] == 21
    assert stages["kept"] == 12
    assert stages["missing_required"] == 3
    assert stages["duplicate_key"] == 1
    assert stages["out_of_range"] == 4
    assert stages["invalid_domain"] == 1
    assert stages["revenue_mismatch"] == 1


def test_keep_first_is_file_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x")], "k int, seq int, v string")
    out = {r["k"]: r["v"] for r in clean.keep_first(df, ["k"], ["seq"]).collect()}
    assert out == {1: "a", 2: "x"}


def test_strip_and_title(spark):
    df = spark.createDataFrame([("\t cod \n",), ("  home  ",), (None,)], "s string")
    got = [r[0] for r in df.select(normalise_label("s")).collect()]
    assert got == ["Cod", "Home", None]
    got = [r[0] for r in df.select(strip_all("s")).collect()]
    assert got == ["cod", "home", None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-0.2,), (0.5,), (1.5,), (None,)], "d double")
    assert [r[0] for r in df.select(clip("d", 0.0, 1.0)).collect()] == [0.0, 0.5, 1.0, None]


def test_parse_date_coerce(spark):
    df = spark.createDataFrame([("1/1/2022",), ("12/31/2035",), ("2/30/2022",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got == [dt.date(2022, 1, 1), dt.date(2035, 12, 31), None, None, None]


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    valid, rejected, report = clean.clean_sales(empty, RULES)
    assert valid.count() == 0 and rejected.count() == 0
    stages = {r["stage"]: r["row_count"] for r in report.collect()}
    assert stages["input"] == 0 and stages["kept"] == 0


def test_domain_filter_canonical(spark):
    df = spark.createDataFrame([(" cOd ",), ("Card",), ("wallet",), ("cash",)], "p string")
    got = sorted(r[0] for r in clean.domain_filter(df, {"p": DOMAINS["payment_method"]}).collect())
    assert got == ["COD", "Card", "Wallet"]


def test_fill_median_exact(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    got = [r[0] for r in clean.fill_median(df, ["x"]).collect()]
    assert sorted(got) == [1.0, 2.0, 2.5, 3.0, 4.0]  # exact median, not approximate 2.0


def test_dedup_by_struct_min_with_null_order(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 1, "a")], "k int, seq int, v string")
    # nulls sort first, as in an ascending ORDER BY with NULLS FIRST
    assert clean.keep_first(df, ["k"], ["seq"]).collect()[0]["v"] == "n"


def test_required_column_order_irrelevant(dirty):
    labelled = clean.label_rows(dirty, RULES).filter(F.col("seq") == 3)
    assert labelled.first()["reject_reason"] == "missing_required"


def test_identical_copies_keep_exactly_one(spark):
    """A group of identical rows (a third of the input here) keeps one row
    and rejects the other copies as duplicates, like pandas keep="first"."""
    copies = [row(100 + i, 50) for i in range(10)]
    others = [row(200 + i, 60 + i) for i in range(20)]
    df = spark.createDataFrame(copies + others, SCHEMA).drop("seq").withColumn("seq", F.lit(0))
    labelled = clean.label_rows(df, clean.CleanRules(domains=DOMAINS))
    reasons = [r["reject_reason"] for r in labelled.filter(F.col("order_id") == 50).collect()]
    assert reasons.count(None) == 1 and reasons.count("duplicate_key") == 9
    assert labelled.filter(F.col("reject_reason").isNull()).count() == 21


def test_quarantine_keeps_raw_label(dirty):
    _, rejected, _ = clean.clean_sales(dirty, RULES)
    home = rejected.filter(F.col("seq") == 16).first()
    assert home["reject_reason"] == "invalid_domain" and home["product_category"] == "Home"


def test_nan_is_missing_like_pandas(spark):
    from mercato.operators import profile

    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    nulls = profile.nulls(df).first()
    assert nulls["missing_count"] == 2
    got = sorted(r[0] for r in clean.fill_median(df, ["x"]).collect())
    assert got == [1.0, 2.0, 2.0, 3.0]  # median of 1 and 3 fills both the NaN and the null


def test_unstaged_on_a_file_scan(spark):
    """stage=False on a direct Parquet scan gives the staged answer."""
    import uuid

    from mercato.session import ensure_checkpoint_dir

    rows = [row(i, i % 7, qty=1 + i % 3) for i in range(40)]
    path = f"{ensure_checkpoint_dir(spark)}/unstaged-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    scan = spark.read.parquet(path)
    a = sorted((r["seq"], r["reject_reason"]) for r in clean.label_rows(scan, RULES, stage=False).collect())
    b = sorted((r["seq"], r["reject_reason"]) for r in clean.label_rows(scan, RULES).collect())
    assert a == b and sum(1 for _, x in a if x == "duplicate_key") == 33
