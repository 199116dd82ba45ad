"""One key, value or copy group holding a third of the rows."""

from __future__ import annotations

import contextlib
import io
import os

from pyspark.sql import functions as F

from mercato.operators import clean
from mercato.session import scratch_path
from mercato.sources import files
from mercato.streaming import events as ev


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def hot_frame(spark, n=3000):
    """order_id 0 holds a third of the rows; the rest are unique."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("order_id"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(2000)).otherwise(F.col("id") % 7 + 2001).alias("year"),
    )


def test_hot_partition_value_written_by_many_tasks(spark):
    path = scratch_path(spark, "skew-write")
    files.write_table(hot_frame(spark), path, "parquet", partition_by=["year"], tasks=8)
    hot_dir = os.path.join(path.replace("file:", ""), "year=2000")
    parts = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(parts) >= 2  # a third of the rows is not funnelled through one writer
    assert spark.read.parquet(path).filter("year = 2000").count() == 1000


def test_hot_key_keep_first(spark):
    df = hot_frame(spark)
    firsts = clean.keep_first(df, ["order_id"], ["seq"])
    got = {r["order_id"]: r["seq"] for r in firsts.collect()}
    assert got[0] == 0 and len(got) == 2001
    assert "partial_min" in explain(firsts)  # collapsed per task before the shuffle


def test_hot_code_window_metrics(spark):
    df = spark.range(6000).select(
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 != 0, F.lit(200)).otherwise(F.col("id") % 5).alias("code"),
        F.lit(10).alias("ms"),
    )
    m = ev.windowed_metrics(df, "ts", "code", "ms", "10 minutes", "5 minutes")
    assert "partial_count" in explain(m)
    assert m.filter("response_code = 200").agg(F.sum("request_count")).first()[0] == 2 * 4000


RULES = clean.CleanRules(
    required=("order_id", "need"), median_fills=(), label_fills={}, text_cols=(), quantity_col="one", price_col="one",
    revenue_col="one", discount_col="one", date_col="dt", expected_revenue="one",
)


def test_label_rows_spreads_hot_null_and_incomplete_keys(spark):
    """A hot key, a null key and a key whose rows miss a column: the join to the
    winners runs on the row id, so no partition gets more than its share."""
    n = 30000
    key = F.when(F.col("id") % 4 == 0, F.lit(0)).when(F.col("id") % 4 == 1, F.lit(None)).when(F.col("id") % 4 == 2, F.lit(-1))
    df = spark.range(n).select(
        key.otherwise(F.col("id")).alias("order_id"),
        F.when(F.col("id") % 4 != 2, F.lit(1)).alias("need"),
        F.lit(1).alias("one"), F.current_date().alias("dt"), F.col("id").alias("seq"),
    )
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = clean.label_rows(df, RULES).select("seq", "reject_reason", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sizes = [len([r for r in rows if r.p == p]) for p in {r.p for r in rows}]
    assert len(rows) == n and max(sizes) <= 2 * n / len(sizes)
    kept = {r.seq for r in rows if r.reject_reason is None}
    assert kept == {0} | set(range(3, n, 4))


def test_keep_first_follows_the_files(spark):
    """The first row of a key is the one in the first file, however Spark packs the files."""
    path = scratch_path(spark, "file-order")
    for name, count in (("a", 20), ("b", 4000), ("c", 300)):
        rows = spark.range(count).select(F.col("id").alias("order_id"), F.lit(name).alias("need"))
        rows.coalesce(1).write.mode("overwrite").csv(f"{path}-{name}")
    folder = f"{path}-all"
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in "abc":
        part = next(f for f in os.listdir(f"{path}-{name}".replace("file:", "")) if f.endswith(".csv"))
        fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{path}-{name}/{part}"), spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.csv"))
    df = spark.read.schema("order_id long, need string").csv(folder)
    df = df.withColumns({"one": F.lit(1), "dt": F.current_date()})
    got = {r.order_id: r.need for r in clean.label_rows(df, RULES).filter("reject_reason is null").collect()}
    assert got == {k: "a" if k < 20 else "b" for k in range(4000)}


def test_aqe_splits_hot_key_between_stored_tables(spark):
    """Joins of two stored tables (how the warehouse joins facts to
    customers) get AQE's skew split: the hot key's partition is cut into
    pieces, each joined with a copy of the other side's partition."""
    from mercato.session import materialize

    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        facts = materialize(hot_frame(spark, 30000).select("order_id", "seq"), spark, "skew-facts")
        dims = materialize(spark.range(30000).select(F.col("id").alias("order_id"), F.lit(1).alias("w")), spark, "skew-dims")
        j = facts.hint("merge").join(dims, "order_id")
        assert len(j.collect()) == 30000
        assert "SortMergeJoin(skew=true)" in explain(j)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
