"""Request events: record decoding, sliding-window metrics, record encoding
(P6, P7, A21, T1-T4, T7-T9, K14, S10, G14-G17).

Every transform here is a function from DataFrame to DataFrame that is
valid on a batch frame and on a streaming frame alike, so history is
replayed by passing a batch read of the same records (T15).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ad-request event record (JSON value, publisher id as key).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("publisher_id", T.StringType()),
        T.StructField("ad_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("response_code", T.IntegerType()),
        T.StructField("response_time_ms", T.IntegerType()),
    ]
)

# Writing JSON keeps full microsecond precision (the default format cuts to
# ms); reading uses Spark's default ISO-8601 parsing, which accepts the
# fraction with any number of digits or none (Python's isoformat() omits a
# zero fraction).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

METRIC_COLUMNS = ["window_start", "window_end", "response_code", "request_count", "avg_response_time_ms"]


def ntz_to_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP (an instant), for
    any session time zone. Watermarks need TIMESTAMP."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def instant_to_ntz(c: Column) -> Column:
    """TIMESTAMP -> its UTC wall clock as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def decode_records(records: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Kafka-shaped rows (key, value binary, ...) -> key text + typed record
    fields (P7, G14, G16, S10). Malformed JSON gives an all-null struct."""
    extra = [c for c in ("topic", "partition", "offset") if c in records.columns]
    return records.select(
        F.col("key").cast("string").alias("key"),
        *extra,
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
    ).select("key", *extra, "data.*")


def parse_events(
    records: DataFrame, schema: T.StructType = EVENT_SCHEMA, time_col: str = "timestamp", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(events, bad_records) from raw records (T1, P6, P7, F9); both carry the record columns in ``keep``.

    A record whose JSON does not parse or whose event time is missing can
    never enter a window; it goes to ``bad_records`` with its raw text
    instead of vanishing."""
    text = records.select(F.col("value").cast("string").alias("raw"), *keep)
    parsed = text.select("raw", F.from_json("raw", schema).alias("data"), *keep)
    ok = F.col(f"data.{time_col}").isNotNull()
    events = parsed.filter(ok).select("data.*", *keep)
    bad = parsed.filter(~ok | F.col("data").isNull()).select("raw", *keep)
    return events, bad


def encode_records(df: DataFrame, key_col: str) -> DataFrame:
    """Rows -> (key, value) binary records, value = JSON of the whole row
    (K14, G15, G16); the frame a Kafka sink writes."""
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).cast("binary").alias("value"),
    )


def windowed_metrics(
    events: DataFrame,
    time_col: str = "timestamp",
    code_col: str = "response_code",
    latency_col: str = "response_time_ms",
    size: str = "10 seconds",
    slide: str | None = "5 seconds",
    arrival_col: str | None = None,
) -> DataFrame:
    """Request count and mean latency (rounded to 1) per (window, code)
    (A21, T3, T4, G17). ``slide=None`` gives tumbling windows.
    ``arrival_col``, a label that rises with arrival (a file's number, an
    offset), adds ``last_arrival``: an update row then says which arrival caused it.

    Windows are aligned to the epoch. A row with a null event time has no
    window (route such rows away first: :func:`parse_events`). The
    aggregate is partial + final, so a code holding most rows is collapsed
    per task before the shuffle."""
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return events.groupBy(w.alias("window"), F.col(code_col).alias("response_code")).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.round(F.avg(F.col(latency_col).cast("decimal(12,2)")), 1).cast("decimal(12,1)").alias(
            "avg_response_time_ms"
        ),
        *([F.max(arrival_col).alias("last_arrival")] if arrival_col else []),
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "response_code",
        "request_count",
        "avg_response_time_ms",
        *(["last_arrival"] if arrival_col else []),
    )


def requests_per_minute(metrics: DataFrame) -> DataFrame:
    """Requests per minute of each window (T8; promised by the reference's
    docstring, not computed there): count x 60 / window length in seconds."""
    secs = F.expr("timestampdiff(SECOND, window_start, window_end)")
    return metrics.withColumn(
        "requests_per_minute",
        (F.col("request_count").cast("decimal(20,0)") * 60 / secs).cast("decimal(20,4)"),
    )


def code_share(metrics: DataFrame) -> DataFrame:
    """Share of each response code within its window, in percent.

    The window function partitions by the window: one partition holds the
    handful of codes of one window. On a stream, apply it to the compacted
    update output (``runner.compact_updates``): streaming frames do not
    support such window functions, and an update batch may hold only the
    codes of a window that changed."""
    per_window = Window.partitionBy("window_start", "window_end")
    total = F.sum("request_count").over(per_window)
    return metrics.withColumn(
        "share_pct", F.round(F.col("request_count").cast("decimal(20,0)") * 100 / total, 2).cast("decimal(6,2)")
    )


def latest_per_key(updates: DataFrame, key: Sequence[str] = ("window_start", "window_end", "response_code"), order_col: str = "batch_id") -> DataFrame:
    """Compact update-mode output to the last version of each key.

    ``max_by`` in a grouped aggregate (partial aggregation, no window): a
    key rewritten in many batches keeps one row per task before the
    shuffle."""
    rest = [c for c in updates.columns if c not in key]
    latest = updates.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("__r"))
    return latest.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])
