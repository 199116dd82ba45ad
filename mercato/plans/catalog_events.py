"""Event queries.

Stand-in mapping (FIXTURES.md §3): ``events.ts`` is the event time,
``event_type`` the response code, ``value`` the latency and ``user_id``
the publisher key. The events span a month, so the stand-in windows are
1 hour sliding by 30 minutes (the reference: 10 s / 5 s over a live
stream) and the watermark is 2 hours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.plans.registry import register
from mercato.session import scratch_path
from mercato.sources.synth import synth_events, synth_sales
from mercato.sources.tables import table
from mercato.streaming import compaction, late, runner
from mercato.streaming import events as ev
from mercato.streaming.journal import BatchJournal, last_watermark, read_journal
from mercato.streaming.sinks import Sink, append_sink

SIZE, SLIDE, WATERMARK = "1 hour", "30 minutes", "2 hours"

STANDIN_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("publisher_id", T.StringType()),
        T.StructField("response_code", T.StringType()),
        T.StructField("response_time_ms", T.DoubleType()),
    ]
)


def _metrics_sql(size_min: int, slide_min: int | None) -> str:
    if slide_min is None:
        starts = f"[time_bucket(INTERVAL {size_min} MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00')]"
    else:
        b = f"time_bucket(INTERVAL {slide_min} MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00')"
        starts = "[" + ", ".join(f"{b} - INTERVAL {k * slide_min} MINUTE" for k in range(size_min // slide_min)) + "]"
    return f"""
metrics AS (
  SELECT window_start, window_start + INTERVAL {size_min} MINUTE AS window_end, response_code,
         COUNT(*) AS request_count,
         CAST(((2 * CAST(SUM(CAST(value AS DECIMAL(12,2))) * 100 AS BIGINT) + 10 * COUNT(*))
               // (20 * COUNT(*))) * 0.1 AS DECIMAL(12,1)) AS avg_response_time_ms
  FROM (SELECT event_type AS response_code, value, unnest({starts}) AS window_start FROM events)
  GROUP BY ALL
)"""


SLIDING_SQL = "WITH " + _metrics_sql(60, 30).strip() + "\n"
TUMBLING_SQL = "WITH " + _metrics_sql(60, None).strip() + "\n"


def _standin_events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _batch_metrics(spark, sf_dir, slide=SLIDE):
    return ev.windowed_metrics(_standin_events(spark, sf_dir), "ts", "event_type", "value", SIZE, slide)


@register("windowed_metrics", covers="A21 T3 G13 G17 T15 (batch)", oracle=SLIDING_SQL + "SELECT * FROM metrics")
def q_windowed_metrics(spark, sf_dir):
    return _batch_metrics(spark, sf_dir)


@register("tumbling_metrics", covers="T4", oracle=TUMBLING_SQL + "SELECT * FROM metrics")
def q_tumbling_metrics(spark, sf_dir):
    return _batch_metrics(spark, sf_dir, slide=None)


@register(
    "requests_per_minute",
    covers="T8",
    oracle=SLIDING_SQL
    + """
SELECT *, CAST(CAST(request_count AS DECIMAL(20,0)) * 60 / 3600 AS DECIMAL(20,4)) AS requests_per_minute
FROM metrics""",
)
def q_requests_per_minute(spark, sf_dir):
    return ev.requests_per_minute(_batch_metrics(spark, sf_dir))


@register(
    "code_share",
    covers="T9",
    oracle=SLIDING_SQL
    + """
SELECT *, CAST(round(CAST(request_count AS DECIMAL(20,0)) * 100
                     / SUM(request_count) OVER (PARTITION BY window_start, window_end), 2) AS DECIMAL(6,2))
          AS share_pct
FROM metrics""",
)
def q_code_share(spark, sf_dir):
    return ev.code_share(_batch_metrics(spark, sf_dir))


@register(
    "json_parse",
    covers="P6 P7 G14",
    oracle="SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_json_parse(spark, sf_dir):
    e = _standin_events(spark, sf_dir)
    return e.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


_EVENTS_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@register(
    "kafka_roundtrip",
    covers="K14 S10 P7 G15 G16",
    oracle="SELECT CAST(user_id AS VARCHAR) AS key, * FROM events",
)
def q_kafka_roundtrip(spark, sf_dir):
    """Encode every event as a keyed JSON record, decode it back: the
    record format a Kafka topic carries, checked by round trip."""
    records = ev.encode_records(_standin_events(spark, sf_dir), "user_id")
    return ev.decode_records(records, _EVENTS_RECORD_SCHEMA)


CHUNKS = 4
STATE_PARTITIONS = 8


def _chunked_events(spark, sf_dir, chunks: int = CHUNKS):
    """The events with a ``chunk`` index: ``chunks`` consecutive event-time
    ranges of equal length in whole microseconds (the same integer rule as
    the oracle SQL). The bounds are a one-row aggregate."""
    e = _standin_events(spark, sf_dir)
    bounds = e.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        return e.withColumn("chunk", F.lit(0))
    step = max(1, ((hi - lo) // dt.timedelta(microseconds=1)) // chunks)
    idx = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{lo.isoformat(sep=' ')}', ts) div {step}")
    return e.withColumn("chunk", F.least(idx, F.lit(chunks - 1)).cast("int"))


def _record_value():
    """An event as the JSON text of an ad-request record."""
    return F.to_json(
        F.struct(
            F.col("event_id"),
            ev.ntz_to_instant(F.col("ts")).alias("timestamp"),
            F.concat(F.lit("publisher_"), F.col("user_id")).alias("publisher_id"),
            F.col("event_type").alias("response_code"),
            F.col("value").alias("response_time_ms"),
        ),
        ev.JSON_OPTIONS,
    ).alias("value")


def _deliver(chunked, src: str, k: int) -> None:
    """Put the records of chunk ``k`` into the topic folder."""
    chunked.filter(F.col("chunk") == k).select("value").write.mode("overwrite").text(f"{src}/chunk={k:04d}")


def _read_events(spark, src: str):
    """The topic folder as a stream of parsed events with their ``arrival`` (the chunk)."""
    raw = runner.read_record_files(spark, src).select("value", runner.arrival_number().alias("arrival"))
    return ev.parse_events(raw, STANDIN_SCHEMA, keep=["arrival"])[0]


def _metrics(events):
    return runner.metrics_stream(
        events, "timestamp", "response_code", "response_time_ms", WATERMARK, SIZE, SLIDE, arrival_col="arrival"
    )


def _run_stream_in_chunks(spark, sf_dir, output_mode: str = "update", chunked=None, after=None, sinks=()):
    """Append the event records to a topic folder one chunk at a time; after
    each chunk the checkpointed query runs with ``availableNow`` and stops (a
    restart from the checkpoint each time: offsets, watermark and window state
    carry over). ``after(out, schema, journal)`` runs between the chunks.
    Returns the update output folder and its schema."""
    src = scratch_path(spark, "event-records")
    out = scratch_path(spark, "metrics-out")
    ckpt = scratch_path(spark, "metrics-ckpt")
    journal_path = scratch_path(spark, "metrics-journal")
    chunked = (chunked or _chunked_events(spark, sf_dir)).select("chunk", _record_value())
    for k in range(CHUNKS):
        _deliver(chunked, src, k)
        metrics = _metrics(_read_events(spark, src))
        schema = runner.update_schema(metrics)
        journal = BatchJournal(spark, journal_path)
        query = runner.start_metrics_query(
            metrics, out, ckpt, trigger={"availableNow": True}, state_partitions=STATE_PARTITIONS,
            output_mode=output_mode, sinks=sinks,
        )
        runner.await_or_stop(query, journal=journal)
        if after is not None:
            after(out, schema, journal_path)
    return out, schema


@register(
    "event_bad_records",
    covers="T1 F9 G14 P7 (bad records to a side output)",
    oracle="""
SELECT CASE WHEN event_id % 50 = 0 OR event_id % 77 = 0 THEN 'bad' ELSE 'parsed' END AS status,
       COUNT(*) AS row_count
FROM events GROUP BY status""",
)
def q_event_bad_records(spark, sf_dir):
    """Records with broken JSON (every 50th) or no event time (every 77th)
    go to the bad-record output with their raw text; the rest parse."""
    e = _standin_events(spark, sf_dir)
    k = F.col("event_id")
    no_time = F.to_json(F.struct(F.col("event_id"), F.col("event_type").alias("response_code")))
    value = F.when(k % 50 == 0, F.lit("{broken")).when(k % 77 == 0, no_time).otherwise(_record_value())
    events, bad = ev.parse_events(e.select(value.alias("value")), STANDIN_SCHEMA)
    count = F.count(F.lit(1)).alias("row_count")
    return events.agg(count).select(F.lit("parsed").alias("status"), "row_count").unionByName(
        bad.agg(count).select(F.lit("bad").alias("status"), "row_count")
    )


def _ntz_windows(df):
    return df.select(
        *[c for c in df.columns if c not in ("window_start", "window_end")],
        ev.instant_to_ntz(F.col("window_start")).alias("window_start"),
        ev.instant_to_ntz(F.col("window_end")).alias("window_end"),
    )


@register(
    "stream_windowed_metrics",
    covers="T1 T2 T3 T6 T7 T11 T12 T14 T15 K12 K13 F8 (a file stream stands in for Kafka)",
    oracle=SLIDING_SQL + "SELECT * FROM metrics",
)
def q_stream_windowed_metrics(spark, sf_dir):
    """Compacted update output of the chunked stream: equals the batch
    answer because no chunk is older than the watermark."""
    out, schema = _run_stream_in_chunks(spark, sf_dir)
    latest = runner.compact_updates(spark, out, schema)
    return _ntz_windows(latest).select(*ev.METRIC_COLUMNS)


@register(
    "stream_code_share",
    covers="T9 T8 T7 (share and rate on the stream's compacted output)",
    oracle=SLIDING_SQL
    + """
SELECT *, CAST(CAST(request_count AS DECIMAL(20,0)) * 60 / 3600 AS DECIMAL(20,4)) AS requests_per_minute,
       CAST(round(CAST(request_count AS DECIMAL(20,0)) * 100
                  / SUM(request_count) OVER (PARTITION BY window_start, window_end), 2) AS DECIMAL(6,2))
         AS share_pct
FROM metrics""",
)
def q_stream_code_share(spark, sf_dir):
    """Share of each code in its window and requests per minute, on the
    stream. An update batch may carry only some codes of a window, so the
    share is taken over the compacted output (latest row per window and
    code), where every window has all its codes."""
    out, schema = _run_stream_in_chunks(spark, sf_dir)
    latest = _ntz_windows(runner.compact_updates(spark, out, schema)).select(*ev.METRIC_COLUMNS)
    return ev.code_share(ev.requests_per_minute(latest))


@register(
    "stream_append_metrics",
    covers="T11 T2 (append mode: each window once, when the watermark closes it)",
    oracle=SLIDING_SQL
    + """
SELECT * FROM metrics
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 2 HOUR""",
)
def q_stream_append_metrics(spark, sf_dir):
    """The same stream in ``append`` mode: a (window, code) row is written
    once, when the watermark (latest event time - 2 h) passes the window's
    end; windows still open at the end of the input are not written."""
    out, schema = _run_stream_in_chunks(spark, sf_dir, output_mode="append")
    rows = runner.read_updates(spark, out, schema)
    return _ntz_windows(rows).select(*ev.METRIC_COLUMNS)


_CHUNK_SQL = f"""
WITH bounds AS (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM events),
ev AS (
  SELECT e.*, CAST(LEAST(date_diff('microsecond', b.lo, e.ts)
                         // GREATEST(1, date_diff('microsecond', b.lo, b.hi) // {CHUNKS}), {CHUNKS - 1}) AS INTEGER)
           AS chunk
  FROM events e, bounds b),
w AS (
  SELECT chunk, event_type AS response_code, value,
         unnest([time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00'),
                 time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') - INTERVAL 30 MINUTE])
           AS window_start
  FROM ev),
touched AS (SELECT DISTINCT chunk, window_start, response_code FROM w)
SELECT t.chunk, t.window_start, t.window_start + INTERVAL 1 HOUR AS window_end, t.response_code,
       COUNT(*) AS request_count,
       CAST(((2 * CAST(SUM(CAST(w.value AS DECIMAL(12,2))) * 100 AS BIGINT) + 10 * COUNT(*))
             // (20 * COUNT(*))) * 0.1 AS DECIMAL(12,1)) AS avg_response_time_ms
FROM touched t JOIN w ON w.window_start = t.window_start AND w.response_code = t.response_code
                     AND w.chunk <= t.chunk
GROUP BY t.chunk, t.window_start, t.response_code"""


@register(
    "stream_update_rows",
    covers="T6 T7 T11 K12 X9 (every update row, by arrival chunk)",
    oracle=_CHUNK_SQL,
)
def q_stream_update_rows(spark, sf_dir):
    """Every row the update-mode query emitted, labelled with the arrival
    chunk that caused it: a (window, code) appears once per chunk that
    touched it, carrying the running count and mean over all chunks so far
    (what the reference's CSV output holds, X9)."""
    out, schema = _run_stream_in_chunks(spark, sf_dir)
    updates = runner.read_updates(spark, out, schema).withColumnRenamed("last_arrival", "chunk")
    return _ntz_windows(updates).select("chunk", *ev.METRIC_COLUMNS)


@register(
    "stream_two_sinks",
    covers="T13 K11 T11 T12 K12 (two outputs of one state stage, a restart in mid batch)",
    oracle=f"SELECT s.sink, u.* FROM ({_CHUNK_SQL}) u, (VALUES ('folders'), ('appended')) s(sink)",
)
def q_stream_two_sinks(spark, sf_dir):
    """Update rows to a folder per batch and to an appended table. In the
    second chunk a third output fails after both have written; the batch comes again
    and neither gets it twice."""
    table_path = scratch_path(spark, "metrics-appended")
    src, out, ckpt = (scratch_path(spark, n) for n in ("event-records", "metrics-out", "metrics-ckpt"))
    chunked = _chunked_events(spark, sf_dir).select("chunk", _record_value())
    broken = [1]  # the chunk at which the third output fails, once

    def fails_once(batch, batch_id):
        if broken and batch.agg(F.max("last_arrival")).first()[0] == broken[0]:
            broken.clear()
            raise RuntimeError("the third output is away")

    outputs = [append_sink(table_path), Sink("third", fails_once)]
    for k in range(CHUNKS):
        _deliver(chunked, src, k)
        for _ in range(2):
            query = runner.start_metrics_query(
                _metrics(_read_events(spark, src)), out, ckpt, trigger={"availableNow": True},
                state_partitions=STATE_PARTITIONS, sinks=outputs,
            )
            try:
                runner.await_or_stop(query)
                break
            except StreamingQueryException:
                if broken:  # another failure than the planted one
                    raise
    folders = runner.read_updates(spark, out, runner.update_schema(_metrics(_read_events(spark, src))))
    both = folders.withColumn("sink", F.lit("folders")).unionByName(
        spark.read.parquet(table_path).withColumn("sink", F.lit("appended"))
    )
    return _ntz_windows(both.withColumnRenamed("last_arrival", "chunk")).select("sink", "chunk", *ev.METRIC_COLUMNS)


@register(
    "stream_incremental_compaction",
    covers="T7 X9 T11 (a step after every chunk reads open windows and new batches only)",
    oracle=SLIDING_SQL + "SELECT * FROM metrics",
)
def q_stream_incremental_compaction(spark, sf_dir):
    base = scratch_path(spark, "metrics-compacted")

    def step(out, schema, journal):
        compaction.compact_step(spark, out, schema, base, last_watermark(spark, journal))

    out, schema = _run_stream_in_chunks(spark, sf_dir, after=step)
    return _ntz_windows(compaction.read_compacted(spark, out, schema, base)).select(*ev.METRIC_COLUMNS)


@register(
    "stream_processing_time",
    covers="T10 T2 T11 (processing-time trigger, a file per batch)",
    oracle=SLIDING_SQL + "SELECT * FROM metrics",
)
def q_stream_processing_time(spark, sf_dir):
    """All chunks wait in the topic folder; a query with a processing-time trigger takes one file after the other."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("event-records", "metrics-out", "metrics-ckpt"))
    chunked = _chunked_events(spark, sf_dir).select("chunk", _record_value())
    for k in range(CHUNKS):
        chunked.filter(F.col("chunk") == k).select("value").coalesce(1).write.text(f"{src}/chunk={k:04d}")
    raw = runner.read_record_files(spark, src, max_files_per_trigger=1).select("value", runner.arrival_number().alias("arrival"))
    metrics = _metrics(ev.parse_events(raw, STANDIN_SCHEMA, keep=["arrival"])[0])
    query = runner.start_metrics_query(
        metrics, out, ckpt, trigger={"processingTime": "100 milliseconds"}, state_partitions=STATE_PARTITIONS
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _ntz_windows(runner.compact_updates(spark, out, runner.update_schema(metrics))).select(*ev.METRIC_COLUMNS)


# Every fortieth event arrives two chunks after the others of its time.
_LATE_ARRIVAL = f"LEAST(chunk + CASE WHEN event_id % 40 = 0 THEN 2 ELSE 0 END, {CHUNKS - 1})"
_LATE_SQL = f"""
WITH bounds AS (SELECT MIN(ts) AS lo, MAX(ts) AS hi FROM events),
ev AS (
  SELECT e.*, CAST(LEAST(date_diff('microsecond', b.lo, e.ts)
                         // GREATEST(1, date_diff('microsecond', b.lo, b.hi) // {CHUNKS}), {CHUNKS - 1}) AS INTEGER)
           AS chunk
  FROM events e, bounds b),
arrived AS (SELECT * REPLACE ({_LATE_ARRIVAL} AS chunk) FROM ev),
marks AS (
  SELECT c AS chunk, (SELECT MAX(ts) FROM arrived WHERE arrived.chunk < c) - INTERVAL 2 HOUR AS watermark
  FROM unnest(range({CHUNKS})) t(c)),
placed AS (
  SELECT arrived.*, unnest([time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00'),
                            time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01 00:00:00') - INTERVAL 30 MINUTE])
           AS window_start, watermark
  FROM arrived JOIN marks USING (chunk)),
judged AS (SELECT *, coalesce(window_start + INTERVAL 1 HOUR <= watermark, FALSE) AS closed FROM placed)
"""


def _late_chunks(spark, sf_dir):
    return _chunked_events(spark, sf_dir).withColumn("chunk", F.expr(_LATE_ARRIVAL).cast("int"))


@register(
    "stream_late_rows",
    covers="T5 (late events with a side output)",
    oracle=_LATE_SQL
    + """
SELECT event_id, chunk AS arrival, CAST(COUNT(*) FILTER (closed) AS INTEGER) AS closed_windows,
       CAST(COUNT(*) FILTER (NOT closed) AS INTEGER) AS open_windows
FROM judged GROUP BY event_id, chunk HAVING COUNT(*) FILTER (closed) > 0""",
)
def q_stream_late_rows(spark, sf_dir):
    """Events that arrive after some of their windows were closed, kept with what they missed."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("event-records", "late-out", "late-ckpt"))
    chunked = _late_chunks(spark, sf_dir).select("chunk", _record_value())
    for k in range(CHUNKS):
        _deliver(chunked, src, k)
        events = _read_events(spark, src)
        runner.await_or_stop(late.start_late_router(events, out, ckpt, "timestamp", WATERMARK, SIZE, SLIDE, {"availableNow": True}))
    return late.read_late(spark, out).select("event_id", "arrival", "closed_windows", "open_windows")


@register(
    "stream_metrics_without_late",
    covers="T5 T2 T6 (windows closed by the watermark stay as they were)",
    oracle=_LATE_SQL
    + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type AS response_code, COUNT(*) AS request_count,
       CAST(((2 * CAST(SUM(CAST(value AS DECIMAL(12,2))) * 100 AS BIGINT) + 10 * COUNT(*))
             // (20 * COUNT(*))) * 0.1 AS DECIMAL(12,1)) AS avg_response_time_ms,
       (SELECT COUNT(*) FROM judged WHERE closed) > 0 AS some_dropped
FROM judged WHERE NOT closed GROUP BY window_start, event_type""",
)
def q_stream_metrics_without_late(spark, sf_dir):
    """The metrics of the same arrivals: Spark leaves late rows out of closed
    windows, and the journal says so."""
    journals = []
    out, schema = _run_stream_in_chunks(
        spark, sf_dir, chunked=_late_chunks(spark, sf_dir), after=lambda out, schema, journal: journals.append(journal)
    )
    dropped = read_journal(spark, journals[0]).agg(F.sum("dropped_by_watermark")).first()[0]
    latest = _ntz_windows(runner.compact_updates(spark, out, schema)).select(*ev.METRIC_COLUMNS)
    return latest.withColumn("some_dropped", F.lit(dropped > 0))


@register("synth_sales", covers="S14 G18 G20")
def q_synth_sales(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    )
    return synth_sales(ids)


@register("synth_events", covers="S15 G18 G19")
def q_synth_events(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts"))
    return synth_events(ids, "id", time_col="ts")
