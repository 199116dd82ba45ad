"""Event parsing, windows, watermark and replay (FIXTURES.md §4 events)."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir
from mercato.streaming import events as ev
from mercato.streaming import runner
from mercato.streaming.journal import BatchJournal, read_journal

UTC = dt.timezone.utc


def rec(ts: str | None, code=200, ms=100, rid="r"):
    return json.dumps(
        {"request_id": rid, "timestamp": ts, "publisher_id": "publisher_1", "ad_id": "ad_1",
         "user_id": "user_1", "response_code": code, "response_time_ms": ms}
    )


def test_parse_routes_bad_records(spark):
    raw = spark.createDataFrame(
        [(rec("2026-07-30T04:08:15.123456+00:00").encode(),), (b"{not json",), (rec(None).encode(),)],
        "value binary",
    )
    events, bad = ev.parse_events(raw)
    assert events.count() == 1
    assert bad.count() == 2
    first = events.first()
    assert first["timestamp"].astimezone(UTC).replace(tzinfo=None) == dt.datetime(2026, 7, 30, 4, 8, 15, 123456) or \
        first["timestamp"] == dt.datetime(2026, 7, 30, 4, 8, 15, 123456)


def test_window_edges(spark):
    # an event exactly on 04:08:15 belongs to [04:08:10,04:08:20) and [04:08:15,04:08:25)
    df = spark.createDataFrame([(dt.datetime(2026, 7, 30, 4, 8, 15), 200, 100)], "ts timestamp_ntz, code int, ms int")
    m = ev.windowed_metrics(df, "ts", "code", "ms", "10 seconds", "5 seconds")
    starts = sorted(r["window_start"] for r in m.collect())
    assert starts == [dt.datetime(2026, 7, 30, 4, 8, 10), dt.datetime(2026, 7, 30, 4, 8, 15)]
    t = ev.windowed_metrics(df, "ts", "code", "ms", "10 seconds", None)
    assert [r["window_start"] for r in t.collect()] == [dt.datetime(2026, 7, 30, 4, 8, 10)]


def test_share_and_rate(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 1, 1, 0, 0, 1), 200, 10), (dt.datetime(2026, 1, 1, 0, 0, 2), 200, 20),
         (dt.datetime(2026, 1, 1, 0, 0, 3), 500, 1000)],
        "ts timestamp_ntz, code int, ms int",
    )
    m = ev.windowed_metrics(df, "ts", "code", "ms", "10 seconds", None)
    share = {r["response_code"]: float(r["share_pct"]) for r in ev.code_share(m).collect()}
    assert share == {200: 66.67, 500: 33.33}
    rpm = {r["response_code"]: float(r["requests_per_minute"]) for r in ev.requests_per_minute(m).collect()}
    assert rpm == {200: 12.0, 500: 6.0}
    avg = {r["response_code"]: float(r["avg_response_time_ms"]) for r in m.collect()}
    assert avg == {200: 15.0, 500: 1000.0}


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([("publisher_3", 7, dt.datetime(2026, 1, 1, 0, 0, 0, 123456))], "p string, n int, ts timestamp_ntz")
    back = ev.decode_records(ev.encode_records(df, "p"), "p string, n int, ts timestamp_ntz").first()
    assert back["key"] == "publisher_3" and back["n"] == 7 and back["ts"] == dt.datetime(2026, 1, 1, 0, 0, 0, 123456)


PROGRESS: list = []


def _stream_run(spark, chunks, watermark="30 seconds"):
    base = ensure_checkpoint_dir(spark)
    src, out, ckpt = (f"{base}/{n}-{uuid.uuid4().hex}" for n in ("src", "out", "ckpt"))
    schema = None
    PROGRESS.clear()
    for k, lines in enumerate(chunks):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/chunk={k:04d}")
        raw = spark.readStream.format("text").option("recursiveFileLookup", "true").load(src)
        events, _ = ev.parse_events(raw)
        metrics = runner.metrics_stream(events, watermark=watermark)
        schema = runner.update_schema(metrics)
        journal = BatchJournal(spark, f"{ckpt}_journal")
        q = runner.start_metrics_query(metrics, out, ckpt, trigger={"availableNow": True})
        runner.await_or_stop(q, journal=journal)
    PROGRESS.extend(r.asDict() for r in read_journal(spark, f"{ckpt}_journal").collect())
    return out, ckpt, schema


def test_late_rows_dropped_by_watermark(spark):
    """Spark applies the watermark per window: after chunk 1 the watermark is
    04:09:00 - 30 s = 04:08:30, so windows ending at or before 04:08:30 are
    closed. A row 29 s behind the max (04:08:31) lands only in open windows;
    a row 31 s behind (04:08:29) is dropped from [04:08:20, 04:08:30) and
    still counted in the open [04:08:25, 04:08:35); a row 41 s behind has
    no open window left and vanishes. Batch over the same rows counts all."""
    chunk1 = [rec("2026-07-30T04:08:00+00:00"), rec("2026-07-30T04:09:00+00:00")]
    chunk2 = [
        rec("2026-07-30T04:08:31+00:00", code=404),
        rec("2026-07-30T04:08:29+00:00", code=503),
        rec("2026-07-30T04:08:19+00:00", code=500),
    ]
    out, _, schema = _stream_run(spark, [chunk1, chunk2])
    latest = runner.compact_updates(spark, out, schema)
    got = {(r["response_code"], r["window_start"].astimezone(UTC).strftime("%H:%M:%S")) for r in latest.collect()}
    assert (404, "04:08:25") in got and (404, "04:08:30") in got
    assert (503, "04:08:25") in got and (503, "04:08:20") not in got
    assert not any(code == 500 for code, _ in got)
    assert sum(p["dropped_by_watermark"] for p in PROGRESS) > 0  # the drop is visible in progress
    batch = ev.windowed_metrics(
        ev.parse_events(spark.createDataFrame([(x,) for x in chunk1 + chunk2], "value string"))[0]
    )
    codes = [r["response_code"] for r in batch.collect()]
    assert codes.count(503) == 2 and codes.count(500) == 2


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    lines = [rec(f"2026-07-30T04:{m:02d}:{s:02d}+00:00", code=200 if s % 3 else 500, ms=10 * s)
             for m in range(8, 12) for s in range(0, 60, 7)]
    chunks = [lines[i::1][j: j + 10] for j, i in ((0, 0), (10, 0), (20, 0), (30, 0))]
    out, _, schema = _stream_run(spark, chunks, watermark="5 minutes")
    latest = runner.compact_updates(spark, out, schema).drop("batch_id")
    batch = ev.windowed_metrics(ev.parse_events(spark.createDataFrame([(x,) for x in lines], "value string"))[0])
    key = ["window_start", "window_end", "response_code"]
    a = sorted(tuple(r) for r in latest.select(*key, "request_count", "avg_response_time_ms").collect())
    b = sorted(tuple(r) for r in batch.select(*key, "request_count", "avg_response_time_ms").collect())
    assert a == b
    # replaying a batch rewrites its batch_id folder in place: no duplicate rows
    updates = runner.read_updates(spark, out, schema)
    before = updates.count()
    first_id = updates.agg(F.min("batch_id")).first()[0]
    replay = updates.filter(F.col("batch_id") == first_id).drop("batch_id")
    replay = spark.createDataFrame(replay.collect(), replay.schema)  # the batch as re-delivered
    runner.batch_writer(out)(replay, first_id)
    assert runner.read_updates(spark, out, schema).count() == before


def test_batch_writer_fans_out_and_skips_empty(spark):
    """One persisted batch goes to every sink (T13); an empty batch writes
    nothing (F8); the batch id tags the rows (P3)."""
    base = ensure_checkpoint_dir(spark)
    out = f"{base}/fanout-{uuid.uuid4().hex}"
    seen = []
    write = runner.batch_writer(out, fmt="parquet", extra=lambda df, bid: seen.append((bid, df.count())))
    rows = spark.createDataFrame([(dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1, 0, 0, 10), 200, 3, 12.5)],
                                 "window_start timestamp, window_end timestamp, response_code int, "
                                 "request_count long, avg_response_time_ms double")
    write(rows, 7)
    write(rows.limit(0), 8)
    assert seen == [(7, 1)]
    back = spark.read.parquet(out)
    assert back.count() == 1 and back.first()["batch_id"] == 7


from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    slide=st.sampled_from([5, 10, 60]),
    k=st.integers(1, 3),
    events=st.lists(st.tuples(st.integers(0, 400), st.sampled_from([200, 500]), st.integers(1, 999)), min_size=1, max_size=40),
)
def test_windows_match_brute_force(spark, slide, k, events):
    """Sliding windows of any size = k x slide against a brute-force
    assignment: every window [start, start + size) with start a multiple of
    the slide that contains the event."""
    base = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [(base + dt.timedelta(seconds=t), c, Decimal(ms).scaleb(-1)) for t, c, ms in events],
        "ts timestamp_ntz, code int, ms decimal(12,1)",
    )
    size = k * slide
    got = {
        (r["window_start"], r["response_code"]): (r["request_count"], r["avg_response_time_ms"])
        for r in ev.windowed_metrics(df, "ts", "code", "ms", f"{size} seconds", f"{slide} seconds").collect()
    }
    groups: dict = {}
    for t, c, ms in events:
        first = (t // slide) * slide - (k - 1) * slide
        for start in range(first, t + 1, slide):
            if start <= t < start + size:
                groups.setdefault((base + dt.timedelta(seconds=start), c), []).append(Decimal(ms).scaleb(-1))
    want = {
        g: (len(v), (sum(v) / len(v)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)) for g, v in groups.items()
    }
    assert got == want
