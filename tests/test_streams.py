"""Journal, sinks with tokens, late events and incremental compaction."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mercato.session import scratch_path
from mercato.streaming import compaction, late, runner, sinks
from mercato.streaming import events as ev
from mercato.streaming.journal import BatchJournal, last_watermark, read_journal

T0 = dt.datetime(2026, 7, 30, 4, 0, tzinfo=dt.UTC)


def record(second, code=200, name="r"):
    time = (T0 + dt.timedelta(seconds=second)).isoformat()
    return f'{{"request_id": "{name}", "timestamp": "{time}", "response_code": {code}, "response_time_ms": 10}}'


def deliver(spark, src, k, lines):
    folder = f"{src}/chunk={k:04d}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)


def parsed(spark, src, **options):
    raw = runner.read_record_files(spark, src, **options).select("value", runner.arrival_number().alias("arrival"))
    return ev.parse_events(raw, keep=["arrival"])[0]


def test_more_batches_than_recent_progress_keeps(spark):
    """Every batch is in the journal and every update row knows its arrival, beyond a hundred batches."""
    src, out, ckpt, path = (scratch_path(spark, n) for n in ("src", "out", "ckpt", "journal"))
    n = 104
    os.makedirs(src.replace("file:", ""))
    for k in range(n):
        folder = f"{src}/chunk={k:04d}".replace("file:", "")
        os.makedirs(folder)
        with open(f"{folder}/part.txt", "w") as f:
            f.write(record(k, 200 + k % 2) + "\n")
        os.utime(f"{folder}/part.txt", (1_000_000 + k, 1_000_000 + k))
    metrics = runner.metrics_stream(parsed(spark, src, max_files_per_trigger=1), arrival_col="arrival")
    journal = BatchJournal(spark, path)
    query = runner.start_metrics_query(metrics, out, ckpt, trigger={"availableNow": True}, state_partitions=1)
    runner.await_or_stop(query, journal=journal)
    assert len(query.recentProgress) <= 100
    read = read_journal(spark, path).filter("input_rows > 0")
    assert read.agg(F.sum("input_rows"), F.count("*")).first() == (n, n)
    arrivals = {r.last_arrival for r in runner.read_updates(spark, out, runner.update_schema(metrics)).collect()}
    assert arrivals == set(range(n))


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


def test_a_batch_that_comes_again_reaches_only_unfinished_sinks(spark, capsys):
    table, folders, tokens = (scratch_path(spark, n) for n in ("table", "folders", "tokens"))
    calls = []

    def sometimes(df, batch_id):
        calls.append(batch_id)
        if len(calls) == 1:
            raise RuntimeError("away")

    outputs = [sinks.append_sink(table), sinks.console_sink(), sinks.folder_sink(folders, "parquet"), sinks.Sink("other", sometimes)]
    write = sinks.fan_out(outputs, tokens)
    with pytest.raises(RuntimeError):
        write(batch(spark, [("a", 1)]), 0)
    for _ in range(2):
        write(batch(spark, [("a", 1)]), 0)
    write(batch(spark, []), 1)
    write(batch(spark, [("b", 2)]), 2)
    want = [("a", 1, 0), ("b", 2, 2)]
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == want
    assert sorted((r.k, r.v, r.batch_id) for r in spark.read.parquet(folders).collect()) == want
    assert calls == [0, 0, 2]
    shown = capsys.readouterr().out
    assert shown.count("batch 0\n") == 1 and shown.count("batch 2\n") == 1
    assert sinks.Tokens(spark, tokens).last("other") == 2 and sinks.Tokens(spark, tokens).last("nobody") == -1


def test_missed_windows(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s),) for s in (0, 4, 5, 9)], "t timestamp")
    mark = int((T0 + dt.timedelta(seconds=10)).timestamp() * 1e6)
    got = [tuple(r) for r in df.select(*late.missed_windows(F.col("t"), F.lit(mark), "10 seconds", "5 seconds")).collect()]
    assert got == [(2, 0), (2, 0), (1, 1), (1, 1)]  # ends 5, 10 / 5, 10 / 10, 15 / 10, 15
    none = df.select(*late.missed_windows(F.col("t"), F.lit(None).cast("long"), "10 seconds", None)).distinct().collect()
    assert [tuple(r) for r in none] == [(0, 1)]


def test_late_rows_and_a_batch_that_comes_again(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("src", "late", "ckpt"))
    trigger = {"availableNow": True}
    for k, seconds in enumerate([[60], [29, 31, 19, 70], [200]]):
        deliver(spark, src, k, [record(s, name=f"s{s}") for s in seconds])
        runner.await_or_stop(late.start_late_router(parsed(spark, src), out, ckpt, trigger=trigger))
    rows = {r.request_id: (r.closed_windows, r.open_windows) for r in late.read_late(spark, out).collect()}
    assert rows == {"s29": (1, 1), "s19": (2, 0)}  # the watermark of the second batch is second 30
    os.remove(f"{ckpt}/commits/1".replace("file:", ""))  # the last two batches were not committed
    os.remove(f"{ckpt}/commits/2".replace("file:", ""))
    for name in os.listdir(f"{ckpt}/commits".replace("file:", "")):
        if name.startswith((".1.", ".2.")):
            os.remove(f"{ckpt}/commits/{name}".replace("file:", ""))
    runner.await_or_stop(late.start_late_router(parsed(spark, src), out, ckpt, trigger=trigger))
    again = {r.request_id: (r.closed_windows, r.open_windows) for r in late.read_late(spark, out).collect()}
    assert again == rows and late.read_late(spark, out).count() == 2


def test_compaction_reads_open_windows_and_new_batches(spark):
    src, out, ckpt, path, base = (scratch_path(spark, n) for n in ("src", "out", "ckpt", "journal", "compacted"))
    for k in range(4):
        deliver(spark, src, k, [record(100 * k + s, 200 + s % 2) for s in range(0, 90, 7)])
        metrics = runner.metrics_stream(parsed(spark, src), arrival_col="arrival")
        schema = runner.update_schema(metrics)
        journal = BatchJournal(spark, path)
        query = runner.start_metrics_query(metrics, out, ckpt, trigger={"availableNow": True}, state_partitions=2)
        runner.await_or_stop(query, journal=journal)
        if k != 2:  # the third chunk waits as a tail
            assert compaction.compact_step(spark, out, schema, base, last_watermark(spark, path)) is not None
            assert compaction.compact_step(spark, out, schema, base, None) is None  # nothing new
        key = lambda df: sorted(map(tuple, df.select(*schema.fieldNames()).collect()))
        assert key(compaction.read_compacted(spark, out, schema, base)) == key(runner.compact_updates(spark, out, schema))
    steps = compaction._numbered(spark, base, "upto")
    open_rows = [spark.read.parquet(f"{base}/upto={s}").filter("state = 'open'").count() for s in steps]
    closed_rows = [spark.read.parquet(f"{base}/upto={s}").filter("state = 'closed'").count() for s in steps]
    assert len(steps) == 3 and max(open_rows) < sum(closed_rows) / 2  # a step reads the open rows of one step only
