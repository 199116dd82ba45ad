"""Loads that touch some partitions (K6) and keys that last over loads."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from mercato.operators import merge, warehouse
from mercato.operators.keys import lasting_keys
from mercato.session import scratch_path


def stamp(day):
    return F.lit(f"2025-01-0{day + 1} 00:00:00").cast("timestamp_ntz")


def rows(spark, items, day=0):
    df = spark.createDataFrame([(k, v, v * 10) for k, v in items], "k long, fixed long, revenue long")
    return df.withColumn("loaded_at", stamp(day))


def content(df):
    return {r.k: (r.fixed, r.revenue, r.loaded_at.day) for r in df.collect()}


def files(base):
    root = base.replace("file:", "") + "/rows"
    return {(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def load(spark, base, items, day, buckets=16):
    return merge.merge_table(spark, base, rows(spark, items, day), ["k"], ["revenue"], stamp(day), buckets=buckets)


def test_untouched_partitions_keep_their_files(spark):
    base = scratch_path(spark, "merge-test")
    load(spark, base, [(i, 1) for i in range(500)], 0)
    before = files(base)
    touched = load(spark, base, [(3, 7), (900, 8)], 1, buckets=99)  # the stored number of partitions counts
    assert 1 <= len(touched) <= 2
    changed = {d for d, _ in before ^ files(base)}
    assert changed == {f"{base.replace('file:', '')}/rows/bucket_of_16={b}" for b in touched}
    want = {i: (1, 10, 1) for i in range(500)} | {3: (1, 70, 2), 900: (8, 80, 2)}
    assert content(merge.read_merged(spark, base)) == want


def test_bad_keys_and_empty_loads_change_nothing(spark):
    base = scratch_path(spark, "merge-test")
    assert merge.read_merged(spark, base) is None
    with pytest.raises(ValueError, match="1 repeated"):
        load(spark, base, [(1, 1), (1, 2)], 0)
    assert merge.read_merged(spark, base) is None
    load(spark, base, [(1, 1)], 0)
    before = files(base)
    for bad in ([(None, 1)], [(2, 1), (2, 2)]):
        with pytest.raises(ValueError):
            load(spark, base, bad, 1)
    assert load(spark, base, [], 1) == [] and files(base) == before


def test_a_load_that_died_is_finished_or_dropped(spark, monkeypatch):
    base = scratch_path(spark, "merge-test")
    load(spark, base, [(i, 1) for i in range(50)], 0)
    monkeypatch.setattr(merge, "_swap", lambda *a: None)  # dies before the partitions are swapped
    load(spark, base, [(5, 2)], 1)
    monkeypatch.undo()
    assert content(merge.read_merged(spark, base))[5] == (1, 20, 2)
    monkeypatch.setattr(merge, "_swap", lambda *a: None)
    load(spark, base, [(6, 3)], 2)
    monkeypatch.undo()
    os.remove(f"{base.replace('file:', '')}/_pending/_SUCCESS")  # dies while the copy is written
    got = content(merge.read_merged(spark, base))
    assert got[6] == (1, 10, 1) and got[5] == (1, 20, 2)
    assert not os.path.exists(f"{base.replace('file:', '')}/_pending")


def test_loads_equal_a_dict(spark):
    base, want = scratch_path(spark, "merge-test"), {}
    for day in range(4):
        items = [(k, day) for k in range(day * 7, 60, day + 1)]
        load(spark, base, items, day, buckets=8)
        for k, v in items:
            want[k] = (want[k][0] if k in want else v, v * 10, day + 1)
    assert content(merge.read_merged(spark, base)) == want


def test_old_ids_stay(spark):
    path = scratch_path(spark, "keys-test")
    names = lambda *v: spark.createDataFrame([(x,) for x in v], "name string")
    ids = lambda df: {r["name"]: r["id"] for r in df.collect()}
    assert ids(lasting_keys(spark, path, names("m", "z", None, "m"))) == {"m": 1, "z": 2}
    assert ids(lasting_keys(spark, path, names("a", "m", "q"))) == {"m": 1, "z": 2, "a": 3, "q": 4}
    assert ids(lasting_keys(spark, path, names("a", "q"))) == {"m": 1, "z": 2, "a": 3, "q": 4}
    assert ids(lasting_keys(spark, path, names())) == {"m": 1, "z": 2, "a": 3, "q": 4}


def test_groups_are_numbered_on_their_own(spark):
    path = scratch_path(spark, "keys-test")
    make = lambda rows: spark.createDataFrame(rows, "g string, name string")
    lasting_keys(spark, path, make([("x", "b"), ("y", "b")]), group_by=["g"])
    got = lasting_keys(spark, path, make([("x", "a"), ("x", "c"), ("z", "a"), ("y", "b")]), group_by=["g"])
    assert {(r.g, r.name): r.id for r in got.collect()} == {("x", "b"): 1, ("y", "b"): 1, ("x", "a"): 2, ("x", "c"): 3, ("z", "a"): 1}


def test_only_the_asked_tables_are_built(spark, monkeypatch):
    from mercato.plans.catalog_warehouse import staging

    flat = staging(spark, "/root/testdata/sf0.001")
    built = []
    monkeypatch.setattr(warehouse.Warehouse, "_keep", lambda self, df, name: built.append(name) or df)
    wh = warehouse.build_warehouse(flat, persist_to="x")
    assert wh.dim_region.count() == 5 and built == ["staging", "lookups"]
    with pytest.raises(ValueError):
        warehouse.build_warehouse(flat, region_of="nobody")
