from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mercato.llm import sharding


def check(rows, docs, tolerance):
    sizes, places = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "bytes" and 0 <= r.shard < 24 and r.grown_shard is None for r in rows)
    if tolerance:
        assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= tolerance * sum(sizes.values()) / 24


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_whole_table_is_balanced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(sharding.assign(spark, docs).collect(), pairs(docs), 0.02)


def test_a_third_of_the_rows_are_one_record(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.withColumn("text", F.expr("if(doc_id % 3 = 0, 'the same short text', text)")).withColumn("doc_id", F.expr("if(doc_id % 3 = 0, 7, doc_id)"))
    check(sharding.assign(spark, hot).collect(), pairs(hot), 0.02)


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    check(sharding.assign(spark, edge_docs).collect(), pairs(edge_docs), None)
    assert sharding.assign(spark, empty_docs).count() == 0
    assert sharding.assign(spark, clashing_docs).count() == 10


def shards_of(df):
    return {(r.doc_id, r.text_crc32): r.shard for r in df.collect()}


def loads(df):
    return {r.shard: r.b for r in df.groupBy("shard").agg(F.sum("size").alias("b")).collect()}


def versions(spark, path):
    out = {}
    for r in spark.read.parquet(path).collect():
        out.setdefault(r.map_version, {})[r.virtual_slot, r.part] = r.shard
    return out


def test_a_stored_map_is_loaded_and_edited(spark):
    from mercato.session import scratch_path

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = scratch_path(spark, "kept_map")
    first = sharding.assign(spark, docs, map_path=path).cache()
    again = sharding.assign(spark, docs.repartition(5), map_path=path)
    assert shards_of(again) == shards_of(first) and set(versions(spark, path)) == {1, 2}  # nothing to edit
    more = docs.filter("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 10_000)
    grown = sharding.assign(spark, docs.unionByName(more), map_path=path).cache()
    maps = versions(spark, path)
    assert set(maps) == {1, 2, 3}
    edited = {u for u in maps[3] if maps[3][u] != maps[2].get(u)}
    assert 0 < len(edited) < len(maps[2]) / 4  # edits, not a new deal
    before, slots = shards_of(first), {r.doc_id: r.virtual_slot for r in grown.collect()}
    moved = {d for (d, c), shard in shards_of(grown).items() if (d, c) in before and before[d, c] != shard}
    assert moved and {slots[d] for d in moved} <= {s for s, _ in edited}
    by_shard = loads(grown)
    assert max(by_shard.values()) - min(by_shard.values()) <= 0.02 * sum(by_shard.values()) / 24
    wider = sharding.assign(spark, docs.unionByName(more), shards=30, map_path=path)
    narrow = shards_of(grown)
    stayed = [narrow[k] == s for k, s in shards_of(wider).items()]
    assert len(loads(wider)) == 30 and sum(stayed) > 0.7 * len(stayed)


def test_places_do_not_follow_the_splits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hot = docs.withColumn("text", F.expr("if(doc_id % 3 = 0, 'the same short text', text)")).withColumn("doc_id", F.expr("if(doc_id % 3 = 0, 7, doc_id)"))
    count = lambda df: {tuple(r) for r in df.groupBy("doc_id", "text_crc32", "shard").count().collect()}
    assert count(sharding.assign(spark, hot)) == count(sharding.assign(spark, hot.repartition(3)))


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_rebalancing_edits_the_map(shards):
    sizes = {(i, -1): (i * 37 % 101) ** 2 + 1 for i in range(500)}
    one = sharding.first_map(list(sizes), shards)
    two = sharding.rebalanced(one, sizes, shards)
    load = [sum(sizes[u] for u, s in two.items() if s == k) for k in range(shards)]
    assert set(two) == set(one) and max(load) - min(load) <= 0.01 * sum(load) / shards + 50
    assert sharding.rebalanced(two, sizes, shards) == two  # nothing is left to move
