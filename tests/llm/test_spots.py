from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mercato.llm import spots


def fingerprint(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    chains = set()
    for i, w in enumerate(words):
        if w in spots.ANCHORS:
            content = [x for x in words[i + 1 : i + 1 + spots.SPAN] if x not in spots.COMMON][: spots.CHAIN]
            if content:
                chains.add(" ".join([w, *content]))
    if not chains and words:
        chains = {" ".join(words)}
    return sorted(hashlib.md5(c.encode()).hexdigest()[:16] for c in chains)


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def brute(docs):
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        f, e = fingerprint(t), fingerprint(edited)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), " ".join(f), " ".join(e), jaccard(f, e), jaccard(f, fingerprint(after))))
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, spots.edited_fingerprints(docs).collect()), key=str)


def test_edges(spark, frame, empty_docs, edge_docs, clashing_docs):
    rows = [(1, None), (2, ""), (3, "  \n\t "), (None, "a text without an id"), (5, "one"), (6, "the quick brown fox of the hill"), (-4, "the " * 9_000 + "end"), (8, "x" * 200_000), (9, "éß 😀 the ünï \x0b\x0c end")]
    assert found(frame(rows)) == brute(rows)
    assert found(empty_docs) == []
    assert found(frame([(7, "the only one")])) == brute([(7, "the only one")])
    assert spots.edited_fingerprints(edge_docs).count() == spots.edited_fingerprints(clashing_docs).count() == 10
    same = {r.fingerprint for r in spots.edited_fingerprints(edge_docs.filter("text = 'one'")).collect()}
    assert len(same) == 1


@pytest.mark.parametrize("bucket", [7, 1000])
def test_successors_over_bucket_borders(spark, frame, monkeypatch, bucket):
    monkeypatch.setattr(spots, "BUCKET", bucket)
    rows = [((i * 37) % 101 * 1000 - 5000, f"the text {i} of {'many ' * (i % 5)} words") for i in range(101)] + [(None, "last of the rows")]
    assert found(frame(rows)) == brute(rows)


def test_likeness_is_pruned_by_length_only_where_it_cannot_reach(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "b", "c"]), (["a"], ["a", "b", "c"]), ([], [])], "x array<string>, y array<string>")
    got = [tuple(r) for r in df.select(spots.likeness(F.col("x"), F.col("y")), spots.likeness(F.col("x"), F.col("y"), 0.5)).collect()]
    assert got == [(2 / 3, 2 / 3), (1 / 3, 0.0), (1.0, 1.0)]


@pytest.mark.parametrize("at_least", [0.5, 0.8])
def test_near_against_all_pairs(spark, at_least):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("text", F.concat(F.expr("substring(text, 1, cast(0.9 * length(text) as int))"), F.lit(" the new end"))).withColumn("doc_id", F.col("doc_id") + 1000)
    docs = docs.unionByName(changed).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 2000))
    members = {}
    for r in spots.members(spots.text_rows(docs)).collect():
        members.setdefault(r["class"], (set(r.spots), []))[1].append(r.doc_id)
    want = set()
    for q, (a, ids) in members.items():
        if any(i % 20 == 0 for i in ids):
            want |= {(q, c) for c, (b, _) in members.items() if len(a & b) >= at_least * len(a | b) - 1e-12}
    got = [(r.query_class, r["class"]) for r in spots.near(spark, docs, F.col("doc_id") % 20 == 0, at_least).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 30
    assert any(len(ids) > 1 for _, ids in members.values())


def test_no_python_in_the_plan(spark, frame):
    plan = spots.edited_fingerprints(frame([(1, "the one")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
