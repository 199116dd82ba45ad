from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import ranked

SF = "/root/testdata/sf0.001"


def brute(docs, items, top=ranked.TOP):
    vectors = [(d, Counter(ranked.terms_of(t))) for d, t in docs]
    vectors = [(d, c, sum(c.values())) for d, c in vectors if c]
    n_docs, length = len(vectors), sum(n for _, _, n in vectors)
    df = Counter(t for _, c, _ in vectors for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in vectors:
            m, score = 50 + (50 * n * n_docs) // length, 0
            for t in set(ranked.terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort(key=lambda x: x[:3])
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(found[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ranked.rank(spark, docs, items)) == want


def test_small_runs_blocks_and_item_blocks(spark, monkeypatch):
    """Many runs, blocks and passes give the same rows as one of each."""
    for name, value in {"RUN_DOCS": 40, "RUN_POSTINGS": 3000, "BLOCK": 4, "LEAST": 2, "ITEMS": 3, "TERMS": 60}.items():
        monkeypatch.setattr(ranked, name, value)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = items.filter("item_id < 5")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 7)
    assert rows(ranked.rank(spark, docs, items, 7)) == want


def test_edges_ties_and_repeats(spark, edge_docs, empty_docs, clashing_docs):
    items = [(1, "one word"), (1, "one word"), (None, "END word éß"), (3, None), (4, ""), (5, "nothing here"), (6, "x" * 200_000), (7, " ".join(f"t{i}" for i in range(30_000)) + " word")]
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = brute(docs, items)
    assert want and rows(ranked.rank(spark, edge_docs, items_frame(spark, items))) == want
    assert rows(ranked.rank(spark, clashing_docs, items_frame(spark, items).withColumn("rank", F.lit(1)).withColumn("score", F.lit("x")))) == want
    assert ranked.rank(spark, empty_docs, items_frame(spark, items)).count() == 0
    assert ranked.rank(spark, edge_docs, items_frame(spark, [])).count() == 0


def test_copies_of_a_third(spark, frame):
    docs = [(i, "the same hot text of all" if i % 3 == 0 else f"text {i} of w{i % 7}") for i in range(600)]
    items = [(0, "the same hot text"), (1, "w3 of text 17")]
    assert rows(ranked.rank(spark, frame(docs), items_frame(spark, items))) == brute(docs, items)


@pytest.mark.parametrize("seed", range(4))
def test_summaries_bound_scores_and_blocks_are_skipped(seed, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK", 8)
    monkeypatch.setattr(ranked, "LEAST", 8)
    rng = np.random.default_rng(seed)
    # two kinds of documents, sorted by kind as the signatures do it
    sizes = rng.integers(1, 12, 400)
    terms = [np.sort(rng.choice(np.arange(20) + 20 * (d >= 200), s, replace=False)) for d, s in enumerate(sizes)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    gains = rng.integers(1, 10**6, first[-1]).astype(np.int32)
    items = ranked.Items([0, 1, 2], np.arange(40, dtype=np.uint64), [np.array([1, 5, 25]), np.array([3, 22, 30, 31]), np.arange(40)], rng.integers(1, 5000, 40))
    coordinates = ranked.Coordinates(items)
    import pyarrow as pa

    arrays = ranked.build_run(first, np.concatenate(terms), gains, coordinates, 40)
    data = ranked.packed([pa.array(np.arange(400)), *(pa.array(np.asarray(a).astype(np.int64 if n == "summary_first" else np.int32)) for n, a in zip(ranked.RUN[1:], arrays, strict=True))])
    run = ranked.Run(data, items, coordinates)
    skipped = 0
    for wanted in items.terms[:2]:
        exact = run.scores(np.arange(400), wanted)
        naive = [sum(int(items.weights[t]) * int(g) for t, g in zip(terms[d], gains[first[d] : first[d + 1]], strict=True) if t in wanted) for d in range(400)]
        assert exact.tolist() == naive
        for k in run.lists(wanted):
            for b, bound in enumerate(run.bounds(k, wanted)):
                assert bound >= exact[run.block(k, b)].max()
        least = int(np.sort(exact)[-20])
        found = run.candidates(wanted, least)
        assert set(np.flatnonzero(exact >= least)) <= set(found.tolist())
        skipped += int((exact > 0).sum()) - len(found)
    assert skipped > 40
