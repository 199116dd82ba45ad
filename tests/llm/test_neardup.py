from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from mercato.llm import neardup
from mercato.llm.graph import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """component per row index, from all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    postings = defaultdict(list)
    for i, s in enumerate(sets):
        for h in s:
            postings[h].append(i)
    for i, s in enumerate(sets):
        for j in {j for h in s for j in postings[h] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    names = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        names[find(i)].append(d)
    least = {c: min((d for d in ds if d is not None), default=None) for c, ds in names.items()}
    return [least[find(i)] for i in range(len(rows))], [len(s) for s in sets]


def group_of_near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 9999)}"
        out.append(" ".join(words))
    return out


def check(spark, frame, rows):
    got = {}
    for r in neardup.near_duplicates(spark, frame(rows)).collect():
        got[r.doc_id] = (r.n_shingles, r.component_id, r.kept)
    want, sizes = brute(rows)
    assert got == {d: (n, c, c == d) for (d, _), c, n in zip(rows, want, sizes, strict=True)}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    texts = [" ".join(f"a{rng.randint(0, 3000)}" for _ in range(rng.randint(1, 150))) for _ in range(60)]
    texts += group_of_near_copies(rng, " ".join(f"b{i}" for i in range(120)), 70, 5)  # links, chains and near misses
    texts += ["SAME   words\nhere", "same words here", "same WORDS here"] * 3
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components_equal_brute_force(spark, frame, corpus):
    check(spark, frame, corpus)


def test_buckets_larger_than_a_block(spark, frame, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    check(spark, frame, corpus)


def test_estimate_is_unbiased_and_the_cut_safe():
    rng = np.random.default_rng(5)
    found = []
    for _ in range(300):
        a = rng.integers(0, 2**63, 400, dtype=np.uint64)
        b = np.concatenate([a[:368], rng.integers(0, 2**63, 32, dtype=np.uint64)])  # J = 368 / 432
        x, y = (neardup.low_bits(neardup.minima(np.unique(s))) for s in (a, b))
        found.append(int(neardup.agreements(x, y[None])[0]))
    assert abs(neardup.estimate(np.array(found)).mean() - 368 / 432) < 0.01
    assert min(found) >= neardup._AGREE


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    rows = neardup.near_duplicates(spark, edge_docs).collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == by_id[1] and all(by_id[d] == [(0, d, True)] for d in (1, 2, 3))
    assert by_id[5] == [(1, 5, True)] and by_id[6] == [(1, 5, False)] * 2
    assert by_id[None] == [(1, None, False)] and by_id[7] == [(1, 7, True)]
    assert neardup.near_duplicates(spark, empty_docs).count() == 0
    kept = neardup.keep_one(spark, clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, d) for d in (1, 2, 3, 5, 7, 8, 9)] + [(True, 0)]


def test_repeated_rows_leave_one(spark, frame):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (4, "A b c  d e f"), (9, "a b c d e f"), (4, "other words")]
    kept = neardup.keep_one(spark, frame(rows)).collect()
    assert sorted((r.doc_id, r.text.lower().split()[0]) for r in kept) == [(4, "a"), (4, "other")]


def test_graph_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in list(root)}


def test_stage_links_from_four_fifths(spark, frame):
    base = [f"w{i}" for i in range(100)]  # 96 shingles; k other last words leave 96 - k of them
    rows = [(k, " ".join(base[: 100 - k] + [f"x{k}_{i}" for i in range(k)])) for k in (0, 10, 12)]  # 86 / 106 and 84 / 108 with row 0
    assert all(r.kept for r in neardup.near_duplicates(spark, frame(rows)).collect())
    assert sorted(r.doc_id for r in neardup.keep_one(spark, frame(rows[:2])).collect()) == [0]
    assert sorted(r.doc_id for r in neardup.keep_one(spark, frame(rows[::2])).collect()) == [0, 12]
    assert neardup.Link(85).bands == 16 and (1 - 0.8**neardup.ROWS) ** neardup.Link(80).bands < neardup.MISS


def test_stage_equals_brute_force_on_a_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets, postings, links = {d: shingles(t) for d, t in rows}, defaultdict(list), []
    for d, s in sets.items():
        for h in s:
            postings[h].append(d)
    for d, s in sets.items():
        for o in {o for h in s for o in postings[h] if o < d}:
            both = len(s & sets[o])
            if 100 * both >= 80 * (len(s) + len(sets[o]) - both):
                links.append((o, d))
    root = {d: d for d in sets}
    for _ in range(len(links)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id for r in neardup.keep_one(spark, docs).collect()} == {d for d in sets if root[d] == d}
