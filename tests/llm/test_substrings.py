from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import substrings


def brute(rows, size):
    """(n_words, n_removed, sha) per row index."""
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words, strict=True):
        if d is not None:
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def check(spark, frame, rows, size=50):
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicate(spark, frame(rows), size).collect())
    assert got == sorted((str(d), *b) for (d, _), b in zip(rows, brute(rows, size), strict=True))
    return sum(g[2] for g in got)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for d in range(80):
        words = [f"x{rng.randint(0, 400)}" for _ in range(rng.randint(0, 160))]
        at = rng.randint(0, len(words))
        cut = rng.randint(0, 20)
        rows.append((d, " ".join(words[:at] + passage[cut : cut + rng.randint(30, 70)] + words[at:])))
    rows += [(100 + i, rows[i][1] + ("" if i % 2 else " tail")) for i in range(20)]  # copies and longer copies
    rows.append((200, " ".join(["loop"] * 300)))
    rows.append((201, " ".join(["loop"] * 120)))
    return rows


def test_equals_brute_force(spark, frame, corpus):
    assert check(spark, frame, corpus) > 1000


def test_large_shards_by_window(spark, frame, corpus, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_SEGMENTS", 1)
    check(spark, frame, corpus)


def test_edges(spark, frame, edge_docs, empty_docs, clashing_docs):
    from tests.llm.conftest import EDGES

    check(spark, frame, EDGES)
    assert substrings.deduplicate(spark, empty_docs).count() == 0
    assert substrings.deduplicate(spark, clashing_docs).count() == len(EDGES)


def test_rows_that_share_an_id(spark, frame):
    a, b = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    check(spark, frame, [(5, a), (5, a), (5, b), (7, b + " " + a), (None, a), (2, b)])


def test_kept_text(spark, frame):
    a = " ".join(f"w{i}" for i in range(60))
    out = {r.doc_id: r.kept for r in substrings.deduplicate(spark, frame([(1, a), (2, f"x\n{a}  y")]), keep_text=True).collect()}
    assert out == {1: a, 2: "x y"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12))
def test_matching_statistics(texts, query):
    sam = substrings.SuffixAutomaton()
    for t in texts:
        sam.add(t)
    inside = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    want = [max((n for n in range(e + 2) if n == 0 or tuple(query[e + 1 - n : e + 1]) in inside), default=0) for e in range(len(query))]
    assert sam.statistics(query) == want
