from __future__ import annotations

import hashlib
import re

import pytest

from mercato.llm import secret_scan

HARD = [
    (10, 'é PassWord: "abcdefgh" tOKen=short AKIA1234567890AB ' + "a" * 40 + " 0123456789abcdef0123456789ABCDEF api_key==abcdefgh"),
    (11, " token=abcdefghi  ghp_" + "a" * 36 + " https://bob:secret1@host -----BEGIN RSA PRIVATE KEY----- 😀 passwd : aaaaaaaaaa"),
    (12, "secret=abcdefghij secret=abcdefghij"),
    (13, "xoxb-1234567890ab eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh1 Bearer " + "z" * 30 + " AIza" + "b" * 35),
    (14, "ab" * 60_000),
]


def brute(text):
    out = []
    for order, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern if rule.kind != "hex" else "[0-9a-f]+", text):
            if len(m.group(rule.group)) >= rule.min_chars:
                out.append((m.start(), order, m.end(), rule.kind))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def check(spark, docs):
    texts = {(r.doc_id): r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows, total = secret_scan.scan(spark, docs).collect(), 0
    for r in rows:
        want = brute(texts[r.doc_id])
        base = [s for s in want if s[3] in secret_scan.BASE_KINDS]
        total += len(want)
        assert r.spans == joined(want)
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == k for s in base) for k in secret_scan.BASE_KINDS]
    return rows, total


def test_whole_table(spark):
    assert check(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))[1] > 10


def test_hard_texts(spark, frame):
    rows, _ = check(spark, frame(HARD))
    kinds = {s.split(":")[0] for r in rows for s in r.spans.split(",")}
    assert kinds == {r.kind for r in secret_scan.RULES}


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_queries_are_necessary(rule):
    """Every match holds all trigrams of one of the rule's alternatives."""
    query = secret_scan.QUERIES.get(rule.kind)
    for _, text in HARD:
        for m in re.finditer(rule.pattern, text):
            grams = secret_scan.trigrams(m.group().lower())
            assert query is None or all(any(s <= grams for s in clause) for clause in query)


def test_trigram_queries():
    def q(pattern):
        found = secret_scan.trigram_query(pattern)
        return found and {frozenset(frozenset(x) for x in clause) for clause in found}

    def clause(*sets):
        return frozenset(frozenset(s.split()) for s in sets)

    assert q("abcd") == {clause("abc bcd")}
    assert q("(abc|xyz)[0-9]+") == {clause("abc", "xyz")}
    assert q("ab?cd") == {clause("abc bcd", "acd")}
    assert q("abc[0-9]+xyz") == {clause("abc"), clause("xyz")}  # both runs are asked for
    assert q("[0-9a-f]+") is None and q("a[0-9]b") is None


def test_candidates_hold_every_run(spark, frame):
    docs = frame([(1, "-----BEGIN RSA PRIVATE KEY-----"), (2, "private key----- only"), (3, "-----begin and nothing"), (4, "secret=abcdefgh")])
    found = secret_scan.candidates(spark, secret_scan.postings(spark, docs)).collect()
    assert {r.doc_id: sorted(r.rules) for r in found} == {1: ["private_key"], 4: ["assign"]}


def test_native(spark):
    plan = secret_scan.scan(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    assert [r.spans for r in secret_scan.scan(spark, edge_docs).collect()] == [""] * 10
    assert secret_scan.scan(spark, empty_docs).count() == 0
    assert secret_scan.scan(spark, clashing_docs).count() == 10
