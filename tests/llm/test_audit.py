from __future__ import annotations

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from mercato.llm import audit


def fails(docs):
    """Per row the set of failed filters, from the definitions."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, _ in docs:
        t = t or ""
        words = [w for w in t.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        out = {"A"} if len(words) < 100 else set()
        out |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        out |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else set()
        out |= {"D"} if set(t) & set("#$%&*|") else set()
        out |= {"E"} if d is not None and d > least[t] else set()
        yield out


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    rows = [(p or "", f, d in good, d in toxic) for (d, _, p), f in zip(docs, fails(docs), strict=True)]
    out, removed = [], Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                failing = [r for r in own if x in r[1]]
                removed[part, x] += len(gone)
                out.append([part, order, step, len(left), len(gone), len(failing) - len(gone), sum(r[1] == {x} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return sorted((*r, removed[r[0], r[1][r[2] - 1]]) for r in out)


def found(docs, labels):
    return sorted(map(tuple, audit.audit(audit.masks(docs, labels)).collect()))


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    labels = [(1, 1, 0), (5, None, 1), (5, 1, None), (6, 0, 1), (None, 1, 1), (99, 1, 1), (7, 1, 1)]
    docs = edge_docs.withColumn("lang", F.expr("case when doc_id % 3 = 0 then null when doc_id = 5 then '' else lang end"))
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], labels)
    assert found(docs, labels_frame(spark, labels)) == want
    extra = clashing_docs.withColumn("lang", F.expr("case when doc_id % 3 = 0 then null when doc_id = 5 then '' else lang end"))
    extra = extra.withColumns({c: F.lit(9) for c in ("mask", "k1", "part", "good", "toxic", "n")})
    assert found(extra, labels_frame(spark, labels).withColumn("n", F.lit(3))) == want
    assert found(empty_docs, labels_frame(spark, labels)) == []
    assert found(docs, labels_frame(spark, [])) == brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], [])


def test_copies_with_other_labels_and_parts(spark):
    words = " ".join(f"w{i}" for i in range(120))
    texts = [words, words + " |", words.upper(), "a b", words]
    docs = [(i // 2 if i % 11 == 0 else i, texts[i % 5], ["en", "de", None][i % 3]) for i in range(300)]
    labels = [(i, i % 2, i % 3 // 2) for i in range(0, 300, 4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert found(frame, labels_frame(spark, labels)) == brute(docs, labels)


@pytest.mark.parametrize("letters", ["XYZ", "PQ"])
def test_any_number_of_filters(spark, letters):
    k = len(letters)
    counts = [("p", m, 3 * m + 1, m, m // 2) for m in range(2**k)]
    got = audit.audit(spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long"), letters).collect()
    total = sum(c[2] for c in counts)
    orders = len(list(permutations(letters)))
    assert len(got) == orders * k
    first = {r.filter_order[r.step - 1]: r.shapley for r in got}
    assert sum(first.values()) == orders * (total - 1)  # all but the record that fails nothing
    for x in letters:
        assert first[x] == sum(r.removed for r in got if r.filter_order[r.step - 1] == x)
