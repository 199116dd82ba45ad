from __future__ import annotations

import random
import re

import numpy as np

from mercato.llm import decontaminate

ITEM = "If Anna buys 12 apples for 3 dollars each and sells them to Tom for 5 dollars, how much does Anna earn?"


def tokens(text):
    return re.findall(r"[0-9a-zà-öø-ÿß]+", text.lower())


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, frame, docs, items):
    return {(r.doc_id, r.item_id): r for r in decontaminate.matches(frame(docs), bench(spark, items)).collect()}


def test_planted_passages_whole_table(spark):
    """The invented texts hold no numbers in items: a hit is ten equal tokens in a row."""
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), decontaminate.benchmark_table(spark, sf)
    windows = {tuple(w[i : i + 10]) for r in items.collect() for w in [tokens(r.text)] for i in range(len(w) - 9)}
    want = {r.doc_id for r in docs.collect() for w in [tokens(r.text)] if any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))}
    assert {r.doc_id for r in decontaminate.matches(docs, items).collect()} == want and want
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - want


def test_reparameterised_question(spark, frame):
    other = ITEM.replace("Anna", "Maria").replace("12", "45").replace("Tom", "John").replace(" 3 ", " 7 ").replace(" 5 ", " 9 ")
    out = found(spark, frame, [(1, f"Quiz: {ITEM}"), (2, f"Once more. {other} Thanks"), (3, "Nothing of this kind is in here at all, is it?")], [(8, ITEM)])
    assert set(out) == {(1, 8), (2, 8)}
    assert out[1, 8].n_changed == 0 and out[2, 8].n_changed >= 4 and out[2, 8].n_tokens >= 18


def test_inconsistent_slots_cut_the_run(spark, frame):
    item = ITEM.replace("does Anna", "does Tom")  # the same slot twice
    odd = item.replace("does Tom", "does Peter")  # two values for it
    whole = found(spark, frame, [(1, f"Well, {item}")], [(8, item)])[1, 8].n_tokens
    assert found(spark, frame, [(1, f"Well, {odd}")], [(8, item)])[1, 8].n_tokens < whole


def test_a_small_filter_loses_nothing(spark, frame, monkeypatch):
    """With a filter that lets nearly everything through the join alone decides."""
    items = [(i, " ".join("abcdef"[i] * (k + 2) for k in range(15))) for i in range(6)]
    docs = [(i, f"lead {t} tail") for i, t in items] + [(99, "clean words of no item at all, but more than ten of them")]
    for bits in (27, 4):
        monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
        assert set(found(spark, frame, docs, items)) == {(i, i) for i in range(6)}
        assert [r.doc_id for r in decontaminate.clean(frame(docs), bench(spark, items)).collect()] == [99]


def readings(t, at, size):
    """All readings of a window as tuples, from the definition."""
    value, kind, code = (x[at : at + size].tolist() for x in (t.value, t.type, t.code))
    named = [v if k == decontaminate.NAME else c for v, k, c in zip(value, kind, code, strict=True)]
    literal, out = min(size, decontaminate.MIN_LITERAL), set()
    for reading in (code, named):
        for form in (reading, [value[0], *reading[1:]]):
            if sum(f == v for f, v in zip(form, value, strict=True)) >= literal:
                out.add(tuple(form))
    return out | {tuple(value)}


def brute(docs, items):
    """Pairs of a document and an item with a consistent run of a window or more."""
    units, out = decontaminate._unit_hashes(), {}
    make = lambda x: decontaminate.Templates(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]), units)
    for i, item in items:
        u = make(item)
        size = min(decontaminate.WINDOW, len(u.value))
        for d, text in docs:
            t, best = make(text), 0
            for shift in range(-len(u.value), len(t.value)):
                hits = [a for a in range(max(0, shift), min(len(t.value), shift + len(u.value)) - size + 1)
                        if readings(t, a, size) & readings(u, a - shift, size)]
                runs = []
                for a in hits:
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = a + size
                    else:
                        runs.append([a, a + size])
                for lo, hi in runs:
                    for a in range(lo, hi):
                        for b in range(a + size, hi + 1):
                            pairs = [(u.type[k - shift], u.value[k - shift], t.value[k]) for k in range(a, b)
                                     if t.type[k] == u.type[k - shift] != decontaminate.LITERAL]
                            there, back = {}, {}
                            if all(there.setdefault((k, x), y) == y and back.setdefault((k, y), x) == x for k, x, y in pairs):
                                best = max(best, b - a)
            if best:
                out[d, i] = best
    return out


def test_templates_against_brute_force(spark, frame):
    """Numbers, names and units changed at random, consistently or not, in running text of other case and order."""
    rng = random.Random(4)
    forms = [
        "If {n} buys {a} apples for {b} dollars each and sells them to {m} for {c} dollars, how much does {n} earn?",
        "A train leaves {n} at {a} hours and drives {b} km to {m}, how many km is it from {m} to {n}?",
        "What is {a} plus {b} times {c}?",
        "On {a} May {b} the town of {n} had {c} people, and {m} counted {a} of them by hand",
    ]
    names, numbers = ["Anna", "Tom", "Peter", "Maria", "Bern"], ["3", "12", "45", "7", "1990"]

    def fill(form, names=names, numbers=numbers):
        return form.format(n=rng.choice(names), m=rng.choice(names), a=rng.choice(numbers), b=rng.choice(numbers), c=rng.choice(numbers))

    items = [(i, fill(forms[i % 4])) for i in range(8)]
    docs = [(d, f"so it goes. {fill(forms[d % 4])} Then {fill(forms[(d // 4) % 4])}") for d in range(24)]
    docs += [(100 + d, x.lower()) for d, x in docs[:4]] + [(200, "a text with 3 numbers in 12 places and nothing else of the kind to be found")]
    templates = decontaminate.item_templates(bench(spark, items))
    first = {r.member_id: r.item_id for r in decontaminate.members(templates).collect()}
    want = {}
    for (d, i), n in brute(docs, items).items():
        want[d, first[i]] = max(n, want.get((d, first[i]), 0))
    assert {k: r.n_tokens for k, r in found(spark, frame, docs, items).items()} == want and len(want) > 20


def test_one_template_is_one_class(spark, frame):
    """Documents of one form against thousands of items of that form: rows grow with the documents."""
    form = "If Anna buys {} apples for {} dollars each and gives {} of them to Tom, how many apples does she keep?"
    items = [(i, form.format(i + 10, i + 4000, i + 8000)) for i in range(1500)]
    docs = [(d, f"Once. {form.format(d + 20_000, d + 30_000, d + 40_000)} So.") for d in range(50)] + [(60, items[700][1])]
    got = found(spark, frame, docs, items)
    assert set(got) == {(d, 0) for d, _ in docs}
    assert got[60, 0].n_exact == got[60, 0].n_tokens and got[3, 0].n_exact < got[3, 0].n_tokens
    assert decontaminate.members(decontaminate.item_templates(bench(spark, items))).count() == 1500
    assert decontaminate.clean(frame(docs), bench(spark, items)).count() == 0


def test_repeated_rows_and_rows_without_id(spark, frame):
    docs = [(1, ITEM), (1, ITEM), (None, ITEM), (None, "clean")]
    rows = decontaminate.matches(frame(docs), bench(spark, [(None, ITEM), (8, ITEM)])).collect()
    assert sorted(str((r.doc_id, r.item_id)) for r in rows) == ["(1, 8)", "(1, 8)", "(None, 8)"]
    assert [r.text for r in decontaminate.clean(frame(docs), bench(spark, [(8, ITEM)])).collect()] == ["clean"]


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    items = bench(spark, [(1, None), (2, ""), (3, "too short"), (4, "just six little words in here")])
    assert decontaminate.matches(edge_docs, items).count() == 0
    assert decontaminate.matches(empty_docs, items).count() == 0
    assert decontaminate.matches(edge_docs, bench(spark, [])).count() == 0
    out = decontaminate.clean(clashing_docs, items)
    assert out.columns == clashing_docs.columns and out.count() == 10


def test_short_items_match_whole(spark, frame):
    assert set(found(spark, frame, [(1, "so just six little words in here now"), (2, "just six little words in")], [(4, "Just six little words in here.")])) == {(1, 4)}


def test_exact_copies_need_no_literals(spark, frame):
    items = [(1, "What is 12 plus 7 times 3?"), (2, "Two and two"), (3, "12 7 1990 15 km 3 kg 4 5 6 8 9 10"), (4, "On 3 May 1990 Anna Bell met Tom Hill in Rome for 5 days")]
    docs = [(i, f"Some words, {t} And more.") for i, t in items] + [(9, "What is 12 plus 8 times 3? Two and three. On 4 June 1991 Eva Cole met Jim Dale in Oslo for 6 days")]
    assert set(found(spark, frame, docs, items)) == {(i, i) for i in range(1, 5)}
    assert [r.doc_id for r in decontaminate.clean(frame(docs), bench(spark, items)).collect()] == [9]


def test_case_and_surroundings(spark, frame):
    short, whole = "Just six little words in here now.", "How Many legs do 7 spiders have in all"
    assert set(found(spark, frame, [(1, "so Just six little words in here now"), (2, f"and {whole.replace('7', '9')}")], [(4, short), (5, whole)])) == {(1, 4), (2, 5)}
    for text in (ITEM, ITEM.replace("12", "45").replace(" 3 ", " 7 ")):
        out = found(spark, frame, [(1, f"so {text}"), (2, f"so {text.lower()}"), (3, f"so {text.upper()}")], [(8, ITEM)])
        assert {k: r.n_tokens for k, r in out.items()} == {(d, 8): 22 for d in (1, 2, 3)}
