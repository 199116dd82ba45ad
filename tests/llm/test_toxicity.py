from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import toxicity
from mercato.llm.words import text_chunks


def features(grammar, text):
    _, _, buf, offsets = next(text_chunks(pa.array([text.lower()])))
    return dict(zip(toxicity.READOUT, grammar.readout(buf, offsets)[0], strict=True))


def naive(insults, text):
    """The clauses read word by word, from the docstring's rules alone."""
    threat, kinds = float(np.median(list(insults.values()))), {w: c for c, ws in toxicity.LEXICON.items() for w in ws.split()}
    sums, heaviest, matches = dict.fromkeys(toxicity.CONTEXTS, 0.0), 0.0, 0
    place = 0
    for clause in re.split(r"[.!?;:\n\r]", text.lower()):
        words = []
        for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", clause):
            raw, kind, weight = w.encode(), None, 0.0
            for size in toxicity.STEMS:
                if len(raw) >= toxicity.STEM_FROM and raw[:size] + b"*" in insults:
                    kind, weight = "insult", insults[raw[:size] + b"*"]
            if raw in insults:
                kind, weight = "insult", insults[raw]
            elif w in kinds:
                kind, weight = kinds[w], threat if kinds[w] == toxicity.THREAT else 1.0
            words.append((kind, weight))
            place += 1
        read = [(i, k, w) for i, (k, w) in enumerate(words) if k]
        if not any(k in ("insult", toxicity.THREAT) for _, k, _ in read):
            continue
        near, total = [], 0.0  # near: what was read since the last gap of more than REACH words

        def add(context, w):
            nonlocal total
            sums[context] += w
            total += w * toxicity.CONTEXTS[context]

        waiting, menaces, free = [], [], False
        for n, (i, k, w) in enumerate(read):
            if n and i - read[n - 1][0] > toxicity.REACH:
                near, free = [], False
            seen = set(near)
            shade = "negated" if toxicity.NEGATION in seen else "reported" if toxicity.REPORT in seen else None
            if k == "insult":
                matches += 1
                context = shade or ("target" if toxicity.TARGET in seen else "plain")
                add(context, w)
                if context == "plain":
                    waiting.append((i, w))
            elif k == toxicity.THREAT:
                if toxicity.TARGET in seen and not free:
                    matches += 1
                    add(shade or "threat", w)
                else:
                    menaces.append((i, w))
                    free = True
            elif k == toxicity.TARGET:
                if free:
                    for j, v in menaces:
                        if i - j <= toxicity.REACH:
                            matches += 1
                            add(shade or "threat_ahead", v)
                    free = False
                menaces = []
                for j, v in waiting:
                    if i - j <= toxicity.REACH:
                        add("plain", -v)
                        add("target", v)
                waiting = []
            near.append(k)
        heaviest = max(heaviest, total)
    return {**sums, "heaviest": heaviest, "matches": matches}


VOCABULARY = "idiot rottenness rotten you they him kill hurt not never said called a calm friendly boat on the way of".split()


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([*VOCABULARY, ".", ":", "\n", ","]), max_size=40))
def test_clauses_against_a_naive_reader(words):
    insults = {b"idiot": 4.0, b"rotte*": 2.0, b"rotten": 3.0}
    text = " ".join(words)
    got, want = features(toxicity.Grammar(insults), text), naive(insults, text)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got), text


def test_clause_grammar():
    g = toxicity.Grammar({b"idiot": 4.0, b"rotte*": 2.0})
    assert features(g, "The idiot left.")["plain"] > 0
    assert features(g, "You idiot!")["target"] > 0
    assert features(g, "Such an idiot you are.")["target"] > 0  # the target may follow
    assert features(g, "This is not an idiot.")["negated"] > 0
    assert features(g, "They said: idiot")["plain"] > 0  # the report ended with its clause
    assert features(g, "It was called an idiot thing")["reported"] > 0
    assert features(g, "I will hurt you")["threat"] == 0 and features(g, "You, I will hurt")["threat"] > 0
    assert features(g, "rottenness abounds")["plain"] > 0 and not any(features(g, "rotte").values())
    assert not any(features(g, "A calm and friendly text about kills and boats.").values())
    assert features(g, "You. The idiot left.")["target"] == 0  # clauses do not mix


def test_composition_is_the_product():
    nxt, flags = toxicity.compose(toxicity.PARTS)
    assert len(nxt) == 8
    assert not any(x for row in toxicity.compose(dict.fromkeys(toxicity.PARTS, toxicity.SILENT))[1] for x in row)
    state = 0
    for symbol, want in ((toxicity.NEGATION, 0), (toxicity.TARGET, 0), (toxicity.INSULT, 3), (toxicity.REPORT, 0), (toxicity.INSULT, 7)):
        assert flags[state][symbol] == want
        state = nxt[state][symbol]


def test_threats_meet_their_target():
    g = toxicity.Grammar({b"idiot": 4.0})
    assert features(g, "I will hurt you")["threat_ahead"] > 0 and features(g, "We will kill and burn you")["threat_ahead"] > features(g, "I will hurt you")["threat_ahead"]
    for text, flag in (("You will not kill", "negated"), ("I will not hurt you", "negated"), ("Quoted: fine. A claimed plan to kill you", "reported")):
        f = features(g, text)
        assert f[flag] > 0 and f["threat"] == f["threat_ahead"] == 0
    assert not any(features(g, "They are gone. Kill the light").values())
    assert features(g, "kill one two three four five six seven you")["threat_ahead"] == 0  # out of reach
    assert features(g, "I will hurt you")["heaviest"] > features(g, "I will not hurt you")["heaviest"] > 0


def auc(good, bad):
    good, bad = np.array(good), np.array(bad)
    return (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()


def test_held_out_accuracy(spark):
    """Scores of rows that no label was learnt from."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.score(spark, docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    yes, no = ([r for r in held if toxic[r.doc_id] == y] for y in (1, 0))
    assert auc([r.score for r in yes], [r.score for r in no]) > 0.93
    assert np.mean([r.predicted for r in yes]) > 0.8 and np.mean([r.predicted for r in no]) < 0.01


CONTEXT_LINES = {  # the same words, toxic or not by their clause
    1: ["you {w} over there", "them and that {w} over there", "that {w} over there is them", "I will {t} you soon", "he will {t} soon"],
    0: ["that {w} over there", "not you {w} over there", "you never that {w} over there", "called them {w} over there", "said you {w} over there", "I will not {t} you soon", "said I will {t} you soon", "I will {t} that soon"],
}


@pytest.fixture(scope="module")
def clauses(spark):
    """Texts whose label follows from the clause, not from its words alone."""
    rng, rows, labels = random.Random(5), [], []
    filler = ["river", "stone", "garden", "window", "paper", "autumn", "harbour", "candle", "meadow", "copper", "violin", "market", *"soon will over there i is and that".split()]
    for i in range(1500):
        y = int(rng.random() < 0.4)
        line = rng.choice(CONTEXT_LINES[y]).format(w=rng.choice(["idiot", "moron", "loser", "scum"]), t=rng.choice(["hurt", "kill", "attack"]))
        around = [" ".join(rng.choices(filler, k=rng.randint(4, 9))) for _ in range(2)]
        if not y and rng.random() < 0.5:
            line = " ".join(rng.choices(filler, k=6))
        rows.append((i, f"{around[0]}. {line}. {around[1]}."))
        labels.append((i, y))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def held_out_auc(docs, labels, model):
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.doc_id, r.text.lower()) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    _, _, buf, offsets = next(text_chunks(pa.array([t for _, t in rows])))
    score = model.score(model.grammar.features(buf, offsets))
    y = np.array([toxic[i] for i, _ in rows])
    return auc(score[y == 1], score[y == 0])


def test_every_transducer_carries_signal(spark, clauses):
    """Leaving one out costs accuracy where clauses decide."""
    whole = held_out_auc(*clauses, toxicity.train(spark, *clauses))
    assert whole > 0.95
    without = {part: held_out_auc(*clauses, toxicity.train(spark, *clauses, without=[part])) for part in ("target", "negated", "reported", "threat")}
    assert all(a < whole - 0.005 for a in without.values()), (whole, without)


def test_context_orders_scores(spark):
    """With the arcs that the given tables teach, the same word weighs by its clause."""
    sf = "/root/testdata/sf0.1"
    model = toxicity.train(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    texts = ["you idiot", "an idiot", "not an idiot", "he called it idiot stuff", "i will hurt you", "i will not hurt you", "hurt"]
    _, _, buf, offsets = next(text_chunks(pa.array(texts)))
    direct, plain, negated, reported, threat, no_threat, none = model.grammar.features(buf, offsets)[:, 0]
    assert direct > plain > negated > 0 and plain > reported > 0 and threat > no_threat > none == 0
    assert model.weights[1] > 0


def test_sample_does_not_depend_on_partitions(spark, frame):
    docs = frame([(i, f"one two three four five six {i // 3}") for i in range(30)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    first = sorted(map(tuple, toxicity.sample(spark, docs, labels).collect()))
    assert first == sorted(map(tuple, toxicity.sample(spark, docs.orderBy(F.desc("doc_id")).repartition(5), labels).collect())) and first


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None), (7, 0)], "doc_id long, toxic int")
    rows = toxicity.score(spark, edge_docs, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(spark, clashing_docs, none).collect()} == {0.0}
    assert toxicity.score(spark, empty_docs, labels).count() == 0
