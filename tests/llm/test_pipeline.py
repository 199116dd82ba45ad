from __future__ import annotations

import re
import subprocess
import sys
from itertools import combinations

from pyspark.sql import functions as F

import corpus_pipeline
from mercato.llm import decontaminate, packing, pii, quality
from mercato.llm.queries import QUERIES
from mercato.session import materialize

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [n for n in names if n.startswith("op")] and set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "template_decontamination", "boosted_pii", "best_fit_packing"]


def kept_of_links(rows, percent):
    """The smallest doc_id of each component of documents that are alike, by comparing all sets of five-word shingles."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = {r.doc_id: [w for w in re.split("[\x20\x09-\x0D]+", (r.text or "").translate(lower)) if w] for r in rows}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, w in words.items()}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {d for d in root if top(d) == d}


def test_stages_act_on_what_came_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.quality_rules(spark, docs, SF)
    kept = {r.doc_id for r in quality.assess(spark, docs).collect() if r.kept}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == kept
    docs = docs.filter(docs.doc_id.isin(sorted(kept)))
    one = corpus_pipeline.minhash_near_dedup(spark, docs, SF)
    first = kept_of_links(docs.collect(), 80)
    assert one.columns == columns and {r.doc_id for r in one.collect()} == first
    docs = docs.filter(docs.doc_id.isin(sorted(first)))
    hit = {r.doc_id for r in decontaminate.matches(docs, decontaminate.benchmark_table(spark, SF)).collect()}
    clean = corpus_pipeline.template_decontamination(spark, docs, SF)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == first - hit
    docs = docs.filter(docs.doc_id.isin(sorted(first - hit)))
    model, texts = pii.train(), {r.doc_id: r.text for r in docs.collect()}
    private = corpus_pipeline.boosted_pii(spark, docs, SF)
    assert private.columns == columns
    for r in private.collect():
        base = pii.base_spans(texts[r.doc_id])
        assert r.text == pii.redacted(texts[r.doc_id], base + model.select(texts[r.doc_id], base)) and r.n_chars == len(r.text)
    got = corpus_pipeline.run(spark, SF)
    want = packing.pack(spark, private)
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(want)


def test_nothing_else_imports_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('mercato.llm') or name == 'corpus_pipeline': raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = e.queries(); e.oracle_sql()\n"
        "assert 'pipeline' not in names and len(names) > 70\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])


def through_stages(spark, docs):
    """Row counts after each stage, and the last table; every stage but the last keeps the columns."""
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = materialize(stage(spark, docs, SF), spark, f"test_{name}")
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
        counts.append(docs.count())
    return counts, docs


def test_stages_in_sequence_on_odd_tables(spark, edge_docs, empty_docs, clashing_docs):
    assert through_stages(spark, empty_docs)[0] == [0] * 5
    good = " ".join(f"the word{i} of sentence{i} and" for i in range(60))
    row = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(100, good, "en", "s", len(good)), (100, good, "en", "s", len(good)), (None, good + " more", None, None, None), (101, None, "en", "s", None)]
    for extra in ([], [F.lit(7).alias(c) for c in clashing_docs.columns[len(edge_docs.columns) :]]):
        docs = edge_docs.unionByName(spark.createDataFrame(rows, row)).select("*", *extra)
        counts, last = through_stages(spark, docs)
        assert counts[0] == 3 and counts[1:] == [1, 1, 1, 1]  # the copies and the near copy are one, nothing else has enough words
        assert last.first().piece == 0 and last.first().offset == 0
