from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from mercato.llm import packing
from mercato.llm.words import text_chunks


def brute_bins(histogram, size):
    """Best-fit decreasing one piece at a time: how many bins it takes."""
    bins = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [b for b in bins if b >= length]
            room = min(fits) if fits else size
            if fits:
                bins.remove(room)
            bins.append(room - length)
    return len(bins)


def test_runs_equal_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(150):
        h = {rng.randint(1, 40): rng.randint(1, 12) for _ in range(rng.randint(1, 15))}
        filled, seen = {}, {}
        for length, lo, hi, first, per, at in packing.best_fit_runs(h, 40):
            assert lo == seen.get(length, 0)
            seen[length] = hi
            for k in range(hi - lo):
                filled.setdefault(first + k // per, []).append((at + k % per * length, length))
        assert seen == h
        assert len(filled) == brute_bins(h, 40)
        for parts in filled.values():
            end = 0
            for at, length in sorted(parts):
                assert at == end
                end += length
            assert end <= 40


def test_segment_tree_finds_the_tightest():
    tree = packing.SegmentTree(2048)
    on = set()
    rng = random.Random(2)
    for _ in range(3000):
        c = rng.randint(0, 2048)
        tree.set(c, c not in on)
        on ^= {c}
        q = rng.randint(0, 2048)
        assert tree.at_least(q) == min((x for x in on if x >= q), default=None)


TRICKY = ["it's we'll.  a—b. “x”. 3.14, É. foo.,bar (x) [y] İ ß. Σας. ×. ÷,  z '.s", "<|endoftext|> x", "a<|endoftext|>b  <|startoftext|>", "<|ENDOFTEXT|> x <|endoftext", "", None, "a\x00b \x1c c"]


def test_ids_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += TRICKY
    encoder, got = packing._Encoder(packing.default_vocabulary()), []
    for _, _, buf, offsets in text_chunks(pa.array(texts)):
        ids, at = encoder.encode(buf, offsets)
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    want = [e.ids + [0] for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want


def check_rows(rows, texts):
    """Pieces cover their documents, sequences are gapless and short enough."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_seq.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= 2048
    for doc, text in texts.items():
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(-(-len(ids) // 2048)))
        for p in parts:
            own = ids[p.piece * 2048 : (p.piece + 1) * 2048]
            assert (p.start, p.length, p.ids_crc32) == (p.piece * 2048, len(own), zlib.crc32(own.tobytes()))
    return by_seq


def test_pack_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(spark, docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_seq = check_rows(rows, texts)
    histogram = {}
    for r in rows:
        histogram[r.length] = histogram.get(r.length, 0) + 1
    assert len(by_seq) == brute_bins(histogram, 2048)


def test_edges(spark, edge_docs, empty_docs, clashing_docs):
    rows = packing.pack(spark, edge_docs).collect()
    check_rows(rows, {1: None, 2: "", 3: " ", 5: "one", 7: "word " * 30_000, 8: "x" * 200_000})
    assert sum(r.doc_id == 6 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    assert [(r.length, r.piece) for r in rows if r.doc_id == 1] == [(1, 0)]
    assert packing.pack(spark, empty_docs).count() == 0
    assert packing.pack(spark, clashing_docs).count() == len(rows)


def test_kept_ids(spark, frame):
    out = packing.pack(spark, frame([(1, "hello world"), (2, None)]), keep_ids=True).collect()
    assert {r.doc_id: len(r.ids) for r in out} == {1: 3, 2: 1}
