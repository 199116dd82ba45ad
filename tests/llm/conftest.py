from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """Documents with the real columns from ``(doc_id, text)`` pairs."""

    def make(rows, **extra):
        full = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


EDGES = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (None, "a text without an id"),
    (5, "one"),
    (6, "one"),
    (6, "one"),
    (7, "word " * 30_000),
    (8, "x" * 200_000),
    (9, "éß 😀 ünï \x0b\x0c end"),
]


@pytest.fixture
def edge_docs(frame):
    return frame(EDGES)


@pytest.fixture
def empty_docs(frame):
    return frame([])


@pytest.fixture
def clashing_docs(edge_docs):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = ["node", "pid", "n", "shard", "length", "spans", "kept", "rank", "words", "text_key", "anchor", "size", "__x"]
    return edge_docs.select("*", *[F.lit(7).alias(c) for c in names])
