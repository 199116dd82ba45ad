"""Quality rules by distribution divergence, in DataFrame functions only.

A document is compared with language references through the Jensen-Shannon
divergence (base 2, 0 to 1) of two histograms:

* character classes: white space, lower case, upper case, digits, symbols,
  punctuation, the rest;
* the language's common words, and all other words together.

The references are sums over all documents of a language that pass the base
rules. A first reference may hold junk, so it is used to leave out documents
far from it and the sums are taken again (``REFINEMENTS``): at most one row
per language reaches the driver, whatever the corpus.

A document is kept if the base rules pass and it is near the reference of
any language. That is asked only of documents whose own language has a
reference: for another ``lang``, or none, there is nothing to measure against
(a text in a script of its own is far from all of them), and the base rules
decide alone. Histograms of short texts are noisy, so the limits are guarded
by length: below ``MIN_WORDS`` words only a gross divergence of character
classes counts, and common words are not looked at.

Null texts have no words and fail the base rules. Very long texts are read
whole. Rows are judged one by one, so
repeated rows get equal verdicts. An empty table has no references and gives
an empty result. Extra columns, whatever their names, do not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import materialize

# fixed values: function words of each language, the most frequent ones first
COMMON_WORDS = {
    "en": "the of and to in is that for it with as on".split(),
    "de": "der die und in den von zu das mit sich des auf".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "es": "de la que el en y a los se del las un".split(),
}
LANGUAGES = list(COMMON_WORDS)

MIN_WORDS = 100  # guard: below it histograms are too noisy for the limits
MAX_CLASS = 0.035  # divergence of character classes
MAX_WORDS = 0.08  # divergence of common words
MAX_CLASS_SHORT = 0.2  # for texts under MIN_WORDS
REFINEMENTS = (0.05, 0.035)  # class divergence up to which a document feeds the next reference

SPACE = r"[\x20\x09-\x0D]+"
CLASSES = {  # after white space and lower case; what is left over is a class of its own
    "upper": r"\p{Lu}+",
    "digit": r"[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "punct": r"[.,;:!?'\"()-]+",
}
WINDOW = 8

References = dict[str, tuple[list[float], list[float]]]


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _removed(text: Column, pattern: str) -> Column:
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def repeated_words(windows: Column) -> Column:
    """Words inside windows whose hash occurs at least twice in the array."""

    def positions(s: Column) -> Column:
        twin = F.filter(s, lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]))
        return F.sort_array(F.transform(twin, lambda e: e["i"]))

    def covered(p: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
        return F.aggregate(
            p,
            start,
            lambda a, i: F.struct(
                (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda a: a["n"],
        )

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    none = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(none, F.lit(0).cast("long")).otherwise(bind(bind(pairs, positions), covered))


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and the two histograms.

    Added columns: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and ``__classes`` (array) and ``__common``
    (an array per language). Columns of these names in ``docs`` are replaced."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"
    everyday = sorted({w for words in COMMON_WORDS.values() for w in words})
    out = docs.select(
        "*",
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("__words"),
        F.regexp_replace(text, r"[\p{Ll}\x20\x09-\x0D]+", "").alias("__rest"),
        F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(has_word))).alias("__lines"),
    )
    words = F.col("__words")
    out = out.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__windows": F.when(
                F.size(words) >= WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
            "__everyday": F.filter(words, lambda w: w.isin(everyday)),
            **{f"__{name}": _removed(F.col("__rest"), pattern) for name, pattern in CLASSES.items()},
        }
    )
    spaces = F.char_length(text) - F.col("word_chars")
    rest = F.char_length("__rest")
    listed = [F.col(f"__{name}") for name in CLASSES]
    counts = [spaces, F.char_length(text) - spaces - rest, *listed, rest - sum(listed[1:], listed[0])]

    def common(language: str) -> Column:
        vocabulary = F.array(*[F.lit(w) for w in COMMON_WORDS[language]])
        found = F.transform(vocabulary, lambda v: F.size(F.filter(F.col("__everyday"), lambda w: w == v)).cast("long"))
        total = F.col("n_words")
        return bind(
            found, lambda c: F.concat(c, F.array(total - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)))
        )

    out = out.withColumns(
        {
            "n_symbols": F.col("__symbol"),
            "n_repeat_words": repeated_words(F.col("__windows")),
            "__classes": F.array(*[c.cast("long") for c in counts]),
            "__common": F.array(*[common(language) for language in LANGUAGES]),
        }
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scratch = ["__words", "__rest", "__lines", "__windows", "__everyday", *[f"__{name}" for name in CLASSES]]
    return out.withColumn("base_failed", failed).drop(*scratch)


def divergence(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon divergence of a count array and a distribution."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    share = bind(total, lambda t: F.transform(counts, lambda x: x / F.greatest(t, F.lit(1))))

    def half(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return half(p, m) + half(q, m)

    terms = F.zip_with(share, F.array(*[F.lit(float(x)) for x in reference]), term)
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2


def _nearest(refs: References, classes: bool) -> Column:
    found = [
        divergence(F.col("__classes"), refs[lang][0])
        if classes
        else divergence(F.get(F.col("__common"), F.lit(i)), refs[lang][1])
        for i, lang in enumerate(LANGUAGES)
        if lang in refs
    ]
    return F.least(*found) if len(found) > 1 else found[0]


def references(features: DataFrame) -> References:
    """Class and common-word distributions of each language (one row each)."""
    own = features.filter(F.col("lang").isin(LANGUAGES) & ~F.col("base_failed"))
    place = F.array_position(F.array(*[F.lit(x) for x in LANGUAGES]), F.col("lang")).cast("int") - 1
    own = own.withColumn("__own", F.get(F.col("__common"), place))
    sums = [F.sum(F.get(F.col("__classes"), F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 3)]
    n = max(len(w) for w in COMMON_WORDS.values()) + 1
    sums += [F.sum(F.get(F.col("__own"), F.lit(i))).alias(f"w{i}") for i in range(n)]

    def take(rows: DataFrame) -> References:
        out = {}
        for r in rows.groupBy("lang").agg(*sums).collect():  # a row per language
            parts = [[r[f"{k}{i}"] for i in range(m)] for k, m in (("c", len(CLASSES) + 3), ("w", n))]
            out[r["lang"]] = tuple([x / max(1, sum(p)) for x in p] for p in parts)
        return out

    refs = take(own)
    for limit in REFINEMENTS:
        if refs:
            refs = take(own.filter(_nearest(refs, True) <= limit)) or refs
    return refs


def verdict(refs: References) -> Column:
    """Whether a row of :func:`with_features` is kept."""
    passed = ~F.col("base_failed")
    if not refs:
        return passed
    long_enough = F.col("n_words") >= MIN_WORDS
    far = F.when(long_enough, _nearest(refs, True) > MAX_CLASS).otherwise(_nearest(refs, True) > MAX_CLASS_SHORT)
    odd = long_enough & (_nearest(refs, False) > MAX_WORDS)
    measured = F.coalesce(F.col("lang").isin(sorted(refs)), F.lit(False))
    return passed & ~(measured & (far | odd))


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def feature_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The features of all rows, without their texts, written once."""
    return materialize(
        with_features(docs.select("doc_id", "text", "lang")).drop("text"), spark, "quality_features"
    )


def assess(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` of every row."""
    table = feature_table(spark, docs)
    return table.select("doc_id", *FEATURES, verdict(references(table)).alias("kept"))


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged.

    Rows are written once with their features, so each text is read through
    once; the references read only the histograms of that table."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text", "lang")
    table = materialize(with_features(rows).drop("text"), spark, "quality_rows")
    return table.filter(verdict(references(table))).select("__row.*")
