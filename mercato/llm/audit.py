"""Filter interaction audit by the Hart-Mas-Colell potential, in DataFrame functions.

A record fails some of ``k`` filters; a bit mask says which. In the removal
game a coalition of filters is worth the records that fail any of them. All
``2**k`` worths of a part come from the counts of its masks. The potential is
defined recursively, ``P(S) = (v(S) + sum of P(S without i)) / |S|`` with
``P({}) = 0``; a filter's Shapley value is ``P(all) - P(all but it)``. Values are kept
times ``k!``, where every division is exact, so ``shapley`` is the records
that the filter removes, summed over all ``k!`` orders. What a step of an
order removes is the worth of the filters up to it less that of those before
it.

Records are counted by (part, mask) before they are shuffled: whatever the
corpus, a part is ``2**k`` rows, and no order is run over records.

The rule E (an equal text with a smaller doc_id) needs copies together. Rows
are counted per text, part and labels in each task first, so a text that a
third of all rows share is some rows per task; equal texts are found by two
64-bit hashes.

Null texts are empty and a null part is the empty string. A row without a
doc_id has no labels, is never a later copy and makes none. Repeated rows
count as often as they occur; equal ids are not smaller ones, so repeated rows
of the smallest id all stay. Labels of one doc_id in several rows count if any does. Very long
texts are hashed and counted like others. An empty table gives no rows. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"


def own_failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part``, the text's two hashes and the ``mask`` of the filters A to D that it fails."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(F.lit(1), text).alias("k1"),
        F.xxhash64(F.lit(2), text).alias("k2"),
        F.char_length(text).alias("chars"),
        F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).alias("upper"),
        F.rlike(text, F.lit("[#$%&*|]")).alias("marked"),
        words.alias("words"),
    )
    size = F.size("words")
    fails = [
        size < 100,
        100 * F.size(F.array_distinct("words")) < 80 * size,
        100 * F.col("upper").cast("long") > 10 * F.col("chars").cast("long"),
        F.col("marked"),
    ]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", "k1", "k2", mask.alias("mask"))


def label_flags(labels: DataFrame) -> DataFrame:
    flags = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    return labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*flags)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents (and those with the labels) by the filters they fail."""
    rows = own_failures(docs).join(label_flags(labels), "doc_id", "left").na.fill(0, ["good", "toxic"])
    group = ["k1", "k2", "part", "mask", "good", "toxic"]
    rows = rows.groupBy("doc_id", *group).agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    rows = rows.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("unknown"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("k1", "k2"))
    rows = rows.withColumn("least", least)
    at_least = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    fresh = F.col("unknown") + F.coalesce(at_least, F.lit(0))
    copy = F.lit(1 << FILTERS.index("E"))
    kinds = F.array(
        F.struct(F.col("mask").alias("mask"), fresh.alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - fresh).alias("n")),
    )
    rows = rows.select("part", "good", "toxic", F.inline(kinds)).filter("n > 0")
    counts = [F.sum(F.col("n") * F.col(f)).alias(f) for f in ("good", "toxic")]
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *counts)


def coalitions(counts: DataFrame, k: int) -> DataFrame:
    """Per part the worth of every coalition: arrays over the bit sets 0 to 2**k - 1, and the ``total``."""
    rows = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(2**k - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    worth = [F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")]
    rows = rows.groupBy("part", "coalition").agg(*worth, F.sum("n").alias("total"))
    listed = F.array_sort(F.collect_list(F.struct("coalition", "n", "good", "toxic")))  # 2**k entries
    rows = rows.groupBy("part").agg(listed.alias("all"), F.max("total").alias("total"))
    return rows.select("part", "total", *[F.col(f"all.{c}").alias(c) for c in ("n", "good", "toxic")])


def potentials(worth: Column, k: int) -> Column:
    """``k!`` times the potential of every coalition, in the order of the bit sets."""

    def add(known: Column, s: Column) -> Column:
        smaller = F.lit(0).cast("long")
        for i in range(k):
            bit = F.lit(1 << i)
            smaller += F.when(s.bitwiseAND(bit) != 0, F.get(known, s - bit)).otherwise(0)
        value = F.call_function("div", factorial(k) * F.get(worth, s) + smaller, F.bit_count(s))
        return F.concat(known, F.array(value))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**k - 1)), F.array(F.lit(0).cast("long")), add)


def audit(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step, from ``(part, mask, n, good, toxic)``.

    ``kept`` (after the step), ``removed`` (by it), ``redundant`` (fail its
    filter, removed earlier), ``unique_fails`` (fail no other filter),
    ``good_lost``, ``toxic_lost`` and ``shapley``."""
    k = len(letters)
    rows = coalitions(counts, k).withColumn("potential", potentials(F.col("n"), k))
    orders = F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")
    rows = rows.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))

    def bit(place: Column) -> Column:
        letter = F.substring(F.col("filter_order"), place, F.lit(1))
        return F.call_function("shiftleft", F.lit(1), F.call_function("instr", F.lit(letters), letter) - 1)

    earlier = F.filter(F.sequence(F.lit(1), F.lit(k)), lambda j: j < F.col("step"))
    rows = rows.withColumns({"own": bit(F.col("step")), "before": F.aggregate(earlier, F.lit(0), lambda a, j: a + bit(j))})
    own, before, everyone = F.col("own"), F.col("before"), F.lit(2**k - 1)

    def step(worth: str) -> Column:
        return F.get(F.col(worth), before + own) - F.get(F.col(worth), before)

    def last(values: str) -> Column:
        return F.get(F.col(values), everyone) - F.get(F.col(values), everyone - own)

    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get(F.col("n"), before + own)).alias("kept"),
        step("n").alias("removed"),
        (F.get(F.col("n"), own) - step("n")).alias("redundant"),
        last("n").alias("unique_fails"),
        step("good").alias("good_lost"),
        step("toxic").alias("toxic_lost"),
        last("potential").alias("shapley"),
    )
