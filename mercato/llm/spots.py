"""Document fingerprints by spot signatures, in DataFrame functions only.

A spot is a common word that serves as an anchor (``ANCHORS``). Its signature
is the anchor with the chain of the next content words: up to ``CHAIN`` words
of the following ``SPAN`` that are not common words themselves. A document's
fingerprint is the set of its signatures (as hashes, ascending). Menus and
other text without flowing sentences hold few spots, so they weigh little. A
text without a spot has one signature, all its words; a text without words
has none.

``likeness`` is the Jaccard coefficient of two fingerprints, 1 for two empty
ones. Below a wanted likeness the lengths alone decide: sets whose sizes
differ by more than that factor are not intersected.

``near`` finds, for some query documents, all documents that are at least so
like them. Equal fingerprints are one class. Classes are partitioned by set
length, in steps of the wanted factor, and a class meets only its own and the
two adjacent partitions. Signatures are ordered from the rarest to the most
frequent; two sets that are alike enough share one of the first
``size - ceil(at_least * size) + 1`` of each, so only those are joined, and
each pair is then confirmed on full sets.

``next_documents`` gives every row the document after it in descending
doc_id, without a sort of the whole table in one task: rows are dealt into
buckets of consecutive ids, and the first row of each bucket is also sent to
the bucket before it.

Null texts are empty. Rows of one doc_id are ordered by a hash of their
texts, rows without one come last; repeated rows follow each other. Very long texts are read whole. The one document of a
table is its own successor; an empty table gives an empty result. Other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.quality import COMMON_WORDS
from mercato.session import materialize

COMMON = sorted({w for words in COMMON_WORDS.values() for w in words})
ANCHORS = sorted({w for words in COMMON_WORDS.values() for w in words[:4]})  # the most frequent ones of each language
CHAIN = 3
SPAN = 8
NOT_WORD = r"[^\p{L}\p{N}]+"
BUCKET = 256  # documents of a bucket, until there are MAX_BUCKETS
MAX_BUCKETS = 1 << 16


def with_spots(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint of the column ``text`` as an array of hashes."""
    rows = rows.withColumn("__words", F.filter(F.split(F.lower(F.col(text)), NOT_WORD), lambda w: w != ""))
    words = F.col("__words")

    def chain(place: Column) -> Column:
        content = F.filter(F.slice(words, place + 2, SPAN), lambda w: ~w.isin(COMMON))
        return F.concat_ws(" ", F.get(words, place), F.slice(content, 1, CHAIN))

    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    places = F.filter(places, lambda i: F.get(words, i).isin(ANCHORS))
    rows = rows.withColumn("__chains", F.array_distinct(F.filter(F.transform(places, chain), lambda c: F.contains(c, F.lit(" ")))))
    whole = F.when((F.size("__chains") == 0) & (F.size(words) > 0), F.array(F.concat_ws(" ", words))).otherwise(F.col("__chains"))
    hashes = F.transform(whole, lambda c: F.substring(F.md5(c), 1, 16))
    return rows.withColumn(name, F.array_sort(F.array_distinct(hashes))).drop("__words", "__chains")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard coefficient; 0 without a look at the sets where their sizes rule ``at_least`` out."""
    common = F.size(F.array_intersect(a, b))
    exact = F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))
    if not at_least:
        return exact
    return F.when(F.least(F.size(a), F.size(b)) < at_least * F.greatest(F.size(a), F.size(b)), F.lit(0.0)).otherwise(exact)


def text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def next_documents(rows: DataFrame, added=lambda dealt: dealt, carried: tuple[str, ...] = ("text",)) -> DataFrame:
    """``rows (doc_id, text)`` with ``next_<c>`` of each carried column: its value in the next row.

    ``added`` may compute columns of the rows where they have been dealt to
    their buckets, so that those are not shuffled."""
    n = rows.count()
    buckets = min(MAX_BUCKETS, max(1, math.ceil(n / BUCKET)))
    shares = F.split(F.lit(",".join(str(i / buckets) for i in range(1, max(2, buckets)))), ",").cast("array<double>")
    borders = rows.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("b")).first()["b"] or []  # one number per bucket
    borders = sorted(set(borders)) if buckets > 1 else []
    listed = F.split(F.lit(",".join(map(str, borders))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(borders).bit_length()))])
    below = F.aggregate(  # binary search: how many borders are not above the id
        steps, F.lit(0), lambda a, s: F.when(F.get(listed, a + s - 1) <= F.col("doc_id"), a + s).otherwise(a)
    )
    place = F.when(F.col("doc_id").isNull(), -1).otherwise(below if borders else F.lit(0))
    placed = rows.withColumn("bucket", place)
    heads = [tuple(r) for r in placed.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id")).orderBy(F.desc("bucket")).collect()]
    spark = rows.sparkSession
    sent = [(b, d, heads[i - 1][0]) for i, (b, d) in enumerate(heads)]  # at most MAX_BUCKETS + 1 rows
    sent = spark.createDataFrame(sent, "bucket int, head long, target int")
    placed = placed.join(F.broadcast(sent), (placed["bucket"] == sent["bucket"]) & placed["doc_id"].eqNullSafe(sent["head"]), "left").drop(sent["bucket"])
    to = F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct(F.col("target").alias("bucket"), F.lit(True).alias("guest")))
    to = F.when(F.col("target").isNull(), F.slice(to, 1, 1)).otherwise(to)
    dealt = placed.select("doc_id", "text", F.inline(to)).repartition("bucket")
    dealt = added(dealt)
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    out = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
    return out.filter(~F.col("guest")).drop("guest", "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, spots`` of every row."""
    return with_spots(text_rows(docs), "text", "spots").drop("text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text, and how like they and its successor's are."""
    rows = next_documents(text_rows(docs), lambda dealt: with_spots(dealt, "text", "spots"), ("text", "spots"))
    n = F.char_length("text")
    cut = F.call_function("div", n, F.lit(2)).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "edited", "spots", "next_spots")
    rows = with_spots(rows, "edited", "edited_spots")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("spots", " ").alias("fingerprint"),
        F.array_join("edited_spots", " ").alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def members(docs: DataFrame) -> DataFrame:
    """``class`` and ``spots`` of all rows of ``docs (doc_id, text, ...)`` with a signature; equal fingerprints are a class."""
    prints = with_spots(docs, "text", "spots").drop("text").filter(F.size("spots") > 0)
    return prints.withColumn("class", F.md5(F.array_join("spots", " ")))


def near(spark: SparkSession, docs: DataFrame, wanted: Column, at_least: float = 0.8) -> DataFrame:
    """``query_class, class, likeness`` of all classes at least so like a class of the ``wanted`` documents.

    ``wanted`` is a condition on ``doc_id``. :func:`members` has the documents of a class; a class is like itself."""
    rows = members(text_rows(docs).withColumn("asked", F.coalesce(wanted, F.lit(False))))
    sets = rows.groupBy("class").agg(F.first("spots").alias("spots"), F.max("asked").alias("asked"))
    sets = materialize(sets, spark, "spot_classes")
    spots = sets.select("class", F.explode("spots").alias("spot"))
    rarity = spots.groupBy("spot").agg(F.count("*").alias("df"))
    ranked = spots.join(rarity, "spot").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("ranked"))
    size = F.size("ranked")
    first = F.slice("ranked", F.lit(1), size - F.ceil(F.lit(at_least) * size - 1e-9).cast("int") + 1)
    length = F.floor(F.log(size.cast("double")) / math.log(1 / at_least) + 1e-9).cast("int")
    heads = ranked.select("class", length.alias("part"), F.explode(first["spot"]).alias("spot"))
    heads = materialize(heads, spark, "spot_heads")
    asked = heads.join(sets.filter("asked").select("class"), "class", "left_semi")
    asked = asked.select(F.col("class").alias("query_class"), "spot", F.explode(F.array(*[F.col("part") + d for d in (-1, 0, 1)])).alias("part"))
    pairs = asked.join(heads, ["part", "spot"]).select("query_class", "class").distinct()
    pairs = pairs.join(sets.select("class", "spots"), "class")
    own = sets.select(F.col("class").alias("query_class"), F.col("spots").alias("query_spots"))
    pairs = pairs.join(own, "query_class").withColumn("likeness", likeness(F.col("query_spots"), F.col("spots"), at_least))
    return pairs.filter(F.col("likeness") >= at_least).select("query_class", "class", "likeness")
