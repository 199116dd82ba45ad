"""Ordered cleaning of flat sales rows with a quarantine.

The reference's nine eager steps become one lazy plan that labels every
input row with the first rule it breaks (``reject_reason``) instead of
dropping it. The order of the steps is part of the semantics and is kept:

0. a field whose text is not of its type (only where the reader lists
   such fields in ``bad_fields``)    -> ``malformed_field``            (S1)
1. parse the order date, bad text -> null                         (N1)
2. missing required column            -> ``missing_required``      (N2)
3. fill rating / delivery days with medians of the step-2 rows      (N3, N4)
4. fill a missing payment method with a label                       (N5)
5. not the first row of its key among step-2 rows -> ``duplicate_key`` (N6)
6. quantity <= 0, price < 0 or revenue < 0 -> ``out_of_range``      (N7)
7. clip discount to [0, 1]                                          (N8)
8. strip + normalise text, compare case/padding-insensitively and
   emit the domain's canonical label, else -> ``invalid_domain``    (N9, N10)
9. flag |revenue - qty x price x (1 - discount)| > tolerance        (N11)

Keep-first (step 5) finds the winning row id of each key with a
``groupBy(key)`` minimum over the surviving rows (a hot key collapses
map-side) and joins all rows to the winners on the row id, which is unique
and never null: no key, hot or null, gathers its rows in one task.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.scalar import clip, is_missing, match_key, nan_to_null, normalise_label, parse_date, strip_all
from mercato.operators.quantiles import medians

MALFORMED = "malformed_field"
MISSING = "missing_required"
DUPLICATE = "duplicate_key"
OUT_OF_RANGE = "out_of_range"
INVALID_DOMAIN = "invalid_domain"
REASONS = (MISSING, DUPLICATE, OUT_OF_RANGE, INVALID_DOMAIN)


@dataclass(frozen=True)
class CleanRules:
    key: str = "order_id"
    order_by: Sequence[str] = ()
    date_col: str = "order_date"
    date_format: str = "M/d/yyyy"
    required: Sequence[str] = (
        "order_id", "order_date", "customer_id", "product_category",
        "region", "quantity", "unit_price", "revenue", "discount",
    )
    price_col: str = "unit_price"
    quantity_col: str = "quantity"
    revenue_col: str = "revenue"
    discount_col: str = "discount"
    median_fills: Sequence[str] = ("customer_rating", "delivery_days")
    truncate_fills: Sequence[str] = ("delivery_days",)
    label_fills: Mapping[str, str] = field(default_factory=lambda: {"payment_method": "Unknown"})
    keep_fill_labels: bool = True
    domains: Mapping[str, Sequence[str]] = field(default_factory=dict)
    text_cols: Sequence[str] = ("product_category", "region", "payment_method")
    clip_bounds: tuple = (0, 1)
    revenue_tolerance: float = 1.0
    expected_revenue: str | Column | None = None
    bad_fields: str = "bad_fields"


def _file_place(df: DataFrame) -> dict[str, Column]:
    """Columns that say where a row of a file scan stands: its file and the start of its split; none for derived input."""
    context = logging.getLogger("DataFrameQueryContextLogger")
    quiet, context.disabled = context.disabled, True  # the question may fail, which is an answer
    try:
        place = {"__file": F.col("_metadata.file_path"), "__split": F.col("_metadata.file_block_start")}
        df.select(*place.values())  # only the scan of one file source has these
        return place
    except AnalysisException:
        return {}
    finally:
        context.disabled = quiet


def _first_ids(rows: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``__rid`` of the first row of each key: by ``order_by``, then in file order.

    The id is unique but does not follow the files (Spark packs splits into
    partitions by size), so file and split lead it where a row has them; they
    only decide between rows of a key and are not part of the id. Without
    either the minimum is numeric, a hash aggregate. A hot key is collapsed
    in each task."""
    place = [c for c in ("__file", "__split") if c in rows.columns]
    lead = [*order_by, *place]
    first = F.min_by("__rid", F.struct(*lead, "__rid")) if lead else F.min("__rid")
    return rows.groupBy(*key).agg(first.alias("__rid")).select("__rid")


def label_rows(df: DataFrame, rules: CleanRules, stage: bool = True) -> DataFrame:
    """Every input row, cleaned where it survives, with ``reject_reason``
    (null for valid rows) and ``revenue_mismatch`` (N13, single plan).

    With ``stage`` (default) the parsed input is written once to the
    session's shared checkpoint folder with each row's place and read back
    with a row id (``__rid``, which rises in file order for a file scan of
    one or many files): the medians, the keep-first
    aggregate and the labelling pass then scan that table instead of
    recomputing the input, the lineage is cut, and ties in ``order_by``
    (identical copies included) are broken by the stored id, so exactly one
    row per key is kept. Staging pays one write of the input: right for a
    CSV extract (parsed once, then read as columns) or any derived input.
    ``stage=False`` skips the copy and is safe only for a direct scan of
    columnar files, whose row ids are the same in every pass."""
    r = rules
    out = df.withColumns({**_file_place(df), "__rid": F.monotonically_increasing_id()})
    if isinstance(df.schema[r.date_col].dataType, T.StringType):
        out = out.withColumn(r.date_col, parse_date(r.date_col, r.date_format))
    else:
        out = out.withColumn(r.date_col, F.col(r.date_col).cast("date"))

    missing = F.lit(False)
    for c in r.required:
        missing = missing | is_missing(c, out.schema[c].dataType)
    malformed = F.size(r.bad_fields) > 0 if r.bad_fields in df.columns else F.lit(False)
    out = out.withColumns({"__missing": missing, "__malformed": malformed})
    if stage:
        from mercato.session import materialize

        out = materialize(out, df.sparkSession, "clean-stage")

    survivors = out.filter(~F.col("__missing") & ~F.col("__malformed"))
    for c, m in medians(survivors, [c for c in r.median_fills if c in df.columns]).items():
        dtype = df.schema[c].dataType
        if c in r.truncate_fills:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(int(m)).cast(dtype)))
        else:
            out = out.withColumn(c, F.coalesce(nan_to_null(F.col(c).cast("double"), T.DoubleType()), F.lit(float(m))))
    for c, label in r.label_fills.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(label)))

    # without order columns the first row in file order wins (the reference's keep="first")
    winners = _first_ids(survivors, [r.key], r.order_by).withColumn("__won", F.lit(True))
    # both sides grow with the input and every join key is unique
    out = out.join(winners, "__rid", "left").withColumn("__is_first", F.coalesce("__won", F.lit(False)))

    in_range = (
        (F.col(r.quantity_col) > 0) & (F.col(r.price_col) >= 0) & (F.col(r.revenue_col) >= 0)
    )
    lo, hi = r.clip_bounds
    out = out.withColumn(r.discount_col, clip(r.discount_col, lo, hi).cast(df.schema[r.discount_col].dataType))

    domain_ok = F.lit(True)
    for c in r.text_cols:
        if c in r.domains:
            canon = list(r.domains[c]) + ([r.label_fills[c]] if r.keep_fill_labels and c in r.label_fills else [])
            mapping = F.create_map(*[x for v in canon for x in (F.lit(v.strip().upper()), F.lit(v))])
            out = out.withColumn(f"__canon_{c}", F.element_at(mapping, match_key(c)))
            domain_ok = domain_ok & F.col(f"__canon_{c}").isNotNull()
        else:
            out = out.withColumn(c, normalise_label(c))

    reason = (
        F.when(F.col("__malformed"), F.lit(MALFORMED))
        .when(F.col("__missing"), F.lit(MISSING))
        .when(~F.col("__is_first"), F.lit(DUPLICATE))
        .when(~in_range, F.lit(OUT_OF_RANGE))
        .when(~domain_ok, F.lit(INVALID_DOMAIN))
    )
    expected = F.expr(r.expected_revenue) if isinstance(r.expected_revenue, str) else r.expected_revenue
    if expected is None:
        expected = F.col(r.quantity_col) * F.col(r.price_col) * (F.lit(1) - F.col(r.discount_col))
    mismatch = F.abs(F.col(r.revenue_col) - expected) > F.lit(r.revenue_tolerance)
    out = out.withColumn("reject_reason", reason)
    # valid rows carry the domain's spelling; a rejected row keeps the label
    # it arrived with, so the quarantine shows what broke the rule
    for c in r.text_cols:
        if c in r.domains:
            out = out.withColumn(c, F.coalesce(F.col(f"__canon_{c}"), F.col(c))).drop(f"__canon_{c}")
    return out.withColumn("revenue_mismatch", F.when(F.col("reject_reason").isNull(), mismatch)).drop(
        "__missing", "__malformed", "__won", "__is_first", "__rid", "__file", "__split"
    )


def split_labelled(labelled: DataFrame, bad_fields: str = "bad_fields") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of :func:`label_rows`; only rejected rows keep the list of malformed fields."""
    valid = labelled.filter(F.col("reject_reason").isNull()).drop("reject_reason", bad_fields)
    return valid, labelled.filter(F.col("reject_reason").isNotNull()).drop("revenue_mismatch")


def clean_sales(df: DataFrame, rules: CleanRules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, rejected, report) from one labelled plan.

    ``valid`` keeps the input columns (labels in the domain's spelling)
    plus the warn-only ``revenue_mismatch`` flag; ``rejected`` keeps each
    row with the labels it arrived with and its ``reject_reason``;
    ``report`` is :func:`clean_report`.
    """
    labelled = label_rows(df, rules)
    return *split_labelled(labelled, rules.bad_fields), clean_report(labelled, rules.bad_fields)


def clean_report(labelled: DataFrame, bad_fields: str = "bad_fields") -> DataFrame:
    """Rows per stage (N12, A20): input, each reject reason (malformed
    fields only where the reader looked for them), kept, the
    revenue warning, each with its share of the input rounded to 2.

    One aggregate over the labelled rows instead of a count per step."""
    reasons = (MALFORMED, *REASONS) if bad_fields in labelled.columns else REASONS
    counts = labelled.agg(
        F.count(F.lit(1)).alias("input"),
        *[F.count_if(F.col("reject_reason") == F.lit(x)).alias(x) for x in reasons],
        F.count_if(F.col("reject_reason").isNull()).alias("kept"),
        F.count_if(F.col("revenue_mismatch")).alias("revenue_mismatch"),
    )
    stages = ["input", *reasons, "kept", "revenue_mismatch"]
    long = counts.select("input", *[F.col(s).alias(f"s_{s}") for s in stages]).unpivot(
        ["input"], [f"s_{s}" for s in stages], "stage", "row_count"
    )
    pct = F.when(F.col("input") == 0, F.lit(None)).otherwise(
        F.round(F.col("row_count").cast("decimal(20,0)") * 100 / F.col("input"), 2)
    )
    return long.select(
        F.expr("substring(stage, 3)").alias("stage"),
        F.col("row_count").cast("long").alias("row_count"),
        pct.cast("decimal(6,2)").alias("pct_of_input"),
    )


# -- single steps, usable on their own ---------------------------------------


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``dropna(subset=required)``."""
    return df.na.drop(subset=list(required))


def fill_median(df: DataFrame, cols: Sequence[str], truncate: Sequence[str] = ()) -> DataFrame:
    """``fillna(median)`` with the exact median of each column (N3, N4, A18);
    columns in ``truncate`` get ``int(median)`` like ``.astype(int)``. NaN
    counts as missing, as in pandas."""
    out = df
    for c, m in medians(df, cols).items():
        dtype = df.schema[c].dataType
        fill = F.lit(int(m)).cast(dtype) if c in truncate else F.lit(float(m))
        out = out.withColumn(c, F.coalesce(nan_to_null(c, dtype), fill))
    return out


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``fillna(const)`` per column."""
    return df.na.fill(dict(values))


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, else in file order (N6, ``keep="first"``).

    The rows are written once with an id; the winning id of each key is an
    aggregate over (key, order, id) only, and the rows meet the winners on
    the id: whole rows are neither sorted nor gathered by key."""
    from mercato.session import materialize

    rows = df.withColumns({**_file_place(df), "__rid": F.monotonically_increasing_id()})
    rows = materialize(rows, df.sparkSession, "keep-first")
    return rows.join(_first_ids(rows, key, order_by), "__rid", "left_semi").select(*df.columns)


def range_filter(df: DataFrame, condition: Column) -> DataFrame:
    """Keep rows meeting a range conjunction."""
    return df.filter(condition)


def normalise_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``str.strip().str.title()`` on text columns."""
    out = df
    for c in cols:
        out = out.withColumn(c, normalise_label(c))
    return out


def domain_filter(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep rows whose columns are in their domains after normalising both
    sides; matched values take the domain's spelling (N10, F3, X1)."""
    out = df
    for c, values in domains.items():
        mapping = F.create_map(*[x for v in values for x in (F.lit(v.strip().upper()), F.lit(v))])
        out = out.withColumn(c, F.element_at(mapping, match_key(c)))
    cond = F.lit(True)
    for c in domains:
        cond = cond & F.col(c).isNotNull()
    return out.filter(cond)


__all__ = [
    "CleanRules", "label_rows", "clean_sales", "clean_report", "drop_missing", "fill_median",
    "fill_const", "keep_first", "range_filter", "normalise_text", "domain_filter", "strip_all",
]
