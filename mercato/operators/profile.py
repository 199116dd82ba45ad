"""Data profiling (Q1-Q7): overview, nulls, duplicates, negatives,
describe, text domains and a tolerance rule.

Each profile is one aggregate job over the input that returns a
long-form frame (one row per column or per value); nothing is collected
to the driver, so the input size only changes the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.scalar import is_missing
from mercato.operators.quantiles import interpolated, select_ranks, value_of

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """``select_dtypes(include="number")``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """``select_dtypes(include=["object","string"])`` minus ``exclude``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null_count) per column (S13,
    Q1; the ``dtypes`` listing plus pandas ``info()`` counts). Types come
    from the schema, counts from one aggregate over the data."""
    spark = df.sparkSession
    fields = list(enumerate(df.schema.fields, start=1))
    types = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in fields],
        "position int, column_name string, data_type string",
    )
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c_{i}") for i, f in fields])
    long = counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"c_{i}").alias("non_null_count")) for i, _ in fields])
        ).alias("s")
    ).select("s.position", "s.non_null_count")
    return types.join(long, "position").orderBy("position")


def overview(df: DataFrame) -> DataFrame:
    """Row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def nulls(df: DataFrame) -> DataFrame:
    """(column_name, missing_count, missing_pct rounded to 2) for every
    column (Q2, A13); NaN counts as missing in float columns, as in pandas."""
    cols = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(is_missing(c, df.schema[c].dataType)).alias(f"m_{c}") for c in cols],
    )
    # the row count rides along as its own column of the one-row frame
    long = wide.select("__n", *[f"m_{c}" for c in cols]).unpivot(
        ["__n"], [f"m_{c}" for c in cols], "column_name", "missing_count"
    )
    pct = F.when(F.col("__n") == 0, F.lit(None)).otherwise(
        F.round(F.col("missing_count").cast("decimal(20,0)") * 100 / F.col("__n"), 2)
    )
    return long.select(
        F.expr("substring(column_name, 3)").alias("column_name"),
        F.col("missing_count").cast("long").alias("missing_count"),
        pct.cast("decimal(5,2)").alias("missing_pct"),
    )


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Full-row and key duplicate counts as pandas ``duplicated()`` counts
    them (Q3, A14, A15); a null key is a value like any other.

    Equal rows have equal keys, so only rows of a repeated key can be
    duplicates: keys are counted first, and whole rows are grouped only where
    their key occurs more than once (a semi join on the repeated keys). Rows
    of unique keys are never shuffled whole. A key or row that a third of the
    table shares is collapsed in each task before either shuffle."""
    keys = [F.col(f"`{k}`") for k in key]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    none = F.lit(0).cast("long")
    per_key = counted.select(
        F.col("__n").alias("row_count"), none.alias("duplicate_rows"), (F.col("__n") - 1).alias("duplicate_keys")
    )
    repeated = counted.filter("__n > 1").select(*[k.alias(f"__k{i}") for i, k in enumerate(keys)])
    same = [k.eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    suspects = df.join(repeated, same, "left_semi")
    rows = suspects.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__copies"))
    copies = rows.select(none.alias("row_count"), (F.col("__copies") - 1).alias("duplicate_rows"), none.alias("duplicate_keys"))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in per_key.columns]
    return per_key.unionByName(copies).agg(*totals)


def negatives(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, negative_count) for numeric columns with at least one
    negative value (Q4, F7)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    wide = df.agg(*[F.count_if(F.col(c) < 0).alias(f"n_{c}") for c in cols])
    return (
        wide.unpivot([], [f"n_{c}" for c in cols], "column_name", "negative_count")
        .select(F.expr("substring(column_name, 3)").alias("column_name"), F.col("negative_count").cast("long"))
        .filter(F.col("negative_count") > 0)
    )


def describe(df: DataFrame, columns: Sequence[str] | None = None, scale: int = 6) -> DataFrame:
    """pandas ``describe()`` per numeric column, long by column (Q5, A16):
    count, mean, sample std, min, exact 25/50/75 % (linear interpolation),
    max. Values are rounded to ``scale`` decimals."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    dec = f"decimal(38,{scale})"
    moments = (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    aggs = [
        F.round(f(value_of(df, c)), scale).cast(dec).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, f in moments
    ]
    # the moments ride along with the first pass of the rank selection
    counts, found, row = select_ranks(df, cols, [0.25, 0.5, 0.75], aggs)
    rows = [
        (c, counts[c], *[row[f"{name}_{i}"] for name, _ in moments], *[interpolated(counts, found, c, p) for p in (0.25, 0.5, 0.75)])
        for i, c in enumerate(cols)
    ]
    fields = [f"{name} {dec}" for name, _ in moments] + [f"{q} double" for q in ("p25", "p50", "p75")]
    out = df.sparkSession.createDataFrame(rows, f"column_name string, count long, {', '.join(fields)}")
    # every requested column appears, an all-null one with count 0 (as pandas)
    return out.select(
        "column_name", "count", "mean", "std", "min",
        *[F.round(q, scale).cast(dec).alias(q) for q in ("p25", "p50", "p75")], "max",
    )


def distinct_values(df: DataFrame, exclude: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value, n) for every text column minus ``exclude``.

    Long form with counts instead of one ``collect_set`` array per column,
    so a wide domain stays a distributed frame."""
    cols = list(columns) if columns is not None else text_columns(df, exclude)
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in cols])).alias("s")
    ).select("s.column_name", "s.value")
    return stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def rule_check(df: DataFrame, actual: Column, expected: Column, tolerance: float) -> DataFrame:
    """Tolerance rule |actual - expected| > t (Q7, P8, F6, A19):
    (checked_rows, mismatch_rows, tolerance) in one aggregate."""
    diff = F.abs(actual - expected)
    return df.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(diff > F.lit(tolerance)).alias("mismatch_rows"),
    ).withColumn("tolerance", F.lit(tolerance).cast("double"))


def rule_offenders(
    df: DataFrame, actual: Column, expected: Column, tolerance: float, key: Sequence[str], n: int = 5
) -> DataFrame:
    """The first ``n`` offenders of a tolerance rule, by key (Q7 ``.head()``)."""
    diff = F.abs(actual - expected)
    return df.filter(diff > F.lit(tolerance)).withColumn("abs_diff", diff).orderBy(*key).limit(n)
