"""Constraints as data checks.

Spark tables carry no enforced NOT NULL / CHECK / PRIMARY KEY / FOREIGN KEY
constraints, so each DDL constraint of the reference becomes a query that
returns the rows or keys breaking it. All checks are aggregates or
anti-joins; none collects rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = str | Column


def _pred(rule: Rule) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def not_null_rules(cols: Sequence[str]) -> dict[str, Column]:
    """NOT NULL constraints as rules."""
    return {f"{c}_not_null": F.col(c).isNotNull() for c in cols}


def broken(rule: Rule) -> Column:
    """A CHECK is broken only when its predicate is FALSE; NULL passes, as
    in SQL (C2)."""
    return ~F.coalesce(_pred(rule), F.lit(True))


def violations(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """(rule, violations) for every rule, in one aggregate."""
    names = list(rules)
    wide = df.agg(*[F.count_if(broken(rules[n])).alias(f"r_{i}") for i, n in enumerate(names)])
    stack = F.explode(
        F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r_{i}").alias("violations")) for i, n in enumerate(names)])
    )
    return wide.select(stack.alias("s")).select("s.rule", F.col("s.violations").cast("long").alias("violations"))


def first_broken_rule(rules: Mapping[str, Rule]) -> Column:
    """Name of the first broken rule (in the given order), or null."""
    out = None
    for n, r in rules.items():
        out = F.when(broken(r), F.lit(n)) if out is None else out.when(broken(r), F.lit(n))
    return out if out is not None else F.lit(None).cast("string")


def split_by_rules(df: DataFrame, rules: Mapping[str, Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected + ``broken_rule``) (C1, C2 as a quarantine)."""
    labelled = df.withColumn("broken_rule", first_broken_rule(rules))
    return (
        labelled.filter(F.col("broken_rule").isNull()).drop("broken_rule"),
        labelled.filter(F.col("broken_rule").isNotNull()),
    )


def key_violations(df: DataFrame, key: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Keys that break PRIMARY KEY (C3: repeated or null) or, with
    ``allow_null``, UNIQUE (C4: repeated, nulls ignored); (key..., n).

    ``groupBy(key).count()`` aggregates map-side, so a repeated hot key is
    one row per task before the shuffle."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    if allow_null:
        return counted.filter(~any_null & (F.col("n") > 1))
    return counted.filter(any_null | (F.col("n") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: Sequence[str], parent_key: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent.

    A left-anti join: the parent is broadcast when AQE measures it small,
    otherwise both sides shuffle on the key; a hot child key is split by
    AQE's skew handling. A null foreign key is not an orphan (SQL FK)."""
    parent_key = list(parent_key or child_key)
    p = parent.select(*[F.col(pk).alias(f"__p{i}") for i, pk in enumerate(parent_key)])
    cond = None
    for i, ck in enumerate(child_key):
        c = child[ck] == p[f"__p{i}"]
        cond = c if cond is None else cond & c
    not_null = F.lit(True)
    for ck in child_key:
        not_null = not_null & F.col(ck).isNotNull()
    return child.filter(not_null).join(p, cond, "left_anti")


def with_default_timestamp(df: DataFrame, col: str = "loaded_at", now: Column | None = None) -> DataFrame:
    """Column default ``CURRENT_TIMESTAMP`` (C6, G5); ``now`` is injectable."""
    value = now if now is not None else F.current_timestamp()
    if col in df.columns:
        return df.withColumn(col, F.coalesce(F.col(col), value))
    return df.withColumn(col, value)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for a set of frames (V1, U1, A11): one
    aggregate per frame, glued with UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(left: DataFrame, right: DataFrame, left_name: str = "left", right_name: str = "right") -> DataFrame:
    """One row (left_name, left_n, right_name, right_n, ok) (V2)."""
    counts = row_counts({"l": left, "r": right})
    return counts.agg(
        F.max(F.when(F.col("table_name") == "l", F.col("row_count"))).alias("left_n"),
        F.max(F.when(F.col("table_name") == "r", F.col("row_count"))).alias("right_n"),
    ).select(
        F.lit(left_name).alias("left_name"),
        "left_n",
        F.lit(right_name).alias("right_name"),
        "right_n",
        (F.col("left_n") == F.col("right_n")).alias("ok"),
    )
