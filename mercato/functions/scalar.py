"""Column-expression helpers (all JVM-side built-ins, no Python UDFs).

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
Where pandas or MySQL semantics differ from Spark's default function of
the same name, the helper reproduces the reference behaviour and the
difference is stated in its docstring.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every Unicode whitespace character, Spark's
# trim() only blanks. (?U) turns \s into the Unicode class; \x1c-\x1f are
# the separators Python also treats as whitespace.
_WS = r"[\s\x1c-\x1f]"
_STRIP_PATTERN = rf"(?U)^{_WS}+|{_WS}+$"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column, dtype) -> Column:
    """pandas ``isnull``: null, or NaN for float/double columns (Spark's
    NaN is a value, pandas counts it as missing)."""
    from pyspark.sql import types as T

    col = as_col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def nan_to_null(c: str | Column, dtype) -> Column:
    """NaN -> null for float/double columns (``nanvl``), the value otherwise."""
    from pyspark.sql import types as T

    col = as_col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def strip_all(c: str | Column) -> Column:
    """str.strip(): remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(as_col(c), _STRIP_PATTERN, "")


def title_case(c: str | Column) -> Column:
    """str.title() for words separated by whitespace.

    Spark's initcap capitalises after whitespace only, so ``o'neil`` becomes
    ``O'neil`` where Python gives ``O'Neil``; irrelevant for the closed
    label domains this is used on.
    """
    return F.initcap(F.lower(as_col(c)))


def normalise_label(c: str | Column) -> Column:
    """strip + title case: the reference's text normalisation."""
    return title_case(strip_all(c))


def match_key(c: str | Column) -> Column:
    """Case- and padding-insensitive comparison key (upper(strip(x))).

    Used for domain membership so that ``' cOd '`` matches ``COD`` (fixes
    the title-case/domain mismatch of the reference, X1).
    """
    return F.upper(strip_all(c))


def clip(c: str | Column, lower=None, upper=None) -> Column:
    """pandas ``clip``: bound a value, null stays null.

    A null input matches neither bound and falls through unchanged;
    ``greatest``/``least`` skip nulls, so they are not used bare.
    """
    col = as_col(c)
    out = None
    if lower is not None:
        out = F.when(col < F.lit(lower), F.lit(lower))
    if upper is not None:
        cond = col > F.lit(upper)
        out = F.when(cond, F.lit(upper)) if out is None else out.when(cond, F.lit(upper))
    return col if out is None else out.otherwise(col)


def parse_date(c: str | Column, fmt: str = "M/d/yyyy") -> Column:
    """pandas ``to_datetime(errors="coerce")``: unparsable text gives null.

    ``M/d/yyyy`` accepts ``1/1/2022`` and ``01/01/2022``; plain ``to_date``
    raises under ANSI mode, ``try_to_date`` does not.
    """
    return F.try_to_date(as_col(c), fmt)


def month_key(c: str | Column) -> Column:
    """MySQL ``DATE_FORMAT(d, '%Y-%m')`` (G1)."""
    return F.date_format(as_col(c), "yyyy-MM")


def date_key(c: str | Column) -> Column:
    """``CAST(DATE_FORMAT(d, '%Y%m%d') AS UNSIGNED)``: yyyyMMdd integer.

    Computed arithmetically (no string round trip)."""
    d = as_col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_name(c: str | Column) -> Column:
    """MySQL ``DAYNAME``: full English day name (G4); Spark ``dayname`` is
    the three-letter form."""
    return F.date_format(as_col(c), "EEEE")


def delivery_bucket(days: str | Column, labels: tuple[str, str, str] | None = None) -> Column:
    """CASE bucket of delivery days: <=3, <=7, else.

    The first bucket also catches 0 and negative values, as in the
    reference's CASE. A null day count falls into the last bucket there as
    well (CASE with no match -> ELSE).
    """
    lo, mid, hi = labels or DELIVERY_LABELS
    d = as_col(days)
    return F.when(d <= 3, F.lit(lo)).when(d <= 7, F.lit(mid)).otherwise(F.lit(hi))


# Delivery bucket labels (English renderings of the
# reference's three buckets, in order).
DELIVERY_LABELS = ("1-3 days", "4-7 days", "8+ days")


def money(c: str | Column, precision: int = 38, scale: int = 2) -> Column:
    """Cast a money amount to an exact decimal (P5)."""
    return as_col(c).cast(f"decimal({precision},{scale})")


def isin_normalised(c: str | Column, domain: Iterable[str]) -> Column:
    """Domain membership after normalising both sides."""
    keys = sorted({d.strip().upper() for d in domain})
    return match_key(c).isin(keys)
