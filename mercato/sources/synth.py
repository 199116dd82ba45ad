"""Synthetic sales rows and ad-request events at any scale.

The reference generates rows in a single Python loop. Here every row is
a pure function of its id: uniform draws come from ``xxhash64(seed,
field, id)``, weighted choices from a CASE over cumulative weights. The
ids come from any DataFrame (a table's key column or ``spark.range``),
so generation is partitioned like its input and re-running a lost task
reproduces the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Generator parameters of the reference's large sales file.
CATEGORIES = (("Beauty", 0.30), ("Clothing", 0.40), ("Electronics", 0.30))
REGIONS = (("North", 0.28), ("South", 0.27), ("East", 0.23), ("West", 0.22))
PAYMENTS = (("Wallet", 0.55), ("Card", 0.45))
DATE_START, DATE_END = "2022-01-01", "2035-12-31"
CUSTOMER_RANGE = (1000, 50000)
QUANTITY_RANGE = (1, 10)
PRICE_RANGE = (10.0, 600.0)
DISCOUNT_RANGE = (0.0, 0.4)
DELIVERY_RANGE = (1, 14)
RATING_RANGE = (1.0, 5.0)

# Generator parameters of the reference's ad-request producer.
RESPONSE_CODES = ((200, 0.85), (204, 0.05), (400, 0.03), (404, 0.03), (500, 0.03), (503, 0.01))
PUBLISHERS = 10
ADS = 50
USERS = 20000
SLOW_CODES = (500, 503)
SLOW_LATENCY = (800, 3000)
FAST_LATENCY = (20, 300)

_SCALE = 1 << 53


def uniform(seed: int, field: str, id_col: Column) -> Column:
    """Deterministic U[0,1) draw per (seed, field, id)."""
    h = F.xxhash64(F.lit(seed), F.lit(field), id_col)
    return F.pmod(h, F.lit(_SCALE)).cast("double") / float(_SCALE)


def uniform_int(seed: int, field: str, id_col: Column, lo: int, hi: int) -> Column:
    """Deterministic integer in [lo, hi] (like ``random.randint``)."""
    return (F.floor(uniform(seed, field, id_col) * (hi - lo + 1)) + lo).cast("int")


def weighted_choice(seed: int, field: str, id_col: Column, choices) -> Column:
    """One value per row drawn with the given weights (``random.choices``)."""
    u = uniform(seed, field, id_col)
    total = sum(w for _, w in choices)
    acc = 0.0
    expr = None
    for value, w in choices[:-1]:
        acc += w / total
        expr = F.when(u < acc, F.lit(value)) if expr is None else expr.when(u < acc, F.lit(value))
    last = F.lit(choices[-1][0])
    return last if expr is None else expr.otherwise(last)


def synth_sales(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Flat sales rows, one per input id (S14): weighted labels, uniform
    measures, revenue = round(q x p x (1 - d), 2)."""
    i = F.col(id_col)
    span = F.datediff(F.lit(DATE_END).cast("date"), F.lit(DATE_START).cast("date"))
    day = F.floor(uniform(seed, "date", i) * (span + 1)).cast("int")
    q = uniform_int(seed, "quantity", i, *QUANTITY_RANGE)
    p = F.round(F.lit(PRICE_RANGE[0]) + uniform(seed, "price", i) * (PRICE_RANGE[1] - PRICE_RANGE[0]), 2)
    d = F.round(F.lit(DISCOUNT_RANGE[0]) + uniform(seed, "discount", i) * (DISCOUNT_RANGE[1] - DISCOUNT_RANGE[0]), 2)
    return ids.select(
        i.cast("long").alias("order_id"),
        F.date_add(F.lit(DATE_START).cast("date"), day).alias("order_date"),
        uniform_int(seed, "customer", i, *CUSTOMER_RANGE).alias("customer_id"),
        weighted_choice(seed, "category", i, CATEGORIES).alias("product_category"),
        weighted_choice(seed, "region", i, REGIONS).alias("region"),
        q.alias("quantity"),
        p.cast("decimal(10,2)").alias("unit_price"),
        d.cast("decimal(4,2)").alias("discount"),
        weighted_choice(seed, "payment", i, PAYMENTS).alias("payment_method"),
        uniform_int(seed, "delivery", i, *DELIVERY_RANGE).alias("delivery_days"),
        F.round(F.lit(RATING_RANGE[0]) + uniform(seed, "rating", i) * (RATING_RANGE[1] - RATING_RANGE[0]), 1)
        .cast("decimal(3,1)")
        .alias("customer_rating"),
        (q.cast("decimal(10,0)") * p.cast("decimal(10,2)") * (F.lit(1) - d.cast("decimal(4,2)")))
        .cast("decimal(12,2)")
        .alias("revenue"),
    )


def synth_events(ids: DataFrame, id_col: str = "id", time_col: str | None = None, seed: int = 42) -> DataFrame:
    """Ad-request events, one per input id (S15): weighted response codes,
    latency 800-3000 ms for 500/503 and 20-300 ms otherwise. The request id
    is a hash of the id (deterministic, unlike ``uuid4``)."""
    i = F.col(id_col)
    code = weighted_choice(seed, "code", i, RESPONSE_CODES)
    slow = code.isin(list(SLOW_CODES))
    latency = F.when(slow, uniform_int(seed, "slow", i, *SLOW_LATENCY)).otherwise(
        uniform_int(seed, "fast", i, *FAST_LATENCY)
    )
    ts = F.col(time_col) if time_col else F.current_timestamp()
    return ids.select(
        F.sha2(F.concat_ws(":", F.lit(seed), i.cast("string")), 256).substr(1, 32).alias("request_id"),
        ts.alias("timestamp"),
        F.concat(F.lit("publisher_"), uniform_int(seed, "publisher", i, 1, PUBLISHERS)).alias("publisher_id"),
        F.concat(F.lit("ad_"), uniform_int(seed, "ad", i, 1, ADS)).alias("ad_id"),
        F.concat(F.lit("user_"), uniform_int(seed, "user", i, 1, USERS)).alias("user_id"),
        code.cast("int").alias("response_code"),
        latency.alias("response_time_ms"),
    )
