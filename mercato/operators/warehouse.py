"""Normalised tables and star schema from flat sales rows.

Flat staging rows -> lookups (regions, categories, payment methods) with
surrogate keys -> customers with one region -> normalised orders ->
date dimension + copied dimensions -> fact table -> star report.

Joins against lookups are plain equi-joins: the lookups are tiny and
AQE turns the join into a broadcast hash join from the measured size;
the fact side is never broadcast. The customer join (J3) is
fact-to-dimension on the customer key and shuffles both sides when the
customer table is large.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.scalar import date_key, day_name
from mercato.operators.keys import lasting_keys, with_surrogate_key


def lookup_table(flat: DataFrame, col: str, id_name: str, name_name: str, collation: str | None = None) -> DataFrame:
    """``INSERT INTO lookup(name) SELECT DISTINCT col`` with an
    AUTO_INCREMENT id (D1, A22, D6): one lookup of :func:`lookup_tables`.
    Ids follow the name order (MySQL's is unspecified); a null name is not
    a lookup value (NOT NULL column)."""
    return lookup_tables(flat, {"one": col}, collation).select(
        F.col("id").alias(id_name), F.col("name").alias(name_name)
    )


def _text_key(col, collation: str | None):
    """Comparison key of a text column: the value itself (binary), or the
    value under a collation, e.g. ``UNICODE_CI_AI_RTRIM`` for MySQL's
    case-, accent- and trailing-blank-insensitive equality (X-hard-3)."""
    return F.col(col) if collation is None else F.collate(F.col(col), collation)


def lookup_tables(
    flat: DataFrame, specs: dict[str, str], collation: str | None = None, key_store: str | None = None
) -> DataFrame:
    """Several lookups in one pass (D1, D6): {lookup name: column} ->
    (lookup, id, name) with ids 1..n per lookup in name order. One scan of
    the flat rows and one numbering job instead of one per lookup.

    With a ``collation`` names equal under it are one lookup value, stored
    with the smallest binary spelling among them (MySQL keeps one arbitrary
    spelling). With a ``key_store`` (a folder) ids last: a name that was
    numbered by an earlier load keeps its id, new ones follow
    (:func:`mercato.operators.keys.lasting_keys`); names are compared by bytes."""
    names = flat.select(
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("lookup"), F.col(c).alias("name")) for k, c in specs.items()])
        ).alias("s")
    ).select("s.lookup", "s.name").filter(F.col("name").isNotNull())
    if key_store is not None:
        if collation is not None:
            raise ValueError("lasting keys compare names by bytes")
        return lasting_keys(flat.sparkSession, key_store, names, group_by=["lookup"])
    if collation is None:
        names = names.distinct()
        return with_surrogate_key(names, ["name"], "id", group_by=["lookup"]).select("lookup", "id", "name")
    keyed = names.groupBy("lookup", _text_key("name", collation).alias("__key")).agg(F.min("name").alias("name"))
    return with_surrogate_key(keyed, ["__key"], "id", group_by=["lookup"]).select("lookup", "id", "name")


def customer_region(flat: DataFrame, regions: DataFrame, how: str = "min", collation: str | None = None) -> DataFrame:
    """One region per customer (D2, J1, A10): ``MIN(region)`` per customer
    (the reference's code; its comment says "first seen"), then the
    region name -> ``region_id`` lookup join (under ``collation`` if given)."""
    if how != "min":
        raise ValueError("only the MIN rule is defined")
    per_customer = flat.groupBy("customer_id").agg(F.min(_text_key("region", collation)).alias("region"))
    return per_customer.join(regions, per_customer.region == _text_key("region_name", collation)).select(
        "customer_id", "region_id"
    )


def orders_normalised(
    flat: DataFrame,
    categories: DataFrame,
    payments: DataFrame,
    collation: str | None = None,
    regions: DataFrame | None = None,
) -> DataFrame:
    """Flat rows with names replaced by lookup ids (D3, J2). Inner joins,
    as in the reference; rows whose names miss a lookup are dropped here
    and counted by ``rules.orphans`` (J6). With a ``collation`` the names
    match as MySQL's collation matches them ('Card ' = 'card'). With
    ``regions`` an order also keeps its own region's id (X4)."""
    k = lambda c: _text_key(c, collation)
    rows = flat.join(categories, k("product_category") == k("category_name"))
    rows = rows.join(payments, k("payment_method") == k("method_name"))
    own = []
    if regions is not None:
        rows, own = rows.join(regions, k("region") == k("region_name")), ["region_id"]
    return rows.select(
        "order_id", "order_date", "customer_id", "category_id", "payment_method_id", *own,
        "quantity", "unit_price", "discount", "delivery_days", "customer_rating", "revenue",
    )


def dim_date(orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Date dimension from the dates in use."""
    d = F.col(date_col)
    return (
        orders.select(d.alias("full_date"))
        .filter(F.col("full_date").isNotNull())
        .distinct()
        .select(
            date_key("full_date").alias("date_id"),
            "full_date",
            F.year("full_date").alias("year"),
            F.month("full_date").alias("month"),
            F.quarter("full_date").alias("quarter"),
            day_name("full_date").alias("day_of_week"),
        )
    )


def calendar_dim(orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Gap-free calendar between the first and last date in use (D4
    option): ``explode(sequence(min, max))`` instead of a recursive CTE.
    One row per calendar day, so the size is bounded by the date span."""
    span = orders.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_id"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        day_name("full_date").alias("day_of_week"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame | None) -> DataFrame:
    """Fact rows with ``date_id`` and the customer's ``region_id`` (D7, J3,
    G2), or the order's own one where the orders carry it (X4)."""
    if "region_id" not in orders.columns:
        orders = orders.hint("merge").join(customers, "customer_id")
    return orders.select(
        "order_id",
        date_key("order_date").alias("date_id"),
        "customer_id",
        "category_id",
        "region_id",
        "payment_method_id",
        "quantity", "unit_price", "discount", "delivery_days", "customer_rating", "revenue",
    )


def category_quarter_report(fact: DataFrame, dim_category: DataFrame, dates: DataFrame) -> DataFrame:
    """SUM(revenue) by (category, year, quarter) over the star."""
    return (
        fact.join(dim_category, "category_id")
        .join(dates, "date_id")
        .groupBy("category_name", "year", "quarter")
        .agg(F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"))
        .orderBy("year", "quarter", F.desc("total_revenue"))
    )


# Tables other tables are built from; a stored table also makes every join
# on it a join of two plain scans, where AQE can split a hot key (an
# aggregate on one side of a join would rule that out).
SHARED_TABLES = {"staging", "lookups", "orders", "customers"}


class Warehouse:
    """The normalised set and the star over flat staging rows, each table built when it is first asked for.

    A question about one lookup builds (and writes) that lookup, not the fact
    table. :func:`build_warehouse` has the parameters."""

    TABLES = (
        "regions", "product_categories", "payment_methods", "customers", "orders", "dim_date",
        "dim_customer", "dim_product_category", "dim_region", "dim_payment_method", "fact_orders",
    )

    def __init__(self, flat: DataFrame, persist_to: str | None, persist: str, collation: str | None, region_of: str, key_store: str | None):
        if region_of not in ("customer", "order"):
            raise ValueError("region_of is 'customer' or 'order'")
        self._flat, self._persist_to, self._persist = flat, persist_to, persist
        self._collation, self._region_of, self._key_store = collation, region_of, key_store

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if self._persist_to is None or (self._persist == "shared" and name not in SHARED_TABLES):
            return df
        from mercato.session import materialize

        return materialize(df, df.sparkSession, f"{self._persist_to}-{name}")

    def _lookup(self, name: str, id_name: str, name_name: str) -> DataFrame:
        rows = self.lookups.filter(F.col("lookup") == name)
        return rows.select(F.col("id").alias(id_name), F.col("name").alias(name_name))

    @cached_property
    def staging(self) -> DataFrame:
        return self._keep(self._flat, "staging")

    @cached_property
    def lookups(self) -> DataFrame:
        specs = {"regions": "region", "categories": "product_category", "payments": "payment_method"}
        return self._keep(lookup_tables(self.staging, specs, self._collation, self._key_store), "lookups")

    @cached_property
    def regions(self) -> DataFrame:
        return self._lookup("regions", "region_id", "region_name")

    @cached_property
    def product_categories(self) -> DataFrame:
        return self._lookup("categories", "category_id", "category_name")

    @cached_property
    def payment_methods(self) -> DataFrame:
        return self._lookup("payments", "payment_method_id", "method_name")

    @cached_property
    def customers(self) -> DataFrame:
        return self._keep(customer_region(self.staging, self.regions, collation=self._collation), "customers")

    @cached_property
    def orders(self) -> DataFrame:
        own = self.regions if self._region_of == "order" else None
        return self._keep(
            orders_normalised(self.staging, self.product_categories, self.payment_methods, self._collation, own), "orders"
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._keep(dim_date(self.orders), "dim_date")

    @cached_property
    def fact_orders(self) -> DataFrame:
        customers = self.customers if self._region_of == "customer" else None
        return self._keep(fact_orders(self.orders, customers), "fact_orders")

    @property
    def dim_customer(self) -> DataFrame:
        return self.customers.select("customer_id")

    @property
    def dim_product_category(self) -> DataFrame:
        return self.product_categories.select("category_id", "category_name")

    @property
    def dim_region(self) -> DataFrame:
        return self.regions.select("region_id", "region_name")

    @property
    def dim_payment_method(self) -> DataFrame:
        return self.payment_methods.select("payment_method_id", "method_name")

    def tables(self) -> dict[str, DataFrame]:
        """The normalised and star tables (not the staging input), all built."""
        return {name: getattr(self, name) for name in self.TABLES}


def build_warehouse(
    flat: DataFrame,
    persist_to: str | None = None,
    persist: str = "all",
    collation: str | None = None,
    region_of: str = "customer",
    key_store: str | None = None,
) -> Warehouse:
    """Whole stage: flat staging rows -> normalised set -> star.

    ``flat`` needs the flat sales columns with a unique ``order_id``. With
    ``persist_to`` (a name prefix) tables are written once under the
    session's shared checkpoint folder and read back before the next table
    is derived from them, as the reference inserts into real tables; a
    written table is computed once instead of once per consumer.
    ``persist="all"`` writes every table that is asked for (the ETL);
    ``"shared"`` writes only those that others are built from (staging,
    lookups, orders, customers) and leaves the rest in the consumer's plan (a report).
    ``collation`` makes lookup values, MIN(region) and the name joins
    follow a text collation (e.g. ``UNICODE_CI_AI_RTRIM``) instead of bytes.
    ``region_of="order"`` gives a fact row the region of its own order
    instead of its customer's one (X4). ``key_store`` is a folder that keeps the
    lookups' ids over loads."""
    return Warehouse(flat, persist_to, persist, collation, region_of, key_store)
