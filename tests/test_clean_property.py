"""Property test: the Spark cleaning plan against a model over row tuples.

(with this build's decisions X1, X2, X11). The plan must give every row the
same reason and every kept row the same cleaned values.
"""

from __future__ import annotations

import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mercato.operators import clean
from mercato.sources.files import SALES_CSV_SCHEMA

DOMAINS = {
    "product_category": ("Beauty", "Clothing", "Electronics"),
    "region": ("North", "South"),
    "payment_method": ("Wallet", "Card", "COD"),
}
RULES = clean.CleanRules(order_by=("seq",), domains=DOMAINS)
REQUIRED = list(RULES.required)
SCHEMA = "seq long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SALES_CSV_SCHEMA.fields)

maybe = lambda s: st.one_of(st.none(), s)
dec = lambda lo, hi, places: st.integers(lo, hi).map(lambda v: Decimal(v).scaleb(-places))

row = st.tuples(
    st.integers(1, 6),                                               # order_id: repeats
    maybe(st.sampled_from(["1/2/2022", "12/31/2023", "02/03/2022", "13/1/2022", "x"])),
    maybe(st.integers(1, 3)),
    maybe(st.sampled_from(["Beauty", " clothing ", "ELECTRONICS", "Home", "\tbeauty"])),
    maybe(st.sampled_from(["North", "south", "West"])),
    maybe(st.integers(-1, 3)),
    maybe(dec(-100, 500, 2)),
    maybe(dec(-50, 150, 2)),
    maybe(st.sampled_from(["Card", " cOd ", "wallet", "Cash"])),
    maybe(st.integers(0, 9)),
    maybe(dec(10, 50, 1)),
    maybe(dec(-100, 900, 2)),
)


FIELD = {f.name: i for i, f in enumerate(SALES_CSV_SCHEMA.fields)}
DATE = re.compile(r"(1[0-2]|0?[1-9])/(3[01]|[12][0-9]|0?[1-9])/[0-9]{4}")


def middle(values):
    """Median with linear interpolation; None without values."""
    v = sorted(values)
    return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None


def model(rows: list[tuple]) -> tuple[dict, dict]:
    """Expected reason per seq and cleaned values per kept seq, from the rules' definitions."""
    get = lambda seq, name: rows[seq][FIELD[name]]

    def complete(seq):
        return all(get(seq, c) is not None for c in REQUIRED) and bool(DATE.fullmatch(get(seq, "order_date")))

    present = [s for s in range(len(rows)) if complete(s)]
    leader = {}
    for s in present:
        leader.setdefault(get(s, "order_id"), s)
    rating = middle([float(get(s, "customer_rating")) for s in present if get(s, "customer_rating") is not None])
    days = middle([get(s, "delivery_days") for s in present if get(s, "delivery_days") is not None])

    def label(seq, column):
        """The domain's spelling of a row's label, or None."""
        known = [*DOMAINS[column], *(["Unknown"] if column == "payment_method" else [])]
        text = get(seq, column)
        if text is None:
            text = "Unknown" if column == "payment_method" else ""
        return next((k for k in known if k.upper() == text.strip().upper()), None)

    reason, kept = {}, {}
    for s in range(len(rows)):
        if s not in present:
            reason[s] = "missing_required"
        elif leader[get(s, "order_id")] != s:
            reason[s] = "duplicate_key"
        elif get(s, "quantity") <= 0 or get(s, "unit_price") < 0 or get(s, "revenue") < 0:
            reason[s] = "out_of_range"
        elif None in (labels := [label(s, c) for c in DOMAINS]):
            reason[s] = "invalid_domain"
        else:
            own_rating, own_days = get(s, "customer_rating"), get(s, "delivery_days")
            kept[s] = (
                *labels,
                min(max(get(s, "discount"), Decimal(0)), Decimal(1)),
                rating if own_rating is None else float(own_rating),
                own_days if own_days is not None else None if days is None else int(days),
            )
    return reason, kept


def _num(v):
    """A rating as float, or None when missing (no median to fill from)."""
    return None if v is None or v != v else float(v)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_clean_matches_model(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    labelled = clean.label_rows(df, RULES).collect()
    want_reason, want_kept = model(rows)
    got_reason = {r["seq"]: r["reject_reason"] for r in labelled if r["reject_reason"] is not None}
    assert got_reason == want_reason
    got_kept = {
        r["seq"]: (
            r["product_category"], r["region"], r["payment_method"], r["discount"],
            _num(r["customer_rating"]), r["delivery_days"],
        )
        for r in labelled if r["reject_reason"] is None
    }
    assert got_kept.keys() == want_kept.keys()
    for s, got in got_kept.items():
        want = want_kept[s]
        assert got[:4] == want[:4], (s, got, want)
        assert (got[4] is None and want[4] is None) or abs(got[4] - want[4]) < 1e-9, (s, got, want)
        assert got[5] == want[5], (s, got, want)
