"""Every registered query against its DuckDB oracle (exact values).

Runs on sf0.001 by default; set MERCATO_TEST_SF=/root/testdata/sf0.01 for
the driver's scale.
"""

from __future__ import annotations

import pytest

from mercato.plans.oracle_check import check
from mercato.plans.registry import all_queries

from .conftest import SF_ORACLE

NAMES = sorted(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = check(spark, SF_ORACLE, {name}, verbose=False)[name]
    assert res[0] in ("OK", "ROWS_ONLY"), res


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["product_category", "total_revenue", "order_count"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
