from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("MERCATO_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from mercato.session import build_session

    s = build_session("local[8]", app_name="mercato-tests", shuffle_partitions=8)
    yield s
    s.stop()
