"""Connector wrappers: the Kafka jar is not on this classpath, so the call
fails at the data source lookup, as documented in README ("Not built")."""

from __future__ import annotations

import pytest

from mercato.sources import connectors


def test_kafka_source_absent_here(spark):
    with pytest.raises(Exception) as err:
        connectors.read_kafka_stream(spark, "localhost:9092", "ad_requests")
    assert "kafka" in str(err.value).lower()
