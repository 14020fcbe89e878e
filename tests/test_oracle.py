"""Every query with an SQL check, on the smallest tables, against the other engine."""

import pytest

import __spark_entry__ as entry
import compare

# Streams take long; the stream tests cover their parts.
SLOW = {n for n in entry.queries() if n.endswith("_stream") or n == "alerts_stream_model"}


@pytest.fixture(scope="module")
def engine(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_equals_its_check(spark, engine, sf, name):
    ok, _, _, note = compare.compare(spark, engine, name, sf)
    assert ok, note


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 30 and sum(r["alert"] for r in rows) == 12
