import os

import pytest

from catlink.plans import basic_queries, curation_queries, linkage_queries, network_queries, registry, source_queries, text_queries  # noqa: F401
from tests.parity import SF, compare, connection

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, con, name):
    compare(con, registry.QUERIES[name](spark, SF), registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_linkage_places_every_catalog_row_once(spark):
    rows = registry.QUERIES["link_flagship_buckets"](spark, SF).collect()
    assert len({r.row_id for r in rows}) == len(rows)
    assert {r.bucket for r in rows} <= {"matched", "review", "exclude_short", "unmatched"}
    assert all((r.ref_id is None) == (r.bucket == "unmatched") for r in rows)
