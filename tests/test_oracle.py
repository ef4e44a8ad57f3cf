"""Every query with an oracle matches DuckDB at sf0.001; rows-only queries run."""

import pytest

from revue.oracle_check import compare, duck
from revue.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
FAST_ROWS_ONLY = ["als_predictions", "als_metrics", "als_user_recs", "als_item_recs", "als_subset_recs", "hybrid_recs",
                  "recs_or_popular", "dashboard_recs", "lsh_similar_items"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert r["types_match"], r


@pytest.mark.parametrize("name", FAST_ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
