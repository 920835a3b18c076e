"""Every registered query against its DuckDB twin (sf0.001), and the entry."""

import os

import pytest

import __spark_entry__ as E
from songgraph.plans import registry
from tests.oracle_check import compare, duck

SF = os.environ.get("SONGGRAPH_TEST_SF", "/root/testdata/sf0.001")
# the training-data operators have their own tests
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}
ORACLE = registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, msg = compare(spark, SF, name, QUERIES[name], ORACLE[name], con)
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0 and len(df.columns) > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["req_id", "rank", "song_id", "title", "artist_name", "year",
                          "score", "source"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_bfs_sample_is_subset_of_all_roots(spark):
    sample = {tuple(r) for r in QUERIES["bfs_sample"](spark, SF)
              .select("root", "v", "degree").collect()}
    full = {tuple(r) for r in QUERIES["bfs_multi"](spark, SF)
            .select("root", "v", "degree").collect()}
    roots = {r[0] for r in sample}
    assert len(roots) == 5
    assert sample == {t for t in full if t[0] in roots}
