"""Every query of the core against its SQL, on the smallest tables."""

import pytest

from helpers import same
from tallyloom.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, oracle, name):
    same(QUERIES[name](spark, SF), oracle.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_the_core_does_without_llm():
    import pathlib

    import tallyloom

    root = pathlib.Path(tallyloom.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert ".llm" not in p.read_text() and "import llm" not in p.read_text(), p
