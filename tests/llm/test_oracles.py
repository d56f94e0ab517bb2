"""The operators that SQL can express, against DuckDB; and what is registered."""

import pytest

import __spark_entry__ as se
from strata.llm.queries import ORACLE, QUERIES
from tests.conftest import SF001
from tools.oracle_check import compare, duck_connect, type_mismatches


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    got, rel = QUERIES[name](spark, SF001), duck_connect(SF001).sql(ORACLE[name])
    assert type_mismatches(got.dtypes, rel) == []
    assert compare(got.toPandas(), rel.df()) is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(se.queries())
    assert set(ORACLE) <= set(se.oracle_sql())
