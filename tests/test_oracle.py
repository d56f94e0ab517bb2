"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as se
from strata.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF001
from tools.oracle_check import compare, duck_connect, type_mismatches

SQL = dict(ORACLE)          # the library's own; tests/llm has those of the training-data operators
FAST_ROWS_ONLY = {"f9_train_sync_reports", "f11_resume_reports"}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = se.queries()[name](spark, SF001)
    rel = duck.sql(SQL[name])
    assert type_mismatches(sdf.dtypes, rel) == []
    assert compare(sdf.toPandas(), rel.df()) is None


@pytest.mark.parametrize("name", sorted(FAST_ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert se.queries()[name](spark, SF001).count() > 0


def test_entry_schema_stable(spark):
    a = se.entry(spark)
    assert a.columns == ["split", "rows", "loss", "accuracy"]
    rows = a.collect()
    assert sum(r.rows for r in rows) == 1500


def test_every_query_has_a_survey_id():
    import re
    assert set(QUERIES) <= set(se.queries()) and set(ORACLE) <= set(se.oracle_sql())
    for name in QUERIES:
        assert re.match(r"^[a-hu]\d+(_f\d+)?_[a-z0-9_]+$", name), name
