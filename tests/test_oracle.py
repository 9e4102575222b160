"""Every registered query equals its DuckDB oracle on sf0.001 (row count + multiset of rows)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import digest
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_reference_query_has_an_oracle():
    own = set(E._plans.queries())
    assert own <= set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Cluster_ID", "Cluster_Description", "Refset_ID", "SNOMED_concept_ID", "Outcome"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    o_cols, o_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(c.lower() for c in s_cols) == sorted(c.lower() for c in o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]
