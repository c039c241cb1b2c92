"""The driver contract: entry smoke, and every registered query against its oracle."""

import pytest

import __spark_entry__ as E
from quayside.plans import catalogue
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck_connect


def session_state(spark):
    return {t.name for t in spark.catalog.listTables() if t.isTemporary}, dict(spark.conf.getAll)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["effective_date", "source_count", "target_count", "is_match"]
    rows = df.collect()
    assert rows and all(r.is_match for r in rows)


def test_every_query_has_an_oracle_or_is_declared():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"anomaly_learned"}  # a learned score: tests/test_isolation.py


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, name):
    con = duck_connect(SF_SMALL)
    before = session_state(spark)
    res = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, con)
    assert res["status"] in ("ok", "rows-only"), res
    assert session_state(spark) == before  # no view and no setting is left in the caller's session
