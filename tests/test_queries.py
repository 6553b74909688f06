"""Every query against its SQL in DuckDB; those without SQL must give rows."""

import pytest
from compare import connect, difference
from conftest import SF

import __spark_entry__ as entry_point
from patronage.plans import catalogue

ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in catalogue.QUERIES}
# checked from the base tables, not from the stored log and mart
WHOLE_PATH = {"g8_segment_values", "p4_line_amount", "w1_ntile_scores"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture()
def stored_stages(monkeypatch, stored_log, stored_mart):
    monkeypatch.setattr(catalogue, "transaction_log", lambda _spark, _d: stored_log)
    monkeypatch.setattr(catalogue, "mart", lambda _spark, _d: stored_mart)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(WHOLE_PATH))
def test_from_base_tables(name, spark, con):
    assert difference(catalogue.QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(ORACLE) - WHOLE_PATH))
def test_against_sql(name, spark, con, stored_stages):
    assert difference(catalogue.QUERIES[name](spark, SF), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(ORACLE)))
def test_gives_rows(name, spark, stored_stages):
    assert catalogue.QUERIES[name](spark, SF).collect()


def test_entry(spark):
    assert len(entry_point.entry(spark).collect()) == 7


def test_comparison_notices_a_wrong_value(spark, con, stored_stages):
    wrong = ORACLE["d2_exact_duplicates"].replace(" AS n_duplicates", " + 1 AS n_duplicates")
    assert difference(catalogue.QUERIES["d2_exact_duplicates"](spark, SF), con, wrong) is not None
