"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import importlib
import sys

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from pedalstrata.verification.oracle import ORACLE
from pedalstrata.verification.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert differences(df, con, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert entry_point.queries().items() >= QUERIES.items()
    assert entry_point.oracle_sql().items() >= ORACLE.items()


def test_entry_works_without_the_training_text_operators(monkeypatch):
    for name in [n for n in sys.modules if n.startswith(("pedalstrata.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "pedalstrata.llm", None)
    alone = importlib.reload(entry_point)
    assert alone.queries() == QUERIES and alone.oracle_sql() == ORACLE
    monkeypatch.undo()
    importlib.reload(entry_point)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


# Row counts of the derived tables at the smallest scale.
COUNTS = {
    "scan_hour_raw": 6000,
    "rollup_day": 2289,
    "dedup_latest_hour": 3906,
    "top1_per_key": 3906,
    "flow_clean_hour": 4251,
    "gold_monthly": 83,
    "demand_by_weather_season": 16,
}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_expected_counts(spark, sf_dir, name):
    assert entry_point.queries()[name](spark, sf_dir).count() == COUNTS[name]


def test_null_cells(spark, sf_dir):
    assert entry_point.queries()["agg_null_cells"](spark, sf_dir).first().n_nulls == 1138
