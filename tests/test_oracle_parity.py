"""Every registered report, batch or streaming, equals its DuckDB oracle (sf0.001)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck

from __spark_entry__ import oracle_sql, queries
from urbanpulse.plans.registry import all_reports

# Reports of this package; the training-data queries have tests of their own.
NAMES = sorted(all_reports())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_report_has_a_callable_and_an_oracle():
    assert set(oracle_sql()) <= set(queries())
    assert set(NAMES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_report_matches_oracle(spark, con, name):
    status = compare(spark, SF_SMALL, [name], con=con, verbose=False)[name]
    assert status[0] == "OK", status


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns[:3] == ["road_id", "road_type", "speed_limit_kmh"]
    assert df.count() == 5
