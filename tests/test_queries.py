"""Every track query against its SQL at the smallest scale, and what the plans must look like."""

import os

import pytest

from halyard.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(name, spark, against_oracle):
    assert name in registry.ORACLES
    rows = against_oracle(registry.QUERIES[name], registry.ORACLES[name], SF)
    assert rows or name == "objects_by_version"


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 691
    assert {*registry.QUERIES} <= {*__spark_entry__.queries()}
    assert {*__spark_entry__.oracle_sql()} <= {*__spark_entry__.queries()}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_three_exchanges_and_no_python(spark):
    plan = _plan(registry.grid_summaries(spark, SF))
    # the trip's aggregate and both trimming windows use the exchange by trip
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Python" not in plan and "Arrow" not in plan


def test_scan_reads_only_what_is_used(spark):
    plan = _plan(registry.QUERIES["track_grid_500"](spark, SF))
    assert "event_type" not in plan
