"""Every registered query against its SQL oracle (DuckDB) on the small
scale factor; queries without an oracle must at least run."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck
from sensorium.plans import REGISTRY

QUERIES = {k: v for k, v in E.queries().items() if k in REGISTRY}   # the optional ones have tests of their own
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    res = compare(df, con, ORACLE[name])
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["site_name", "TotalReadings", "AnomalyRate", "TotalAlerts", "AlertRate"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_rows_only_queries(spark):
    """The sampling queries have no SQL oracle: check them against their own
    definitions instead."""
    from sensorium.plans.context import Ctx
    ctx = Ctx(spark, SF_SMALL)
    sample = QUERIES["sample_sensors"](spark, SF_SMALL)
    rows = [tuple(r) for r in sample.collect()]
    assert len(rows) == 10 and len(set(rows)) == 10
    assert sample.exceptAll(ctx.sensors).count() == 0                 # drawn from the sensors
    a = sorted(r["ReadingId"] for r in QUERIES["thin_anomalies"](spark, SF_SMALL).collect())
    b = sorted(r["ReadingId"] for r in QUERIES["thin_anomalies"](spark, SF_SMALL).collect())
    anomalies = ctx.readings_plain.where("IsAnomaly").count()
    assert a == b                                                     # replayable
    assert 0 <= len(a) <= anomalies and abs(len(a) - 0.05 * anomalies) <= 4 * (0.05 * anomalies) ** 0.5 + 2
