"""The queries that SQL can state, against DuckDB."""

import pytest

from oracle_compare import compare, duck
from sensorium.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    import __spark_entry__ as E
    numbers = {int(q[2:].split("_")[0]) for q in QUERIES if q != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    result = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert result["ok"], result
