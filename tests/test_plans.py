"""Physical plans: no nested loops, no Python workers, no cross products."""

import pytest

from checks.registry import ORACLES, QUERIES, Tables
from conftest import SF
from sitegrid.plans.campsites import build_campsites
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.operators.quality import nested_shapes
from sitegrid.operators.inside import with_shape

import __spark_entry__  # noqa: E402


def plans(t):
    return {
        "campsites": build_campsites(t.points, t.polys, t.country_grid),
        "playgrounds": build_playgrounds(t.points, t.lines, t.polys),
        "nested": nested_shapes(with_shape(t.marked)),
    }


@pytest.mark.parametrize("name", ["campsites", "playgrounds", "nested"])
def test_no_loops_and_no_python(spark, name):
    plan = plans(Tables(spark, SF))[name]._jdf.queryExecution().executedPlan().toString()
    for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "InPandas"):
        assert word not in plan


def test_registry_is_complete():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(QUERIES) > 100 and set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == Tables(spark, SF).marked.count()
    assert [t for _, t in df.dtypes if t not in ("string", "bigint", "boolean", "timestamp_ntz")] == []
