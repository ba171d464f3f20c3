"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from stormledger.plans.catalogue import CHECKS, QUERIES
from tests.compare import connect, differences

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in plan
    assert differences(df.toPandas(), duck.sql(CHECKS[name]).df()) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def test_period_and_storm_threshold_reach_the_scan(spark, tmp_path):
    from stormledger.operators import cubes, exposure
    from stormledger.operators.filters import Filtro
    from stormledger.plans import fixtures as fx
    from stormledger.plans.fixtures import Data

    d = Data(spark, DATA)
    cubes.monthly_cube(fx.fact_view(d)).write.parquet(str(tmp_path / "cubo"))
    cube = spark.read.parquet(str(tmp_path / "cubo"))
    plan = Filtro(1996, 1997).rows(cube)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(mes,1996-01-01" in plan
    fx.climate_hours(d).write.parquet(str(tmp_path / "clima"))
    clima = spark.read.parquet(str(tmp_path / "clima"))
    plan = exposure.heavy_hours(clima)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(chuva_c,500)" in plan
