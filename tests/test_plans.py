"""Physical plans, and agreement of all registered queries with their SQL."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tripspark.operators import insights
from tripspark.plans import proxy, registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join(spark, sf):
    for name in ("trip_features", "insight_geo", "fs_mutual_information", "gap_clamp",
                 "insight_fuel_by_type", "profile_numeric_quantiles", "filter_quantile_trim"):
        text = plan(queries()[name](spark, sf))
        assert "EvalPython" not in text and "PythonRunner" not in text, name
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name


def test_trip_statistics_are_combined_before_the_shuffle(spark, sf):
    text = plan(registry.trip_table(spark, sf))
    assert "partial_percentile_approx" in text and "partial_max_by" in text
    # Windows run over a minute, over one row per minute of a day, and over one row per day.
    windows = re.findall(r"windowspecdefinition\(([^)]*)\)", text)
    assert ["_part" in keys for keys in dict.fromkeys(windows)].count(False) == 1
    assert "Exchange SinglePartition" not in text


def test_insights_read_only_their_columns(spark, sf):
    text = plan(insights.fuel_by_speed_bin(proxy.telemetry(spark, sf)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "user_id" not in schema and "ts" not in [c.split(":")[0] for c in schema.split(",")]


def test_telemetry_is_not_shuffled_for_the_vehicle_join(spark, sf):
    text = plan(queries()["enrich_telemetry"](spark, sf))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "fuel_l_per_100km" in df.columns


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in queries() if n in oracle_sql()])
def test_query_agrees_with_sql(spark, con, sf, name):
    problem, _ = compare(spark, con, name, sf)
    assert problem is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_query_without_sql_gives_rows(spark, con, sf, name):
    problem, _ = compare(spark, con, name, sf)
    assert problem is None
