"""Shape of the physical plans."""

import re

from tripweave import engine
from tripweave.plans import fleet

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trips_and_events_need_one_exchange(spark):
    tel = fleet.telemetry(spark, SF)
    for df in (engine.trips(tel), engine.events(tel)):
        plan = plan_of(df)
        assert len(re.findall(r"Exchange", plan)) == 1, plan
        assert "hashpartitioning(vin" in plan
        assert "Python" not in plan and "ArrowEval" not in plan


def test_trips_read_no_flags_and_no_positions(spark):
    plan = plan_of(engine.trips(fleet.telemetry(spark, SF)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in schema


def test_vehicle_filter_reaches_the_scan(spark, tmp_path):
    from tripweave.sources.telemetry import normalize

    path = str(tmp_path / "telemetry")
    fleet.telemetry(spark, SF).drop("tie").write.parquet(path)
    df = engine.trips(normalize(spark.read.parquet(path)), hot_rows=None).filter("vin = 'V7'")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(vin,V7\)", plan_of(df))
