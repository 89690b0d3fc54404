"""The keyed stream against the incremental batch step."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from brute import SHORT, fleet, telemetry
from pyspark.sql import functions as F

from tripweave import engine, schemas
from tripweave import profiles as P
from tripweave.session import scratch_dir
from tripweave.functions.expressions import trip_id
from tripweave.sinks.merge import latest, merge_writer, read_merged, unseen, within
from tripweave.sinks.tables import csv_stream, file_writer, split_tables
from tripweave.sources import streams
from tripweave.sources.telemetry import judged, normalize, renamed
from tripweave.streaming.bounded import BoundedRuns
from tripweave.streaming.job import TRIGGERS, JobConfig, checkpoint_path, run_trip_job, start, state_root
from tripweave.streaming.trips import open_trips, trip_stream

SHAPE = ("trip_id", "row_type", "trip_type", "unix_micros(start_time)", "unix_micros(end_time)", "max_speed",
         "round(avg_speed, 6)", "start_lon", "start_lat", "end_lon", "end_lat")
DDL = "n long, vin string, timestamp timestamp, " + ", ".join(
    f"{c} {'double' if k in ('speed', 'lon', 'lat') else 'int'}" for k, c in SHORT.items()
)


def tuples(results):
    return sorted((tuple(r) for r in results.selectExpr(*SHAPE).collect()), key=str)


def files(spark, rows, parts, seed):
    """The rows in files of consecutive stretches, shuffled inside; file order by name."""
    folder = f"{scratch_dir(spark)}/in"
    order = sorted(range(len(rows)), key=lambda i: rows[i]["ts"])
    size = -(-len(order) // parts)
    for p in range(parts):
        chosen = order[p * size : (p + 1) * size]
        random.Random(seed + p).shuffle(chosen)
        data = [(i, rows[i]["vin"], rows[i]["ts"].replace(tzinfo=timezone.utc), *[rows[i].get(k) for k in SHORT]) for i in chosen]
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(folder)
    return folder


@pytest.mark.parametrize("parts", [1, 3])
def test_bounded_runs_equal_the_keyed_stream(spark, parts):
    """Several data batches, with late rows, ties and vehicles that fall silent; a repeated batch replaces itself."""
    rows = fleet(seed=31 + parts, vehicles=8, rows=40)
    folder = files(spark, rows, parts, 5)
    out = scratch_dir(spark)
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out))
    raw = lambda: normalize(streams.parquet_stream(spark, folder, DDL), tie="n")
    start(raw(), "offline", config).awaitTermination()
    running = start(raw(), "realtime", config)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    for table in (config.trips_table, config.events_table):
        written = spark.read.parquet(f"{out}/{table}").withColumn("row_type", F.lit("x"))
        offline, realtime = (tuples(written.filter(F.col("job") == mode)) for mode in ("offline", "realtime"))
        assert offline == realtime and len(offline) > 10


def test_both_modes_go_on_from_carried_state(spark):
    """A run to the middle and a stream of the rest give what one run gives, and leave the same trips open."""
    rows = fleet(seed=53, vehicles=10, rows=40)
    cut = sorted(r["ts"] for r in rows)[len(rows) // 2]
    first, rest = [r for r in rows if r["ts"] < cut], [r for r in rows if r["ts"] >= cut]
    out = scratch_dir(spark)
    step = engine.step(None, telemetry(spark, first))
    step.carry.write.parquet(f"{out}/carry")
    carried = spark.read.parquet(f"{out}/carry")
    assert carried.filter("phase = 'HANG_OFF'").count() and carried.filter("size(open_events) > 0").count()
    before = tuples(engine.result_rows(step.trips, step.events))
    watermark = max(r["ts"] for r in rows) - timedelta(minutes=10)
    watermark = watermark.replace(microsecond=watermark.microsecond // 1000 * 1000)
    seen = telemetry(spark, rows).filter(F.col(P.TIMESTAMP) <= F.lit(watermark.replace(tzinfo=timezone.utc)))
    whole = engine.step(None, seen, now=watermark)
    want = tuples(engine.result_rows(whole.trips, whole.events))
    folder = files(spark, rest, 2, 3)
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out), carry=f"{out}/carry")
    for mode in ("offline", "realtime"):
        query = start(normalize(streams.parquet_stream(spark, folder, DDL), tie="n"), mode, config)
        query.awaitTermination() if mode == "offline" else query.processAllAvailable()
        query.stop()
        trips = spark.read.parquet(f"{out}/{config.trips_table}").withColumn("row_type", F.lit("TRIP"))
        events = spark.read.parquet(f"{out}/{config.events_table}").withColumn("row_type", F.lit("EVENT"))
        found = trips.unionByName(events).filter(F.col("job") == mode)
        assert sorted(before + tuples(found), key=str) == want
    state = ("vin", "phase", "trip_type", "trip_start", "hang_start", "last_ts", "last_speed_ts", "round(speed_sum, 6)", "speed_weight",
             "speed_max", "end_lon", "end_lat", "array_sort(map_entries(open_events))")
    shown = lambda carry: sorted(map(str, carry.selectExpr(*state).collect()))
    left = shown(open_trips(spark, checkpoint_path(config, "realtime")))
    assert left and left == shown(whole.carry.withColumn("open_events", F.expr("coalesce(open_events, map())")))


def test_a_repeated_bounded_batch_and_its_plan(spark):
    rows = telemetry(spark, fleet(seed=77, vehicles=6, rows=40)).persist()
    cut = rows.selectExpr("percentile_approx(timestamp, 0.5)").first()[0]
    early, late = rows.filter(F.col(P.TIMESTAMP) <= F.lit(cut)), rows.filter(F.col(P.TIMESTAMP) > F.lit(cut))
    seen = {}

    def on_results(results, batch_id):
        plan = results._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
        seen.setdefault(batch_id, []).append(tuples(results))

    runs = BoundedRuns(scratch_dir(spark), on_results)
    for batch, batch_id in ((early, 0), (early, 0), (late, 1), (late, 1), (early.limit(0), 2)):
        runs(batch, batch_id)
    assert seen[0][0] == seen[0][1] and seen[1][0] == seen[1][1] and seen[2] == [[]]
    passed = max(r[P.TIMESTAMP] for r in rows.collect()) - timedelta(minutes=10)
    whole = engine.step(None, rows.filter(F.col(P.TIMESTAMP) <= F.lit(passed)), now=passed.replace(tzinfo=None))
    shape = lambda found: sorted(str(r[:5]) for r in found)  # noqa: E731  the first run's timeouts have no closing row
    assert shape(seen[0][0] + seen[1][0]) == shape(tuples(engine.result_rows(whole.trips, whole.events)))


@pytest.mark.parametrize("mode", ["offline", "realtime"])
def test_both_modes_write_rejected_rows(spark, mode):
    good = [f'{{"vin":"V","report_time":"2026-01-01T08:{m:02d}:00Z","vehicle_status":2,"speed":{m}.5}}' for m in range(0, 50, 10)]
    bad = ["{broken", '{"report_time":"2026-01-01T08:00:00Z","speed":1.0}', '{"vin":"W","speed":2.0}']
    folder, out = f"{scratch_dir(spark)}/wire", scratch_dir(spark)
    spark.createDataFrame([(t,) for t in good + bad], "json_str string").coalesce(1).write.parquet(folder)
    text = streams.table_stream(spark, folder, "parquet", "json_str string")
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out))
    query = start(judged(renamed(streams.decode_json(text), schemas.WIRE_MAPPING)), mode, config)
    query.processAllAvailable() if mode == "realtime" else query.awaitTermination()
    query.stop()
    found = spark.read.parquet(f"{out}/{config.rejected_table}").select("vin", "reason", "speed", "content", "job").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(None, "broken text", 0.0, "{broken", mode), (None, "no vehicle", 1.0, None, mode), ("W", "no time", 2.0, None, mode)], key=str
    )
    assert "content" not in spark.read.parquet(f"{out}/{config.events_table}").columns


@pytest.mark.parametrize("parts,profile", [(1, P.UNIFIED), (3, P.UNIFIED.but(close_coords="at_end"))])
def test_stream_equals_step(spark, parts, profile):
    rows = fleet(seed=21 + parts, vehicles=8, rows=40)
    raw = streams.parquet_stream(spark, files(spark, rows, parts, 7), DDL)
    out = scratch_dir(spark)
    query = (
        trip_stream(normalize(raw, tie="n"), profile)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    watermark = max(r["ts"] for r in rows) - timedelta(minutes=10)
    watermark = watermark.replace(microsecond=watermark.microsecond // 1000 * 1000)
    seen = telemetry(spark, rows).filter(F.col(P.TIMESTAMP) <= F.lit(watermark.replace(tzinfo=timezone.utc)))
    step = engine.step(None, seen, now=watermark, profile=profile)
    want = tuples(engine.result_rows(step.trips, step.events))
    assert tuples(spark.read.schema(schemas.RESULT).parquet(f"{out}/rows")) == want and len(want) > 50


def test_state_is_kept_by_group_of_vehicles(spark):
    """A batch writes a part of each group and slice and a timer of each group, however many vehicles it has."""
    rows = fleet(seed=5, vehicles=60, rows=12)
    raw = streams.parquet_stream(spark, files(spark, rows, 3, 7), DDL)
    out, groups = scratch_dir(spark), 3
    query = (
        trip_stream(normalize(raw, tie="n"), slice_seconds=10**9, groups=groups)
        .writeStream.format("parquet")
        .option("path", f"{out}/rows")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    first = query.recentProgress[0]
    assert first["numInputRows"] == -(-len(rows) // 3)
    assert 0 < first["stateOperators"][0]["numRowsUpdated"] <= 3 * groups  # the timer is stored by group and by time
    watermark = max(r["ts"] for r in rows) - timedelta(minutes=10)
    watermark = watermark.replace(microsecond=watermark.microsecond // 1000 * 1000)
    seen = telemetry(spark, rows).filter(F.col(P.TIMESTAMP) <= F.lit(watermark.replace(tzinfo=timezone.utc)))
    step = engine.step(None, seen, now=watermark)
    shape = lambda found: sorted(str(r[:7]) for r in found)  # noqa: E731  a trip ended by a batch's watermark has no closing row
    assert shape(tuples(spark.read.schema(schemas.RESULT).parquet(f"{out}/rows"))) == shape(tuples(engine.result_rows(step.trips, step.events)))
    held = open_trips(spark, f"{out}/checkpoint").select("vin", "trip_start", "speed_sum").collect()
    assert sorted(map(str, held)) == sorted(map(str, step.carry.select("vin", "trip_start", "speed_sum").collect())) and held


def test_two_tables_late_rows_and_timeouts(spark):
    """Micro-batches in order; a row behind the watermark is dropped, silence ends a trip."""
    base = datetime(2026, 10, 1, 8)

    def row(vin, minute, power, speed):
        return dict(vin=vin, ts=base + timedelta(minutes=minute), power=power, speed=float(speed), lon=5.0, lat=6.0)

    batches = [
        [row("A", 0, 2, 30), row("A", 5, 2, 15), row("B", 0, 2, 50), row("B", 5, 0, 0)],
        [row("B", 13, 2, 30), row("B", 20, 0, 0)],
        [row("PUSH", 60, 2, 60)],
        [row("A", 10, 2, 99), row("PUSH", 120, 0, 0)],
    ]
    folder = f"{scratch_dir(spark)}/in"
    for n, batch in enumerate(batches):
        data = [(n, r["vin"], r["ts"].replace(tzinfo=timezone.utc), *[r.get(k) for k in SHORT]) for r in batch]
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(folder)
    raw = streams.parquet_stream(spark, folder, DDL, options={"latestFirst": "false"})
    out = scratch_dir(spark)
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out), delay="5 minutes")
    query = start(normalize(raw, tie="n"), "offline", config)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    trips = spark.read.parquet(f"{out}/ads_trip_summary")
    assert "row_type" not in trips.columns
    found = trips.filter("vin <> 'PUSH'").selectExpr(
        "vin", "trip_type", "date_format(start_time, 'HH:mm')", "date_format(end_time, 'HH:mm')", "max_speed", "round(avg_speed, 6)"
    )
    assert sorted(tuple(r) for r in found.collect()) == [
        ("A", "DRIVING", "08:00", "08:05", 30.0, 25.0),
        ("B", "DRIVING", "08:00", "08:20", 50.0, round(160 / 6, 6)),
    ]
    events = spark.read.parquet(f"{out}/ads_trip_event_detail")
    low = events.filter("vin = 'A' AND trip_type = 'LOW_SPEED_EVENT'").first()
    assert (low.end_lon, low.end_lat) == (0.0, 0.0)
    assert events.join(trips, "trip_id", "left_anti").isEmpty()


def test_state_lives_on_between_bounded_runs(spark):
    """Each run reads the new files only and goes on from the checkpoint."""
    base = datetime(2026, 10, 1, 8)

    def put(folder, n, *rows):
        data = [(n, vin, (base + timedelta(minutes=m)).replace(tzinfo=timezone.utc), p, float(v), 1.0, 1.0, 0, 0, 0)
                for vin, m, p, v in rows]
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(folder)

    folder, out = f"{scratch_dir(spark)}/in", scratch_dir(spark)
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out))

    def run():
        raw = streams.table_stream(spark, folder, "parquet", DDL)
        query = start(normalize(raw, tie="n"), "offline", config)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    put(folder, 0, ("A", 0, 2, 30), ("A", 10, 2, 20), ("PUSH", 40, 2, 1))
    assert run() == 3
    put(folder, 1, ("PUSH", 41, 2, 1), ("A", 33, 0, 0), ("PUSH", 300, 0, 0))
    assert run() == 3
    trips = spark.read.parquet(f"{out}/ads_trip_summary").filter("vin = 'A'").collect()
    assert [(t.start_time.minute, t.end_time.minute, t.max_speed) for t in trips] == [(0, 10, 30.0)]
    pushed = spark.read.parquet(f"{out}/ads_trip_summary").filter("vin = 'PUSH'").collect()
    assert [(t.start_time.minute, t.end_time.minute) for t in pushed] == [(40, 41)]


def test_realtime_trigger_runs_on_a_clock(spark):
    rows = fleet(seed=9, vehicles=2, rows=10)
    raw = streams.parquet_stream(spark, files(spark, rows, 1, 1), DDL)
    out = scratch_dir(spark)
    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=file_writer(out))
    query = start(normalize(raw, tie="n"), "realtime", config)
    try:
        query.processAllAvailable()
        assert query.isActive and "processing" in str(TRIGGERS["realtime"]).lower()
        assert sum(p["numInputRows"] for p in query.recentProgress) == len(rows)
    finally:
        query.stop()


def results(spark):
    df = telemetry(spark, fleet(seed=2, vehicles=4, rows=30))
    return engine.result_rows(engine.trips(df), engine.events(df))


def test_a_repeated_batch_replaces_itself(spark):
    rows, out = results(spark), scratch_dir(spark)
    on_batch = split_tables(file_writer(out))
    on_batch(rows, 7)
    on_batch(rows, 8)
    on_batch(rows, 8)
    trips = spark.read.parquet(f"{out}/ads_trip_summary")
    each = rows.filter("row_type = 'TRIP'").count()
    assert {r.batch_id: r["count"] for r in trips.groupBy("batch_id").count().collect()} == {7: each, 8: each}


def test_merging_sink_keeps_one_row_for_each_key(spark):
    """Late, repeated and corrected rows, two jobs, rows without a start, and a batch that broke off before its days were put in place."""
    rows, out = results(spark).filter("row_type = 'TRIP'").persist(), scratch_dir(spark)
    write = merge_writer(out)
    some, rest = rows.filter("hash(trip_id) % 2 = 0"), rows.filter("hash(trip_id) % 2 <> 0")
    wrong = some.withColumn("max_speed", F.col("max_speed") + 1)
    nowhere = rows.limit(1).withColumn("start_time", F.lit(None).cast("timestamp"))
    shape = lambda df: sorted(map(str, df.select("trip_id", "trip_type", "start_time", "max_speed", "batch_id").collect()))
    want = lambda *parts: sorted(str(r) for df, n in parts for r in df.select("trip_id", "trip_type", "start_time", "max_speed", F.lit(n).cast("long").alias("batch_id")).collect())
    table = lambda: read_merged(spark, out, "t")
    write(wrong.unionByName(wrong), "t", 0)
    assert shape(table()) == want((wrong, 0))
    write(rest.unionByName(nowhere), "t", 1)
    write(rest.unionByName(nowhere), "t", 1)
    assert shape(table()) == want((wrong, 0), (rest, 1), (nowhere, 1))
    before = {f.path for f in spark.read.format("binaryFile").load(f"{out}/t").select("path").collect()}
    write(rest, "t", 2)
    assert before == {f.path for f in spark.read.format("binaryFile").load(f"{out}/t").select("path").collect()}, "nothing new, nothing written"
    write(some, "t", 3)
    assert shape(table()) == want((some, 3), (rest, 1), (nowhere, 1))
    # The days of batch 4 are ready, but the job ended before they were put in place.
    ready = table().withColumn("max_speed", F.lit(7.0)).withColumn("day", F.to_date("start_time"))
    ready.write.parquet(f"{out}/t_merging/-4")
    write(rows, "t", 4)
    assert {r[0] for r in table().select("max_speed").distinct().collect()} == {7.0} and table().count() == rows.count() + 1
    write(rows.limit(0), "t", 5)
    split_tables(merge_writer(out), job="a")(rows, 0)
    split_tables(merge_writer(out), job="b")(rows, 0)
    assert {tuple(r) for r in read_merged(spark, out, "ads_trip_summary").groupBy("job").count().collect()} == {("a", rows.count())}


@pytest.mark.parametrize("mode", ["offline", "realtime"])
def test_jobs_keep_narrow_rows_only(spark, mode):
    """Neither mode keeps a batch's result rows, which are far wider than what they are made of."""
    out, plans = scratch_dir(spark), {}

    def write(rows, table, batch_id):
        plans[table] = rows._jdf.queryExecution().withCachedData().toString()

    config = JobConfig(checkpoint_root=f"{out}/checkpoints", write=write)
    folder = files(spark, fleet(seed=5, vehicles=6, rows=40), 1, 3)
    query = start(normalize(streams.parquet_stream(spark, folder, DDL), tie="n"), mode, config)
    query.awaitTermination() if mode == "offline" else query.processAllAvailable()
    query.stop()
    assert set(plans) == {config.trips_table, config.events_table}
    for plan in plans.values():
        kept = [line for line in plan.splitlines() if "InMemoryRelation" in line]
        assert kept and not any("trip_id" in line or "row_type" in line for line in kept)
    if mode == "offline":
        waiting = spark.read.parquet(f"{state_root(config, mode)}/lanes/batch=0").columns
        assert "mask" in waiting and not set(P.FLAGS) & set(waiting)


def test_parts_of_the_merging_append(spark):
    """What the warehouse writer is made of, on tables of files: rows that are there stay out, corrected ones come in."""
    rows, out = results(spark).persist(), scratch_dir(spark)
    rows.withColumn("batch_id", F.lit(0)).write.parquet(out)
    held = spark.read.parquet(out)
    some = rows.orderBy("trip_id", "trip_type", "start_time").limit(20).persist()
    some.count()
    assert unseen(some, within(held, some)).isEmpty()
    plan = within(held, some)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(start_time)" in plan and "start_time#" in plan.split(">=")[0] and "<= 20" in plan
    corrected = some.withColumn("end_time", F.expr("end_time + INTERVAL 1 second"))
    new = unseen(corrected.unionByName(some), within(held, some))
    assert new.count() == some.count()
    after = latest(held.unionByName(new.withColumn("batch_id", F.lit(1))))
    assert after.filter("batch_id = 1").count() == some.count() and after.count() == rows.count()


def test_jobs_do_not_replace_each_others_batches(spark):
    rows, out = results(spark), scratch_dir(spark)
    for job in ("offline", "realtime", "realtime"):
        split_tables(file_writer(out), job=job)(rows, 0)
    trips = spark.read.parquet(f"{out}/ads_trip_summary")
    each = rows.filter("row_type = 'TRIP'").count()
    assert {r.job: r["count"] for r in trips.groupBy("job").count().collect()} == {"offline": each, "realtime": each}


def test_trip_ids_do_not_depend_on_the_session_zone(spark):
    """Two starts an hour apart, at the end of summer time, have two ids, those of UTC."""
    at = spark.createDataFrame([(1793509200000000,), (1793512800000000,)], "m long")  # 2026-11-01 05:00 and 06:00 UTC
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        ids = []
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            ids.append([r[0] for r in at.orderBy("m").selectExpr(trip_id("'V'", "timestamp_micros(m)")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ids[0] == ids[1] and len(set(ids[0])) == 2


def test_trips_only_sink_keeps_row_type_and_skips_empty(spark):
    written = {}
    on_batch = split_tables(lambda df, table, batch: written.update({table: df.columns}), events=None)
    on_batch(results(spark), 1)
    assert list(written) == ["ads_trip_summary"] and "row_type" in written["ads_trip_summary"]
    written.clear()
    split_tables(lambda df, table, batch: written.update({table: 1}))(results(spark).limit(0), 2)
    assert not written


def test_csv_sink_writes_one_file_with_header(spark):
    folder, out = f"{scratch_dir(spark)}/in", scratch_dir(spark)
    results(spark).repartition(3).write.parquet(folder)
    stream = streams.parquet_stream(spark, folder, schemas.RESULT, files_per_batch=None)
    query = csv_stream(stream, f"{out}/csv", files_per_batch=1).option("checkpointLocation", f"{out}/c")
    query.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.csv(f"{out}/csv", header=True)
    assert back.columns == schemas.RESULT.fieldNames() and back.count() == results(spark).count()
    assert back.select(F.input_file_name()).distinct().count() == 1


def test_json_decode(spark):
    text = ['{"vin":"V","report_time":"2026-01-01T08:00:00Z","vehicle_status":2,"odometer":1.0,"speed":3.5}', "{broken"]
    df = streams.decode_json(spark.createDataFrame([(t,) for t in text], "json_str string"))
    good, bad = df.orderBy("bad_row").collect()
    assert (good.vin, good.vehicle_status, good.speed, good.bad_row) == ("V", 2, 3.5, None)
    assert bad.vin is None and bad.bad_row == "{broken"


def test_modes(spark):
    config = JobConfig(checkpoint_root="/x", write=file_writer("/y"))
    assert checkpoint_path(config, "offline") != checkpoint_path(config, "realtime")
    with pytest.raises(ValueError, match="offline, realtime"):
        run_trip_job(spark, "sometimes", config)
