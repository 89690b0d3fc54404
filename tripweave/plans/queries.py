"""Registered queries: each operator over the whole ``events`` table, read as telemetry.

``REGISTRY`` maps a name to (callable(spark, sf_dir), SQL text or ``None``).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import engine
from tripweave import profiles as P
from tripweave import schemas
from tripweave.functions.expressions import POWERED_OFF, POWERED_ON, moment_text, trip_id
from tripweave.operators import report
from tripweave.operators.carry import heads
from tripweave.operators.segment import label, lanes, with_heads
from tripweave.plans import daily, fleet, oracle
from tripweave.session import scratch_dir
from tripweave.sinks.merge import merge_writer, read_merged
from tripweave.sinks.tables import csv_stream, file_writer
from tripweave.sources import offsets, streams
from tripweave.sources.telemetry import TIE, judged, normalize, renamed
from tripweave.streaming.job import JobConfig, start
from tripweave.streaming.trips import open_trips, trip_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}

US = 1_000_000
# Day boundary of the incremental queries, inside the compressed time range.
CUT_US = fleet.EPOCH_US + 32_400 * US
CUT_TEXT = "2024-01-01 09:00:00"


def register(name: str, sql: str | None):
    def add(query: Query) -> Query:
        REGISTRY[name] = (query, sql)
        return query

    return add


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 7) for n in names})


def _trips(spark: SparkSession, sf_dir: str, profile: P.Profile = P.UNIFIED) -> DataFrame:
    return _rounded(engine.trips(fleet.telemetry(spark, sf_dir), profile), "avg_speed")


def _events(spark: SparkSession, sf_dir: str, profile: P.Profile = P.UNIFIED) -> DataFrame:
    return engine.events(fleet.telemetry(spark, sf_dir), profile)


def _labelled(spark: SparkSession, sf_dir: str, profile: P.Profile = P.UNIFIED) -> DataFrame:
    return label(lanes(fleet.telemetry(spark, sf_dir)), profile)


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(-1))


def _before(tel: DataFrame) -> DataFrame:
    return tel.filter(F.col(P.TIMESTAMP) < F.lit(CUT_TEXT).cast("timestamp"))


def _after(tel: DataFrame) -> DataFrame:
    return tel.filter(F.col(P.TIMESTAMP) >= F.lit(CUT_TEXT).cast("timestamp"))


TRIPS_SQL = f"{oracle.trips()}\nSELECT {oracle.TRIP_COLUMNS} FROM trip WHERE start_t < end_t"
EVENTS_SQL = f"{oracle.trips()},\n{oracle.events()}\nSELECT {oracle.EVENT_COLUMNS} FROM ev"


# --- sources, projection, alignment -------------------------------------------------------


@register(
    "normalize_telemetry",
    f"""WITH {oracle.telemetry()}
SELECT vin, make_timestamp(t) AS timestamp, tie, coalesce(power, -1) AS {P.POWER}, speed AS {P.SPEED}, lon AS {P.LON}, lat AS {P.LAT},
  {', '.join(P.FLAGS)} FROM tel""",
)
def normalize_telemetry(spark, sf_dir):
    """Canonical rows; -1 shows a power mode that is unknown, hence neutral."""
    return fleet.telemetry(spark, sf_dir).withColumn(P.POWER, _shown(P.POWER))


@register(
    "power_flags",
    f"""WITH {oracle.telemetry()}
SELECT coalesce(power = 2, false) OR speed > 0 AS is_on, coalesce(power = 0, false) AS is_off, count(*) AS n_rows
FROM tel GROUP BY 1, 2""",
)
def power_flags(spark, sf_dir):
    flags = fleet.telemetry(spark, sf_dir).selectExpr(f"{POWERED_ON} AS is_on", f"{POWERED_OFF} AS is_off")
    return flags.groupBy("is_on", "is_off").agg(F.count("*").alias("n_rows"))


@register(
    "key_by_vin",
    f"WITH {oracle.telemetry()} SELECT vin, count(*) AS n_rows, make_timestamp(min(t)) AS first_ts, make_timestamp(max(t)) AS last_ts FROM tel GROUP BY vin",
)
def key_by_vin(spark, sf_dir):
    return (
        fleet.telemetry(spark, sf_dir)
        .groupBy(P.VIN)
        .agg(F.count("*").alias("n_rows"), F.min(P.TIMESTAMP).alias("first_ts"), F.max(P.TIMESTAMP).alias("last_ts"))
    )


@register(
    "order_rows",
    f"""WITH {oracle.telemetry()}, o AS (SELECT vin, tie, t, t - lag(t) OVER (PARTITION BY vin ORDER BY t, tie) AS s FROM tel)
SELECT vin, tie AS event_id, make_timestamp(t) AS timestamp, coalesce(s, -1) AS silence_us FROM o""",
)
def order_rows(spark, sf_dir):
    """Time since the row before, from the marks of the segmentation."""
    return _labelled(spark, sf_dir).select(
        P.VIN,
        F.col("tie").alias("event_id"),
        F.timestamp_micros("t").alias("timestamp"),
        F.coalesce(F.col("t") - F.col("prev_t"), F.lit(-1)).alias("silence_us"),
    )


_WIRE_SQL = f"""WITH {oracle.telemetry()}
SELECT vin, make_timestamp(t) AS timestamp, coalesce(power, -1) AS {P.POWER}, speed AS {P.SPEED},
  CAST(NULL AS VARCHAR) AS bad_row FROM tel WHERE tie % 10 <> 0
UNION ALL
SELECT NULL, NULL, -1, NULL, 'no json ' || tie FROM tel WHERE tie % 10 = 0"""


@register("src_json_decode", _WIRE_SQL)
def src_json_decode(spark, sf_dir):
    """Rows written as wire JSON, every tenth broken, and decoded again."""
    tel = fleet.telemetry(spark, sf_dir)
    wire = tel.select(
        F.when(F.col(TIE) % 10 == 0, F.concat(F.lit("no json "), F.col(TIE).cast("string")))
        .otherwise(
            F.to_json(
                F.struct(
                    P.VIN,
                    F.col(P.TIMESTAMP).alias("report_time"),
                    F.col(P.POWER).alias("vehicle_status"),
                    F.lit(1.5).alias("odometer"),
                    F.col(P.SPEED).alias("speed"),
                )
            )
        )
        .alias("json_str")
    )
    return renamed(streams.decode_json(wire), schemas.WIRE_MAPPING).drop("odometer").withColumn(P.POWER, _shown(P.POWER))


# --- trips --------------------------------------------------------------------------------


@register("trip_segments", TRIPS_SQL)
def trip_segments(spark, sf_dir):
    return _trips(spark, sf_dir)


@register("trip_type", f"SELECT vin, start_time, trip_type FROM ({TRIPS_SQL})")
def trip_type(spark, sf_dir):
    return _trips(spark, sf_dir).select("vin", "start_time", "trip_type")


@register("trip_max_speed", f"SELECT vin, start_time, max_speed FROM ({TRIPS_SQL})")
def trip_max_speed(spark, sf_dir):
    return _trips(spark, sf_dir).select("vin", "start_time", "max_speed")


@register("trip_avg_speed", f"SELECT vin, start_time, avg_speed, samples FROM ({TRIPS_SQL})")
def trip_avg_speed(spark, sf_dir):
    return _trips(spark, sf_dir).select("vin", "start_time", "avg_speed", "samples")


@register(
    "trip_avg_speed_deduped",
    f"""{oracle.trips()}
SELECT t.vin, make_timestamp(t.start_t) AS start_time, round(avg(x.speed), 7) AS avg_speed, count(*) AS samples
FROM trip t JOIN acts x USING (vin, trip) WHERE t.start_t < t.end_t GROUP BY t.vin, t.start_t""",
)
def trip_avg_speed_deduped(spark, sf_dir):
    return _trips(spark, sf_dir, P.UNIFIED.but(dedupe_samples=True)).select("vin", "start_time", "avg_speed", "samples")


@register("trip_id", f"SELECT vin, start_time, trip_id FROM ({TRIPS_SQL})")
def trip_ids(spark, sf_dir):
    return _trips(spark, sf_dir).select("vin", "start_time", "trip_id")


@register(
    "trip_id_text",
    """WITH e AS (SELECT event_id, user_id, ts AS moment_ts, epoch_us(ts) AS start_t FROM events)
SELECT event_id, CASE WHEN start_t % 1000000 = 0 THEN strftime(moment_ts, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(moment_ts, '%Y-%m-%d %H:%M:%S.%f') END AS moment, md5('V' || user_id || '_' || moment) AS id FROM e""",
)
def trip_id_text(spark, sf_dir):
    """The id of a trip at uncompressed times, whose fractions often end in zeros."""
    at = "CAST(ts AS TIMESTAMP)"
    return fleet.events_table(spark, sf_dir).selectExpr(
        "event_id", f"{moment_text(at)} AS moment", f"{trip_id("'V' || user_id", at)} AS id"
    )


def _row_rule(mark: str) -> Query:
    def query(spark, sf_dir):
        return (
            _labelled(spark, sf_dir)
            .filter(F.col(mark))
            .select(P.VIN, F.col("tie").alias("event_id"), F.timestamp_micros("t").alias("at"))
        )

    return query


def _row_rule_sql(source: str, condition: str) -> str:
    return f"{oracle.trips()} SELECT vin, tie AS event_id, make_timestamp(t) AS at FROM {source} WHERE {condition}"


register("trip_open", _row_rule_sql("acts", "opening"))(_row_rule("opens"))
register("hang_resume", _row_rule_sql("acts", "resuming"))(_row_rule("resumes"))
register("active_sample", _row_rule_sql("acts", "true"))(_row_rule("active"))


@register("power_off", _row_rule_sql("acts", "is_off"))
def power_off(spark, sf_dir):
    return (
        _labelled(spark, sf_dir)
        .filter("active AND is_off")
        .select(P.VIN, F.col("tie").alias("event_id"), F.timestamp_micros("t").alias("at"))
    )


_CLOSERS = f"""{oracle.trips()},
{oracle.closing()}
SELECT r.vin, r.tie AS event_id, make_timestamp(r.t) AS at FROM closed d JOIN a r ON r.vin = d.vin AND r.rn = d.close_rn
WHERE r.silence {{}} {900 * US}"""


@register("gap_cut", _CLOSERS.format(">"))
def gap_cut(spark, sf_dir):
    """Rows that end a trip by the silence before them."""
    return (
        _labelled(spark, sf_dir)
        .filter(F.col("closes") & F.col("cut"))
        .select(P.VIN, F.col("tie").alias("event_id"), F.timestamp_micros("t").alias("at"))
    )


@register("hang_expire", _CLOSERS.format("<="))
def hang_expire(spark, sf_dir):
    """Rows that end a trip because the vehicle has been switched off for too long."""
    return (
        _labelled(spark, sf_dir)
        .filter(F.col("closes") & ~F.col("cut"))
        .select(P.VIN, F.col("tie").alias("event_id"), F.timestamp_micros("t").alias("at"))
    )


_OPEN_AT_END = f"{oracle.trips()},\n{oracle.closing()}\n"


@register(
    "trip_flush_timeout",
    f"""{_OPEN_AT_END} SELECT {oracle.TRIP_COLUMNS} FROM trip x
WHERE start_t < end_t AND EXISTS (SELECT 1 FROM closed d WHERE d.vin = x.vin AND d.trip = x.trip AND d.close_rn IS NULL)""",
)
def trip_flush_timeout(spark, sf_dir):
    """Trips that only a timeout ends: run once without, then empty input past the alarms."""
    tel = fleet.telemetry(spark, sf_dir)
    first = engine.step(None, tel, with_events=False)
    later = engine.step(first.carry, tel.filter("false"), now="2030-01-01 00:00:00", with_events=False)
    return _rounded(later.trips, "avg_speed")


@register(
    "trips_trip_profile",
    f"""SELECT vin, 'TRIP' AS row_type, trip_type, CAST(NULL AS VARCHAR) AS phase, start_time, end_time, max_speed, avg_speed,
  end_time AS last_ts, CAST(NULL AS TIMESTAMP) AS last_speed_ts, CAST(NULL AS VARCHAR) AS state_speeds FROM ({TRIPS_SQL})""",
)
def trips_trip_profile(spark, sf_dir):
    """The older profile in its 11 columns; power and speed must be there."""
    tel = normalize(fleet.as_raw(fleet.events_table(spark, sf_dir)), tie="event_id", require=(P.POWER, P.SPEED))
    return engine.short_rows(engine.result_rows(_rounded(engine.trips(tel, P.TRIP), "avg_speed")))


_PIECES = f"""{oracle.pieces()}
SELECT {oracle.TRIP_COLUMNS} FROM piece WHERE start_t {{}} end_t"""


@register("trips_legacy", _PIECES.format("<="))
def trips_legacy(spark, sf_dir):
    return _trips(spark, sf_dir, P.LEGACY)


@register("trips_legacy_flush", _PIECES.format("<"))
def trips_legacy_flush(spark, sf_dir):
    return _trips(spark, sf_dir, P.LEGACY_FLUSH)


@register(
    "idle_split",
    f"""{oracle.pieces()}
SELECT vin, tie AS event_id, CASE WHEN stops THEN 'stops' ELSE 'leaves' END AS split FROM p6 WHERE stops OR leaves""",
)
def idle_split(spark, sf_dir):
    from tripweave.operators.trips import split

    rows = split(_labelled(spark, sf_dir, P.LEGACY), P.LEGACY)
    return rows.filter(F.col("stops") | F.col("leaves")).select(
        P.VIN, F.col("tie").alias("event_id"), F.when(F.col("stops"), "stops").otherwise("leaves").alias("split")
    )


# --- events -------------------------------------------------------------------------------


@register("event_detail", EVENTS_SQL)
def event_detail(spark, sf_dir):
    return _events(spark, sf_dir)


def _of_kind(names: tuple[str, ...], least_seconds: int | None = None) -> tuple[Query, str]:
    listed = ", ".join(f"'{n}'" for n in names)

    def query(spark, sf_dir):
        return _events(spark, sf_dir).filter(F.col("event_name").isin(*names))

    return query, f"SELECT * FROM ({EVENTS_SQL}) WHERE event_name IN ({listed})"


for _name, _rules in (
    ("events_speed_band", P.SPEED_EVENTS),
    ("events_switch", P.SWITCH_EVENTS),
    ("events_seat", P.SEAT_EVENTS),
):
    _query, _sql = _of_kind(tuple(r.name for r in _rules))
    register(_name, _sql)(_query)
for _name, _kind in (("event_park_before", P.BEFORE_EVENT), ("event_park_after", P.AFTER_EVENT)):
    _query, _sql = _of_kind((_kind,))
    register(_name, _sql)(_query)


@register(
    "event_min_duration",
    f"""SELECT event_name, count(*) AS n_events, min(epoch_us(end_time) - epoch_us(start_time)) AS shortest_us
FROM ({EVENTS_SQL}) GROUP BY event_name""",
)
def event_min_duration(spark, sf_dir):
    length = F.unix_micros("end_time") - F.unix_micros("start_time")
    return (
        _events(spark, sf_dir)
        .groupBy("event_name")
        .agg(F.count("*").alias("n_events"), F.min(length).alias("shortest_us"))
    )


@register(
    "event_flush",
    f"SELECT e.* FROM ({EVENTS_SQL}) e JOIN ({TRIPS_SQL}) t USING (trip_id) WHERE e.end_time = t.end_time",
)
def event_flush(spark, sf_dir):
    """Events that end with their trip."""
    tel = fleet.telemetry(spark, sf_dir)
    ends = engine.trips(tel).select("trip_id", F.col("end_time").alias("trip_end"))
    return engine.events(tel).join(ends, "trip_id").filter(F.col("end_time") == F.col("trip_end")).drop("trip_end")


@register(
    "event_close_at_end",
    f"""{oracle.trips()},
{oracle.events()},
lastrow AS (SELECT vin, trip, arg_max(lon, rn) AS l_lon, arg_max(lat, rn) AS l_lat FROM acts GROUP BY vin, trip)
SELECT {oracle.EVENT_COLUMNS.replace('e_lon', 'l_lon').replace('e_lat', 'l_lat').replace('s_lon', 'l_lon').replace('s_lat', 'l_lat')}
FROM (SELECT ev.*, l.l_lon, l.l_lat FROM ev JOIN bounds b ON b.vin = ev.vin AND b.start_t = ev.start_t
  JOIN lastrow l ON l.vin = b.vin AND l.trip = b.trip WHERE event_name = '{P.AFTER_EVENT}')""",
)
def event_close_at_end(spark, sf_dir):
    """Rest after driving, with the position of the trip's end instead of the closing row's."""
    return _events(spark, sf_dir, P.UNIFIED.but(close_coords="at_end")).filter(F.col("event_name") == P.AFTER_EVENT)


@register(
    "events_with_parent",
    f"""SELECT e.*, t.trip_type AS parent_type, t.start_time AS parent_start, t.end_time AS parent_end
FROM ({EVENTS_SQL}) e JOIN ({TRIPS_SQL}) t USING (trip_id)""",
)
def events_with_parent(spark, sf_dir):
    tel = fleet.telemetry(spark, sf_dir)
    return report.with_parent(engine.events(tel), engine.trips(tel))


# --- result rows, filters, presentation ----------------------------------------------------


def _result_sql(rows: str = "TRIP EVENT") -> str:
    parts = []
    nothing = "CAST(NULL AS VARCHAR) AS phase"
    tail = "CAST(NULL AS TIMESTAMP) AS last_speed_ts, CAST(NULL AS VARCHAR) AS state_speeds"
    if "TRIP" in rows:
        parts.append(
            f"""SELECT trip_id, vin, 'TRIP' AS row_type, trip_type, {nothing}, start_time, end_time, max_speed, avg_speed,
  CAST(NULL AS DOUBLE) AS start_lon, CAST(NULL AS DOUBLE) AS start_lat, CAST(NULL AS DOUBLE) AS end_lon,
  CAST(NULL AS DOUBLE) AS end_lat, end_time AS last_ts, {tail} FROM ({TRIPS_SQL})"""
        )
    if "EVENT" in rows:
        parts.append(
            f"""SELECT trip_id, vin, 'EVENT' AS row_type, event_name AS trip_type, {nothing}, start_time, end_time,
  CAST(0 AS DOUBLE) AS max_speed, CAST(0 AS DOUBLE) AS avg_speed, start_lon, start_lat, end_lon, end_lat,
  end_time AS last_ts, {tail} FROM ({EVENTS_SQL})"""
        )
    return "\nUNION ALL\n".join(parts)


def _results(spark, sf_dir) -> DataFrame:
    tel = fleet.telemetry(spark, sf_dir)
    return engine.result_rows(_rounded(engine.trips(tel), "avg_speed"), engine.events(tel))


@register("grouped_fold", _result_sql())
def grouped_fold(spark, sf_dir):
    """Trips and events in the 16-column row shape."""
    return _results(spark, sf_dir)


@register("filter_trip", _result_sql("TRIP"))
def filter_trip(spark, sf_dir):
    return report.only_trips(_results(spark, sf_dir))


@register("filter_event", _result_sql("EVENT"))
def filter_event(spark, sf_dir):
    return report.only_events(_results(spark, sf_dir))


@register("drop_row_type", f"SELECT * EXCLUDE (row_type) FROM ({_result_sql('TRIP')})")
def drop_row_type(spark, sf_dir):
    return report.without_row_type(report.only_trips(_results(spark, sf_dir)))


@register("filter_trip_day", f"SELECT * FROM ({TRIPS_SQL}) WHERE end_time >= TIMESTAMP '{CUT_TEXT}'")
def filter_trip_day(spark, sf_dir):
    return report.of_day(_trips(spark, sf_dir), CUT_TEXT)


@register("filter_vin", f"SELECT * FROM ({TRIPS_SQL}) WHERE vin = 'V7'")
def filter_vin(spark, sf_dir):
    return report.of_vehicle(_trips(spark, sf_dir), "V7")


@register("filter_vin_except", f"SELECT * FROM ({TRIPS_SQL}) WHERE vin <> 'V7'")
def filter_vin_except(spark, sf_dir):
    return report.except_vehicle(_trips(spark, sf_dir), "V7")


_PRESENT_SQL = f"""SELECT vin, trip_type, strftime(start_time, '%m-%d %H:%M:%S') AS start_text,
  strftime(end_time, '%m-%d %H:%M:%S') AS end_text, round(max_speed, 2) AS max_speed,
  CAST(round(CAST(avg_speed AS DECIMAL(18, 7)), 2) AS DOUBLE) AS avg_speed, minutes FROM (
  SELECT *, round((epoch_us(end_time) - epoch_us(start_time)) / 60000000, 1) AS minutes FROM ({_PIECES.format('<')})
  WHERE end_time >= TIMESTAMP '{CUT_TEXT}')"""


@register("present_trip", _PRESENT_SQL)
def present_trip(spark, sf_dir):
    """Readable trips of a day."""
    return report.presented(report.of_day(_trips(spark, sf_dir, P.LEGACY_FLUSH), CUT_TEXT))


@register("sort_trip", f"SELECT vin, start_text, end_text FROM ({_PRESENT_SQL}) ORDER BY vin, start_text")
def sort_trip(spark, sf_dir):
    """The report's order; a range-partitioned sort."""
    shown = report.presented(report.of_day(_trips(spark, sf_dir, P.LEGACY_FLUSH), CUT_TEXT))
    return shown.select(P.VIN, "start_text", "end_text")


@register("count_by_type", f"SELECT trip_type, count(*) AS count FROM ({TRIPS_SQL}) GROUP BY trip_type")
def count_by_type(spark, sf_dir):
    return report.count_by_type(_trips(spark, sf_dir))


# --- carried state ------------------------------------------------------------------------


def _snapshot_sql(profile: P.Profile, until: int | None = None) -> str:
    hang = profile.hang_seconds
    return f"""{oracle.trips(hang, until=until)},
{oracle.closing(hang)},
state AS (
  SELECT x.*, (x.last_hang IS NOT NULL AND x.end_t = x.last_hang) AS hanging, (SELECT max(t) FROM tel r WHERE r.vin = x.vin) AS last_t
  FROM trip x JOIN closed d USING (vin, trip) WHERE d.close_rn IS NULL
)
SELECT vin, CASE WHEN hanging THEN 'HANG_OFF' ELSE 'ACTIVE' END AS phase,
  CASE WHEN max_speed > 0 THEN 'DRIVING' ELSE 'PARKING' END AS trip_type,
  make_timestamp(start_t) AS trip_start, CASE WHEN hanging THEN make_timestamp(end_t) END AS hang_start,
  make_timestamp(last_t) AS last_ts, make_timestamp(last_moved) AS last_speed_ts,
  round(speed_sum, 6) AS speed_sum, CAST(weight AS BIGINT) AS speed_weight, max_speed AS speed_max FROM state"""


_STATE_COLUMNS = ("vin", "phase", "trip_type", "trip_start", "hang_start", "last_ts", "last_speed_ts", "speed_sum", "speed_weight", "speed_max")


def _running_sql(until: str | None = None) -> str:
    return f"""{oracle.trips(until=until)},
{oracle.events()},
at_end AS (SELECT vin, trip, lon, lat FROM acts QUALIFY row_number() OVER (PARTITION BY vin, trip ORDER BY rn DESC) = 1),
running AS (
  SELECT k.vin, k.trip, string_agg(concat_ws(':', k.event_name, k.s_t, CAST(round(k.s_lon * 1000) AS BIGINT), CAST(round(k.s_lat * 1000) AS BIGINT)), ',' ORDER BY k.event_name) AS open_events
  FROM tracked k JOIN stretch z ON z.vin = k.vin AND z.trip = k.trip AND z.event_name = k.event_name AND z.rn = k.last_rn
  WHERE z.n_t IS NULL GROUP BY k.vin, k.trip)
SELECT vin, lon AS end_lon, lat AS end_lat, coalesce(open_events, '') AS open_events
FROM closed JOIN at_end USING (vin, trip) LEFT JOIN running USING (vin, trip) WHERE close_rn IS NULL"""


def _with_events_text(carry: DataFrame) -> DataFrame:
    """Carried state with its running events as text."""
    thousandths = lambda x: F.round(x * 1000).cast("long")
    entries = F.transform(F.map_entries("open_events"), lambda e: F.concat_ws(":", e["key"], F.unix_micros(e["value"]["start_time"]), thousandths(e["value"]["lon"]), thousandths(e["value"]["lat"])))
    running = F.coalesce(F.array_join(F.array_sort(entries), ","), F.lit(""))
    return carry.select(*_STATE_COLUMNS, "end_lon", "end_lat", running.alias("open_events")).withColumn("speed_sum", F.round("speed_sum", 6))


@register("carry_snapshot", f"SELECT * FROM ({_snapshot_sql(P.UNIFIED)}) JOIN ({_running_sql()}) USING (vin)")
def carry_snapshot(spark, sf_dir):
    """State of the trips still open after the last row, with their running events as text."""
    return _with_events_text(engine.step(None, fleet.telemetry(spark, sf_dir)).carry)


_LEGACY_STATE = f"""{oracle.pieces()},
{oracle.closing(300)},
open_piece AS (
  SELECT p.*, (x.last_hang IS NOT NULL AND x.end_t = x.last_hang) AS hanging, r.last_t
  FROM piece p JOIN bounds x USING (vin, trip) JOIN closed d USING (vin, trip)
  JOIN (SELECT vin, max(t) AS last_t FROM tel GROUP BY vin) r USING (vin) WHERE d.close_rn IS NULL AND p.is_last
)"""


@register(
    "t_plus_1",
    f"""{_LEGACY_STATE},
done AS (SELECT * FROM piece p WHERE NOT EXISTS (SELECT 1 FROM open_piece o WHERE o.vin = p.vin AND o.trip = p.trip AND p.is_last))
SELECT vin, 'TRIP' AS row_type, CASE WHEN max_speed > 0 THEN 'DRIVING' ELSE 'PARKING' END AS trip_type,
  CAST(NULL AS VARCHAR) AS phase, make_timestamp(start_t) AS start_time, make_timestamp(end_t) AS end_time, max_speed,
  round(speed_sum / weight, 7) AS avg_speed, make_timestamp(end_t) AS last_ts, CAST(NULL AS TIMESTAMP) AS last_speed_ts,
  CAST(NULL AS VARCHAR) AS state_speeds FROM done
UNION ALL
SELECT vin, 'STATE', CASE WHEN max_speed > 0 THEN 'DRIVING' ELSE 'PARKING' END,
  CASE WHEN hanging THEN 'HANG_OFF' ELSE 'ACTIVE' END, make_timestamp(start_t),
  CASE WHEN hanging THEN make_timestamp(end_t) END, NULL, NULL, make_timestamp(last_t), make_timestamp(last_moved), NULL
FROM open_piece""",
)
def t_plus_1(spark, sf_dir):
    """A run of the older profile: its trips and its state rows, in one row shape."""
    step = engine.step(None, fleet.telemetry(spark, sf_dir), profile=P.LEGACY, with_events=False)
    rows = engine.result_rows(_rounded(step.trips, "avg_speed")).unionByName(engine.state_rows(step.carry))
    return engine.short_rows(rows)


@register(
    "carry_snapshot_legacy",
    f"""{_LEGACY_STATE}
SELECT vin, round(speed_sum, 6) AS speed_sum, CAST(weight AS BIGINT) AS speed_weight, max_speed AS speed_max FROM open_piece""",
)
def carry_snapshot_legacy(spark, sf_dir):
    """Speed totals of the pieces still open after the last row."""
    carry = engine.step(None, fleet.telemetry(spark, sf_dir), profile=P.LEGACY, with_events=False).carry
    return carry.select(P.VIN, F.round("speed_sum", 6).alias("speed_sum"), "speed_weight", "speed_max")


@register("daily_runs", _result_sql())
def daily_runs(spark, sf_dir):
    """Two T+1 runs with tables on disk: their trips and events."""
    root = f"{scratch_dir(spark)}/warehouse"
    tel = fleet.telemetry(spark, sf_dir)
    daily.run_day(spark, _before(tel), root, "d1", None)
    daily.run_day(spark, _after(tel), root, "d2", "d1", now="2030-01-01 00:00:00")
    trips, events = (spark.read.parquet(f"{root}/{table}").drop("day") for table in (daily.TRIPS, daily.EVENTS))
    return engine.result_rows(_rounded(trips, "avg_speed"), events)


@register(
    "state_remove",
    f"""{oracle.trips()},
{oracle.closing()}
SELECT DISTINCT vin FROM tel WHERE vin NOT IN (SELECT vin FROM closed WHERE close_rn IS NULL)""",
)
def state_remove(spark, sf_dir):
    """Vehicles seen that keep no state, because they have no open trip."""
    tel = fleet.telemetry(spark, sf_dir)
    carry = engine.step(None, tel, with_events=False).carry
    return tel.select(P.VIN).distinct().join(carry, P.VIN, "left_anti")


@register(
    "state_timeout",
    f"""SELECT vin, CASE WHEN phase = 'HANG_OFF' THEN hang_start ELSE last_ts END + INTERVAL 15 MINUTE AS alarm
FROM ({_snapshot_sql(P.UNIFIED)})""",
)
def state_timeout(spark, sf_dir):
    """The moment after which each open trip ends by itself."""
    carry = engine.step(None, fleet.telemetry(spark, sf_dir), with_events=False).carry
    since = F.when(F.col("phase") == "HANG_OFF", F.col("hang_start")).otherwise(F.col("last_ts"))
    return carry.select(P.VIN, (since + F.expr("INTERVAL 15 MINUTES")).alias("alarm"))


def _two_runs(spark, sf_dir, profile: P.Profile, with_events: bool) -> tuple[engine.Step, engine.Step]:
    tel = fleet.telemetry(spark, sf_dir)
    first = engine.step(None, _before(tel), profile=profile, with_events=with_events)
    second = engine.step(
        first.carry, _after(tel), now="2030-01-01 00:00:00", profile=profile, with_events=with_events
    )
    return first, second


@register("carry_restore", TRIPS_SQL)
def carry_restore(spark, sf_dir):
    """Trips of two runs with carried state: the same as those of one run."""
    first, second = _two_runs(spark, sf_dir, P.UNIFIED, with_events=False)
    return _rounded(first.trips.unionByName(second.trips), "avg_speed")


@register("carry_restore_legacy", _PIECES.format("<="))
def carry_restore_legacy(spark, sf_dir):
    first, second = _two_runs(spark, sf_dir, P.LEGACY, with_events=False)
    # The run's own id follows the piece's start, as everywhere.
    return _rounded(first.trips.unionByName(second.trips), "avg_speed")


@register("carry_restore_events", EVENTS_SQL)
def carry_restore_events(spark, sf_dir):
    first, second = _two_runs(spark, sf_dir, P.UNIFIED, with_events=True)
    return first.events.unionByName(second.events)


@register(
    "union_state_raw",
    f"""WITH st AS ({_snapshot_sql(P.LEGACY, until=CUT_US)}),
{oracle.telemetry()}
SELECT CAST(is_state AS INTEGER) AS is_state, count(*) AS n_rows, count(DISTINCT vin) AS n_vehicles, make_timestamp(min(t)) AS first_ts
FROM (SELECT 1 AS is_state, vin, epoch_us(last_ts) AS t FROM st UNION ALL SELECT 0, vin, t FROM tel WHERE t >= {CUT_US})
GROUP BY is_state""",
)
def union_state_raw(spark, sf_dir):
    """Yesterday's state rows aligned with and put beside today's rows, by column name."""
    tel = fleet.telemetry(spark, sf_dir)
    carry = engine.step(None, _before(tel), profile=P.LEGACY, with_events=False).carry
    rows = with_heads(lanes(_after(tel)), heads(carry))
    return (
        rows.groupBy(F.when(F.col("pos") == 0, 1).otherwise(0).alias("is_state"))
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct(P.VIN).alias("n_vehicles"),
            F.timestamp_micros(F.min("t")).alias("first_ts"),
        )
    )


@register(
    "align_state_raw",
    f"""SELECT vin, 1 AS is_state, last_ts AS timestamp, trip_start, phase = 'HANG_OFF' AS hanging, last_speed_ts, speed_weight
FROM ({_snapshot_sql(P.LEGACY)})""",
)
def align_state_raw(spark, sf_dir):
    """State rows in the column layout of the rows that they precede."""
    carry = engine.step(None, fleet.telemetry(spark, sf_dir), profile=P.LEGACY.but(idle_split_seconds=None), with_events=False).carry
    return with_heads(lanes(fleet.telemetry(spark, sf_dir)), heads(carry)).filter("pos = 0").selectExpr(
        P.VIN,
        "1 AS is_state",
        "timestamp_micros(t) AS timestamp",
        "timestamp_micros(h_trip) AS trip_start",
        "h_hanging AS hanging",
        "timestamp_micros(h_moved) AS last_speed_ts",
        "h_speed_weight AS speed_weight",
    )


@register("src_state_table", _snapshot_sql(P.UNIFIED))
def src_state_table(spark, sf_dir):
    """State written by one run and read back by the next."""
    path = f"{scratch_dir(spark)}/carry"
    tel = fleet.telemetry(spark, sf_dir)
    engine.step(None, tel, with_events=False).carry.write.mode("overwrite").parquet(path)
    return streams.state_table(spark, path).select(*_STATE_COLUMNS).withColumn("speed_sum", F.round("speed_sum", 6))


@register(
    "st_gap_session",
    f"""WITH {oracle.telemetry()}, g AS (
  SELECT vin, t, tie, CASE WHEN t - lag(t) OVER w > {900 * US} THEN 1 ELSE 0 END AS cut
  FROM tel WINDOW w AS (PARTITION BY vin ORDER BY t, tie)),
i AS (SELECT *, sum(cut) OVER (PARTITION BY vin ORDER BY t, tie ROWS UNBOUNDED PRECEDING) AS isl FROM g)
SELECT vin, make_timestamp(min(t)) AS first_ts, make_timestamp(max(t)) AS last_ts, count(*) AS n_rows FROM i GROUP BY vin, isl""",
)
def st_gap_session(spark, sf_dir):
    return report.gap_sessions(fleet.telemetry(spark, sf_dir))


# --- streaming ----------------------------------------------------------------------------


# The fleet sends a row in some ten minutes, so a slice of waiting rows may span hours.
SLICE_SECONDS = 21_600


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``events`` file as a stream of telemetry."""
    schema = fleet.events_table(spark, sf_dir).schema
    raw = streams.parquet_stream(spark, sf_dir, schema, options={"pathGlobFilter": "events.parquet"})
    return normalize(fleet.as_raw(raw), tie="event_id")


def _stream_sql(kind: str) -> str:
    """Rows that the watermark has passed; trips closed by them or overdue at the watermark."""
    known = f"{oracle.WATERMARK} + 1"
    base = f"""{oracle.trips(until=known)},
{oracle.events()},
done AS (SELECT vin, start_t, trip FROM closed WHERE close_rn IS NOT NULL OR {oracle.WATERMARK} > end_t + {900 * US})"""
    if kind == "TRIP":
        return f"{base} SELECT {oracle.TRIP_COLUMNS} FROM trip SEMI JOIN done USING (vin, trip) WHERE start_t < end_t"
    # Events that end on a row are known before their trip is over.
    return f"""{base}, ends AS (SELECT vin, start_t, end_t FROM closed WHERE close_rn IS NULL AND {oracle.WATERMARK} <= end_t + {900 * US})
SELECT {oracle.EVENT_COLUMNS} FROM ev LEFT JOIN (SELECT vin, start_t, end_t AS trip_end FROM ends) o USING (vin, start_t)
LEFT JOIN (SELECT x.vin, b.start_t, x.t, x.speed AS last_v, {', '.join('x.' + f for f in P.FLAGS)} FROM acts x JOIN bounds b USING (vin, trip) QUALIFY row_number() OVER (PARTITION BY x.vin, x.trip ORDER BY x.rn DESC) = 1) z USING (vin, start_t)
WHERE trip_end IS NULL OR e_t < trip_end OR NOT ({_still_running()})"""


def _still_running() -> str:
    """Whether the condition of an event holds on the last active row of its open trip."""
    cases = []
    for rule in P.TRACKED_EVENTS:
        if rule.flag:
            holds = f"z.{rule.flag} = 1"
        elif rule.low == rule.high:
            holds = f"last_v = {rule.low}"
        else:
            holds = f"last_v > {rule.low}" + ("" if rule.high is None else f" AND last_v <= {rule.high}")
        cases.append(f"WHEN '{rule.name}' THEN {holds}")
    return f"CASE event_name {' '.join(cases)} WHEN '{P.AFTER_EVENT}' THEN true ELSE false END"


_STREAM_TRIPS = _stream_sql("TRIP")
_STREAM_EVENTS = _stream_sql("EVENT")
_TRIP_SHAPE = ("trip_id", "vin", "trip_type", "start_time", "end_time", "max_speed", "avg_speed")
_EVENT_SHAPE = ("trip_id", "vin", "event_name", "start_time", "end_time", "start_lon", "start_lat", "end_lon", "end_lat")


@register("st_trips", f"SELECT {', '.join(_TRIP_SHAPE)} FROM ({_STREAM_TRIPS})")
def st_trips(spark, sf_dir):
    """Trips of the keyed stateful stream, by an append file sink."""
    folder = scratch_dir(spark)
    results = trip_stream(_event_stream(spark, sf_dir), slice_seconds=SLICE_SECONDS)
    query = (
        results.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.schema(schemas.RESULT).parquet(f"{folder}/rows")
    return _rounded(report.only_trips(rows).select(*_TRIP_SHAPE), "avg_speed")


@register("st_from_carry", f"SELECT {', '.join(_TRIP_SHAPE)} FROM ({_STREAM_TRIPS})")
def st_from_carry(spark, sf_dir):
    """A run over the first part of the rows, then a keyed stream over the rest that goes on from its state: trips of both."""
    folder, first = scratch_dir(spark), F.col(P.TIMESTAMP) < F.lit(CUT_TEXT).cast("timestamp")
    step = engine.step(None, fleet.telemetry(spark, sf_dir).filter(first), keep=True)
    try:
        engine.result_rows(step.trips).write.parquet(f"{folder}/rows")
        step.carry.write.parquet(f"{folder}/carry")
    finally:
        step.release()
    rest = _event_stream(spark, sf_dir).filter(~first)
    results = trip_stream(rest, slice_seconds=SLICE_SECONDS, carry=streams.state_table(spark, f"{folder}/carry"))
    query = (
        results.writeStream.format("parquet")
        .option("path", f"{folder}/stream")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    read = spark.read.schema(schemas.RESULT)
    rows = read.parquet(f"{folder}/rows").unionByName(read.parquet(f"{folder}/stream"))
    return _rounded(report.only_trips(rows).select(*_TRIP_SHAPE), "avg_speed")


@register(
    "st_open_trips",
    f"""SELECT * FROM ({_snapshot_sql(P.UNIFIED, f"{oracle.WATERMARK} + 1")}) JOIN ({_running_sql(f"{oracle.WATERMARK} + 1")}) USING (vin)
WHERE epoch_us(coalesce(hang_start, last_ts)) + {900 * US} >= {oracle.WATERMARK}""",
)
def st_open_trips(spark, sf_dir):
    """Trips that a keyed stream has open at its watermark, read from its checkpoint: the state that a T+1 run would carry."""
    folder = scratch_dir(spark)
    query = (
        trip_stream(_event_stream(spark, sf_dir), slice_seconds=SLICE_SECONDS)
        .writeStream.format("noop")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _with_events_text(open_trips(spark, f"{folder}/checkpoint"))


def _job(spark, sf_dir) -> str:
    folder = scratch_dir(spark)
    config = JobConfig(
        checkpoint_root=f"{folder}/checkpoints", write=file_writer(folder), slice_seconds=SLICE_SECONDS
    )
    start(_event_stream(spark, sf_dir), "offline", config).awaitTermination()
    return folder


@register("st_replay_offline", f"SELECT {', '.join(_TRIP_SHAPE)} FROM ({_STREAM_TRIPS})")
def st_replay_offline(spark, sf_dir):
    """The offline job: bounded stream, two tables; its trip table."""
    rows = spark.read.parquet(f"{_job(spark, sf_dir)}/ads_trip_summary")
    return _rounded(rows.select(*_TRIP_SHAPE), "avg_speed")


@register("st_two_sinks", f"SELECT {', '.join(_EVENT_SHAPE)} FROM ({_STREAM_EVENTS})")
def st_two_sinks(spark, sf_dir):
    """The offline job's event table."""
    rows = spark.read.parquet(f"{_job(spark, sf_dir)}/ads_trip_event_detail")
    return rows.withColumnRenamed("trip_type", "event_name").select(*_EVENT_SHAPE)


@register(
    "st_timeout",
    f"""{oracle.trips(until=f"{oracle.WATERMARK} + 1")},
{oracle.closing()},
silent AS (SELECT vin, trip FROM closed WHERE close_rn IS NULL AND {oracle.WATERMARK} > end_t + {900 * US})
SELECT {', '.join(_TRIP_SHAPE)} FROM (SELECT {oracle.TRIP_COLUMNS} FROM trip SEMI JOIN silent USING (vin, trip) WHERE start_t < end_t)""",
)
def st_timeout(spark, sf_dir):
    """Trips of the offline job that silence ended: without a clock they would still be open."""
    trips = spark.read.parquet(f"{_job(spark, sf_dir)}/ads_trip_summary").select(*_TRIP_SHAPE)
    tel = fleet.telemetry(spark, sf_dir)
    passed = tel.agg((F.max(P.TIMESTAMP) - F.expr("INTERVAL 10 minutes")).alias("passed")).first().passed
    carry = engine.step(None, tel.filter(F.col(P.TIMESTAMP) <= F.lit(passed)), with_events=False).carry
    still = carry.selectExpr(f"{trip_id(P.VIN, 'trip_start')} AS trip_id")
    return _rounded(trips.join(still, "trip_id", "left_semi"), "avg_speed")


@register(
    "sink_merge",
    f"SELECT *, CAST(CASE WHEN trip_type = 'DRIVING' THEN 2 WHEN start_time < TIMESTAMP '{CUT_TEXT}' THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM ({TRIPS_SQL})",
)
def sink_merge(spark, sf_dir):
    """Trips merged into a table by three batches: the second is written twice, the third corrects the speeds of the others."""
    folder, trips = scratch_dir(spark), _trips(spark, sf_dir)
    trips.write.parquet(f"{folder}/trips")
    trips, write = spark.read.parquet(f"{folder}/trips"), merge_writer(folder)
    unmeasured = trips.withColumns({c: F.lit(0.0) for c in ("max_speed", "avg_speed")})
    for batch_id, rows in (
        (0, unmeasured.filter(f"start_time < TIMESTAMP '{CUT_TEXT}'")),
        (1, unmeasured.filter(f"start_time >= TIMESTAMP '{CUT_TEXT}'")),
        (1, unmeasured.filter(f"start_time >= TIMESTAMP '{CUT_TEXT}'")),
        (2, trips),
    ):
        write(rows, "merged", batch_id)
    return read_merged(spark, folder, "merged").select(*trips.columns, "batch_id")


def _both_modes(columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{mode}' AS job, {columns} FROM ({_STREAM_TRIPS})" for mode in ("offline", "realtime"))


@register("st_two_modes", _both_modes(", ".join(_TRIP_SHAPE)))
def st_two_modes(spark, sf_dir):
    """Both modes write into one table, told apart by job: the batch engine and the keyed stream give the same trips."""
    folder = scratch_dir(spark)
    config = JobConfig(checkpoint_root=f"{folder}/checkpoints", write=file_writer(folder), slice_seconds=SLICE_SECONDS)
    start(_event_stream(spark, sf_dir), "offline", config).awaitTermination()
    running = start(_event_stream(spark, sf_dir), "realtime", config)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _rounded(spark.read.parquet(f"{folder}/ads_trip_summary").select("job", *_TRIP_SHAPE), "avg_speed")


@register(
    "rejected_rows",
    f"""WITH {oracle.telemetry()}
SELECT CAST(NULL AS VARCHAR) AS vin, 'broken text' AS reason, CAST(NULL AS TIMESTAMP) AS timestamp, CAST(0 AS DOUBLE) AS speed, 'no json ' || tie AS content FROM tel WHERE tie % 10 = 0
UNION ALL SELECT NULL, 'no vehicle', make_timestamp(t), speed, NULL FROM tel WHERE tie % 10 = 1
UNION ALL SELECT vin, 'no time', NULL, speed, NULL FROM tel WHERE tie % 10 = 2""",
)
def rejected_rows(spark, sf_dir):
    """Messages of the wire that a job can't place: broken text, no vehicle, no time; from its table of rejected rows."""
    folder, tel = scratch_dir(spark), fleet.telemetry(spark, sf_dir)
    kind = F.col(TIE) % 10
    message = F.struct(
        F.when(kind != 1, F.col(P.VIN)).alias("vin"),
        F.when(kind != 2, F.col(P.TIMESTAMP)).alias("report_time"),
        F.col(P.POWER).alias("vehicle_status"),
        F.col(P.SPEED).alias("speed"),
    )
    wire = tel.select(F.when(kind == 0, F.concat(F.lit("no json "), F.col(TIE).cast("string"))).otherwise(F.to_json(message)).alias("json_str"))
    wire.write.parquet(f"{folder}/wire")
    text = streams.table_stream(spark, f"{folder}/wire", "parquet", "json_str string")
    telemetry = judged(renamed(streams.decode_json(text), schemas.WIRE_MAPPING))
    config = JobConfig(checkpoint_root=f"{folder}/checkpoints", write=file_writer(folder))
    start(telemetry, "offline", config).awaitTermination()
    return spark.read.parquet(f"{folder}/{config.rejected_table}").select("vin", "reason", "timestamp", "speed", "content")


@register(
    "st_watermark",
    f"""WITH {oracle.telemetry()}, g AS (
  SELECT vin, t, tie, CASE WHEN t - lag(t) OVER w > {900 * US} THEN 1 ELSE 0 END AS cut
  FROM tel WINDOW w AS (PARTITION BY vin ORDER BY t, tie)),
i AS (SELECT *, sum(cut) OVER (PARTITION BY vin ORDER BY t, tie ROWS UNBOUNDED PRECEDING) AS isl FROM g)
SELECT vin, make_timestamp(min(t)) AS first_ts, make_timestamp(max(t)) AS last_ts, count(*) AS n_rows FROM i GROUP BY vin, isl
HAVING max(t) + {900 * US} <= {oracle.WATERMARK}""",
)
def st_watermark(spark, sf_dir):
    """Stretches without a long gap that the watermark has made final, from the stream."""
    folder = scratch_dir(spark)
    late = _event_stream(spark, sf_dir).withWatermark(P.TIMESTAMP, "10 minutes")
    query = (
        report.gap_sessions(late)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@register(
    "src_table_stream",
    f"""WITH {oracle.telemetry()} SELECT vin, count(*) AS n_rows, sum(CASE WHEN speed > 0 THEN 1 ELSE 0 END) AS n_moving FROM tel GROUP BY vin""",
)
def src_table_stream(spark, sf_dir):
    """A table written once, read as a bounded stream, its rows per vehicle."""
    folder = scratch_dir(spark)
    tel = fleet.telemetry(spark, sf_dir)
    tel.write.parquet(f"{folder}/table")
    rows = streams.table_stream(spark, f"{folder}/table", "parquet", tel.schema)
    query = (
        rows.select(P.VIN, P.SPEED)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    read = spark.read.parquet(f"{folder}/rows")
    return read.groupBy(P.VIN).agg(F.count("*").alias("n_rows"), F.expr(f"count_if({P.SPEED} > 0)").alias("n_moving"))


@register(
    "st_offsets",
    f"""WITH {oracle.telemetry()}, m AS (SELECT vin, t, make_timestamp(t) AS timestamp, coalesce(power, -1) AS {P.POWER}, speed AS {P.SPEED} FROM tel)
SELECT 'earliest' AS started, * EXCLUDE (t) FROM m UNION ALL SELECT 'given', * EXCLUDE (t) FROM m WHERE t >= {CUT_US}""",
)
def st_offsets(spark, sf_dir):
    """Messages of a log read by offsets: from the start with a restart after an append, and from the offsets where that append began."""
    folder, tel = scratch_dir(spark), fleet.telemetry(spark, sf_dir)
    message = F.struct(P.VIN, F.col(P.TIMESTAMP).alias("report_time"), F.col(P.POWER).alias("vehicle_status"), F.col(P.SPEED).alias("speed"))

    def run(started: str, starting_offsets: str) -> None:
        text = offsets.log_stream(spark, f"{folder}/log", starting_offsets)
        query = (
            renamed(streams.decode_json(text), schemas.WIRE_MAPPING)
            .writeStream.format("parquet")
            .option("path", f"{folder}/rows/started={started}")
            .option("checkpointLocation", f"{folder}/checkpoint/{started}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    ends = {}
    for part in (_before(tel), _after(tel)):
        began, ends = ends, offsets.append(part.select(TIE, F.to_json(message).alias("value")), f"{folder}/log", order=[TIE])
        run("earliest", "earliest")
    run("given", json.dumps(began))
    kinds = [spark.read.parquet(f"{folder}/rows/started={k}").withColumn("started", F.lit(k)) for k in ("earliest", "given")]
    return kinds[0].unionByName(kinds[1]).select("started", P.VIN, P.TIMESTAMP, _shown(P.POWER).alias(P.POWER), P.SPEED)


@register(
    "src_parquet_stream",
    f"""WITH {oracle.telemetry()} SELECT vin, tie AS event_id, make_timestamp(t) AS timestamp, speed AS {P.SPEED} FROM tel""",
)
def src_parquet_stream(spark, sf_dir):
    """Telemetry read as a file stream and written to CSV files with a header."""
    folder = scratch_dir(spark)
    rows = _event_stream(spark, sf_dir).select(P.VIN, F.col(TIE).alias("event_id"), P.TIMESTAMP, P.SPEED)
    query = (
        csv_stream(rows, f"{folder}/csv")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).csv(f"{folder}/csv", header=True)
