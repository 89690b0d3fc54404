"""Trips and events of a telemetry stream.

Rows wait in keyed state until the watermark passes them and are then applied in time order,
so the result does not depend on how rows arrive in micro-batches. Event-time timers do both:
one for the next waiting row and one for the moment at which silence ends an open trip.

State is kept by group of vehicles (a hash of the vehicle), not by vehicle: every call of the state's
interface and of pandas costs far more than a row does, so one call serves the rows of a whole group.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripweave import profiles as P
from tripweave import schemas
from tripweave.functions.expressions import EVENT_NAME, add, trip_id
from tripweave.operators.segment import NEVER, lanes
from tripweave.session import ship_helpers, use_state_store
from tripweave.streaming.machine import OpenTrip, VehicleFold

# Waiting rows are stored by slice of event time, so that no more than one slice of a group is
# read or held in memory at a time. Dense fleets want short slices, sparse ones long.
SLICE_SECONDS = 300
# Groups of vehicles. A checkpoint belongs to its number of groups; fleets of millions want more.
GROUPS = 1024
GROUP = "vehicle_group"
# Result rows that are handed on at a time.
OUT_ROWS = 10_000

_ROW = np.dtype(
    [
        ("t", "<i8"),
        ("tie", "<i8"),
        ("is_on", "?"),
        ("is_off", "?"),
        ("speed", "<f8"),
        ("lon", "<f8"),
        ("lat", "<f8"),
        ("mask", "<i4"),
    ]
)
_VEHICLE = T.StructType([T.StructField(P.VIN, T.StringType())])
# Waiting rows are only ever added: what arrives together is a part of its slice. A part has its rows by vehicle.
_PART_KEY = T.StructType([T.StructField("slice", T.LongType()), T.StructField("part", T.LongType())])
_PART = T.StructType(
    [
        T.StructField("vehicles", T.ArrayType(T.StringType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("rows", T.BinaryType()),
    ]
)
_TRIP = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("hanging", T.BooleanType()),
        T.StructField("last_row", T.LongType()),
        T.StructField("moved", T.LongType()),
        T.StructField("speed_sum", T.DoubleType()),
        T.StructField("weight", T.LongType()),
        T.StructField("speed_max", T.DoubleType()),
        T.StructField("events", T.ArrayType(T.IntegerType())),
        T.StructField("event_starts", T.ArrayType(T.LongType())),
        T.StructField("event_lons", T.ArrayType(T.DoubleType())),
        T.StructField("event_lats", T.ArrayType(T.DoubleType())),
    ]
)
_OUT = T.StructType(
    [
        T.StructField(P.VIN, T.StringType()),
        T.StructField("trip", T.LongType()),
        T.StructField("event", T.IntegerType()),
        T.StructField("start_t", T.LongType()),
        T.StructField("end_t", T.LongType()),
        T.StructField("max_speed", T.DoubleType()),
        T.StructField("avg_speed", T.DoubleType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
    ]
)
_WHOLE_TRIP = -1


def _stored(trip: OpenTrip) -> tuple:
    events = sorted(trip.running.items())
    return (
        trip.start,
        trip.end,
        trip.end_lon,
        trip.end_lat,
        trip.hanging,
        trip.last_row,
        trip.moved,
        trip.speed_sum,
        trip.weight,
        trip.speed_max,
        [bit for bit, _ in events],
        [at[0] for _, at in events],
        [at[1] for _, at in events],
        [at[2] for _, at in events],
    )


def _restored(value: tuple) -> OpenTrip:
    *plain, bits, starts, lons, lats = value
    running = {int(b): (s, x, y) for b, s, x, y in zip(bits, starts, lons, lats)}
    return OpenTrip(*plain, running=running)


class TripProcessor(StatefulProcessor):
    """Keyed by group of vehicles; all vehicles of a group share one timer."""

    def __init__(self, profile: P.Profile, slice_seconds: int = SLICE_SECONDS):
        self._profile = profile
        self._slice_us = slice_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._trips = handle.getMapState("trip", _VEHICLE, _TRIP)
        self._waiting = handle.getMapState("waiting", _PART_KEY, _PART)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        """Carried state of the group's vehicles whose last trip is open (``_carried``): one row each."""
        alarms = []
        for values in initialState.drop_duplicates(P.VIN).to_dict("records"):
            trip = tuple(_value(values[f.name], f.dataType) for f in _TRIP)
            self._trips.updateValue((values[P.VIN],), trip)
            alarms.append(_restored(trip).alarm(self._profile))
        self._handle.registerTimer(max(min(alarms) // 1000, timerValues.getCurrentWatermarkInMs()) + 1)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        part = max((p for p, _ in self._parts().values()), default=-1) + 1
        first = None
        for batch in rows:
            earliest = int(batch["t"].min())
            first = earliest if first is None else min(first, earliest)
            codes, vehicles = pd.factorize(batch[P.VIN])
            found = np.empty(len(batch), _ROW)
            for name in _ROW.names:
                found[name] = batch[name]
            slices = found["t"] // self._slice_us
            for number in np.unique(slices).tolist():
                here = slices == number
                self._put(number, part, list(vehicles), codes[here], found[here])
            part += 1
        # Waiting rows and open trips already have their timer; only an earlier one is new.
        timers = list(self._handle.listTimers())
        due = max(_ceil_ms(first), timerValues.getCurrentWatermarkInMs() + 1)
        if not timers or due < min(timers):
            self._set_timer(timers, due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        watermark = now * 1000
        held = {vehicle: _restored(tuple(value)) for (vehicle,), value in self._trips.iterator()}
        before = {vehicle: _stored(trip) for vehicle, trip in held.items()}
        folds = {vehicle: VehicleFold(self._profile, trip) for vehicle, trip in held.items()}
        found, moments = [], []
        for number, (last, parts) in sorted(self._parts().items()):
            vehicles, codes, rows = self._get(number, parts)
            due = rows["t"] <= watermark
            if not due.all():
                moments.append(_ceil_ms(int(rows["t"][~due].min())))
            if not due.any():
                break
            for vehicle, some in _by_vehicle(vehicles, codes[due], rows[due]):
                fold = folds.get(vehicle)
                if fold is None:
                    fold = folds[vehicle] = VehicleFold(self._profile)
                for t, _, on, off, speed, lon, lat, mask in some:
                    fold.feed(t, on, off, speed, lon, lat, mask)
                found += _output(vehicle, fold)
                if len(found) >= OUT_ROWS:
                    yield _frame(found)
                    found = []
            for part in parts:
                self._waiting.removeKey((number, part))
            if not due.all():
                self._put(number, last + 1, vehicles, codes[~due], rows[~due])
        for vehicle, fold in folds.items():
            if fold.trip is not None and watermark > fold.trip.alarm(self._profile):
                fold.close()
                found += _output(vehicle, fold)
            if fold.trip is not None:
                moments.append(fold.trip.alarm(self._profile) // 1000 + 1)
                if (trip := _stored(fold.trip)) != before.get(vehicle):
                    self._trips.updateValue((vehicle,), trip)
            elif vehicle in before:
                self._trips.removeKey((vehicle,))
        if moments:
            self._handle.registerTimer(max(min(moments), now + 1))
        if found:
            yield _frame(found)

    def close(self) -> None:
        pass

    def _parts(self) -> dict[int, tuple[int, list[int]]]:
        """The last part and all parts of each slice that has waiting rows."""
        parts: dict[int, list[int]] = {}
        for number, part in self._waiting.keys():
            parts.setdefault(number, []).append(part)
        return {number: (max(some), sorted(some)) for number, some in parts.items()}

    def _get(self, number: int, parts: list[int]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Vehicles of a slice, the number of each row's vehicle among them, and the rows."""
        numbers: dict[str, int] = {}
        codes, rows = [], []
        for part in parts:
            vehicles, counts, data = self._waiting.getValue((number, part))
            codes.append(np.repeat([numbers.setdefault(v, len(numbers)) for v in vehicles], counts))
            rows.append(np.frombuffer(data, _ROW))
        return list(numbers), np.concatenate(codes), np.concatenate(rows)

    def _put(self, number: int, part: int, vehicles: list[str], codes: np.ndarray, rows: np.ndarray) -> None:
        present, counts = np.unique(codes, return_counts=True)
        data = rows[np.argsort(codes, kind="stable")].tobytes()
        self._waiting.updateValue((number, part), ([vehicles[c] for c in present], counts.tolist(), data))

    def _set_timer(self, timers: list[int], moment: int) -> None:
        """One timer per group: the next waiting row, or just after the first alarm of its trips."""
        for timer in timers:
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(moment)


def _by_vehicle(vehicles: list[str], codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[str, list[tuple]]]:
    """Rows of each vehicle in the order of time and tie."""
    order = np.lexsort((rows["tie"], rows["t"], codes))
    codes, rows = codes[order], rows[order]
    ends = np.append(np.flatnonzero(np.diff(codes)) + 1, len(codes)).tolist()
    for start, end in zip([0, *ends], ends):
        yield vehicles[codes[start]], rows[start:end].tolist()


def _ceil_ms(t: int) -> int:
    return -(-t // 1000)


def _value(value: Any, kind: T.DataType) -> Any:
    """A value that pandas handed over, as its column's type has it."""
    if isinstance(kind, T.ArrayType):
        return [_value(v, kind.elementType) for v in value]
    if value is None or (kind == T.LongType() and pd.isna(value)):
        return None
    return {T.LongType(): int, T.IntegerType(): int, T.DoubleType(): float, T.BooleanType(): bool}[kind](value)


def _output(vin: str, fold: VehicleFold) -> list[tuple]:
    """Takes the finished trips and events out of the fold."""
    nowhere = (None,) * 4
    trips = [(vin, s, _WHOLE_TRIP, s, e, top, mean, *nowhere) for s, e, top, mean, _ in fold.trips]
    events = [(vin, trip, bit, s, e, 0.0, 0.0, *place) for trip, bit, s, e, *place in fold.events]
    fold.trips, fold.events = [], []
    return trips + events


def _frame(found: list[tuple]) -> pd.DataFrame:
    """Result rows by column, which is faster than a frame made of rows; null positions are NaN here."""
    kinds = {T.LongType(): "i8", T.IntegerType(): "i4", T.DoubleType(): "f8", T.StringType(): object}
    return pd.DataFrame({f.name: np.array(column, kinds[f.dataType]) for f, column in zip(_OUT, zip(*found))})


def _group(groups: int) -> str:
    return f"CAST(pmod(xxhash64({P.VIN}), {groups}) AS INT)"


def trip_stream(
    telemetry: DataFrame,
    profile: P.Profile = P.UNIFIED,
    delay: str = "10 minutes",
    slice_seconds: int = SLICE_SECONDS,
    carry: DataFrame | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Result rows (trips and events) of canonical streaming telemetry, in append mode.

    Rows later than ``delay`` behind the newest are dropped by Spark. ``carry``: state that a run left (``engine.step``);
    the stream goes on from it and should be given the rows that the run did not read. Spark takes it in with
    the first batch of a new checkpoint only; a restart goes on from its own state. ``groups``: by how many groups of
    vehicles state is kept; a checkpoint goes on with the number that it began with.
    """
    return as_results(found_stream(telemetry, profile, delay, slice_seconds, carry, groups))


def found_stream(
    telemetry: DataFrame,
    profile: P.Profile = P.UNIFIED,
    delay: str = "10 minutes",
    slice_seconds: int = SLICE_SECONDS,
    carry: DataFrame | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """What ``trip_stream`` finds in the operator's own narrow columns, of which ``as_results`` makes result rows."""
    use_state_store(telemetry.sparkSession)
    ship_helpers()
    rows = telemetry.withWatermark(P.TIMESTAMP, delay)
    # A null tie comes first, as in the windows.
    keyed = add(lanes(rows, keep_time=True), {"tie": f"coalesce(tie, {NEVER})", GROUP: _group(groups)})
    return (
        keyed.groupBy(GROUP)
        .transformWithStateInPandas(
            TripProcessor(profile, slice_seconds),
            outputStructType=_OUT,
            outputMode="Append",
            timeMode="EventTime",
            initialState=None if carry is None else add(_carried(carry), {GROUP: _group(groups)}).groupBy(GROUP),
        )
    )


_NAMES = f"array({', '.join(repr(rule.name) for rule in P.TRACKED_EVENTS)})"
_HANGING = "phase = 'HANG_OFF'"


def _carried(carry: DataFrame) -> DataFrame:
    """Carried state in the stream's own columns, one row per vehicle with an open trip."""
    entries = f"map_entries(coalesce(open_events, CAST(map() AS {schemas.CARRY['open_events'].dataType.simpleString()})))"
    columns = {
        "start": "unix_micros(trip_start)",
        "end": f"unix_micros(IF({_HANGING}, hang_start, last_ts))",
        "end_lon": "end_lon",
        "end_lat": "end_lat",
        "hanging": _HANGING,
        "last_row": "unix_micros(last_ts)",
        "moved": "unix_micros(last_speed_ts)",
        "speed_sum": "speed_sum",
        "weight": "speed_weight",
        "speed_max": "speed_max",
        "events": f"transform({entries}, e -> CAST(array_position({_NAMES}, e.key) - 1 AS INT))",
        "event_starts": f"transform({entries}, e -> unix_micros(e.value.start_time))",
        "event_lons": f"transform({entries}, e -> e.value.lon)",
        "event_lats": f"transform({entries}, e -> e.value.lat)",
    }
    return carry.filter("phase IN ('ACTIVE', 'HANG_OFF')").selectExpr(P.VIN, *[f"{text} AS `{name}`" for name, text in columns.items()])


def open_trips(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """State of the trips that a keyed stream has open, in the columns of carried state (``engine.step`` goes on from it).

    Read from the stream's checkpoint, while it runs or after it, as its last finished batch left it, or ``batch_id`` did.
    Rows that still wait for the watermark are not in it. A stream without an open trip gives no rows.
    """
    use_state_store(spark)
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "trip")
    state = (reader if batch_id is None else reader.option("batchId", batch_id)).load()
    running = f"transform(arrays_zip(events, event_starts, event_lons, event_lats), e -> struct({_NAMES}[e.events] AS key, struct(timestamp_micros(e.event_starts) AS start_time, e.event_lons AS lon, e.event_lats AS lat) AS value))"
    return state.selectExpr(f"user_map_key.{P.VIN} AS {P.VIN}", "user_map_value.*").selectExpr(
        P.VIN,
        "IF(hanging, 'HANG_OFF', 'ACTIVE') AS phase",
        "IF(speed_max > 0, 'DRIVING', 'PARKING') AS trip_type",
        "timestamp_micros(start) AS trip_start",
        "IF(hanging, timestamp_micros(end), null) AS hang_start",
        "timestamp_micros(last_row) AS last_ts",
        "timestamp_micros(moved) AS last_speed_ts",
        "speed_sum",
        "weight AS speed_weight",
        "speed_max",
        "end_lon",
        "end_lat",
        f"CAST(map_from_entries({running}) AS {schemas.CARRY['open_events'].dataType.simpleString()}) AS open_events",
    )


def as_results(found: DataFrame) -> DataFrame:
    return found.selectExpr(
        f"{trip_id(P.VIN, 'timestamp_micros(trip)')} AS trip_id",
        P.VIN,
        f"IF(event = {_WHOLE_TRIP}, 'TRIP', 'EVENT') AS row_type",
        f"IF(event = {_WHOLE_TRIP}, IF(max_speed > 0, 'DRIVING', 'PARKING'), {EVENT_NAME}) AS trip_type",
        "CAST(null AS STRING) AS phase",
        "timestamp_micros(start_t) AS start_time",
        "timestamp_micros(end_t) AS end_time",
        "max_speed",
        "avg_speed",
        "start_lon",
        "start_lat",
        "end_lon",
        "end_lat",
        "timestamp_micros(end_t) AS last_ts",
        "CAST(null AS TIMESTAMP) AS last_speed_ts",
        "CAST(null AS STRING) AS state_speeds",
    )
