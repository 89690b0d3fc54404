"""Rule profiles and the event catalogue, both plain data."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Profile:
    """One set of segmentation rules.

    ``gap_seconds``         silence that cuts a trip (strictly more than)
    ``hang_seconds``        power-off time that ends a trip (strictly more than)
    ``idle_split_seconds``  standing time that splits a trip, ``None`` = never
    ``keep_zero_length``    keep trips whose start equals their end
    ``dedupe_samples``      count opening and resuming rows once in the average
    ``close_coords``        end position of events that end with their trip:
                            ``closing_row`` = the row that closed the trip (0/0 when
                            a timeout did), ``at_end`` = the trip's last active row
    """

    name: str
    gap_seconds: int = 900
    hang_seconds: int = 900
    idle_split_seconds: int | None = None
    keep_zero_length: bool = False
    dedupe_samples: bool = False
    close_coords: str = "closing_row"

    def __post_init__(self):
        if self.close_coords not in ("closing_row", "at_end"):
            raise ValueError(f"close_coords must be closing_row or at_end, not {self.close_coords!r}")

    @property
    def gap_us(self) -> int:
        return self.gap_seconds * 1_000_000

    @property
    def hang_us(self) -> int:
        return self.hang_seconds * 1_000_000

    @property
    def idle_us(self) -> int | None:
        return None if self.idle_split_seconds is None else self.idle_split_seconds * 1_000_000

    def but(self, **changes) -> "Profile":
        return replace(self, **changes)


UNIFIED = Profile("unified")
TRIP = Profile("trip")
LEGACY = Profile("legacy", hang_seconds=300, idle_split_seconds=900, keep_zero_length=True)
LEGACY_FLUSH = LEGACY.but(name="legacy_flush", keep_zero_length=False)

PROFILES = {p.name: p for p in (UNIFIED, TRIP, LEGACY, LEGACY_FLUSH)}


# Canonical column names of the telemetry.
VIN = "vin"
TIMESTAMP = "timestamp"
POWER = "syspowermod_2012001"
SPEED = "vehspd_2011002"
LON = "gps_longitude"
LAT = "gps_latitude"
SEATS = ("driv", "pass", "secrl", "secrr")
SEAT_FUNCTIONS = {"vent": "VENTNSTS", "heat": "HEATSTS", "massg": "MASSG"}
FLAGS = ("ivi_power_status", "trunk_door_status") + tuple(
    f"{seat}_seat_{fn}_sts" for fn in SEAT_FUNCTIONS for seat in SEATS
)
POWER_ON, POWER_OFF = 2, 0


@dataclass(frozen=True)
class EventRule:
    """An event that lasts while its condition holds on the active rows of a trip.

    Either a speed band ``low < v <= high`` (``v == 0`` when both are 0) or a flag
    column that equals 1.
    """

    name: str
    min_seconds: int
    low: float | None = None
    high: float | None = None
    flag: str | None = None


# Names, bands (km/h) and minimum durations (s) of the tracked events.
SPEED_EVENTS = (
    EventRule("CREEP_RUN_EVENT", 300, low=0, high=10),
    EventRule("TRAFFIC_JAM_EVENT", 300, low=10, high=20),
    EventRule("LOW_SPEED_EVENT", 0, low=0, high=40),
    EventRule("MEDIUM_SPEED_EVENT", 0, low=40, high=80),
    EventRule("HIGH_SPEED_EVENT", 0, low=80, high=120),
    EventRule("OVER_SPEED_EVENT", 0, low=120, high=None),
    EventRule("PARK_RUNNING_EVENT", 0, low=0, high=0),
)
SWITCH_EVENTS = (
    EventRule("ON_OFF_IVI_EVENT", 0, flag="ivi_power_status"),
    EventRule("TRUNK_EVENT", 60, flag="trunk_door_status"),
)
SEAT_EVENTS = tuple(
    EventRule(f"{seat.upper()}_SEAT_{label}_EVENT", 60, flag=f"{seat}_seat_{fn}_sts")
    for fn, label in SEAT_FUNCTIONS.items()
    for seat in SEATS
)
TRACKED_EVENTS = SPEED_EVENTS + SWITCH_EVENTS + SEAT_EVENTS

# The two events derived from the trip's first and last moving row.
BEFORE_EVENT = "PARK_BEFORE_RUN_EVENT"
AFTER_EVENT = "PARK_AFTER_RUN_EVENT"

# Position in this tuple = bit in the masks of the event operator.
EVENT_NAMES = tuple(e.name for e in TRACKED_EVENTS) + (BEFORE_EVENT, AFTER_EVENT)
EVENT_MIN_SECONDS = tuple(e.min_seconds for e in TRACKED_EVENTS) + (0, 0)
BEFORE_BIT = EVENT_NAMES.index(BEFORE_EVENT)
AFTER_BIT = EVENT_NAMES.index(AFTER_EVENT)
