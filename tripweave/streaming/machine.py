"""The state of one vehicle between rows, for the keyed stream.

Constant in size: the trip's speeds are kept as sum, weight and maximum. Row conditions (on,
off, event bits) come computed from Spark; this helper only keeps track of them in order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from tripweave import profiles as P

MINIMUM_US = [seconds * 1_000_000 for seconds in P.EVENT_MIN_SECONDS]


@dataclass
class OpenTrip:
    start: int
    end: int = 0
    end_lon: float = 0.0
    end_lat: float = 0.0
    hanging: bool = False
    last_row: int = 0
    moved: int | None = None
    speed_sum: float = 0.0
    weight: int = 0
    speed_max: float = float("-inf")
    running: dict[int, tuple[int, float, float]] = field(default_factory=dict)

    def __post_init__(self):
        self.held = sum(1 << bit for bit in self.running)

    def alarm(self, profile: P.Profile) -> int:
        """The moment after which silence ends the trip."""
        return self.end + profile.hang_us if self.hanging else self.last_row + profile.gap_us


class VehicleFold:
    """Feeds rows in time order and collects finished trips and events."""

    def __init__(self, profile: P.Profile, trip: OpenTrip | None = None):
        self.profile = profile
        self.trip = trip
        self.trips: list[tuple] = []
        self.events: list[tuple] = []

    def feed(self, t, on, off, speed, lon, lat, mask) -> None:
        trip = self.trip
        if trip is not None:
            silent = t - trip.last_row > self.profile.gap_us
            if silent or (trip.hanging and t - trip.end > self.profile.hang_us):
                self.close(lon, lat)
                trip = None
        if on and trip is None:
            trip = self.trip = OpenTrip(start=t)
            doubled = True
        else:
            doubled = bool(on and trip is not None and trip.hanging)
        if trip is None:
            return
        trip.last_row = t
        if trip.hanging and not on:
            return
        trip.hanging = bool(off)
        trip.end, trip.end_lon, trip.end_lat = t, lon, lat
        weight = 2 if doubled and not self.profile.dedupe_samples else 1
        trip.speed_sum += weight * speed
        trip.weight += weight
        trip.speed_max = max(trip.speed_max, speed)
        if speed > 0:
            if trip.moved is None:
                self._event(P.BEFORE_BIT, trip.start, t, lon, lat, lon, lat)
            trip.moved = t
        self._track(t, lon, lat, mask)

    def _track(self, t, lon, lat, mask) -> None:
        trip = self.trip
        changed, trip.held = mask ^ trip.held, mask
        running, here = trip.running, (t, lon, lat)
        while changed:
            lowest = changed & -changed
            changed ^= lowest
            bit = lowest.bit_length() - 1
            if mask & lowest:
                running[bit] = here
            else:
                began, s_lon, s_lat = running.pop(bit)
                if began < t and t - began >= MINIMUM_US[bit]:
                    self.events.append((trip.start, bit, began, t, s_lon, s_lat, lon, lat))

    def close(self, lon: float = 0.0, lat: float = 0.0) -> None:
        """Ends the open trip at its last active row; the position is that of the cause."""
        trip = self.trip
        if self.profile.close_coords == "at_end":
            lon, lat = trip.end_lon, trip.end_lat
        if trip.start < trip.end or (self.profile.keep_zero_length and trip.start == trip.end):
            self.trips.append((trip.start, trip.end, trip.speed_max, trip.speed_sum / trip.weight, trip.weight))
        if trip.moved is not None:
            self._event(P.AFTER_BIT, trip.moved, trip.end, lon, lat, lon, lat)
        for bit, (began, s_lon, s_lat) in trip.running.items():
            self._event(bit, began, trip.end, s_lon, s_lat, lon, lat)
        self.trip = None

    def _event(self, bit, start, end, s_lon, s_lat, e_lon, e_lat) -> None:
        if start < end and end - start >= MINIMUM_US[bit]:
            self.events.append((self.trip.start, bit, start, end, s_lon, s_lat, e_lon, e_lat))
