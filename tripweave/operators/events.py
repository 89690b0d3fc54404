"""Sub-events of trips.

Each tracked event is a bit. Comparing a row's bits with those of the active row before it in
the same trip gives *edges*: an event starts, or ends, here; events still running at the last
active row of a trip end there too. Only edges are exploded and sorted, never the product of
rows and event kinds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P
from tripweave.functions.expressions import EVENT_MINIMUM_US, EVENT_NAME, add, over, trip_id
from tripweave.operators.segment import HEAD, is_row, ordering

PAIRED = (P.VIN, "event", "trip", "start_t", "start_lon", "start_lat", "end_t", "end_lon", "end_lat")
BEFORE, AFTER = 1 << P.BEFORE_BIT, 1 << P.AFTER_BIT


def kept_rows(labelled: DataFrame) -> DataFrame:
    """Active rows and rows that close a trip; the rest cannot start or end an event."""
    return labelled.filter(f"active OR closes OR NOT ({is_row(labelled)})")


def mark_edges(
    labelled: DataFrame, profile: P.Profile, keys: Sequence[str], end_open: bool, now_us: int | None
) -> DataFrame:
    """Rows with at least one edge, with ``starts``, ``ends``, ``flushes``, ``whole`` bits.

    ``end_open`` ends trips that nothing in the data closes; otherwise only those overdue at
    ``now_us`` are ended.
    """
    have = set(labelled.columns)

    def on_head(name: str, otherwise: str) -> str:
        return f"IF(head, {name}, {otherwise})" if name in have else otherwise

    rows = add(
        kept_rows(labelled),
        {
            "head": f"pos = {HEAD}" if "pos" in have else "false",
            # A tail row speaks for a row of a later chunk.
            "stays": "coalesce(t_active, active)" if "t_active" in have else "active",
        },
    )
    rows = add(rows, {"bits": f"coalesce({on_head('h_mask', 'IF(active, mask, 0)')}, 0)"})
    beside = over(keys, ordering(rows))
    following = ("t", "trip", "stays", "lon", "lat")
    rows = add(
        rows,
        {"p_trip": f"lag(trip) {beside}", "p_bits": f"lag(bits) {beside}"}
        | {f"n_{c}": f"lead({c}) {beside}" for c in following},
    )
    rows = rows.filter("active OR (head AND h_open IS NOT NULL)" if "h_open" in have else "active")
    rows = add(
        rows,
        {
            "moves": "active AND speed > 0",
            "trip_end": on_head("h_last_active", "t"),
            "hangs": on_head("h_hanging", "is_off"),
        },
    )
    last = "(n_t IS NULL OR NOT n_stays OR n_trip <> trip)"
    if not end_open and now_us is None:
        last += " AND n_t IS NOT NULL"
    elif not end_open:
        limit = f"IF(hangs, {profile.hang_us}, {profile.gap_us})"
        last += f" AND (n_t IS NOT NULL OR {now_us} > trip_end + {limit})"
    rows = add(
        rows,
        {
            "last": last,
            "moved_t": f"CASE WHEN moves THEN t WHEN head THEN {on_head('h_moved', 'moved')} ELSE moved END",
            "ran": "IF(p_trip = trip, p_bits, 0)",
        },
    )
    rows = add(
        rows,
        {
            "starts": "IF(head, IF(last, 0, bits), bits & ~ran)",
            "ends": "IF(head, 0, coalesce(ran, 0) & ~bits)",
            "flushes": "IF(last, bits, 0)",
            "whole": f"IF(moves AND (moved IS NULL OR moved < trip) AND t > trip, {BEFORE}, 0)"
            f" + IF(last AND moved_t >= trip AND moved_t < trip_end, {AFTER}, 0)",
        },
    )
    # An event that starts at the trip's last row has no duration.
    rows = add(rows, {"starts": "starts & ~flushes", "flushes": "flushes & ~starts"})
    return add(rows, {"edges": "starts | ends | flushes | whole"}).filter("edges <> 0")


def _has(bits: str) -> str:
    return f"(shiftright({bits}, event) & 1) = 1"


def explode_edges(marked: DataFrame, profile: P.Profile, keys: Sequence[str]) -> DataFrame:
    """One row per edge: where it lies and, for an end, where the event ends."""
    each = f"filter(sequence(0, {len(P.EVENT_NAMES) - 1}), i -> (shiftright(edges, i) & 1) = 1)"
    edges = add(marked.withColumn("event", F.explode(F.expr(each))), {"is_start": _has("starts")})
    edges = add(edges, {"at_flush": f"{_has('flushes')} OR event = {P.AFTER_BIT}"})
    if profile.close_coords == "at_end":
        edges = add(edges, {"e_lon": "lon", "e_lat": "lat"})
    else:
        edges = add(
            edges,
            {c: f"IF(at_flush, coalesce(n_{c[2:]}, 0.0D), {c[2:]})" for c in ("e_lon", "e_lat")},
        )

    carried = f"h_open[{EVENT_NAME}]"

    def start(before: str, after: str, on_head: str, own: str) -> str:
        """A start knows its place, whole and carried events too, any other end does not."""
        from_head = f" WHEN head THEN {on_head}" if "h_open" in marked.columns else ""
        return (
            f"CASE WHEN event = {P.BEFORE_BIT} THEN {before} WHEN event = {P.AFTER_BIT} THEN {after}{from_head}"
            f" WHEN is_start THEN {own} END"
        )

    return edges.selectExpr(
        *keys,
        "event",
        "trip",
        *ordering(marked),
        "is_start",
        f"{start('trip', 'moved_t', f'unix_micros({carried}.start_time)', 't')} AS start_t",
        f"{start('e_lon', 'e_lon', f'{carried}.lon', 'lon')} AS start_lon",
        f"{start('e_lat', 'e_lat', f'{carried}.lat', 'lat')} AS start_lat",
        "CASE WHEN is_start THEN null WHEN at_flush THEN trip_end ELSE t END AS end_t",
        "IF(is_start, null, e_lon) AS end_lon",
        "IF(is_start, null, e_lat) AS end_lat",
    )


def pair_edges(edges: DataFrame, keys: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """Ends with the start before them, plus starts that nothing ends (``end_t`` null)."""
    beside = over((*keys, "event"), (*first, *ordering(edges)))
    place = ("start_t", "start_lon", "start_lat")
    paired = add(
        edges,
        {f"p_{c}": f"lag(IF(is_start, {c}, null)) {beside}" for c in place} | {"n_end": f"lead(end_t) {beside}"},
    )
    kept = paired.filter("NOT is_start OR n_end IS NULL")
    return add(kept, {c: f"coalesce({c}, p_{c})" for c in place}).drop("n_end", *[f"p_{c}" for c in place])


def event_rows(paired: DataFrame) -> DataFrame:
    """Finished events that last as long as their kind demands, with their trip's id."""
    lasting = f"end_t IS NOT NULL AND start_t < end_t AND end_t - start_t >= {EVENT_MINIMUM_US}"
    return paired.filter(lasting).selectExpr(
        f"{trip_id(P.VIN, 'timestamp_micros(trip)')} AS trip_id",
        P.VIN,
        f"{EVENT_NAME} AS event_name",
        "timestamp_micros(trip) AS trip_start",
        "timestamp_micros(start_t) AS start_time",
        "timestamp_micros(end_t) AS end_time",
        "start_lon",
        "start_lat",
        "end_lon",
        "end_lat",
    )


def paired_events(
    labelled: DataFrame,
    profile: P.Profile,
    keys: Sequence[str] = (P.VIN,),
    end_open: bool = True,
    now_us: int | None = None,
) -> DataFrame:
    marked = mark_edges(labelled, profile, keys, end_open, now_us)
    return pair_edges(explode_edges(marked, profile, keys), keys)
