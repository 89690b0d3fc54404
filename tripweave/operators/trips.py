"""Trips from labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P
from tripweave.functions.expressions import add, over, trip_id
from tripweave.operators.pieces import PIECE, mark_pieces
from tripweave.operators.segment import label


def _carried(rows: DataFrame) -> bool:
    return "h_speed_weight" in rows.columns


def _own(rows: DataFrame, value: str, seed: str) -> str:
    """The value on an active row, or what a head row carries from an earlier run."""
    carried = f" WHEN h_speed_weight IS NOT NULL THEN {seed}" if _carried(rows) else ""
    return f"CASE WHEN active THEN {value}{carried} END"


def _totals(rows: DataFrame) -> dict[str, str]:
    return {
        "end_t": f"max({_own(rows, 't', 'h_last_active')})",
        "max_speed": f"max({_own(rows, 'speed', 'h_speed_max')})",
        "speed_sum": f"sum({_own(rows, 'speed * weight', 'h_speed_sum')})",
        "speed_weight": f"sum({_own(rows, 'CAST(weight AS BIGINT)', 'h_speed_weight')})",
    }


def _outlook(rows: DataFrame) -> dict[str, str]:
    """What tells whether a trip is still open, and what its carried state needs."""
    order = "struct(pos, t, tie)" if "pos" in rows.columns else "struct(t, tie)"
    spoken, hangs = "active", "is_off"
    if _carried(rows):
        spoken, hangs = "(active OR h_speed_weight IS NOT NULL)", "coalesce(h_hanging, is_off)"
    last_moved = _own(rows, "IF(speed > 0, t, null)", "h_moved")
    return {
        "shut": "max(IF(closes AND NOT active, 1, 0))",
        "last_t": "max(t)",
        "last_moved": f"max({last_moved})",
        "last": f"max_by(struct({hangs} AS hanging, lon, lat), {order}) FILTER (WHERE {spoken})",
    }


def split(labelled: DataFrame, profile: P.Profile, keys=(P.VIN,)) -> DataFrame:
    """Rows with the start (and key) of the trip, or piece of a trip, that they belong to."""
    if profile.idle_split_seconds is None:
        return labelled
    return mark_pieces(labelled, profile, keys)


def measure(rows: DataFrame, profile: P.Profile, outlook: bool = False) -> DataFrame:
    """One row per trip (or piece): ``start_t``, ``end_t``, speed totals.

    A trip ends at its last active row: a hanging vehicle ends where it was switched off, and
    that row is the last active one. The aggregate is partial before any exchange, and needs
    none when the rows already lie by vehicle. With ``outlook`` a column ``last_of_vehicle``
    and the columns for carried state are added.
    """
    pieced = PIECE in rows.columns
    by = [P.VIN, "trip", PIECE, "start_t"] if pieced else [P.VIN, "trip"]
    kept = "trip IS NOT NULL"
    if not outlook:
        kept += " AND (active OR h_speed_weight IS NOT NULL)" if _carried(rows) else " AND active"
    aggregates = _totals(rows) | (_outlook(rows) if outlook else {})
    if pieced:
        aggregates["left_sample"] = "max(left_sample)"
    totals = rows.filter(kept).groupBy(*by).agg(*[F.expr(f"{text} AS {n}") for n, text in aggregates.items()])
    following = over((P.VIN,), (PIECE if pieced else "trip",))
    if outlook:
        totals = add(totals, {"last_of_vehicle": f"lead(trip) {following} IS NULL"})
    if not pieced:
        return add(totals, {"start_t": "trip"})
    # A piece ends where the next piece of its trip starts.
    totals = add(
        totals,
        {
            "n_start": f"IF(lead(trip) {following} = trip, lead(start_t) {following}, null)",
            "n_left": f"lead(left_sample) {following}",
        },
    )
    return add(
        totals,
        {
            "speed_weight": "speed_weight + IF(n_start IS NOT NULL, n_left, 0)",
            "end_t": "coalesce(n_start, end_t)",
        },
    ).drop("n_start", "n_left", "left_sample")


def still_open(profile: P.Profile, now_us: int | None) -> str:
    """Condition on measured trips (with outlook): neither the data nor ``now_us`` ends it."""
    alive = "(shut = 0 AND last_of_vehicle)"
    if now_us is None:
        return alive
    return f"({alive} AND {now_us} <= end_t + IF(last.hanging, {profile.hang_us}, {profile.gap_us}))"


def trip_rows(measured: DataFrame, profile: P.Profile) -> DataFrame:
    """Measured trips as trips, those without duration left out unless the profile keeps them."""
    start = "timestamp_micros(start_t)"
    return measured.filter("start_t <= end_t" if profile.keep_zero_length else "start_t < end_t").selectExpr(
        f"{trip_id(P.VIN, start)} AS trip_id",
        P.VIN,
        "IF(max_speed > 0, 'DRIVING', 'PARKING') AS trip_type",
        f"{start} AS start_time",
        "timestamp_micros(end_t) AS end_time",
        "max_speed",
        "speed_sum / speed_weight AS avg_speed",
        "speed_weight AS samples",
    )


def measured_trips(rows: DataFrame, profile: P.Profile, outlook: bool = False) -> DataFrame:
    """From lane rows of whole vehicles to measured trips."""
    labelled = label(rows, profile)
    return measure(split(labelled, profile), profile, outlook)
