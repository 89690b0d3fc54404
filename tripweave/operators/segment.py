"""Trip segmentation as running windows over a vehicle's rows.

The three-phase rule set (off, active, hanging after power-off) looks sequential, but the
phase before a row depends on three things only, each of which is "the last value so far":

``live``         time of the last row that left the vehicle active, if no power-off came since
``island``       start of the current stretch without a long gap
``last_active``  time of the last active row

All windows share one partitioning and one order, so Spark needs one exchange and one sort.
Rows may be preceded by a *head* row (``pos`` 0) that carries the state from before the first
row in ``h_`` columns, and followed by a *tail* row (``pos`` 2) that stands for what comes
later. Plain input has neither and no ``pos`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P
from tripweave.functions.expressions import EVENT_MASK, POWERED_OFF, POWERED_ON, add, over
from tripweave.sources.telemetry import TIE

HEAD, ROW, TAIL = 0, 1, 2
NEVER = "(-9223372036854775807L)"


def lanes(telemetry: DataFrame, keep_time: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Canonical telemetry reduced to what the windows need, times in microseconds.

    ``keep_time`` keeps the timestamp too, whose watermark a stream needs, ``also`` other columns.
    """
    return telemetry.selectExpr(
        P.VIN,
        *([P.TIMESTAMP] if keep_time else []),
        *also,
        f"unix_micros({P.TIMESTAMP}) AS t",
        f"{TIE} AS tie",
        f"{POWERED_ON} AS is_on",
        f"{POWERED_OFF} AS is_off",
        f"{P.SPEED} AS speed",
        f"{P.LON} AS lon",
        f"{P.LAT} AS lat",
        f"{EVENT_MASK} AS mask",
    )


def ordering(rows: DataFrame) -> list[str]:
    return ["pos", "t", "tie"] if "pos" in rows.columns else ["t", "tie"]


def is_row(rows: DataFrame) -> str:
    return f"pos = {ROW}" if "pos" in rows.columns else "true"


def seeded(rows: DataFrame, name: str, marker: str) -> str:
    """The marker, or on a head row the value it carries."""
    return f"coalesce(h_{name}, {marker})" if f"h_{name}" in rows.columns else marker


def with_heads(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows and head (or tail) rows by column name, absent columns null."""
    if "pos" not in rows.columns:
        rows = rows.withColumn("pos", F.lit(ROW))
    return rows.unionByName(heads, allowMissingColumns=True)


def mark_islands(rows: DataFrame, profile: P.Profile, keys: Sequence[str] = (P.VIN,)) -> DataFrame:
    """Adds ``prev_t``, ``cut`` (a long gap before the row), ``island``, ``live``, ``moved``."""
    order = ordering(rows)
    before = over(keys, order, "before")
    live = seeded(rows, "live", f"CASE WHEN is_off THEN {NEVER} WHEN is_on THEN t END")
    moved = seeded(rows, "moved", "IF(speed > 0, t, null)")
    rows = add(
        rows,
        {
            "prev_t": f"lag(t) {over(keys, order)}",
            "live": f"coalesce(last({live}, true) {before}, {NEVER})",
            "moved": f"last({moved}, true) {before}",
        },
    )
    rows = add(rows, {"cut": f"prev_t IS NULL OR t - prev_t > {profile.gap_us}"})
    island = seeded(rows, "island", "IF(cut, t, null)")
    return add(rows, {"island": f"last({island}, true) {over(keys, order, 'so far')}"})


def mark_active(rows: DataFrame, profile: P.Profile, keys: Sequence[str] = (P.VIN,)) -> DataFrame:
    """Adds ``active``, ``last_active`` (before the row) and ``prev_island``."""
    order = ordering(rows)
    rows = add(rows, {"active": f"{is_row(rows)} AND coalesce(is_on OR live >= island, false)"})
    last_active = seeded(rows, "last_active", "IF(active, t, null)")
    return add(
        rows,
        {
            "last_active": f"last({last_active}, true) {over(keys, order, 'before')}",
            "prev_island": f"lag(island) {over(keys, order)}",
        },
    )


def mark_trips(rows: DataFrame, profile: P.Profile, keys: Sequence[str] = (P.VIN,)) -> DataFrame:
    """Adds ``opens``, ``closes``, ``resumes``, ``trip`` (its start) and ``weight``.

    ``closes`` is the row that ends the trip open before it; it may open the next one.
    """
    expired = f"(live < island AND t - last_active > {profile.hang_us})"
    open_before = (
        "last_active IS NOT NULL AND last_active >= prev_island"
        f" AND (live >= prev_island OR prev_t - last_active <= {profile.hang_us})"
    )
    rows = add(
        rows,
        {
            "opens": f"{is_row(rows)} AND coalesce(is_on, false)"
            f" AND (last_active IS NULL OR last_active < island OR {expired})",
            "closes": f"{is_row(rows)} AND coalesce({open_before} AND (cut OR {expired}), false)",
        },
    )
    rows = add(rows, {"resumes": "active AND is_on AND live < island AND NOT opens"})
    trip = seeded(rows, "trip", "IF(opens, t, null)")
    return add(
        rows,
        {
            "trip": f"last({trip}, true) {over(keys, ordering(rows), 'so far')}",
            "weight": "1" if profile.dedupe_samples else "IF(opens OR resumes, 2, 1)",
        },
    )


def label(rows: DataFrame, profile: P.Profile, keys: Sequence[str] = (P.VIN,)) -> DataFrame:
    """All marks on the rows of each vehicle; drop to ``active`` for the rows of trips."""
    return mark_trips(mark_active(mark_islands(rows, profile, keys), profile, keys), profile, keys)
