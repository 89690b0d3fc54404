"""Vehicles with too many rows for one task.

Most vehicles fit a task, and one exchange by vehicle serves all windows. A vehicle with more
than ``hot_rows`` rows (a default id, a test bench) does not. Its rows are range-partitioned
by time into *chunks* of about equal size, however dense they lie, and the windows run by
(vehicle, chunk). What a chunk must know of the chunks before it are a few last values; they
are summed up per chunk, passed along by a window over those small summaries and put in front
of the chunk as a head row. A tail row tells the next kept row of a later chunk.

The chunk number is a partition id, so it is fixed by a reliable checkpoint before use.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P
from tripweave.functions.expressions import add, over
from tripweave.operators.events import PAIRED, explode_edges, kept_rows, mark_edges, pair_edges, paired_events
from tripweave.operators.pieces import mark_late, mark_pieces
from tripweave.operators.segment import (
    HEAD,
    NEVER,
    ROW,
    TAIL,
    label,
    mark_active,
    mark_islands,
    mark_trips,
    with_heads,
)
from tripweave.operators.trips import measure, measured_trips, split
from tripweave.session import checkpoint_dir

HOT_ROWS = 20_000_000
CHUNK = "chunk"
KEYS = (P.VIN, CHUNK)
IS_ROW = f"pos = {ROW}"
BY_CHUNK = over((P.VIN,), (CHUNK,))
BEFORE_CHUNK = over((P.VIN,), (CHUNK,), "before")


def plan(rows: DataFrame, heads: DataFrame | None, hot_rows: int | None) -> "Work":
    """Splits lane rows into vehicles that fit a task and hot ones.

    Counting reads the vehicle column only and combines before its exchange. At most
    rows / ``hot_rows`` vehicles can be hot, so their list is small by construction.
    """
    if hot_rows is None:
        return Work(rows, heads, None, None, 0)
    counts = rows.groupBy(P.VIN).count().filter(F.col("count") > hot_rows).collect()
    if not counts:
        return Work(rows, heads, None, None, 0)
    spark = rows.sparkSession
    hot = F.broadcast(spark.createDataFrame([(r[P.VIN],) for r in counts], f"{P.VIN} string"))
    chunks = math.ceil(sum(r["count"] for r in counts) / hot_rows) + 1

    def part(df: DataFrame | None, how: str) -> DataFrame | None:
        return None if df is None else df.join(hot, P.VIN, how)

    return Work(
        part(rows, "left_anti"),
        part(heads, "left_anti"),
        part(rows, "left_semi"),
        part(heads, "left_semi"),
        chunks,
    )


class Work:
    """Lane rows and carried heads, split by how they must be computed."""

    def __init__(self, cold, cold_heads, hot, hot_heads, chunks: int):
        self._cold = cold if cold_heads is None else with_heads(cold, cold_heads)
        self._hot = None if hot is None else HotVehicles(hot, hot_heads, chunks)

    def measured(self, profile: P.Profile, outlook: bool = False) -> DataFrame:
        cold = measured_trips(self._cold, profile, outlook)
        return cold if self._hot is None else cold.unionByName(self._hot.measured(profile, outlook))

    def paired(self, profile: P.Profile, end_open: bool = True, now_us: int | None = None) -> DataFrame:
        cold = paired_events(label(self._cold, profile), profile, (P.VIN,), end_open, now_us).select(*PAIRED)
        if self._hot is None:
            return cold
        return cold.unionByName(self._hot.paired(profile, end_open, now_us).select(*PAIRED))


class HotVehicles:
    def __init__(self, rows: DataFrame, day_heads: DataFrame | None, chunks: int):
        checkpoint_dir(rows.sparkSession)
        # Rows alike in every sort column may be cut anywhere, hence the random last key.
        self._rows = (
            rows.withColumn("cut", F.rand(17))
            .repartitionByRange(chunks, P.VIN, "t", "tie", "cut")
            .drop("cut")
            .withColumns({CHUNK: F.spark_partition_id(), "pos": F.lit(ROW)})
            .checkpoint()
        )
        self._day = None
        if day_heads is not None:
            first = self._rows.groupBy(P.VIN).agg(F.min(CHUNK).alias(CHUNK))
            self._day = first.join(day_heads, P.VIN).checkpoint()
        self._heads: dict[P.Profile, DataFrame] = {}

    def _fronted(self, heads: DataFrame | None) -> DataFrame:
        rows = self._rows
        for front in (self._day, heads):
            if front is not None:
                rows = with_heads(rows, front)
        return rows

    def heads(self, profile: P.Profile) -> DataFrame:
        """Head rows that make every mark right in every chunk but a vehicle's first."""
        if profile not in self._heads:
            heads = self._past_trips(self._past_islands(profile), profile)
            if profile.idle_us is not None:
                heads = self._past_pieces(self._past_stops(heads, profile), profile)
            self._heads[profile] = heads
        return self._heads[profile]

    def _past_islands(self, profile: P.Profile) -> DataFrame:
        """What follows from the rows alone: last row, ``live``, last moving row, island.

        Inside its chunk a first row has no row before it, so whether it is cut off is decided
        on the summaries.
        """
        marked = mark_islands(self._fronted(None), profile, KEYS)
        sums = _summed(
            marked,
            {
                "h_t": f"max(t) FILTER (WHERE {IS_ROW})",
                "first_t": f"min(t) FILTER (WHERE {IS_ROW})",
                "h_live": f"max_by(IF(is_off, {NEVER}, t), struct(t, tie)) FILTER (WHERE {IS_ROW} AND (is_on OR is_off))",
                "h_moved": f"max(t) FILTER (WHERE {IS_ROW} AND speed > 0)",
                "h_island": f"max(t) FILTER (WHERE {IS_ROW} AND cut AND prev_t IS NOT NULL)",
            },
        )
        sums = add(sums, {"prev_t": f"lag(h_t) {BY_CHUNK}"})
        cut = f"prev_t IS NULL OR first_t - prev_t > {profile.gap_us}"
        sums = add(sums, {"h_island": f"coalesce(h_island, IF({cut}, first_t, null))"})
        return _heads(sums, ("h_t", "h_live", "h_moved", "h_island"))

    def _past_trips(self, heads: DataFrame, profile: P.Profile) -> DataFrame:
        """Last active row and last opening row.

        Only a chunk's first active row needs the chunks before it to tell whether it opens a
        trip; that, too, is decided on the summaries.
        """
        marked = mark_active(mark_islands(self._fronted(heads), profile, KEYS), profile, KEYS)
        marked = mark_trips(marked, profile, KEYS)
        first = "min_by(struct(t, is_on, live < island AS hanging, island), struct(t, tie))"
        sums = _summed(
            marked,
            {
                "h_last_active": f"max(t) FILTER (WHERE {IS_ROW} AND active)",
                "h_trip": f"max(t) FILTER (WHERE {IS_ROW} AND opens AND last_active IS NOT NULL)",
                "first": f"{first} FILTER (WHERE {IS_ROW} AND active AND last_active IS NULL)",
            },
            heads,
        )
        sums = add(sums, {"before": f"last(h_last_active, true) {BEFORE_CHUNK}"})
        opens = (
            "first.is_on AND (before IS NULL OR before < first.island"
            f" OR (first.hanging AND first.t - before > {profile.hang_us}))"
        )
        sums = add(sums, {"h_trip": f"coalesce(h_trip, IF({opens}, first.t, null))"})
        return _heads(sums, (*_carried_by(heads), "h_last_active", "h_trip"), new=("h_last_active", "h_trip"))

    def _past_stops(self, heads: DataFrame, profile: P.Profile) -> DataFrame:
        marked = mark_late(label(self._fronted(heads), profile, KEYS), profile, KEYS)
        sums = _summed(marked, {"h_late": f"max(t) FILTER (WHERE {IS_ROW} AND late)"}, heads)
        return _heads(sums, (*_carried_by(heads), "h_late"), new=("h_late",))

    def _past_pieces(self, heads: DataFrame, profile: P.Profile) -> DataFrame:
        marked = mark_pieces(label(self._fronted(heads), profile, KEYS), profile, KEYS)
        at_split = f"FILTER (WHERE {IS_ROW} AND piece_mark IS NOT NULL)"
        new = {"h_piece": f"max(piece_mark) {at_split}", "h_start": f"max_by(start_mark, piece_mark) {at_split}"}
        return _heads(_summed(marked, new, heads), (*_carried_by(heads), *new), new=tuple(new))

    def measured(self, profile: P.Profile, outlook: bool) -> DataFrame:
        labelled = label(self._fronted(self.heads(profile)), profile, KEYS)
        return measure(split(labelled, profile, KEYS), profile, outlook)

    def paired(self, profile: P.Profile, end_open: bool, now_us: int | None) -> DataFrame:
        heads = self.heads(profile)
        kept = kept_rows(label(self._fronted(heads), profile, KEYS))
        sums = _summed(
            kept,
            {
                "h_mask": f"max_by(IF(active, mask, 0), struct(t, tie)) FILTER (WHERE {IS_ROW})",
                "first": f"min_by(struct(t, trip, active, lon, lat), struct(t, tie)) FILTER (WHERE {IS_ROW})",
            },
            heads,
        ).checkpoint()
        fronts = _heads(sums, (*_carried_by(heads), "h_mask"), new=("h_mask",))
        labelled = label(with_heads(self._fronted(fronts), _tails(sums)), profile, KEYS)
        edges = explode_edges(mark_edges(labelled, profile, KEYS, end_open, now_us), profile, KEYS)
        inside = pair_edges(edges, KEYS).checkpoint()
        # Events that cross chunks: at most one loose end and one loose start per chunk and kind.
        loose = F.expr("is_start OR start_t IS NULL")
        across = pair_edges(inside.filter(loose), (P.VIN,), first=(CHUNK,))
        return inside.filter(~loose).unionByName(across)


def _carried_by(heads: DataFrame) -> list[str]:
    return [c for c in heads.columns if c.startswith("h_")]


def _summed(marked: DataFrame, new: dict[str, str], heads: DataFrame | None = None) -> DataFrame:
    """One row per chunk: new values of its rows, else of the state carried into it, and what
    its head row already holds."""
    on_head = f"FILTER (WHERE pos = {HEAD})"
    sums = [F.expr(f"max({c}) {on_head} AS {c}") for c in (_carried_by(heads) if heads is not None else [])]
    for name, last in new.items():
        day = f"max({name}) {on_head}" if name in marked.columns else "null"
        sums.append(F.expr(f"coalesce({last}, {day}) AS {name}"))
    return marked.groupBy(*KEYS).agg(*sums)


def _heads(sums: DataFrame, columns: Sequence[str], new: Sequence[str] | None = None) -> DataFrame:
    """Head rows: of ``new`` columns (default all) the last value in the chunks before."""
    passed = {n: f"last({n}, true) {BEFORE_CHUNK}" for n in (new or columns)}
    heads = add(sums, passed | {"nth": f"row_number() {BY_CHUNK}"}).filter("nth > 1")
    place = (f"{HEAD} AS pos", "h_t AS t", "0L AS tie")
    return heads.selectExpr(*KEYS, *place, *columns).checkpoint()


def _tails(sums: DataFrame) -> DataFrame:
    """For each chunk the first kept row of the chunks after it."""
    later = over((P.VIN,), (f"{CHUNK} DESC",), "before")
    return (
        add(sums, {"next": f"last(first, true) {later}"})
        .filter("next IS NOT NULL")
        .selectExpr(
            *KEYS,
            f"{TAIL} AS pos",
            "next.t AS t",
            "0L AS tie",
            "next.lon AS lon",
            "next.lat AS lat",
            "next.trip AS h_trip",
            "next.active AS t_active",
        )
    )
