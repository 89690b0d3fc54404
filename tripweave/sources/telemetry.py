"""From raw rows to canonical telemetry."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P
from tripweave import schemas
from tripweave.functions.expressions import filled

TIE = "tie"
# Why a row cannot be placed (null for rows that can), and the text that did not decode.
REASON, CONTENT, BAD_ROW = "reason", "content", "bad_row"
BROKEN, NO_VEHICLE, NO_TIME = "broken text", "no vehicle", "no time"
REJECTED = "REJECTED"


def renamed(raw: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Wire names to canonical names."""
    return raw.withColumnsRenamed(dict(mapping))


def normalize(raw: DataFrame, tie: str | None = None, require: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns only: missing columns become 0, null or NaN measurements 0.0.

    A *missing* power column reads as off, a *null* power value as neutral. ``tie`` names
    a column that orders rows of one vehicle at one instant; without it a hash of the row
    does. Rows without a vehicle or without a time cannot be placed and are left out; ``judged``
    keeps them. ``require`` names columns that must not be missing.
    """
    return judged(raw, tie, require).filter(f"{REASON} IS NULL").drop(REASON, CONTENT)


def judged(raw: DataFrame, tie: str | None = None, require: tuple[str, ...] = ()) -> DataFrame:
    """Canonical columns of every row, why it cannot be placed (null if it can), and the text that did not decode.

    Works on batch and streaming frames. ``decode_json`` keeps such text in ``bad_row``.
    """
    present = set(raw.columns)
    absent = [c for c in (P.VIN, P.TIMESTAMP, *require) if c not in present]
    if absent:
        raise ValueError(f"telemetry lacks {', '.join(absent)}")
    columns = {
        P.VIN: P.VIN,
        P.TIMESTAMP: f"CAST({P.TIMESTAMP} AS TIMESTAMP)",
        P.POWER: P.POWER if P.POWER in present else str(P.POWER_OFF),
    }
    for name in (P.SPEED, P.LON, P.LAT):
        columns[name] = filled(name) if name in present else "0.0D"
    for name in P.FLAGS:
        columns[name] = f"CAST({name} AS INT)" if name in present else "0"
    given = sorted(present & {P.POWER, P.SPEED, P.LON, P.LAT, *P.FLAGS})
    columns[TIE] = f"CAST({tie} AS BIGINT)" if tie else f"xxhash64({', '.join([P.TIMESTAMP, *given])})"
    broken = f"WHEN {BAD_ROW} IS NOT NULL THEN '{BROKEN}'" if BAD_ROW in present else ""
    columns[REASON] = f"CASE {broken} WHEN {P.VIN} IS NULL THEN '{NO_VEHICLE}' WHEN {columns[P.TIMESTAMP]} IS NULL THEN '{NO_TIME}' END"
    columns[CONTENT] = BAD_ROW if BAD_ROW in present else "CAST(null AS STRING)"
    return raw.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def rejected_results(rejected: DataFrame) -> DataFrame:
    """Rejected rows in the result row shape and their text: the reason stands in ``trip_type``, the time in ``start_time``."""
    own = {"vin": P.VIN, "row_type": f"'{REJECTED}'", "trip_type": REASON, "start_time": P.TIMESTAMP, "max_speed": P.SPEED, "start_lon": P.LON, "start_lat": P.LAT}
    texts = [f"CAST({own.get(f.name, 'null')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.RESULT]
    return rejected.selectExpr(*texts, CONTENT)
