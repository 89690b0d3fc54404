"""SQL expressions used by several operators.

They are texts, for ``selectExpr`` and ``F.expr``: one call per expression, however long.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import profiles as P


def add(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds (or replaces) columns given as SQL texts."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def filled(name: str) -> str:
    """A measurement where null and NaN count as 0.0."""
    return f"coalesce(nanvl(CAST({name} AS DOUBLE), 0.0D), 0.0D)"


POWERED_ON = f"(coalesce({P.POWER} = {P.POWER_ON}, false) OR {P.SPEED} > 0)"
POWERED_OFF = f"coalesce({P.POWER} = {P.POWER_OFF}, false)"


def rule_holds(rule: P.EventRule) -> str:
    if rule.flag:
        return f"{rule.flag} = 1"
    if rule.low == rule.high:
        return f"{P.SPEED} = {rule.low}"
    upper = "" if rule.high is None else f" AND {P.SPEED} <= {rule.high}"
    return f"{P.SPEED} > {rule.low}{upper}"


# All event conditions of a row, one bit per tracked event.
EVENT_MASK = " + ".join(f"IF({rule_holds(rule)}, {1 << bit}, 0)" for bit, rule in enumerate(P.TRACKED_EVENTS))

# Tables by event number.
EVENT_NAME = f"array({', '.join(repr(n) for n in P.EVENT_NAMES)})[event]"
EVENT_MINIMUM_US = f"array({', '.join(f'{s * 1_000_000}L' for s in P.EVENT_MIN_SECONDS)})[event]"


def moment_text(moment: str) -> str:
    """Timestamp text in UTC, whatever the session's zone: no fraction, or exactly six digits of it."""
    micros = f"unix_micros({moment})"
    seconds = f"make_dt_interval(0, 0, 0, CAST(floor({micros} / 1000000) AS DECIMAL(18, 6)))"
    return (
        f"concat(substring(CAST(TIMESTAMP_NTZ '1970-01-01 00:00:00' + {seconds} AS STRING), 1, 19),"
        f" IF({micros} % 1000000 = 0, '', concat('.', lpad(CAST(pmod({micros}, 1000000) AS STRING), 6, '0'))))"
    )


def trip_id(vin: str, trip_start: str) -> str:
    return f"md5(concat_ws('_', {vin}, {moment_text(trip_start)}))"


def over(keys: Sequence[str], order: Sequence[str], frame: str = "") -> str:
    rows = {"so far": "UNBOUNDED PRECEDING AND CURRENT ROW", "before": "UNBOUNDED PRECEDING AND 1 PRECEDING"}
    bounds = f" ROWS BETWEEN {rows[frame]}" if frame else ""
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}{bounds})"
