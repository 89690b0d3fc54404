"""Idle splitting: a trip with a long stop falls into driving and parking pieces.

A driving piece ends at its last moving row once the vehicle has stood for longer than the
limit; the parking piece that starts there ends at the row before the next moving row. Both
follow from the time of the last moving row (``moved``) and of the last row that stood too
long (``late``), so they are running windows like the segmentation itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripweave import profiles as P
from tripweave.functions.expressions import add, over
from tripweave.operators.segment import ordering, seeded

PIECE = "piece"
OPENED, STOPPED, LEFT = 0, 1, 2


def mark_late(rows: DataFrame, profile: P.Profile, keys: Sequence[str]) -> DataFrame:
    """Adds ``drove`` (last moving time in the trip), ``late`` and ``last_late``."""
    rows = add(rows, {"drove": "IF(moved >= trip, moved, null)"})
    rows = add(rows, {"late": f"active AND speed = 0 AND coalesce(t - drove > {profile.idle_us}, false)"})
    late = seeded(rows, "late", "IF(late, t, null)")
    return add(rows, {"last_late": f"last({late}, true) {over(keys, ordering(rows), 'before')}"})


def mark_splits(rows: DataFrame, profile: P.Profile, keys: Sequence[str]) -> DataFrame:
    """Adds ``piece`` (a key), ``start_t`` of the piece, ``left_sample``; corrects ``weight``."""
    stood_since = "CASE WHEN drove IS NULL THEN trip WHEN last_late > drove THEN drove END"
    rows = add(
        rows,
        {
            "stops": "late AND (last_late IS NULL OR last_late <= drove)",
            "leaves": "active AND speed > 0 AND NOT opens AND NOT resumes"
            f" AND coalesce(t - {stood_since} > {profile.idle_us}, false)",
        },
    )
    key = f"CASE WHEN opens THEN t * 4 + {OPENED} WHEN stops THEN t * 4 + {STOPPED} WHEN leaves THEN t * 4 + {LEFT} END"
    start = "CASE WHEN opens THEN t WHEN stops THEN drove WHEN leaves THEN prev_t END"
    rows = add(rows, {"piece_mark": seeded(rows, PIECE, key), "start_mark": seeded(rows, "start", start)})
    so_far = over(keys, ordering(rows), "so far")
    return add(
        rows,
        {
            PIECE: f"last(piece_mark, true) {so_far}",
            "start_t": f"last(start_mark, true) {so_far}",
            # A row that resumes and splits leaves one sample in the piece it ends.
            "left_sample": "IF(stops AND resumes, 1, 0)",
            "weight": "IF(stops OR leaves, 1, weight)",
        },
    )


def mark_pieces(labelled: DataFrame, profile: P.Profile, keys: Sequence[str]) -> DataFrame:
    return mark_splits(mark_late(labelled, profile, keys), profile, keys)
