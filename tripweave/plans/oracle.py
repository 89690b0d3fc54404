"""The same results as plain SQL, by another route.

Segmentation here counts islands and segments and joins them, where the library takes running
last values; events come from islands of each condition, where the library pairs edges.
"""

from __future__ import annotations

from tripweave import profiles as P
from tripweave.plans.fleet import EPOCH_US, FLAG_RULES, POWER_RULE, SPEED_RULE

US = 1_000_000
# Where the watermark of a stream over the whole table ends: ten minutes before the newest row.
WATERMARK = (
    f"(SELECT {EPOCH_US} + ((max(epoch_us(ts)) - {EPOCH_US}) // 40000000) * {US} - {600 * US} FROM events)"
)


def telemetry(until: int | str | None = None) -> str:
    flags = ",\n      ".join(f"{rule} AS {flag}" for flag, rule in FLAG_RULES.items())
    where = "" if until is None else f"WHERE t < {until}"
    return f"""tel AS (
    SELECT * FROM (
    SELECT event_id AS tie, 'V' || user_id AS vin,
      {EPOCH_US} + ((epoch_us(ts) - {EPOCH_US}) // 40000000) * {US} AS t,
      {POWER_RULE} AS power,
      CAST({SPEED_RULE} AS DOUBLE) AS speed,
      120.0 + k / 100.0 AS lon,
      30.0 + user_id / 1000.0 AS lat,
      {flags}
    FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events)) {where}
)"""


def trips(hang: int = 900, gap: int = 900, until: int | str | None = None) -> str:
    """CTEs up to ``acts`` (active rows with trip number) and ``trip`` (one row per trip)."""
    return f"""WITH {telemetry(until)},
a AS (
    SELECT *, (coalesce(power = 2, false) OR speed > 0) AS is_on, coalesce(power = 0, false) AS is_off,
      row_number() OVER w AS rn, t - lag(t) OVER w AS silence
    FROM tel WINDOW w AS (PARTITION BY vin ORDER BY t, tie)
),
b AS (
    SELECT *,
      sum(CASE WHEN silence > {gap * US} THEN 1 ELSE 0 END) OVER w AS isl,
      sum(CASE WHEN is_on THEN 1 ELSE 0 END) OVER w AS seg
    FROM a WINDOW w AS (PARTITION BY vin ORDER BY rn ROWS UNBOUNDED PRECEDING)
),
c AS (
    SELECT *,
      min(CASE WHEN is_on THEN isl END) OVER (PARTITION BY vin, seg) AS seg_isl,
      min(CASE WHEN is_on THEN t END) OVER (PARTITION BY vin, seg) AS seg_t,
      min(CASE WHEN is_off THEN t END) OVER (PARTITION BY vin, seg, isl ORDER BY rn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hang_before
    FROM b WHERE seg > 0
),
s AS (
    SELECT vin, seg, any_value(seg_isl) AS seg_isl, any_value(seg_t) AS seg_t,
      min(t) FILTER (WHERE is_off AND isl = seg_isl) AS hang,
      max(t) FILTER (WHERE isl = seg_isl) AS last_in
    FROM c GROUP BY vin, seg
),
s2 AS (
    SELECT *, lag(hang) OVER w AS p_hang,
      coalesce(seg_isl <> lag(seg_isl) OVER w OR seg_t - lag(hang) OVER w > {hang * US}, lag(seg) OVER w IS NULL) AS opens
    FROM s WINDOW w AS (PARTITION BY vin ORDER BY seg)
),
s3 AS (
    SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY vin ORDER BY seg ROWS UNBOUNDED PRECEDING) AS trip
    FROM s2
),
m AS (
    SELECT c.*, s3.trip, s3.opens, s3.p_hang, s3.hang,
      (c.is_on OR (c.isl = c.seg_isl AND c.hang_before IS NULL)) AS active
    FROM c JOIN s3 USING (vin, seg)
),
acts AS (
    SELECT *, is_on AND opens AS opening, is_on AND NOT opens AND p_hang IS NOT NULL AS resuming,
      CASE WHEN is_on AND (opens OR p_hang IS NOT NULL) THEN 2 ELSE 1 END AS w
    FROM m WHERE active
),
bounds AS (
    SELECT vin, trip, min(seg_t) AS start_t, arg_max(coalesce(hang, last_in), seg) AS end_t,
      arg_max(hang, seg) AS last_hang, max(seg) AS last_seg, arg_max(seg_isl, seg) AS last_isl
    FROM s3 GROUP BY vin, trip
),
trip AS (
    SELECT x.*, y.max_speed, y.speed_sum, y.weight, y.last_moved
    FROM bounds x JOIN (
      SELECT vin, trip, max(speed) AS max_speed, sum(speed * w) AS speed_sum, sum(w) AS weight,
        max(CASE WHEN speed > 0 THEN t END) AS last_moved
      FROM acts GROUP BY vin, trip) y USING (vin, trip)
)"""


def closing(hang: int = 900) -> str:
    """CTE ``closed``: the coordinates of the row that closes each trip, if any does."""
    return f"""closer AS (
    SELECT x.vin, x.trip, min(r.rn) AS rn
    FROM bounds x JOIN c r ON r.vin = x.vin AND r.seg = x.last_seg
      AND (r.isl <> x.last_isl OR r.t - r.hang_before > {hang * US})
    GROUP BY x.vin, x.trip
),
follower AS (
    SELECT x.vin, x.trip, min(r.rn) AS rn
    FROM bounds x JOIN c r ON r.vin = x.vin AND r.seg = x.last_seg + 1 GROUP BY x.vin, x.trip
),
closed AS (
    SELECT x.vin, x.trip, x.start_t, x.end_t, r.rn AS close_rn, coalesce(r.lon, 0.0) AS c_lon, coalesce(r.lat, 0.0) AS c_lat
    FROM bounds x
    LEFT JOIN closer k USING (vin, trip) LEFT JOIN follower f USING (vin, trip)
    LEFT JOIN a r ON r.vin = x.vin AND r.rn = coalesce(k.rn, f.rn)
)"""


def _condition(rule: P.EventRule) -> str:
    if rule.flag:
        return f"coalesce({rule.flag} = 1, false)"
    if rule.low == rule.high:
        return f"speed = {rule.low}"
    upper = "" if rule.high is None else f" AND speed <= {rule.high}"
    return f"speed > {rule.low}{upper}"


def events(hang: int = 900) -> str:
    """CTE ``ev``: every event of every trip."""
    kinds = ", ".join(
        f"{{'name': '{r.name}', 'least': {r.min_seconds * US}, 'holds': {_condition(r)}}}" for r in P.TRACKED_EVENTS
    )
    return f"""{closing(hang)},
kinds AS (
    SELECT vin, trip, rn, t, lon, lat, unnest([{kinds}]) AS e FROM acts
),
flat AS (
    SELECT vin, trip, rn, t, lon, lat, e.name AS event_name, e.least AS least, e.holds AS holds FROM kinds
),
stretch AS (
    SELECT *, sum(CASE WHEN holds THEN 0 ELSE 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS grp,
      lead(t) OVER w AS n_t, lead(lon) OVER w AS n_lon, lead(lat) OVER w AS n_lat
    FROM flat WINDOW w AS (PARTITION BY vin, trip, event_name ORDER BY rn)
),
tracked AS (
    SELECT vin, trip, event_name, any_value(least) AS least, min(t) AS s_t, arg_min(lon, rn) AS s_lon, arg_min(lat, rn) AS s_lat,
      arg_max(n_t, rn) FILTER (WHERE true) AS e_t0, max(rn) AS last_rn
    FROM stretch WHERE holds GROUP BY vin, trip, event_name, grp
),
ended AS (
    SELECT k.vin, k.trip, k.event_name, k.least, k.s_t, k.s_lon, k.s_lat,
      coalesce(z.n_t, d.end_t) AS e_t,
      CASE WHEN z.n_t IS NULL THEN d.c_lon ELSE z.n_lon END AS e_lon,
      CASE WHEN z.n_t IS NULL THEN d.c_lat ELSE z.n_lat END AS e_lat, d.start_t
    FROM tracked k
    JOIN stretch z ON z.vin = k.vin AND z.trip = k.trip AND z.event_name = k.event_name AND z.rn = k.last_rn
    JOIN closed d ON d.vin = k.vin AND d.trip = k.trip
),
moving AS (
    SELECT vin, trip, min(t) AS first_t, arg_min(lon, rn) AS f_lon, arg_min(lat, rn) AS f_lat, max(t) AS last_t
    FROM acts WHERE speed > 0 GROUP BY vin, trip
),
ev AS (
    SELECT vin, start_t, event_name, s_t, e_t, s_lon, s_lat, e_lon, e_lat FROM ended WHERE s_t < e_t AND e_t - s_t >= least
    UNION ALL
    SELECT vin, start_t, '{P.BEFORE_EVENT}', start_t, first_t, f_lon, f_lat, f_lon, f_lat
    FROM moving JOIN closed USING (vin, trip) WHERE start_t < first_t
    UNION ALL
    SELECT vin, start_t, '{P.AFTER_EVENT}', last_t, end_t, c_lon, c_lat, c_lon, c_lat
    FROM moving JOIN closed USING (vin, trip) WHERE last_t < end_t
)"""


def pieces(idle: int = 900, hang: int = 300) -> str:
    """CTE ``piece``: trips with idle splitting."""
    return f"""{trips(hang)},
p AS (
    SELECT x.*, y.start_t AS trip_t, y.end_t AS trip_end,
      max(CASE WHEN x.speed > 0 THEN x.t END) OVER (PARTITION BY x.vin, x.trip ORDER BY x.rn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS psp,
      x.t - x.silence AS prev_t
    FROM acts x JOIN bounds y USING (vin, trip)
),
p2 AS (
    SELECT *, sum(CASE WHEN speed > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY vin, trip ORDER BY rn
          ROWS UNBOUNDED PRECEDING) AS move_no,
      coalesce(speed = 0 AND t - psp > {idle * US}, false) AS late
    FROM p
),
p3 AS (
    SELECT *, late AND row_number() OVER (PARTITION BY vin, trip, move_no, late ORDER BY rn) = 1 AS stops FROM p2
),
p4 AS (
    SELECT *, max(CASE WHEN stops THEN 1 ELSE 0 END) OVER (PARTITION BY vin, trip, move_no) AS group_stops FROM p3
),
p5 AS (
    SELECT z.*, coalesce(z.speed > 0 AND NOT z.opening AND NOT z.resuming AND (
        (z.psp IS NULL AND z.t - z.trip_t > {idle * US}) OR (g.stopped = 1 AND z.t - z.psp > {idle * US})), false) AS leaves
    FROM p4 z LEFT JOIN (SELECT vin, trip, move_no + 1 AS move_no, max(group_stops) AS stopped
        FROM p4 GROUP BY ALL) g
      ON g.vin = z.vin AND g.trip = z.trip AND g.move_no = z.move_no
),
p6 AS (
    SELECT *, sum(CASE WHEN stops OR leaves THEN 1 ELSE 0 END) OVER (PARTITION BY vin, trip ORDER BY rn
        ROWS UNBOUNDED PRECEDING) AS piece_no,
      CASE WHEN stops OR leaves THEN 1 ELSE w END AS pw
    FROM p5
),
p7 AS (
    SELECT vin, trip, piece_no, any_value(trip_t) AS trip_t, any_value(trip_end) AS trip_end,
      max(speed) AS max_speed, sum(speed * pw) AS speed_sum, sum(pw) AS weight,
      max(CASE WHEN stops THEN psp WHEN leaves THEN prev_t END) AS cut_t,
      max(CASE WHEN stops AND resuming THEN 1 ELSE 0 END) AS stray,
      max(CASE WHEN speed > 0 THEN t END) AS last_moved
    FROM p6 GROUP BY vin, trip, piece_no
),
piece AS (
    SELECT vin, trip, last_moved, lead(piece_no) OVER w IS NULL AS is_last, coalesce(cut_t, trip_t) AS start_t,
      coalesce(lead(cut_t) OVER w, trip_end) AS end_t,
      max_speed, speed_sum, weight + coalesce(lead(stray) OVER w, 0) AS weight
    FROM p7 WINDOW w AS (PARTITION BY vin, trip ORDER BY piece_no)
)"""


# Text of a trip's start as it enters its id: no fraction, or six digits of it.
START_TEXT = (
    "CASE WHEN start_t % 1000000 = 0 THEN strftime(make_timestamp(start_t), '%Y-%m-%d %H:%M:%S')"
    " ELSE strftime(make_timestamp(start_t), '%Y-%m-%d %H:%M:%S.%f') END"
)
TRIP_ID = f"md5(vin || '_' || {START_TEXT})"
TRIP_COLUMNS = f"""{TRIP_ID} AS trip_id, vin,
  CASE WHEN max_speed > 0 THEN 'DRIVING' ELSE 'PARKING' END AS trip_type,
  make_timestamp(start_t) AS start_time, make_timestamp(end_t) AS end_time,
  max_speed, round(speed_sum / weight, 7) AS avg_speed, CAST(weight AS BIGINT) AS samples"""
EVENT_COLUMNS = f"""{TRIP_ID} AS trip_id, vin, event_name, make_timestamp(start_t) AS trip_start,
  make_timestamp(s_t) AS start_time, make_timestamp(e_t) AS end_time,
  s_lon AS start_lon, s_lat AS start_lat, e_lon AS end_lon, e_lat AS end_lat"""
