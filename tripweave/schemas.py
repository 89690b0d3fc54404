"""Declared schemas of inputs, results and carried state."""

from __future__ import annotations

from pyspark.sql import types as T

from tripweave import profiles as P

TELEMETRY = T.StructType(
    [
        T.StructField(P.VIN, T.StringType()),
        T.StructField(P.TIMESTAMP, T.TimestampType()),
        T.StructField(P.POWER, T.IntegerType()),
        T.StructField(P.SPEED, T.DoubleType()),
        T.StructField(P.LON, T.DoubleType()),
        T.StructField(P.LAT, T.DoubleType()),
    ]
    + [T.StructField(f, T.IntegerType()) for f in P.FLAGS]
)

# The wire schema of the vehicle log topic.
WIRE_DDL = "vin STRING, report_time TIMESTAMP, vehicle_status INT, odometer DOUBLE, speed DOUBLE"
# Wire name -> canonical name.
WIRE_MAPPING = {"report_time": P.TIMESTAMP, "vehicle_status": P.POWER, "speed": P.SPEED}

# Columns of trip and event rows, told apart by row_type.
RESULT = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("vin", T.StringType()),
        T.StructField("row_type", T.StringType()),
        T.StructField("trip_type", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("max_speed", T.DoubleType()),
        T.StructField("avg_speed", T.DoubleType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("last_speed_ts", T.TimestampType()),
        T.StructField("state_speeds", T.StringType()),
    ]
)
# The older profiles have neither a trip id nor positions.
SHORT_RESULT = T.StructType(
    [f for f in RESULT if f.name not in ("trip_id", "start_lon", "start_lat", "end_lon", "end_lat")]
)

# State of a vehicle with an open trip between two runs. The speed list of the trip is
# kept as sum, weight and maximum, so a row does not grow with the trip.
CARRY = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("trip_type", T.StringType()),
        T.StructField("trip_start", T.TimestampType()),
        T.StructField("hang_start", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("last_speed_ts", T.TimestampType()),
        T.StructField("speed_sum", T.DoubleType()),
        T.StructField("speed_weight", T.LongType()),
        T.StructField("speed_max", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
        T.StructField(
            "open_events",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("start_time", T.TimestampType()),
                        T.StructField("lon", T.DoubleType()),
                        T.StructField("lat", T.DoubleType()),
                    ]
                ),
            ),
        ),
    ]
)
