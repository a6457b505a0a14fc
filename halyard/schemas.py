"""Schemas of the datasets, and a check that a table has what an operator reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


def struct(fields: str) -> T.StructType:
    """A schema from "name type, ..."; unlike Spark's own parser it needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in fields.split(", "))])


DEVICES = struct("state string, IMEI string")
TRIPS = struct("Trip bigint, IMEI string, Started timestamp, Ended timestamp")
POINTS = T.StructType(
    [
        T.StructField("Trip", T.LongType()),
        T.StructField("Time", T.TimestampType()),
        T.StructField("Lat", T.DoubleType()),
        T.StructField("Lng", T.DoubleType()),
        T.StructField("Speed (M/S)", T.DoubleType()),
        T.StructField("Range (Meters)", T.DoubleType()),
        T.StructField("Heading", T.DoubleType()),
        T.StructField("seq", T.LongType()),
    ]
)
GRIDDED = struct("Trip bigint, lat_grid double, lng_grid double, time_spent_mins double, mean_speed double, mean_range double, first_seen timestamp, last_seen timestamp, n_points bigint")
SUMMARIES = struct("lat_grid_1km double, lng_grid_1km double, avg_speed double, avg_range double, total_visits bigint, original_cells bigint, total_points bigint, avg_time_hours double")
OBJECTS = struct("name string, updated timestamp")
RESULTS = struct("status string, trip_id bigint, message string")


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    if lacking := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df
