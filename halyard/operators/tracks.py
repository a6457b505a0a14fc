"""Gridding of trips: time gaps, cells and trimming. Two windows and one aggregate share one exchange by Trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from halyard.functions.numeric import mean_of_known, micros, minutes, positive, snap, strict
from halyard.schemas import require

#: Cell size in metres and its degrees.
GRID_DEGREES = {100: 0.001, 250: 0.0025, 500: 0.005, 1000: 0.01}
#: What a table of points must have; the heading is not read.
REQUIRED = ("Trip", "Time", "Lat", "Lng", "Speed (M/S)", "Range (Meters)", "Heading")
COLUMNS = ("Trip", "Time", "Lat", "Lng", "Speed (M/S)", "Range (Meters)")


def degrees(grid_size: int) -> float:
    if grid_size not in GRID_DEGREES:
        raise ValueError(f"no cells of {grid_size} m; there are: {', '.join(map(str, GRID_DEGREES))}")
    return GRID_DEGREES[grid_size]


def point_gaps(points: DataFrame) -> DataFrame:
    """points with gap_micros to the next point of the trip; the last point has the gap before it again.

    Points of one time stay in the order of seq, which stands for the order of the input."""
    in_order = Window.partitionBy("Trip").orderBy(F.col("Time").asc_nulls_last(), "seq")
    now = micros(F.col("Time"))
    return points.withColumn("gap_micros", F.coalesce(F.lead(now).over(in_order) - now, now - F.lag(now).over(in_order)))


def cells(points: DataFrame, grid_size: int = 500) -> DataFrame:
    """One row for each cell of a trip in which time was spent."""
    step = degrees(grid_size)
    require(points, *REQUIRED)
    if "seq" not in points.columns:
        points = points.withColumn("seq", F.lit(0))
    at = point_gaps(points.select(*[F.col(f"`{c}`") for c in COLUMNS], "seq")).withColumns({"lat_grid": snap(F.col("Lat"), step), "lng_grid": snap(F.col("Lng"), step)})
    return (
        at.groupBy("Trip", "lat_grid", "lng_grid")
        .agg(
            minutes(F.sum("gap_micros")).alias("time_spent_mins"),
            mean_of_known(F.col("`Speed (M/S)`")).alias("mean_speed"),
            mean_of_known(F.col("`Range (Meters)`")).alias("mean_range"),
            strict(F.min, F.col("Time")).alias("first_seen"),
            strict(F.max, F.col("Time")).alias("last_seen"),
            F.count(F.lit(1)).alias("n_points"),
        )
        .where(positive(F.col("time_spent_mins")))
    )


def trim_ranks(visited: DataFrame) -> DataFrame:
    """visited with each cell's rank in its trip by first_seen, and the trip's number of cells."""
    trip = Window.partitionBy("Trip")
    return visited.withColumns({"trip_rank": F.row_number().over(trip.orderBy(F.col("first_seen").asc_nulls_last(), "lat_grid", "lng_grid")), "trip_cells": F.count(F.lit(1)).over(trip)})


def grid_tracks(points: DataFrame, grid_size: int = 500) -> DataFrame:
    """Cells of each trip without its first two and last two; trips of four cells or fewer vanish."""
    ranked = trim_ranks(cells(points, grid_size))
    return ranked.where((F.col("trip_rank") >= 3) & (F.col("trip_rank") <= F.col("trip_cells") - 2)).drop("trip_rank", "trip_cells")
