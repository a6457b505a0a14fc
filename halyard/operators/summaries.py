"""Activity by 1 km cell: means of the means of the finer cells, unweighted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.functions.numeric import distinct_with_null, snap, strict

KM = 0.01


def by_cell(gridded: DataFrame) -> DataFrame:
    """One row for each fine cell; any null among its values makes the mean null."""
    return gridded.groupBy("lat_grid", "lng_grid").agg(
        strict(F.avg, F.col("time_spent_mins")).alias("avg_time_mins"),
        strict(F.avg, F.col("mean_speed")).alias("avg_speed"),
        strict(F.avg, F.col("mean_range")).alias("avg_range"),
        distinct_with_null(F.col("Trip")).alias("visits"),
        F.sum("n_points").alias("total_points"),
    )


def regrid(fine: DataFrame) -> DataFrame:
    """One row for each 1 km cell. A trip in two fine cells counts as two visits."""
    return (
        fine.withColumns({"lat_grid_1km": snap(F.col("lat_grid"), KM), "lng_grid_1km": snap(F.col("lng_grid"), KM)})
        .groupBy("lat_grid_1km", "lng_grid_1km")
        .agg(
            strict(F.avg, F.col("avg_time_mins")).alias("avg_time_mins"),
            strict(F.avg, F.col("avg_speed")).alias("avg_speed"),
            strict(F.avg, F.col("avg_range")).alias("avg_range"),
            F.sum("visits").alias("total_visits"),
            F.count(F.lit(1)).alias("original_cells"),
            F.sum("total_points").alias("total_points"),
        )
    )


def bounded(regridded: DataFrame, min_hours: float, max_hours: float) -> DataFrame:
    """avg_time_hours in place of avg_time_mins, cells within both bounds only."""
    hours = regridded.withColumn("avg_time_hours", F.col("avg_time_mins") / F.lit(60.0)).drop("avg_time_mins")
    return hours.where(F.col("avg_time_hours").between(F.lit(float(min_hours)), F.lit(float(max_hours))) & ~F.isnan("avg_time_hours"))


def grid_summaries(gridded: DataFrame, min_hours: float = 0.15, max_hours: float = 15.0) -> DataFrame:
    """1 km cells whose mean time lies within both bounds."""
    return bounded(regrid(by_cell(gridded)), min_hours, max_hours)
