"""Summaries that are added to: what each fine cell needs, so that new trips never have old ones read again.

The state of some gridded rows is two tables. `cells` has, for each fine cell, the number of rows, the sums and known
counts of what is averaged, and whether a row had no trip; `visits` has the cell's trips as bitmaps, one for each bucket of trip ids, so that a
trip in two increments counts once. Both merge by cell: sums add up, flags and bitmaps unite. The state of a union
is the merge of the states, and summed_up() gives what grid_summaries() gives of the union (sums of doubles in another order aside).

Defined results: null rules are those of summaries.by_cell: any null makes its mean null, NaN stays NaN, null trips count as one; an empty
state has no cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.operators.summaries import bounded, regrid

CELL = ("lat_grid", "lng_grid")
#: A gridded column and the name of its mean.
MEANS = (("time_spent_mins", "avg_time_mins"), ("mean_speed", "avg_speed"), ("mean_range", "avg_range"))


def cells(gridded: DataFrame) -> DataFrame:
    sums = [x for c, _ in MEANS for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_known"))]
    return gridded.groupBy(*CELL).agg(F.count(F.lit(1)).alias("rows"), *sums, F.sum("n_points").alias("total_points"), F.bool_or(F.col("Trip").isNull()).alias("no_trip"))


def visits(gridded: DataFrame) -> DataFrame:
    trips = gridded.where("Trip is not null").select(*CELL, F.bitmap_bucket_number("Trip").alias("bucket"), F.bitmap_bit_position("Trip").alias("bit"))
    return trips.groupBy(*CELL, "bucket").agg(F.bitmap_construct_agg("bit").alias("trips"))


def merged_cells(several: DataFrame) -> DataFrame:
    sums = [x for c, _ in MEANS for x in (F.sum(f"{c}_sum").alias(f"{c}_sum"), F.sum(f"{c}_known").alias(f"{c}_known"))]
    return several.groupBy(*CELL).agg(F.sum("rows").alias("rows"), *sums, F.sum("total_points").alias("total_points"), F.bool_or("no_trip").alias("no_trip"))


def merged_visits(several: DataFrame) -> DataFrame:
    return several.groupBy(*CELL, "bucket").agg(F.bitmap_or_agg("trips").alias("trips"))


def _mean(column: str) -> Column:
    return F.when(F.col(f"{column}_known") == F.col("rows"), F.col(f"{column}_sum") / F.col("rows"))


def by_cell(cell_states: DataFrame, visit_states: DataFrame) -> DataFrame:
    """One row for each fine cell, as summaries.by_cell makes it; the states may be of several increments."""
    count = merged_visits(visit_states).groupBy(*CELL).agg(F.sum(F.bitmap_count("trips")).alias("trips"))
    known = merged_cells(cell_states).join(count.select(*[F.col(c).alias(f"_{c}") for c in CELL], "trips"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CELL], "left")
    number = F.coalesce("trips", F.lit(0)) + F.col("no_trip").cast("bigint")
    return known.select(*CELL, *[_mean(c).alias(name) for c, name in MEANS], number.alias("visits"), "total_points")


def summed_up(cell_states: DataFrame, visit_states: DataFrame, min_hours: float = 0.15, max_hours: float = 15.0) -> DataFrame:
    """grid_summaries() of all gridded rows that the states are of."""
    return bounded(regrid(by_cell(cell_states, visit_states)), min_hours, max_hours)
