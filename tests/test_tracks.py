"""Hand-worked cases of gridding and of the summaries."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from halyard.functions import numeric
from halyard.operators import summaries, tracks
from halyard.schemas import GRIDDED, POINTS

START = datetime(2024, 1, 1)


def at(minute):
    return None if minute is None else START + timedelta(minutes=minute)


def points(spark, rows):
    """rows: (trip, minute, lat, lng, speed)"""
    return spark.createDataFrame([(t, at(m), lat, lng, speed, 10.0, 0.0, n) for n, (t, m, lat, lng, speed) in enumerate(rows)], POINTS)


def line(n, trip=1, speeds=None):
    return [(trip, float(i), -4.0 - 0.005 * i, 39.0, (speeds or {}).get(i, 1.0)) for i in range(n)]


def test_straight_trip_loses_two_cells_at_either_end(spark):
    rows = tracks.grid_tracks(points(spark, line(7))).orderBy("first_seen").collect()
    assert [(round(r.lat_grid, 6), r.time_spent_mins, r.n_points) for r in rows] == [(-4.01, 1.0, 1), (-4.015, 1.0, 1), (-4.02, 1.0, 1)]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_a_cell_without_speeds_has_nan_and_so_do_means_over_it(spark, missing):
    rows = line(7)
    rows[3] = (*rows[3][:4], missing)
    gridded = tracks.grid_tracks(points(spark, rows))
    speeds = [r.mean_speed for r in gridded.orderBy("first_seen").collect()]
    assert speeds[1] != speeds[1] and speeds[0] == 1.0
    km = summaries.regrid(summaries.by_cell(gridded)).collect()
    assert any(r.avg_speed != r.avg_speed for r in km)


@pytest.mark.parametrize(("n", "left"), [(1, 0), (4, 0), (5, 1), (6, 2)])
def test_short_trips_vanish(spark, n, left):
    assert tracks.grid_tracks(points(spark, line(n))).count() == left


def test_the_last_gap_counts_again(spark):
    rows = points(spark, [(1, m, -4.0, 39.0, 1.0) for m in (0, 1, 5)])
    assert [r.gap_micros / 6e7 for r in tracks.point_gaps(rows).orderBy("seq").collect()] == [1, 4, 4]


def test_ties_of_first_seen_go_by_label(spark):
    lat = [-4.0, -4.01, -4.02, -4.01, -4.03, -4.04, -4.05]
    rows = points(spark, [(1, m, x, 39.0, 1.0) for m, x in zip((0, 1, 1, 2, 3, 4, 5), lat, strict=True)])
    ranks = {round(r.lat_grid, 2): r.trip_rank for r in tracks.trim_ranks(tracks.cells(rows)).collect()}
    assert ranks[-4.02] == 2 and ranks[-4.01] == 3


def test_equal_times_keep_the_order_of_the_input(spark):
    rows = points(spark, [(1, 0, -4.0, 39.0, 1.0), (1, 0, -4.01, 39.0, 1.0), (1, 1, -4.02, 39.0, 1.0)])
    assert -4.0 not in {round(r.lat_grid, 2) for r in tracks.cells(rows).collect()}


def test_unknown_grid_size(spark):
    with pytest.raises(ValueError, match="100, 250, 500, 1000"):
        tracks.grid_tracks(points(spark, line(7)), 300)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="Lng"):
        tracks.cells(points(spark, line(7)).drop("Lng"))
    with pytest.raises(ValueError, match="Heading"):
        tracks.cells(points(spark, line(7)).drop("Heading"))


def test_a_missing_time_makes_both_ends_null(spark):
    rows = points(spark, [(1, 0, -4.0, 39.0, 1.0), (1, 1, -4.0, 39.0, 1.0), (1, None, -4.0, 39.0, 1.0)])
    (r,) = tracks.cells(rows).collect()
    assert r.first_seen is None and r.last_seen is None and r.n_points == 3


def test_half_goes_to_the_even_label(spark):
    lat = [0.015, 0.01, 0.0025, -0.0025, -0.01, -0.015, -0.02]
    rows = tracks.cells(points(spark, [(1, float(m), x, 0.0, 1.0) for m, x in enumerate(lat)])).collect()
    assert {r.lat_grid: r.n_points for r in rows}[0.0] == 2


def test_half_even_matters_for_the_summaries(spark):
    """Rounding halves up instead gives another label for a good part of the 500 m labels."""
    labels = spark.range(-2000, 2000).select((F.col("id") * F.lit(0.005)).alias("x"))
    even, up = numeric.snap(F.col("x"), 0.01), F.round(F.col("x") / F.lit(0.01)) * F.lit(0.01)
    assert labels.where(even != up).count() > 500


def test_input_order_and_splitting_by_trip_change_nothing(spark):
    rows = [r for t in range(4) for r in line(9, t)]
    whole = sorted(map(tuple, tracks.grid_tracks(points(spark, rows)).collect()))
    mixed = points(spark, rows).orderBy(F.rand(3))
    assert sorted(map(tuple, tracks.grid_tracks(mixed).collect())) == whole
    parts = [tracks.grid_tracks(points(spark, rows).where(F.col("Trip") == t)) for t in range(4)]
    assert sorted(tuple(r) for p in parts for r in p.collect()) == whole


def test_points_before_trimming_are_all_points(spark):
    rows = [r for t in range(3) for r in line(6, t)]
    assert tracks.cells(points(spark, rows)).agg(F.sum("n_points")).first()[0] == 18


def gridded(spark, rows):
    """rows: (trip, lat, lng, minutes)"""
    return spark.createDataFrame([(t, lat, lng, m, 1.0, 1.0, START, START, 2) for t, lat, lng, m in rows], GRIDDED)


def test_summary_is_a_mean_of_cell_means(spark):
    table = gridded(spark, [(1, -4.0, 39.0, 10.0), (2, -4.0, 39.0, 10.0), (3, -4.0, 39.0, 10.0), (1, -4.004, 39.0, 20.0)])
    (r,) = summaries.grid_summaries(table).collect()
    assert r.avg_time_hours == 0.25 and r.original_cells == 2 and r.total_visits == 4 and r.total_points == 8


def test_bounds_are_inclusive(spark):
    table = gridded(spark, [(1, -4.0, 39.0, 10.0), (1, -4.004, 39.0, 20.0)])
    assert summaries.grid_summaries(table, 0.25, 0.25).count() == 1
    assert summaries.grid_summaries(table, 0.2501, 1.0).count() == 0


def test_a_missing_trip_is_one_visit(spark):
    (r,) = summaries.by_cell(gridded(spark, [(1, -4.0, 39.0, 1.0), (None, -4.0, 39.0, 1.0), (None, -4.0, 39.0, 1.0)])).collect()
    assert r.visits == 2


def test_one_missing_value_makes_the_mean_null(spark):
    (r,) = summaries.by_cell(gridded(spark, [(1, -4.0, 39.0, 1.0), (2, -4.0, 39.0, None)])).collect()
    assert r.avg_time_mins is None and r.avg_speed == 1.0
