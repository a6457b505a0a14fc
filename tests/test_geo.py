"""Coverings and the lookup by keys against plain containment, and trips that arrive in pieces."""

import json
import math
import random
from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from halyard.operators import geo
from halyard.operators.tracks import grid_tracks
from halyard.schemas import POINTS
from halyard.sources import store
from halyard.sources.geojson import GEOMETRY
from halyard.streaming.pieces import STORE, grid_pieces

from .test_workflows import START


def ring(rng, lng, lat, size, n):
    turns = sorted(rng.random() * 2 * math.pi for _ in range(n))
    out = [[lng + math.cos(t) * size * (0.5 + rng.random() / 2), lat + math.sin(t) * size * (0.5 + rng.random() / 2)] for t in turns]
    return [*out, out[0]]


def shapes():
    rng = random.Random(2)
    small = [[39 + 0.2 * k, -4.0] for k in range(3)]
    hole = ring(rng, 39.5, -5, 0.1, 9)
    return {
        "triangle": ("Polygon", [[[39, -4], [39.4, -4.1], [39.2, -3.7], [39, -4]]]),
        "ragged": ("Polygon", [ring(rng, 40, -4.5, 0.8, 40)]),
        "hole": ("Polygon", [ring(rng, 39.5, -5, 0.5, 30), hole]),
        "two": ("MultiPolygon", [[ring(rng, 38, -4, 0.3, 12)], [ring(rng, 41, -6, 0.3, 12)]]),
        "wide": ("Polygon", [[[20, -20], [60, -20], [60, 15], [20, 15], [20, -20]]]),
        "meridian": ("Polygon", [[[175, -5], [-175, -5], [-175, 5], [175, 5], [175, -5]]]),
        "pole": ("Polygon", [[[k * 60 - 180, 80] for k in range(6)]]),
        "line": ("LineString", small),
        "flat": ("Polygon", [[small[0], small[0], small[0]]]),
        "garbled": ("Polygon", "x"),
    }


def places():
    rng = random.Random(7)
    some = [(39 + rng.gauss(0, 1), -4.5 + rng.gauss(0, 1)) for _ in range(900)] + [(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(400)]
    some += [(rng.choice([-1, 1]) * 180 + rng.gauss(0, 4), rng.gauss(0, 4)) for _ in range(200)] + [(rng.uniform(-180, 180), rng.uniform(75, 90)) for _ in range(200)]
    return some


def test_lookup_equals_plain_containment(spark):
    regions = spark.createDataFrame([(n, (t, json.dumps(c))) for n, (t, c) in shapes().items()] + [("none", None), ("again", ("Polygon", json.dumps(shapes()["triangle"][1])))], f"name string, geometry {GEOMETRY.simpleString()}")
    finest = 10
    index = geo.coverings(regions, finest=finest).cache()
    named = regions.select("name", geo.region_id(F.col("geometry")).alias("region"))
    at = spark.createDataFrame([(k, x, y, -1) for k, (x, y) in enumerate(places())] + [(5000, None, 1.0, -1), (5001, float("nan"), 1.0, -1), (5002, 1.0, 91.0, -1)], "id int, lng double, lat double, key int")
    found = geo.regions_of(at, index, finest=finest)
    assert found.columns == ["id", "lng", "lat", "key", "region"]
    got = Counter((r.id, r.name) for r in found.join(named, "region").collect())
    want = Counter()
    for n, (t, c) in shapes().items():
        edges = geo.edges_of(geo.rings(t, json.dumps(c)))
        for k, (x, y) in enumerate(places()):
            if len(edges) and geo.holds(geo.vectors(np.float64(x), np.float64(y)), edges):
                want[k, n] += 1
                if n == "triangle":
                    want[k, "again"] += 1
    assert got == want and {n for _, n in got} == {"triangle", "again", "ragged", "hole", "two", "wide", "meridian", "pole"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    # whole cells are as coarse as they can be, and a boundary cell has only the edges near it
    sizes = index.groupBy(F.col("anchor").isNull()).agg(F.max(F.size("edges")).alias("most"), F.count("*")).collect()
    assert {r[0]: r.most for r in sizes}[True] == 0 and index.where("anchor is null").select(F.countDistinct(F.shiftright("key", 50))).first()[0] > 2


def test_places_on_a_boundary_count_by_the_arc_from_far(spark):
    """Cells that are vertices of a region: as crossings of all its edges have it, at any level of the index."""
    corners = [[39 + dx, -4.1 + dy] for dx, dy in ((0.0, 0.0), (0.031, 0.007), (0.027, 0.033), (-0.006, 0.029))]
    hole = [[39 + dx, -4.1 + dy] for dx, dy in ((0.011, 0.011), (0.021, 0.013), (0.014, 0.022))]
    wide = [[15, -10], [42, -10], [42, 13], [15, 13]]  # holds the far place
    shapes = {"small": ("Polygon", [[*corners, corners[0]], [*hole, hole[0]]]), "wide": ("Polygon", [wide])}
    regions = spark.createDataFrame([(n, (t, json.dumps(c))) for n, (t, c) in shapes.items()], f"name string, geometry {GEOMETRY.simpleString()}")
    named = regions.select("name", geo.region_id(F.col("geometry")).alias("region"))
    on = [*corners, *hole, *wide]
    on += [(round(x / 0.001) * 0.001, round(y / 0.001) * 0.001) for x, y in [*corners, *hole]]
    at = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(on)], "id int, lng double, lat double")
    far = geo.vectors(*map(np.float64, geo.FAR))
    want = set()
    for n, (t, c) in shapes.items():
        parts = geo.edges_of(geo.rings(t, json.dumps(c)))
        for k, (x, y) in enumerate(on):
            p = geo.vectors(np.float64(x), np.float64(y))
            odd = False
            for a, b in np.concatenate(parts):  # without the fused sums of a matrix product, which end otherwise at a vertex
                dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
                cross = lambda u, v: (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
                ab, way = cross(a, b), cross(p, far)
                odd ^= bool(dot(ab, p) * dot(ab, far) < 0 and dot(a, way) * dot(b, way) < 0 and dot(ab, p) * dot(b, way) > 0)
            if odd != (n == "wide"):
                want.add((k, n))
    for finest in (8, 10):
        found = geo.regions_of(at, geo.coverings(regions, finest=finest), finest=finest)
        assert {(r.id, r.name) for r in found.join(named, "region").collect()} == want


def test_an_indexed_collection(spark, tmp_path):
    rows = [("coast", 1, ("Polygon", json.dumps([[[39, -4], [39.4, -4.1], [39.2, -3.7], [39, -4]]]))), ("open", 2, None), ("all", 3, ("Polygon", json.dumps([[[38, -5], [40, -5], [40, -3], [38, -3], [38, -5]]])))]
    maps = spark.createDataFrame(rows, f"region string, n int, geometry {GEOMETRY.simpleString()}")
    asked = []
    store.push(maps, str(tmp_path), "maps", "db", geo=True, run=asked.append)
    assert json.loads(asked[0])["createIndexes"] == "maps"
    cells = spark.createDataFrame([(39.2, -3.95, 5), (38.2, -4.5, 6), (10.0, 10.0, 7)], "lng_grid double, lat_grid double, visits int")
    got = store.located(spark, cells, str(tmp_path), "maps", "db", "lng_grid", "lat_grid")
    assert {(r.visits, r.region, r.n) for r in got.collect()} == {(5, "coast", 1), (5, "all", 3), (6, "all", 3)}
    assert got.columns == ["lng_grid", "lat_grid", "visits", "region", "n"]
    store.push(maps, str(tmp_path), "plain", "db")
    with pytest.raises(ValueError, match="no index"):
        store.located(spark, cells, str(tmp_path), "plain", "db", "lng_grid", "lat_grid")


# --- trips in pieces


def trip_points(trip, first, n=8):
    return [(trip, START + timedelta(minutes=first + i), -4 - 0.005 * i, 39.0, 1.0 + i, 1.0, 0.0, i) for i in range(n)]


def test_trips_split_over_files_and_a_restart(spark, tmp_path):
    before = spark.conf.get(STORE[0])
    spark.conf.set(*STORE)
    rows = [r for t, first in ((1, 0), (2, 3), (3, 200), (4, 230)) for r in trip_points(t, first)]
    rows.sort(key=lambda r: r[1])
    rows.insert(3, (1, None, -4.0, 39.0, 9.0, 1.0, 0.0, 99))
    files = [rows[k : k + 4] for k in range(0, len(rows), 4)]
    again = trip_points(1, 190, 2)  # of a trip that is closed by then
    files.insert(-2, again)
    files.append([(9, START + timedelta(days=3), -4.0, 39.0, 1.0, 1.0, 0.0, 0)])  # lets the watermark pass all

    def put(n, some):
        spark.createDataFrame(some, POINTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{n:03}")

    def run():
        grid_pieces(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck", timedelta(minutes=60), files_at_once=2).awaitTermination(300)

    try:
        for n, some in enumerate(files[:6]):
            put(n, some)
        run()
        for n, some in enumerate(files[6:], 6):
            put(n, some)
        run()
        run()
    finally:
        spark.conf.set(STORE[0], before)
    want = grid_tracks(spark.createDataFrame(rows, POINTS))
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.select("Trip").distinct().count() == 4
