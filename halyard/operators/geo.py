"""Which regions hold a place: coverings of polygons by nested cells as stored keys, and a lookup by equal keys.

The earth is cut into 2^level by 2^level cells of longitude and latitude. A polygon's covering has whole cells, as
coarse as they can be, inside it, and cells of the finest level across its boundary. A boundary cell keeps what decides its places
alone: whether an anchor place in it is inside, and the edges that come near it. A place is then inside if the arc from the
anchor crosses those edges an even number of times, or an odd one where the anchor is outside; rings and holes need no telling apart.

Edges are arcs of great circles, so a covering holds at the poles and across the 180th meridian. regions_of() is a join by key, without a
cross join: a place has one key a level, of the levels that coverings can have; the arc test is made of column expressions.
Coverings are made one geometry at a time in tasks.

Defined results: a geometry that is null, garbled or no (multi)polygon covers nothing; a place with a null or NaN coordinate is in no region; a
place on a boundary itself (within ON_EDGE) counts by the crossings of all edges by the arc from it to the place FAR, whatever cells
the index has; rings that take more than half of the earth aren't told from their complement; repeated
places and repeated geometries each give their own rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSEST = 4
FINEST = 12
#: Anchors lie off the middle of a cell, where grids rarely have a vertex.
_OFF = (0.4873, 0.5291)
#: The angle within which a place is on an edge: 6 mm on the ground. The cells' margin is as wide.
ON_EDGE = 1e-9
#: The place from which places on a boundary are judged: the same for all regions and indexes.
FAR = (20.0, 10.0)
EDGE = "struct<ax:double,ay:double,az:double,bx:double,by:double,bz:double>"
COVERING = f"region bigint, key bigint, inside boolean, anchor struct<x:double,y:double,z:double>, edges array<{EDGE}>"


def rings(geometry_type: str | None, coordinates: str | None) -> list[np.ndarray]:
    """Rings of (longitude, latitude) of a polygon or several; none for anything else."""
    try:
        found = json.loads(coordinates) if coordinates and geometry_type in ("Polygon", "MultiPolygon") else []
        polygons = [found] if geometry_type == "Polygon" else found
        out = [np.array([p[:2] for p in ring], float) for polygon in polygons for ring in polygon]
    except (ValueError, TypeError, KeyError, IndexError):
        return []
    return [r for r in out if r.ndim == 2 and len(r) >= 3 and np.isfinite(r).all()]


def vectors(lng: np.ndarray, lat: np.ndarray) -> np.ndarray:
    lng, lat = np.radians(lng), np.radians(lat)
    return np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)], -1)


def edges_of(parts: list[np.ndarray]) -> list[np.ndarray]:
    """(edges, 2, 3) of each ring: the ends of each edge as unit vectors; rings are closed."""
    out = []
    for ring in parts:
        v = vectors(ring[:, 0], ring[:, 1])
        ends = np.stack([v, np.roll(v, -1, axis=0)], 1)
        out.append(ends[(ends[:, 0] != ends[:, 1]).any(1)])
    return [e for e in out if len(e)]


def crossings(p: np.ndarray, q: np.ndarray, edges: np.ndarray) -> int:
    """How many edges the arc from p to q crosses."""
    a, b = edges[:, 0], edges[:, 1]
    ab, pq = np.cross(a, b), np.cross(p, q)
    at_p, at_q = ab @ p, ab @ q
    at_a, at_b = a @ pq, b @ pq
    # the ends of each lie on two sides of the other, and the arcs are on one side of the earth
    return int(np.count_nonzero((at_p * at_q < 0) & (at_a * at_b < 0) & (at_p * at_b > 0)))


def holds(place: np.ndarray, parts: list[np.ndarray]) -> bool:
    """By the angles under which a place sees each ring's edges; they add up to a whole turn from within.

    They do from the other side of the earth too, so a ring within half of the earth holds places of that half only."""
    inside = False
    for edges in parts:
        a, b = edges[:, 0], edges[:, 1]
        middle = a.sum(0)
        if (a @ middle).min() > 0 and place @ middle <= 0:
            continue
        a_side, b_side = np.cross(a, place), np.cross(b, place)
        turn = np.arctan2(np.cross(a_side, b_side) @ place, (a_side * b_side).sum(1))
        inside ^= bool(round(float(turn.sum()) / (2 * np.pi)) % 2)
    return inside


def _distances(place: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Angles from a place to the nearest point of each edge."""
    a, b = edges[:, 0], edges[:, 1]
    n = np.cross(a, b)
    n /= np.maximum(np.linalg.norm(n, axis=1, keepdims=True), 1e-300)
    ends = np.arccos(np.clip(np.maximum(a @ place, b @ place), -1, 1))
    beside = ((np.cross(n, a) @ place) >= 0) & ((np.cross(b, n) @ place) >= 0)
    return np.where(beside, np.minimum(np.abs(np.arcsin(np.clip(n @ place, -1, 1))), ends), ends)


def _corner(level: int, x: int, y: int, dx: float, dy: float) -> tuple[float, float]:
    return (x + dx) * 360.0 / 2**level - 180.0, (y + dy) * 180.0 / 2**level - 90.0


def _place(level: int, x: int, y: int, dx: float, dy: float) -> np.ndarray:
    return vectors(*map(np.float64, _corner(level, x, y, dx, dy)))


def cell_key(level: int, x: int, y: int) -> int:
    return level << 50 | x << 25 | y


def covering(parts: list[np.ndarray], finest: int = FINEST, coarsest: int = COARSEST) -> Iterator[tuple[int, bool, np.ndarray | None, np.ndarray]]:
    """(key, anchor inside, anchor, near edges) of each cell; a whole cell has no anchor and no edges."""
    if not parts:
        return
    edges = np.concatenate(parts)
    # cells to look at, with the edges that may be near and a place of the cell above of which it's known whether it is inside
    open_ = [(coarsest, x, y, edges, None, False) for x in range(2**coarsest) for y in range(2**coarsest)]
    while open_:
        level, x, y, near, known, inside = open_.pop()
        middle, anchor = _place(level, x, y, 0.5, 0.5), _place(level, x, y, *_OFF)
        inside = holds(anchor, parts) if known is None else inside ^ bool(crossings(known, anchor, near) % 2)
        radius = max(float(np.arccos(np.clip(middle @ _place(level, x, y, dx, dy), -1, 1))) for dx in (0, 1) for dy in (0, 1))
        near = near[_distances(middle, near) <= radius * 1.001 + 1e-9] if len(near) else near
        if not len(near):
            if inside:
                yield cell_key(level, x, y), True, None, near
        elif level == finest:
            yield cell_key(level, x, y), inside, anchor, near
        else:
            open_ += [(level + 1, 2 * x + dx, 2 * y + dy, near, anchor, inside) for dx in (0, 1) for dy in (0, 1)]


_ARROW = pa.schema([
    ("region", pa.int64()),
    ("key", pa.int64()),
    ("inside", pa.bool_()),
    ("anchor", pa.struct([(c, pa.float64()) for c in "xyz"])),
    ("edges", pa.list_(pa.struct([(c, pa.float64()) for c in ("ax", "ay", "az", "bx", "by", "bz")]))),
])


def region_id(geometry: Column) -> Column:
    """A number that stands for a geometry: a hash of its type and coordinates."""
    return F.xxhash64(geometry["type"], geometry["coordinates"])


def coverings(regions: DataFrame, geometry: str = "geometry", finest: int = FINEST) -> DataFrame:
    """The cells of the coverings of regions' distinct geometries, as COVERING."""

    def run(batches):
        for batch in batches:
            rows = []
            for region, kind, coordinates in zip(*[batch.column(c).to_pylist() for c in ("region", "kind", "coordinates")], strict=True):
                for key, inside, anchor, near in covering(edges_of(rings(kind, coordinates)), finest):
                    rows.append((region, key, inside, None if anchor is None else dict(zip("xyz", map(float, anchor), strict=True)), [dict(zip(("ax", "ay", "az", "bx", "by", "bz"), map(float, e), strict=True)) for e in near.reshape(-1, 6)]))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    g = F.col(geometry)
    shapes = regions.where(g.isNotNull()).select(region_id(g).alias("region"), g["type"].alias("kind"), g["coordinates"].alias("coordinates")).dropDuplicates(["region"])
    return shapes.repartition("region").mapInArrow(run, COVERING)


def place_keys(lng: Column, lat: Column, finest: int = FINEST) -> Column:
    """The keys of the cells that hold a place, one a level; null without a place."""

    def at(share: Column, level: int) -> Column:
        return F.least(F.floor(share * F.lit(float(2**level))), F.lit(2**level - 1))

    turn = F.pmod(lng + 180.0, F.lit(360.0)) / 360.0
    up = (lat + 90.0) / 180.0
    keys = F.array(*[F.lit(level << 50) + at(turn, level) * F.lit(1 << 25) + at(up, level) for level in range(COARSEST, finest + 1)])
    return F.when(lng.isNotNull() & ~(F.isnan(lng) | F.isnan(lat)) & lat.between(-90.0, 90.0), keys)


def _cross(a: tuple, b: tuple) -> tuple:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def _dot(a: tuple, b: tuple) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _far() -> tuple:
    return tuple(F.lit(float(c)) for c in vectors(*map(np.float64, FAR)))


def _odd(edges: Column, start: tuple, end: tuple) -> Column:
    """Whether the arc from start to end crosses an odd number of edges."""
    way = _cross(start, end)

    def crossed(edge):
        a, b = tuple(edge[f"a{c}"] for c in "xyz"), tuple(edge[f"b{c}"] for c in "xyz")
        ab = _cross(a, b)
        from_, to, at_a, at_b = _dot(ab, start), _dot(ab, end), _dot(a, way), _dot(b, way)
        return (from_ * to < 0) & (at_a * at_b < 0) & (from_ * at_b > 0)

    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != crossed(e))


def _inside(place: tuple) -> Column:
    """Whether a place of a boundary cell is in the region: the anchor's side, changed by each edge on the way."""
    anchor = tuple(F.col(f"anchor.{c}") for c in "xyz")
    return F.when(F.col("anchor").isNull(), F.col("inside")).otherwise(F.col("inside") != _odd(F.col("edges"), anchor, place))


def _close(place: tuple) -> Column:
    """Whether a place lies on an edge of its cell, as far as numbers tell."""

    def near(edge):
        a, b = tuple(edge[f"a{c}"] for c in "xyz"), tuple(edge[f"b{c}"] for c in "xyz")
        ab = _cross(a, b)
        most = F.sqrt(_dot(ab, ab)) * ON_EDGE
        return (F.abs(_dot(ab, place)) <= most) & (_dot(_cross(ab, a), place) >= -most) & (_dot(_cross(b, ab), place) >= -most)

    return F.exists("edges", near)


def _boundaries(index: DataFrame, finest: int) -> DataFrame:
    """region, all its edges, and whether it holds the place FAR."""
    # cells share edges; one that a geometry has twice is in a cell twice, and crossing it changes nothing
    each = index.select("region", "key", F.explode("edges").alias("edge")).groupBy("region", "key", "edge").agg(F.count(F.lit(1)).alias("n"))
    whole = each.groupBy("region", "edge").agg(F.max("n").alias("n")).where("n % 2 = 1").groupBy("region").agg(F.collect_list("edge").alias("every"))
    turn, up = (FAR[0] + 180.0) % 360.0 / 360.0, (FAR[1] + 90.0) / 180.0
    keys = [cell_key(level, int(turn * 2**level), int(up * 2**level)) for level in range(COARSEST, finest + 1)]
    holding = index.where(F.col("key").isin(keys)).where(_inside(_far())).select("region", F.lit(True).alias("far"))
    return whole.join(holding, "region", "left")


def regions_of(places: DataFrame, index: DataFrame, lng: str = "lng", lat: str = "lat", finest: int = FINEST) -> DataFrame:
    """places with `region`, a row for each region of the index (a table of coverings) that holds the place; others drop out."""
    at = F.radians(F.col("_lat")), F.radians(F.col("_lng"))
    named = places.select(F.struct(*[F.col(f"`{c}`") for c in places.columns]).alias("_place"), F.col(f"`{lng}`").cast("double").alias("_lng"), F.col(f"`{lat}`").cast("double").alias("_lat"))
    keyed = named.withColumn("key", F.explode(place_keys(F.col("_lng"), F.col("_lat"), finest))).withColumns({"_x": F.cos(at[0]) * F.cos(at[1]), "_y": F.cos(at[0]) * F.sin(at[1]), "_z": F.sin(at[0])})
    place = F.col("_x"), F.col("_y"), F.col("_z")
    met = keyed.join(index, "key").select("_place", "region", "_x", "_y", "_z", _inside(place).alias("_in"), _close(place).alias("_on")).where("_in or _on")
    # places on a boundary meet its edges by region; all others meet nothing, and are dealt by place
    met = met.withColumn("_by", F.when(F.col("_on"), F.col("region")).otherwise(F.xxhash64("_x", "_y", "_z")))
    edges = _boundaries(index, finest).select(F.col("region").alias("_by"), F.lit(True).alias("_on"), "every", "far")
    plain = _odd(F.col("every"), place, _far()) != F.coalesce("far", F.lit(False))
    found = met.join(edges, ["_by", "_on"], "left").where(F.when(F.col("_on"), plain).otherwise(F.col("_in")))
    return found.select("_place.*", "region")
