"""The track queries over the driver's tables, and the same in DuckDB SQL.

The views: events as track points, customers as devices and metrics, orders as trips, objects and files.
Means are rounded on both sides, since the order of a sum changes its last bits; labels and counts are not."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.functions.names import versioned_column
from halyard.functions.numeric import minutes
from halyard.operators import catalog, collection, incremental, metrics, summaries, tracks
from halyard.plans import workflows
from halyard.schemas import POINTS, struct
from halyard.sources import geojson, sheets, store
from halyard.sources import objects as stored
from halyard.streaming.pieces import grid_pieces
from halyard.streaming.tracks import grid_new_files

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def put(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- views -------------------------------------------------------------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("Trip"),
        F.col("ts").alias("Time"),
        (F.lit(-4.0) - F.col("value") / F.lit(5000.0)).alias("Lat"),
        (F.lit(39.0) + k / F.lit(1000.0)).alias("Lng"),
        (F.col("value") / F.lit(50.0)).alias("Speed (M/S)"),
        (F.col("value") * F.lit(10.0)).alias("Range (Meters)"),
        F.lit(0.0).alias("Heading"),
        F.col("event_id").alias("seq"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(F.when(F.col("c_mktsegment") == "BUILDING", "Installed").otherwise("Retired").alias("state"), F.col("c_custkey").cast("string").alias("IMEI"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Trip"), F.col("o_custkey").cast("string").alias("IMEI"), F.col("o_orderdate").alias("day"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    ext = F.when(F.col("o_orderkey") % 2 == 0, ".parquet").otherwise(".csv")
    name = F.concat_ws("__", F.concat(F.lit("obj"), (F.col("o_custkey") % 7).cast("string")), F.date_format("o_orderdate", "yyyyMMddHHmmss"), ext)
    return o.select(name.alias("name"), F.col("o_orderdate").alias("updated"))


def track_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    odd = F.col("o_orderkey") % 10 == 0
    return _table(spark, sf_dir, "orders").select(F.when(odd, F.concat(F.lit("tracks_x"), key, F.lit(".csv"))).otherwise(F.concat(F.lit("tracks_"), key, F.lit(".parquet"))).alias("name"))


def _country(key: str):
    return F.when(F.col(key) % 3 == 0, "kenya").when(F.col(key) % 3 == 1, "zanzibar").otherwise("other")


_POINTS = """points AS (
  SELECT user_id AS Trip, ts, event_id AS seq, -4.0::DOUBLE - value / 5000.0::DOUBLE AS Lat,
         39.0::DOUBLE + (props ->> '$.k')::DOUBLE / 1000.0::DOUBLE AS Lng, value / 50.0::DOUBLE AS speed, value * 10.0::DOUBLE AS rng
  FROM events),
gaps AS (
  SELECT *, coalesce(epoch_us(lead(ts) OVER w) - epoch_us(ts), epoch_us(ts) - epoch_us(lag(ts) OVER w)) AS gap
  FROM points WINDOW w AS (PARTITION BY Trip ORDER BY ts ASC NULLS LAST, seq))"""


def _gridded(step: float) -> str:
    return f"""{_POINTS},
cells AS (
  SELECT Trip, round_even(Lat / {step}::DOUBLE, 0) * {step}::DOUBLE AS lat_grid, round_even(Lng / {step}::DOUBLE, 0) * {step}::DOUBLE AS lng_grid,
         sum(gap)::BIGINT / 60000000.0::DOUBLE AS time_spent_mins, coalesce(avg(speed) FILTER (NOT isnan(speed)), 'nan'::DOUBLE) AS mean_speed,
         coalesce(avg(rng) FILTER (NOT isnan(rng)), 'nan'::DOUBLE) AS mean_range,
         CASE WHEN count(ts) = count(*) THEN min(ts) END AS first_seen, CASE WHEN count(ts) = count(*) THEN max(ts) END AS last_seen, count(*)::BIGINT AS n_points
  FROM gaps GROUP BY 1, 2, 3 HAVING sum(gap) > 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Trip ORDER BY first_seen ASC NULLS LAST, lat_grid, lng_grid)::INTEGER AS trip_rank, count(*) OVER (PARTITION BY Trip)::BIGINT AS trip_cells FROM cells),
gridded AS (SELECT * EXCLUDE (trip_rank, trip_cells) FROM ranked WHERE trip_rank >= 3 AND trip_rank <= trip_cells - 2)"""


_MEANS = "* REPLACE (round(mean_speed, 8) AS mean_speed, round(mean_range, 8) AS mean_range)"
_SUMMED = """,
fine AS (
  SELECT lat_grid, lng_grid, CASE WHEN count(time_spent_mins) = count(*) THEN avg(time_spent_mins) END AS avg_time_mins,
         CASE WHEN count(mean_speed) = count(*) THEN avg(mean_speed) END AS avg_speed, CASE WHEN count(mean_range) = count(*) THEN avg(mean_range) END AS avg_range,
         (count(DISTINCT Trip) + max(CASE WHEN Trip IS NULL THEN 1 ELSE 0 END))::BIGINT AS visits, sum(n_points)::BIGINT AS total_points
  FROM gridded GROUP BY 1, 2),
km AS (
  SELECT round_even(lat_grid / 0.01::DOUBLE, 0) * 0.01::DOUBLE AS lat_grid_1km, round_even(lng_grid / 0.01::DOUBLE, 0) * 0.01::DOUBLE AS lng_grid_1km,
         CASE WHEN count(avg_time_mins) = count(*) THEN avg(avg_time_mins) END AS mins, CASE WHEN count(avg_speed) = count(*) THEN avg(avg_speed) END AS avg_speed,
         CASE WHEN count(avg_range) = count(*) THEN avg(avg_range) END AS avg_range, sum(visits)::BIGINT AS total_visits, count(*)::BIGINT AS original_cells, sum(total_points)::BIGINT AS total_points
  FROM fine GROUP BY 1, 2)"""


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _grid_query(size: int):
    @query(f"WITH {_gridded(tracks.GRID_DEGREES[size])} SELECT {_MEANS} FROM gridded", f"track_grid_{size}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _round(tracks.grid_tracks(points(spark, sf_dir), size), 8, "mean_speed", "mean_range")


for _size in tracks.GRID_DEGREES:
    _grid_query(_size)


def _summary_sql(low: str, high: str) -> str:
    return f"""WITH {_gridded(0.005)}{_SUMMED}
SELECT lat_grid_1km, lng_grid_1km, round(avg_speed, 6) AS avg_speed, round(avg_range, 6) AS avg_range, total_visits, original_cells, total_points, round(mins / 60.0::DOUBLE, 6) AS avg_time_hours
FROM km WHERE mins / 60.0::DOUBLE BETWEEN {low}::DOUBLE AND {high}::DOUBLE"""


@query(_summary_sql("0.15", "15.0"))
def grid_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(summaries.grid_summaries(tracks.grid_tracks(points(spark, sf_dir))), 6, "avg_speed", "avg_range", "avg_time_hours")


@query(_summary_sql("1.0", "400.0"))
def grid_summaries_custom_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(summaries.grid_summaries(tracks.grid_tracks(points(spark, sf_dir)), 1.0, 400.0), 6, "avg_speed", "avg_range", "avg_time_hours")


@query(f"WITH {_POINTS} SELECT Trip, seq, gap / 60000000.0::DOUBLE AS gap_mins FROM gaps")
def point_time_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.point_gaps(points(spark, sf_dir)).select("Trip", "seq", minutes(F.col("gap_micros")).alias("gap_mins"))


@query(f"WITH {_gridded(0.005)} SELECT Trip, lat_grid, lng_grid, trip_rank, trip_cells FROM ranked")
def trip_trim_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.trim_ranks(tracks.cells(points(spark, sf_dir))).select("Trip", "lat_grid", "lng_grid", "trip_rank", "trip_cells")


@query(f"WITH {_gridded(0.005)}{_SUMMED} SELECT lat_grid, lng_grid, visits, total_points FROM fine")
def visits_per_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.by_cell(tracks.grid_tracks(points(spark, sf_dir))).select("lat_grid", "lng_grid", "visits", "total_points")


@query(f"WITH {_gridded(0.005)}{_SUMMED} SELECT lat_grid_1km, lng_grid_1km, round(mins, 6) AS avg_time_mins, round(avg_speed, 6) AS avg_speed, round(avg_range, 6) AS avg_range, total_visits, original_cells, total_points FROM km")
def mean_of_means_regrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(summaries.regrid(summaries.by_cell(tracks.grid_tracks(points(spark, sf_dir)))), 6, "avg_time_mins", "avg_speed", "avg_range")


@query("SELECT DISTINCT c_custkey::VARCHAR AS IMEI FROM customer WHERE c_mktsegment = 'BUILDING'")
def installed_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.distinct_devices(devices(spark, sf_dir))


@query("SELECT o_orderkey AS Trip, o_custkey::VARCHAR AS IMEI, o_orderdate AS day FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def trips_of_installed_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.trips_of(trips(spark, sf_dir), incremental.distinct_devices(devices(spark, sf_dir)))


@query("SELECT string_agg(i, ',' ORDER BY i) AS imeis FROM (SELECT DISTINCT c_custkey::VARCHAR AS i FROM customer WHERE c_mktsegment = 'BUILDING')")
def device_list_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.device_list(devices(spark, sf_dir))


@query("SELECT o_orderkey AS Trip, o_custkey::VARCHAR AS IMEI, o_orderdate AS day FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-06-30'")
def trips_in_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).where(F.col("day").between(F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1996-06-30").cast("timestamp_ntz")))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("trip_id"))


_NEW = "SELECT DISTINCT o_orderkey AS trip_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)"


@query(_NEW)
def new_trip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.new_ids(trips(spark, sf_dir).select(F.col("Trip").alias("trip_id")), _stored(spark, sf_dir))


@query(f"SELECT 'tracks_' || o_orderkey || '.parquet' AS name FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey IN ({_NEW})")
def new_track_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.new_files(track_files(spark, sf_dir), new_trip_ids(spark, sf_dir).select(F.col("trip_id").cast("string").alias("trip_id")))


@query(f"{_NEW} ORDER BY trip_id LIMIT 100")
def new_trip_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.batch(new_trip_ids(spark, sf_dir), 100)


_FILES = "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'tracks_x' || o_orderkey || '.csv' ELSE 'tracks_' || o_orderkey || '.parquet' END AS name FROM orders"


@query(f"SELECT name, regexp_replace(name, '^.*_([0-9]+)\\.parquet$', '\\1') AS trip_id FROM ({_FILES})")
def trip_ids_from_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.trip_ids(track_files(spark, sf_dir))


_OBJECTS = """o AS (
  SELECT 'obj' || (o_custkey % 7) AS base_name, strftime(o_orderdate, '%Y%m%d%H%M%S') AS version, CASE WHEN o_orderkey % 2 = 0 THEN '.parquet' ELSE '.csv' END AS ext, o_orderdate AS updated FROM orders),
objects AS (SELECT base_name || '__' || version || '__' || ext AS name, updated, base_name, version, ext FROM o)"""


@query(f"WITH {_OBJECTS} SELECT * FROM objects")
def object_name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.object_parts(objects(spark, sf_dir))


@query(f"WITH {_OBJECTS} SELECT * FROM objects WHERE ext LIKE '%parquet' QUALIFY updated = max(updated) OVER (PARTITION BY base_name, ext)")
def latest_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolve(objects(spark, sf_dir), "obj", extension="parquet")


@query(f"WITH {_OBJECTS} SELECT * FROM objects WHERE base_name = 'obj3' QUALIFY updated = max(updated) OVER (PARTITION BY base_name, ext)")
def latest_objects_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolve(objects(spark, sf_dir), "obj3", exact_match=True)


@query(f"WITH {_OBJECTS} SELECT * FROM objects WHERE version = '19950601000000' AND ext LIKE '%csv'")
def objects_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.resolve(objects(spark, sf_dir), "obj", "19950601000000", "csv")


@query("SELECT o_orderkey, 'tracks__' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '_abcdef0__.parquet' AS name FROM orders")
def versioned_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", versioned_column(F.lit("tracks"), F.col("o_orderdate"), "parquet", "abcdef0123").alias("name"))


def _metric_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    one = _table(spark, sf_dir, "supplier").select(_country("s_nationkey").alias("country"), F.col("s_suppkey").cast("long").alias("id"), *[(F.col("s_acctbal") * F.lit(k)).alias(c) for k, c in zip((1.0, 2.0, 3.0), metrics.MONEY, strict=True)], F.col("s_name").alias("site"))
    two = _table(spark, sf_dir, "customer").select(_country("c_nationkey").alias("country"), F.col("c_custkey").cast("long").alias("id"), *[(F.col("c_acctbal") * F.lit(k)).alias(c) for k, c in zip((1.0, 2.0, 3.0), metrics.MONEY, strict=True)])
    return one, two


_COUNTRY = "CASE {} % 3 WHEN 0 THEN 'kenya' WHEN 1 THEN 'zanzibar' ELSE 'other' END AS country"
_RATE = "CASE country WHEN 'zanzibar' THEN 0.00037::DOUBLE WHEN 'kenya' THEN 0.0077::DOUBLE END"
_METRICS = f"""m AS (
  SELECT {_COUNTRY.format("s_nationkey")}, s_suppkey::BIGINT AS id, s_acctbal * 1.0::DOUBLE AS a, s_acctbal * 2.0::DOUBLE AS b, s_acctbal * 3.0::DOUBLE AS c, s_name AS site FROM supplier
  UNION ALL SELECT {_COUNTRY.format("c_nationkey")}, c_custkey::BIGINT, c_acctbal * 1.0::DOUBLE, c_acctbal * 2.0::DOUBLE, c_acctbal * 3.0::DOUBLE, NULL FROM customer)"""


@query(f"WITH {_METRICS} SELECT country, id, site, a * {_RATE} AS mean_rpue, b * {_RATE} AS mean_rpua, c * {_RATE} AS mean_price_kg FROM m")
def regional_metrics_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.in_usd(metrics.unite(*_metric_sides(spark, sf_dir)))


@query(f"WITH {_METRICS} SELECT country, id, site, a AS mean_rpue, b AS mean_rpua, c AS mean_price_kg FROM m")
def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.unite(*_metric_sides(spark, sf_dir))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    return _table(spark, sf_dir, "events").select(F.when(bad, "error").otherwise("success").alias("status"), F.col("event_id").alias("trip_id"), F.when(bad, F.concat(F.lit("failed at "), F.col("user_id").cast("string"))).otherwise("Successfully processed").alias("message"))


@query("SELECT count(*) FILTER (event_type <> 'error')::BIGINT AS successes, count(*) FILTER (event_type = 'error')::BIGINT AS failures FROM events")
def task_status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.status_summary(_results(spark, sf_dir))


@query("SELECT event_id AS trip_id, 'failed at ' || user_id AS message FROM events WHERE event_type = 'error'")
def task_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.failures(_results(spark, sf_dir))


@query("SELECT value, NULL::VARCHAR AS missing, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS type FROM events WHERE event_type <> 'view'")
def collection_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", collection.METADATA).when(F.col("event_type") != "error", F.col("event_type"))
    documents = _table(spark, sf_dir, "events").select("event_id", kind.alias("type"), "value")
    return collection.in_order(collection.data_rows(documents), ["value", "missing", "event_id"]).withColumn("missing", F.col("missing").cast("string"))


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer")
def sheet_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.all_strings(_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


@query("SELECT n_nationkey::BIGINT AS region_id, n_name AS region, 'Point' AS kind, '[' || n_nationkey || '.5,-4]' AS coordinates FROM nation")
def region_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = F.format_string('{"type":"Feature","properties":{"region_id":%d,"region":"%s"},"geometry":{"type":"Point","coordinates":[%d.5,-4]}}', "n_nationkey", "n_name", "n_nationkey")
    texts = _table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list(feature)), F.lit("]}")).alias("value"))
    found = geojson.features(texts, "value", struct("region_id bigint, region string"))
    return found.select("region_id", "region", F.col("geometry.type").alias("kind"), F.col("geometry.coordinates").alias("coordinates"))


# --- what is stored and read again ---------------------------------------------------------------


def _stored_tracks(spark: SparkSession, sf_dir: str, root: str, some: Column | None = None) -> None:
    """An object of points for each trip (or some), as ingest_tracks leaves them."""
    every = points(spark, sf_dir)
    own = (every if some is None else every.where(some)).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in POINTS.fields])
    stored.write_objects(own.withColumn("_of", F.col("Trip")), root, "tracks", "_of", "seq")


def _as_tables_have_it(gridded: DataFrame) -> DataFrame:
    return _round(gridded, 8, "mean_speed", "mean_range").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


_ROUNDED = f"WITH {_gridded(0.005)} SELECT {_MEANS} FROM gridded"
_AT = datetime(2024, 1, 1, tzinfo=UTC)


@query(_ROUNDED)
def stored_tracks_gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workflow over stored tracks: listing, difference, gridding, versioned write, latest version."""
    root = store.scratch(spark, "tracks")
    conf = {"storage": {"root": f"{root}/store", "tracks_root": f"{root}/tracks"}, "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500}}
    _stored_tracks(spark, sf_dir, conf["storage"]["tracks_root"])
    workflows.preprocess_tracks(spark, conf, now=_AT)
    return _as_tables_have_it(store.read_latest(spark, conf["storage"]["root"], "tracks-preprocessed"))


@query(_ROUNDED)
def streamed_tracks_gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file stream over stored tracks, twice: the second run has no new files and changes nothing."""
    root = store.scratch(spark, "stream")
    _stored_tracks(spark, sf_dir, f"{root}/tracks")
    for _ in range(2):
        grid_new_files(spark, f"{root}/tracks", f"{root}/gridded", f"{root}/checkpoint").awaitTermination()
    return _as_tables_have_it(spark.read.parquet(f"{root}/gridded").drop("batch"))


@query(_summary_sql("0.15", "15.0"))
def appended_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summaries of the appending workflow after three runs, each with a third of the trips and one of them repeated in vain."""
    root = store.scratch(spark, "appended")
    conf = {"storage": {"root": f"{root}/store", "tracks_root": f"{root}/tracks"}, "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500}}
    name = None
    for k in range(3):
        _stored_tracks(spark, sf_dir, conf["storage"]["tracks_root"], F.pmod("Trip", F.lit(3)) == k)
        name = workflows.append_tracks(spark, conf, now=_AT.replace(year=2024 + k))
        assert workflows.append_tracks(spark, conf) is None
    return _round(spark.read.parquet(f"{root}/store/{name}"), 6, "avg_speed", "avg_range", "avg_time_hours")


def _recorded(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Answers of the service as files: a body for each trip, in which the column that tells of its sort comes and goes, and one number turns into text."""
    p = points(spark, sf_dir)
    cell = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    base = ("Time", "Lat", "Lng", "Speed (M/S)", "Range (Meters)", "Heading")
    odd = F.pmod("Trip", F.lit(2)) == 1
    line = F.concat_ws(",", F.concat(F.date_format("Time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")), *[cell(c) for c in base[1:]], (F.col("seq") % 100).cast("string"), F.when(odd, F.concat(F.lit("b"), F.col("seq").cast("string"))).otherwise(F.col("seq").cast("string")))
    line = F.when(odd, F.concat_ws(",", line, F.concat((F.col("seq") % 7).cast("string"), F.lit(".5")))).otherwise(line)
    lines = p.groupBy("Trip").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    head = F.when(odd, F.lit(",".join([*base, "battery", "note", "signal"]))).otherwise(F.lit(",".join([*base, "battery", "note"])))
    stored.write_texts(lines.select(F.concat(F.lit("trips/"), F.col("Trip").cast("string"), F.lit("/points")).alias("name"), F.concat(head, F.lit("\n"), F.col("lines"), F.lit("\n")).alias("body")), f"{root}/tok/v1")


@query(
    f"""WITH {_POINTS}, o AS (SELECT *, row_number() OVER (PARTITION BY Trip ORDER BY seq) - 1 AS n FROM points)
SELECT Trip, 'tracks_' || Trip || '.parquet' AS object, n::BIGINT AS seq, ts AS Time, round(Lat, 9) AS Lat, round(Lng, 9) AS Lng, (seq % 100)::BIGINT AS battery,
       CASE WHEN Trip % 2 = 1 THEN 'b' ELSE '' END || seq AS note, CASE WHEN Trip % 2 = 1 THEN (seq % 7) + 0.5::DOUBLE END AS signal FROM o"""
)
def ingested_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion of trips and tracks from recorded answers: what the objects hold, of known columns and of those that the answers brought along."""
    root = store.scratch(spark, "ingested")
    _recorded(spark, sf_dir, f"{root}/api")
    trip_list = points(spark, sf_dir).select("Trip").distinct()
    store.write_versioned(trip_list, f"{root}/store", "trips", now=_AT)
    base = root if "://" in root or root.startswith("file:") else f"file://{root}"
    conf = {"api": {"base_url": f"{base}/api", "token": "tok", "secret": "-"}, "trips": {"prefix": "trips", "version": "latest"}, "tracks": {"prefix": "tracks"}, "storage": {"root": f"{root}/store", "tracks_root": f"{root}/tracks"}}
    workflows.ingest_tracks(spark, conf)
    names = stored.listing(spark, f"{root}/tracks", "tracks_")
    # the objects of one run have one schema, so that of any tells it
    schema = spark.read.parquet(f"{root}/tracks/{names.agg(F.min("name")).first()[0]}").schema
    rows = stored.read_objects(names, f"{root}/tracks", schema, named="object")
    return rows.select("Trip", "object", "seq", F.col("Time").cast("timestamp_ntz").alias("Time"), *[F.round(c, 9).alias(c) for c in ("Lat", "Lng")], "battery", "note", "signal")


@query(_ROUNDED)
def tracks_in_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points that arrive in ten files by time, so each trip in many pieces, gridded as trips close; the stream is restarted halfway."""
    root = store.scratch(spark, "pieces")
    own = points(spark, sf_dir).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in POINTS.fields])
    first, last = own.agg(F.min("Time"), F.max("Time")).first()
    share = (F.unix_micros("Time") - F.unix_micros(F.lit(first))) * 10 / (F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1)
    own.withColumn("file", F.floor(share)).repartition("file").write.partitionBy("file").parquet(f"{root}/all")
    # a point long after, of a trip of its own, lets the watermark pass all others
    spark.createDataFrame([(-1, last + timedelta(days=9000), 0.0, 0.0, 0.0, 0.0, 0.0, -1)], POINTS).coalesce(1).write.parquet(f"{root}/end")
    fs, at = store._fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(f"{root}/in"))
    for half in (range(5), range(5, 10)):
        for k in half:
            fs.rename(path(f"{root}/all/file={k}"), path(f"{root}/in/{k}"))
        if 9 in half:
            fs.rename(path(f"{root}/end"), path(f"{root}/in/end"))
        grid_pieces(spark, f"{root}/in", f"{root}/gridded", f"{root}/checkpoint", timedelta(days=4000), files_at_once=64).awaitTermination()
    return _as_tables_have_it(spark.read.parquet(f"{root}/gridded").drop("batch"))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leaning quadrilateral with a triangular hole for each nation, around the tracks."""
    n = F.col("n_nationkey").cast("double")
    x, y = F.lit(39.0) + F.lit(0.0173) * (n % 5.0), F.lit(-4.1) + F.lit(0.0191) * F.floor(n / 5.0)

    def ring(*corners):
        return F.array(*[F.array(x + F.lit(dx), y + F.lit(dy)) for dx, dy in (*corners, corners[0])])

    shape = F.to_json(F.array(ring(*_OUTER), ring(*_HOLE)))
    return _table(spark, sf_dir, "nation").select(F.col("n_name").alias("region"), F.struct(F.lit("Polygon").alias("type"), shape.alias("coordinates")).alias("geometry"))


_OUTER = ((0.0, 0.0), (0.031, 0.007), (0.027, 0.033), (-0.006, 0.029))
_HOLE = ((0.011, 0.011), (0.021, 0.013), (0.014, 0.022))


def _within_sql() -> str:
    """Regions of places by the crossings of the arc from a place far away, of all edges."""
    edges = [(r[k], r[(k + 1) % len(r)]) for r in (_OUTER, _HOLE) for k in range(len(r))]
    ends = " UNION ALL ".join(f"SELECT region, x + {a[0]}::DOUBLE AS ax, y + {a[1]}::DOUBLE AS ay, x + {b[0]}::DOUBLE AS bx, y + {b[1]}::DOUBLE AS by_ FROM n" for a, b in edges)
    v = lambda name, lng, lat: f"cos(radians({lat})) * cos(radians({lng})) AS {name}1, cos(radians({lat})) * sin(radians({lng})) AS {name}2, sin(radians({lat})) AS {name}3"
    cross = lambda a, b, name: f"{a}2 * {b}3 - {a}3 * {b}2 AS {name}1, {a}3 * {b}1 - {a}1 * {b}3 AS {name}2, {a}1 * {b}2 - {a}2 * {b}1 AS {name}3"
    dot = lambda a, b: f"({a}1 * {b}1 + {a}2 * {b}2 + {a}3 * {b}3)"
    return f"""n AS (SELECT n_name AS region, 39.0::DOUBLE + 0.0173::DOUBLE * (n_nationkey % 5) AS x, -4.1::DOUBLE + 0.0191::DOUBLE * (n_nationkey // 5) AS y FROM nation),
ends AS ({ends}),
arcs AS (SELECT region, {v("a", "ax", "ay")}, {v("b", "bx", "by_")} FROM ends),
sides AS (SELECT *, {cross("a", "b", "n")} FROM arcs),
places AS (SELECT lat_grid, lng_grid, {v("p", "lng_grid", "lat_grid")}, {v("q", "20.0::DOUBLE", "10.0::DOUBLE")} FROM (SELECT DISTINCT lat_grid, lng_grid FROM gridded)),
ways AS (SELECT *, {cross("p", "q", "w")} FROM places),
met AS (SELECT lat_grid, lng_grid, region, count(*) FILTER ({dot("n", "p")} * {dot("n", "q")} < 0 AND {dot("w", "a")} * {dot("w", "b")} < 0 AND {dot("n", "p")} * {dot("w", "b")} > 0) AS times FROM ways, sides GROUP BY ALL),
within AS (SELECT lat_grid, lng_grid, region FROM met WHERE times % 2 = 1)"""


@query(f"WITH {_gridded(0.001)}, {_within_sql()} SELECT region, count(*)::BIGINT AS cells, sum(g.n_points)::BIGINT AS n_points, count(DISTINCT Trip)::BIGINT AS trips FROM gridded g JOIN within w ON g.lat_grid = w.lat_grid AND g.lng_grid = w.lng_grid GROUP BY region")
def cells_of_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tracks spend in each region of a published, indexed collection of maps; each distinct cell is looked up once."""
    root = store.scratch(spark, "maps")
    store.push(_regions(spark, sf_dir), root, "maps", "portal", geo=True, finest=16)
    gridded = tracks.grid_tracks(points(spark, sf_dir), 100)
    found = store.located(spark, gridded.select("lng_grid", "lat_grid").distinct(), root, "maps", "portal", "lng_grid", "lat_grid")
    return gridded.join(found, ["lng_grid", "lat_grid"]).groupBy("region").agg(F.count(F.lit(1)).alias("cells"), F.sum("n_points").alias("n_points"), F.count_distinct("Trip").alias("trips"))


@query("SELECT o_orderkey AS Trip, o_custkey::VARCHAR AS IMEI, o_orderdate AS day FROM orders WHERE o_orderkey % 2 = 0")
def versioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of one object; the first by its version is all trips, the latest is the second."""
    root = store.scratch(spark, "objects")
    every = trips(spark, sf_dir)
    store.write_versioned(every, root, "trips", commit="", now=_AT)
    store.write_versioned(store.read_latest(spark, root, "trips", _AT.strftime("%Y%m%d%H%M%S")).where("Trip % 2 = 0"), root, "trips", commit="", now=_AT.replace(year=2025))
    return store.read_latest(spark, root, "trips")


@query("SELECT c_nationkey, c_name, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def published_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection that is pushed, replaced by other documents and pulled in its column order."""
    root = store.scratch(spark, "collections")
    customers = _table(spark, sf_dir, "customer")
    store.push(customers.select("c_custkey"), root, "customers", "portal")
    store.push(customers.where("c_mktsegment = 'BUILDING'").select("c_nationkey", "c_name", "c_custkey"), root, "customers", "portal", geo=True, run=lambda command: None)
    return store.pull(spark, root, "customers", "portal")


@query("SELECT c_custkey::VARCHAR AS c_custkey, nullif(c_mktsegment, '') AS c_mktsegment FROM customer")
def sheets_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table kept as a CSV sheet, read with every column a string."""
    root = store.scratch(spark, "sheets")
    _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").write.option("header", True).csv(f"{root}/customers.csv")
    return sheets.read_sheets(spark, root, ["customers", "others"], "customers")["customers"]
