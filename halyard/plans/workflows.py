"""The four workflows: trips in, tracks in, tracks gridded and summed up, results published.

Settings as in conf.toml. Each takes the session and settings; what a run does depends only on what is stored."""

from __future__ import annotations

import logging
import uuid
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.operators import incremental, state
from halyard.operators.catalog import trip_ids
from halyard.operators.metrics import in_usd, unite
from halyard.operators.summaries import grid_summaries
from halyard.operators.tracks import grid_tracks
from halyard.schemas import GRIDDED, POINTS, RESULTS, TRIPS
from halyard.sources import answers, http, objects, snapshots, store
from halyard.sources.geojson import read_geojson
from halyard.sources.sheets import read_sheets

log = logging.getLogger("halyard")


def _request_options(api: dict) -> dict:
    """What the settings say of retries; see http.fetch."""
    return {"attempts": int(api.get("attempts", 4)), "wait": float(api.get("wait", 0.5))}


def _answers(requests: DataFrame, api: dict, known: T.StructType, **options) -> DataFrame:
    """The answers as a table, so that nothing later makes a request again."""
    spark = requests.sparkSession
    at = store.scratch(spark, "answers")
    answers.fetched(requests, api, known, api.get("tasks"), api.get("rate"), **options, **_request_options(api)).write.parquet(at)
    return spark.read.schema(answers.ANSWERS).parquet(at)


def get_trips(spark: SparkSession, api: dict, from_date: str, to_date: str, **options) -> DataFrame:
    """Trips of a range of dates with all columns that the service sends; options are imeis, tags (lists), deviceInfo, withLastSeen.

    A failed request is an error."""
    request = spark.createDataFrame([("", http.trips_path(from_date, to_date))], "asked string, path string")
    got = _answers(request, api, TRIPS, **options)
    if failed := got.where("error is not null").first():
        raise RuntimeError(failed.error)
    return answers.typed(got, answers.discovered(got, TRIPS)).where("seq is not null").drop("asked", "seq")


def get_trip_points(spark: SparkSession, api: dict, ids: DataFrame | None = None, from_date: str | None = None, to_date: str | None = None, **options) -> DataFrame:
    """Points of trips (ids has trip_id) or of a range of dates, one request a day, with all columns that the service sends.

    A failed request is an error; options are imeis, tags (lists), deviceInfo, errant, withLastSeen."""
    if ids is not None:
        requests = ids.select(F.col("trip_id").cast("string").alias("asked"), points_request(F.col("trip_id")).alias("path"))
    else:
        http.points_path(None, from_date, to_date)  # both dates, or an error
        day = F.explode(F.sequence(F.lit(from_date).cast("date"), F.lit(to_date).cast("date"))).cast("string").alias("asked")
        requests = spark.range(1).select(day).select("asked", F.concat_ws("/", F.lit("points"), "asked", "asked").alias("path"))
    got = _answers(requests, api, POINTS, **options)
    if failed := got.where("error is not null").first():
        raise RuntimeError(f"{failed.asked}: {failed.error}")
    return answers.typed(got, answers.discovered(got, POINTS), None if ids is None else "Trip").where("seq is not null").drop("asked")


def points_request(trip: Column) -> Column:
    return F.concat(F.lit("trips/"), F.url_encode(trip.cast("string")), F.lit("/points"))


def ingest_trips(spark: SparkSession, conf: dict, today: date | None = None, now: datetime | None = None) -> str:
    """Trips of the installed devices as a new object, with all columns that the service sends."""
    devices = read_sheets(spark, conf["metadata"]["root"], conf["metadata"]["tables"], "devices")["devices"]
    imeis = incremental.device_list(devices).first().imeis
    trips = get_trips(spark, conf["api"], conf["api"]["from_date"], str(today or datetime.now(UTC).date()), imeis=imeis)
    return store.write_versioned(trips, conf["storage"]["root"], conf["trips"]["prefix"], now=now)


RUNS = "_results"


def ledger(spark: SparkSession, tracks_root: str) -> DataFrame:
    """run, status, trip_id and message of all runs of ingest_tracks."""
    fs, at = store._fs(spark, f"{tracks_root}/{RUNS}")
    schema = T.StructType([*RESULTS.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(schema).parquet(f"{tracks_root}/{RUNS}") if fs.exists(at) else spark.createDataFrame([], schema)


def quarantined(runs: DataFrame, after: int) -> DataFrame:
    """Trips (trip_id) that failed in `after` runs or more and never came."""
    return runs.groupBy("trip_id").agg(F.count_if(F.col("status") == "error").alias("failures"), F.count_if(F.col("status") == "success").alias("came")).where((F.col("failures") >= after) & (F.col("came") == 0)).select("trip_id")


def ingest_tracks(spark: SparkSession, conf: dict, batch_size: int | None = None) -> DataFrame:
    """Points of trips that aren't stored yet, one object a trip, named by the id asked for; status, trip_id and message of each.

    A trip that fails is a row with the error; the others are stored all the same, also those without points, which
    so aren't asked for again. Answers are written once as they came, and all that follows reads that table: no lost
    executor makes a request again whose first answer is in use. Objects have all columns that any answer of the run has, of one type
    in all of them. Ids, answers and objects pass from task to task; the driver sees counts.

    tracks.quarantine_after: trips that failed in so many runs aren't asked for again (never, without it)."""
    api, root, prefix = conf["api"], conf["storage"]["tracks_root"], conf["tracks"]["prefix"]
    trips = store.read_latest(spark, conf["storage"]["root"], conf["trips"]["prefix"], conf["trips"]["version"])
    if trips is None:
        raise ValueError("no trips are stored")
    have = trip_ids(objects.listing(spark, root, f"{prefix}_")).select("trip_id")
    fresh = incremental.new_ids(trips.select(F.col("Trip").cast("string").alias("trip_id")), have).where("trip_id is not null")
    fresh = fresh.select(F.col("trip_id").cast("bigint").alias("trip_id"))
    if after := conf["tracks"].get("quarantine_after"):
        fresh = fresh.join(quarantined(ledger(spark, root), int(after)), "trip_id", "left_anti")
    at = store.scratch(spark, "ids")
    incremental.batch(fresh, batch_size).write.parquet(at)
    todo = spark.read.schema("trip_id bigint").parquet(at)
    if todo.isEmpty():
        log.info("No new tracks to download")
        return spark.createDataFrame([], RESULTS)
    got = _answers(todo.select(F.col("trip_id").cast("string").alias("asked"), points_request(F.col("trip_id")).alias("path")), api, POINTS, deviceInfo="true")
    fields = answers.discovered(got, POINTS)
    objects.write_objects(answers.typed(got, fields, "Trip"), root, prefix, "asked", "seq", null_seq="seq")
    run = (datetime.now(UTC)).strftime("%Y%m%d%H%M%S") + f"-{uuid.uuid4().hex[:8]}"
    answers.results(got).write.parquet(f"{root}/{RUNS}/run={run}")
    results = spark.read.schema(RESULTS).parquet(f"{root}/{RUNS}/run={run}")
    counts = incremental.status_summary(results).first()
    log.info("%d tracks stored, %d failed", counts.successes, counts.failures)
    return results


def preprocess_tracks(spark: SparkSession, conf: dict, grid_size: int | None = None, now: datetime | None = None) -> tuple[str, str] | None:
    """Grids the tracks that no stored result has, unites them with those before and sums up all of them.

    None if there are no new tracks. The summaries read the written table, so the gridding runs once. Each run writes all history as
    one object; append_tracks() is for where that's too much."""
    root, tracks_root, prefix = conf["storage"]["root"], conf["storage"]["tracks_root"], conf["tracks"]["prefix"]
    before = store.read_latest(spark, root, f"{prefix}-preprocessed", conf["tracks"]["version"])
    files = objects.listing(spark, tracks_root, f"{prefix}_")
    ids = trip_ids(files).select("trip_id")
    fresh = incremental.new_ids(ids, before.select(F.col("Trip").cast("string"))) if before is not None else ids.distinct()
    names = incremental.new_files(files, fresh)
    if names.isEmpty():
        log.info("No new tracks")
        return None
    gridded = grid_tracks(objects.read_objects(names, tracks_root, POINTS), grid_size or conf["tracks"]["grid_size"])
    every = unite(before, gridded) if before is not None else gridded
    first = store.write_versioned(every, root, f"{prefix}-preprocessed", now=now)
    second = store.write_versioned(grid_summaries(spark.read.parquet(f"{root}/{first}")), root, f"{prefix}-grid_summaries", now=now)
    return first, second


#: Increments of the state that are merged into one when there are more.
INCREMENTS = 16
_STATES = ("cells", "visits")


def _appended_root(conf: dict) -> str:
    return f"{conf['storage']['root']}/{conf['tracks']['prefix']}-appended"


def _parts(spark: SparkSession, root: str, version: snapshots.Version | None, kind: str) -> DataFrame | None:
    """A table of all parts of a version that have it; parts are few."""
    found = [f"{root}/{p}/{kind}" for p in version.parts if p in version.meta[kind]] if version else []
    return spark.read.parquet(*found) if found else None


def appended(spark: SparkSession, conf: dict) -> DataFrame | None:
    """All gridded tracks that append_tracks() has stored."""
    root = _appended_root(conf)
    return _parts(spark, root, snapshots.current(spark, root), "gridded")


def append_tracks(spark: SparkSession, conf: dict, grid_size: int | None = None, now: datetime | None = None) -> str | None:
    """Grids the track objects that no run before has seen, adds them to the table and their state to the summaries'.

    Reads the new objects and the state of the cells, never what was gridded before; the summaries become a new object, whose name is
    returned (None if there's nothing new). A run is one commit: if it's cut off, the next one does it again. Objects are known by
    name, so one whose trip has no cells left isn't gridded again."""
    storage, prefix, root = conf["storage"], conf["tracks"]["prefix"], _appended_root(conf)
    before = snapshots.current(spark, root)
    names = objects.listing(spark, storage["tracks_root"], f"{prefix}_").select("name")
    if (seen := _parts(spark, root, before, "objects")) is not None:
        names = names.join(seen, "name", "left_anti")
    part = snapshots.new_part()
    names.write.parquet(f"{root}/{part}/objects")
    names = spark.read.schema("name string").parquet(f"{root}/{part}/objects")
    if names.isEmpty():
        log.info("No new tracks")
        fs, at = store._fs(spark, f"{root}/{part}")
        fs.delete(at, True)
        return None
    grid_tracks(objects.read_objects(names, storage["tracks_root"], POINTS), grid_size or conf["tracks"]["grid_size"]).write.option("compression", store.COMPRESSION).parquet(f"{root}/{part}/gridded")
    gridded = spark.read.schema(GRIDDED).parquet(f"{root}/{part}/gridded")
    state.cells(gridded).write.parquet(f"{root}/{part}/cells")
    state.visits(gridded).write.parquet(f"{root}/{part}/visits")
    own, name = [part], None

    def change(at: snapshots.Version | None) -> tuple[list[str], dict]:
        nonlocal own
        if at != before:
            raise RuntimeError("another run has added tracks at the same time")
        meta = {k: [*(before.meta[k] if before else []), part] for k in ("objects", "gridded", *_STATES)}
        if len(meta["cells"]) > INCREMENTS:
            whole = snapshots.new_part("state")
            for kind, merge in zip(_STATES, (state.merged_cells, state.merged_visits), strict=True):
                merge(spark.read.parquet(*[f"{root}/{p}/{kind}" for p in meta[kind]])).write.parquet(f"{root}/{whole}/{kind}")
                meta[kind] = [whole]
            own = [part, whole]
        # a part stays as long as one of its tables is in use
        return [p for p in [*(before.parts if before else []), *own] if any(p in names for names in meta.values())], meta

    version = snapshots.commit(spark, root, change)
    name = store.write_versioned(state.summed_up(*[_parts(spark, root, version, k) for k in _STATES]), storage["root"], f"{prefix}-grid_summaries", now=now)
    return name


def export(spark: SparkSession, conf: dict, maps: tuple[str, ...] = ("region_map_a", "region_map_b"), series: tuple[str, ...] = ("monthly_summaries_a", "monthly_summaries_b"), database: str = "portal", run=None) -> None:
    """Region maps, regional metrics in US dollars and grid summaries, each in place of its collection."""
    root, to = conf["storage"]["root"], conf["collections"]
    shapes = unite(*[read_geojson(spark, *[f"{root}/{n}" for n in store.object_names(spark, root, m, extension="geojson")]) for m in maps])
    metrics = in_usd(unite(*[store.read_latest(spark, root, s, exact_match=False) for s in series]))
    store.push(shapes, to["root"], to["maps"], database, geo=True, run=run)
    store.push(metrics, to["root"], to["metrics"], database)
    store.push(store.read_latest(spark, root, f"{conf['tracks']['prefix']}-grid_summaries"), to["root"], to["grids"], database)
