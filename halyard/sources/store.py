"""Objects and collections in any file system that Spark reaches; listing and renaming go through its own client."""

from __future__ import annotations

import json
import logging
import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.functions.names import versioned
from halyard.operators import catalog, collection
from halyard.operators import geo as geo_
from halyard.schemas import OBJECTS
from halyard.sources import snapshots

log = logging.getLogger("halyard")
COMPRESSION = "lz4_raw"


#: Settings of each provider and the file system options that carry them: fixed names of the Hadoop clients.
CREDENTIALS = {
    "gcs": {"service_account_key": "fs.gs.auth.service.account.json.keyfile", "project": "fs.gs.project.id"},
    "s3": {"access_key": "fs.s3a.access.key", "secret_key": "fs.s3a.secret.key", "session_token": "fs.s3a.session.token", "endpoint": "fs.s3a.endpoint"},
}


def authenticate(spark: SparkSession, provider: str, settings: dict) -> list[str]:
    """Hands a provider's credentials to the file system clients; the names of the options that were set.

    Options that are set already stay, so a session's own credentials win; values are never logged."""
    if provider not in CREDENTIALS:
        raise ValueError(f"no provider {provider!r}; there are: {', '.join(CREDENTIALS)}")
    names = CREDENTIALS[provider]
    if unknown := set(settings) - set(names):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    conf = spark._jsc.hadoopConfiguration()
    fresh = {names[k]: str(v) for k, v in settings.items() if v and not conf.get(names[k])}
    if provider == "gcs" and names["service_account_key"] in fresh:
        fresh["fs.gs.auth.type"] = "SERVICE_ACCOUNT_JSON_KEYFILE"
    for name, value in fresh.items():
        conf.set(name, value)
    return sorted(fresh)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under the one that driver and executors share; a temporary one only where none is set and all run on one machine."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="halyard-")
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """name and updated of the entries of root that start with prefix; none if root isn't there."""
    fs, at = _fs(spark, root)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, f"{prefix}*")) if fs.exists(at) else None
    rows = [(s.getPath().getName(), datetime.fromtimestamp(s.getModificationTime() / 1000, UTC)) for s in (found or [])]
    return spark.createDataFrame(rows, OBJECTS)


def object_names(spark: SparkSession, root: str, prefix: str, version: str = "latest", extension: str = "", exact_match: bool = False) -> list[str]:
    """Names of the objects of one version; see catalog.resolve."""
    return [r.name for r in catalog.resolve(list_objects(spark, root, prefix), prefix, version, extension, exact_match).select("name").orderBy("name").collect()]


def read_latest(spark: SparkSession, root: str, prefix: str, version: str = "latest", exact_match: bool = True) -> DataFrame | None:
    """The newest Parquet object of that name, or None."""
    names = object_names(spark, root, prefix, version, "parquet", exact_match)
    return spark.read.option("mergeSchema", len(names) > 1).parquet(*[f"{root}/{n}" for n in names]) if names else None


def write_versioned(df: DataFrame, root: str, prefix: str, commit: str | None = None, now: datetime | None = None, compression: str = COMPRESSION) -> str:
    """df as a new Parquet object; the name that it got."""
    name = versioned(prefix, "parquet", commit, now=now)
    df.write.option("compression", compression).parquet(f"{root}/{name}")
    log.info("Wrote %s", name)
    return name


def index_command(name: str) -> str:
    """The command that makes a spherical index on geometry, for a document store that takes one."""
    return json.dumps({"createIndexes": name, "indexes": [{"key": {"geometry": "2dsphere"}, "name": "geometry_2dsphere"}]})


def push(data: DataFrame | None, root: str | None, name: str | None, database: str | None, geo: bool = False, run: Callable[[str], object] | None = None, finest: int = geo_.FINEST) -> bool:
    """data in place of all documents of a collection, with its column order beside it.

    The documents are a new snapshot, which takes the old one's place by a commit: readers see one or the other, and a crash leaves
    one of them. geo adds an index of the column geometry to the snapshot, which located() reads, and runs the index command of
    a document store with `run`, if given; a failure there is only logged. finest: the level of the index's smallest cells."""
    if data is None or root is None or name is None or database is None:
        raise ValueError("data, root, name and database must all be given")
    spark = data.sparkSession
    base, part = f"{root}/{database}/{name}", snapshots.new_part("snapshot")
    data.write.option("compression", COMPRESSION).parquet(f"{base}/{part}/data")
    spark.createDataFrame([(collection.METADATA, data.columns)], "type string, columns array<string>").coalesce(1).write.json(f"{base}/{part}/metadata")
    indexed = geo and "geometry" in data.columns
    if geo and not indexed:
        log.warning("%s has no column geometry, so it gets no index", name)
    if indexed:
        # the documents are read back, so that they aren't made twice
        geo_.coverings(spark.read.schema(data.schema).parquet(f"{base}/{part}/data"), finest=finest).write.parquet(f"{base}/{part}/geometry")
    snapshots.commit(spark, base, lambda before: ([part], {"finest": finest if indexed else None}))
    if geo and run is not None:
        try:
            run(index_command(name))
        except Exception as e:
            log.warning("The index on geometry failed: %s", e)
    return True


def pull(spark: SparkSession, root: str, name: str, database: str) -> DataFrame:
    """The documents of a collection, columns in the order in which they were stored, others after them."""
    base = f"{root}/{database}/{name}"
    version = snapshots.current(spark, base)
    if version is None:
        raise FileNotFoundError(f"no collection {name} in {root}/{database}")
    at = f"{base}/{version.parts[0]}"
    row = collection.metadata_rows(spark.read.schema("type string, columns array<string>").json(f"{at}/metadata")).first()
    return collection.in_order(collection.data_rows(spark.read.parquet(f"{at}/data")), list(row.columns) if row and row.columns else None)


def located(spark: SparkSession, places: DataFrame, root: str, name: str, database: str, lng: str = "lng", lat: str = "lat") -> DataFrame:
    """places with the columns of each document of an indexed collection whose geometry holds them; places in none drop out.

    Of columns that both have, those of places stay."""
    base = f"{root}/{database}/{name}"
    version = snapshots.current(spark, base)
    if version is None or version.meta["finest"] is None:
        raise ValueError(f"{name} has no index; push it with geo")
    at = f"{base}/{version.parts[0]}"
    documents = spark.read.parquet(f"{at}/data")
    own = [c for c in documents.columns if c != "geometry" and c not in places.columns]
    documents = documents.select(geo_.region_id(F.col("geometry")).alias("_region"), *[F.col(f"`{c}`") for c in own])
    found = geo_.regions_of(places, spark.read.schema(geo_.COVERING).parquet(f"{at}/geometry"), lng, lat, version.meta["finest"]).withColumnRenamed("region", "_region")
    return found.join(documents, "_region").drop("_region")
