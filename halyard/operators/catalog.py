"""Objects by name, version and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.functions.names import parts_of, trip_id_of


def object_parts(objects: DataFrame) -> DataFrame:
    base, version, ext = parts_of(F.col("name"))
    return objects.withColumns({"base_name": base, "version": version, "ext": ext})


def resolve(objects: DataFrame, prefix: str = "", version: str = "latest", extension: str = "", exact_match: bool = False) -> DataFrame:
    """Objects whose name starts with prefix and whose ext ends with extension (a pattern), of one version.

    "latest" is the newest of each (base_name, ext); equal times all stay. Names without three parts drop out.
    The newest time comes from an aggregate that is joined back, so no group has to fit into one task."""
    found = object_parts(objects.where(F.startswith("name", F.lit(prefix)))).where(F.rlike("ext", F.lit(f"{extension}$")))
    if exact_match:
        found = found.where(F.col("base_name") == prefix)
    if version != "latest":
        return found.where(F.col("version") == version)
    newest = found.groupBy("base_name", "ext").agg(F.max("updated").alias("updated"))
    return found.join(newest, ["base_name", "ext", "updated"], "left_semi").select(*found.columns)


def trip_ids(files: DataFrame, name: str = "name") -> DataFrame:
    """files with trip_id, taken from the name; a name of another form is its own id."""
    return files.withColumn("trip_id", trip_id_of(F.col(name)))
