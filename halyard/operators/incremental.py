"""What is new, in batches, and how the tasks went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halyard.operators.catalog import trip_ids


def new_ids(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct ids of wanted that stored lacks; null is an id like others."""
    return wanted.subtract(stored)


def new_files(files: DataFrame, ids: DataFrame) -> DataFrame:
    """Files whose trip is among the ids (trip_id); repeated files stay."""
    return trip_ids(files).join(ids, "trip_id", "left_semi").select("name")


def batch(ids: DataFrame, size: int | None) -> DataFrame:
    """The first ids in order, all of them without a size."""
    return ids if size is None else ids.orderBy(*ids.columns).limit(size)


def installed(devices: DataFrame) -> DataFrame:
    return devices.where(F.col("state") == "Installed")


def distinct_devices(devices: DataFrame) -> DataFrame:
    return installed(devices).select("IMEI").distinct()


def trips_of(trips: DataFrame, devices: DataFrame) -> DataFrame:
    return trips.join(devices.select("IMEI"), "IMEI", "left_semi").select(*trips.columns)


def device_list(devices: DataFrame) -> DataFrame:
    """One row: the distinct ids as a sorted list with commas, the form in which a request takes them."""
    return distinct_devices(devices).where("IMEI is not null").agg(F.concat_ws(",", F.array_sort(F.collect_list("IMEI"))).alias("imeis"))


def status_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status") == "success").alias("successes"), F.count_if(F.col("status") == "error").alias("failures"))


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "error").select("trip_id", "message")
