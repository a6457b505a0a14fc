"""Gridding of track files as they arrive: a file stream in batches of whole files.

A trip lies in one file, so each batch holds whole trips; time gaps need the next point, which a streaming
window can't give. The checkpoint remembers the files, so each is gridded once, also across restarts. A trip that
an earlier batch has stored is skipped, whatever later files hold of it; a list of the trips of each batch beside the rows tells that."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from halyard.operators.tracks import grid_tracks
from halyard.schemas import GRIDDED, POINTS


def grid_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, grid_size: int = 500, files_at_once: int = 1000) -> StreamingQuery:
    """Grids the files that are new in source, appends to target and stops."""
    points = spark.readStream.schema(POINTS).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", True).parquet(source)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        trips = f"{target}/_trips"  # the trips of each batch: what the next ones read, not all that is stored
        at = spark._jvm.org.apache.hadoop.fs.Path(trips)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            known = spark.read.schema("Trip bigint, batch bigint").parquet(trips).where(F.col("batch") != number).select("Trip")
            batch = batch.join(known, "Trip", "left_anti").select(*batch.columns)
        # one folder a batch, overwritten: a batch that is run again leaves its rows once
        grid_tracks(batch, grid_size).write.mode("overwrite").parquet(f"{target}/batch={number}")
        spark.read.schema(GRIDDED).parquet(f"{target}/batch={number}").select("Trip").distinct().write.mode("overwrite").parquet(f"{trips}/batch={number}")

    return points.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
