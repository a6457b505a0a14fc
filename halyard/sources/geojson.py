"""GeoJSON feature collections as rows: the properties, and geometry as a struct of type and coordinates (JSON text).

A collection is one JSON value, which can't be cut at line ends. features_of() reads it in stretches of bytes all the same, in two
passes over them. The first finds for each stretch how many quotes that aren't escaped it has and how the nesting changes, for
both cases, that it begins inside of a string or not; of all stretches in order that tells, by sums, how each really begins.
In the second each task gives the features that begin in its stretch, reading on to the end of the last. So a file of any size is read by
many tasks, and the largest unit is a feature."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.schemas import struct
from halyard.sources import objects, store

#: Coordinates nest to another depth for each kind of geometry, so they stay text.
GEOMETRY = struct("type string, coordinates string")
#: Files above this go in stretches of this many bytes.
STRETCH = 32 << 20
_MORE = 1 << 20
_QUOTE, _ESCAPE = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
#: The depth at which features begin: in the collection, in its array.
_FEATURES = 2


def _quotes(data: np.ndarray, escapes: int) -> np.ndarray:
    """Where strings begin and end; escapes: how many escape characters stand right before data."""
    at = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != _ESCAPE, at, -1))
    before = np.append(-1, plain[:-1])
    run = at - 1 - before + np.where(before < 0, escapes, 0)
    return (data == _QUOTE) & (run % 2 == 0)


def _escapes_before(read, start: int) -> int:
    """How many escape characters stand right before a place."""
    n = 0
    while start - n > 0 and read(start - n - 1, 1) == b"\\":
        n += 1
    return n


def summary(data: np.ndarray, escapes: int) -> tuple[int, int, int]:
    """Quotes of a stretch, and how the nesting changes if it begins outside or inside of a string."""
    quotes = _quotes(data, escapes)
    inside = np.cumsum(quotes) % 2 == 1
    step = _STEP[data].astype(np.int64)
    return int(quotes.sum()), int(step[~inside].sum()), int(step[inside].sum())


def _cut(read, start: int, size: int, whole: int, within: bool, depth: int) -> Iterator[bytes]:
    """The objects of the features' depth that begin in a stretch; read(at, n) gives bytes, and the last feature may go on beyond."""
    held, at, first = b"", start, None
    escapes = _escapes_before(read, start)
    limit = start + size
    while at < whole and (at < limit or first is not None):
        raw = read(at, size if at < limit else _MORE)
        data = np.frombuffer(raw, np.uint8)
        quotes = _quotes(data, escapes)
        inside = (np.cumsum(quotes) + within) % 2 == 1
        change = np.where(inside, 0, _STEP[data])
        level = np.cumsum(change) + depth
        marks = np.flatnonzero(change != 0)
        for k in marks[((change[marks] == 1) & (level[marks] == _FEATURES + 1)) | ((change[marks] == -1) & (level[marks] == _FEATURES))].tolist():
            if change[k] == 1:
                if first is None and at + k < limit and raw[k : k + 1] == b"{":
                    first, held = k, b""
            elif first is not None:
                yield held + raw[max(first, 0) : k + 1]
                first = None
                if at + k >= limit:
                    return
        if first is not None:
            held += raw[max(first, 0) :]
            first = -1
        within, depth = bool(inside[-1]), int(level[-1])
        tail = len(raw) - len(raw.rstrip(b"\\"))
        escapes = tail + (escapes if tail == len(raw) else 0)
        at += len(raw)


def features_of(spark: SparkSession, *paths: str, stretch: int = STRETCH) -> DataFrame:
    """A row (value) with the text of each feature of the collections in some files."""
    files = []
    for path in paths:
        fs, at = objects.file_system(path)
        whole = fs.get_file_info(at).size
        files += [(path, start, min(stretch, whole - start), whole) for start in range(0, whole, stretch)]
    kinds = "path string, start bigint, size bigint, whole bigint"
    pieces = spark.createDataFrame(files, kinds).repartition(max(1, len(files)), "path", "start")

    def opened(path):
        fs, at = objects.file_system(path)
        file = fs.open_input_file(at)
        return file, lambda start, n: file.read_at(n, start)

    def first(batches):
        for b in batches:
            rows = []
            for path, start, size in zip(*[b.column(c).to_pylist() for c in ("path", "start", "size")], strict=True):
                file, read = opened(path)
                with file:
                    rows.append(summary(np.frombuffer(read(start, size), np.uint8), _escapes_before(read, start)))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else ([], [], []))]], [*b.schema.names, "quotes", "outside", "inside"])

    up = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    told = pieces.mapInArrow(first, f"{kinds}, quotes bigint, outside bigint, inside bigint")
    told = told.withColumn("within", F.coalesce(F.sum("quotes").over(up), F.lit(0)) % 2 == 1).withColumn("change", F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside")))
    placed = told.withColumn("depth", F.coalesce(F.sum("change").over(up), F.lit(0))).select("path", "start", "size", "whole", "within", "depth")
    at = store.scratch(spark, "stretches")
    placed.write.parquet(at)  # a row a stretch
    placed = spark.read.schema(f"{kinds}, within boolean, depth bigint").parquet(at).repartition(max(1, len(files)), "path", "start")

    def second(batches):
        for b in batches:
            for row in b.to_pylist():
                file, read = opened(row["path"])
                with file:
                    for text in _cut(read, row["start"], row["size"], row["whole"], row["within"], row["depth"]):
                        yield pa.RecordBatch.from_arrays([pa.array([text.decode().replace("\r", " ").replace("\n", " ")], pa.string())], ["value"])

    # other objects of that depth, as of a reference system, aren't features
    return placed.mapInArrow(second, "value string").where(F.get_json_object("value", "$.type") == "Feature")


def _large(paths: tuple[str, ...], stretch: int) -> bool:
    """Whether any of the files (no folders, no patterns) has more than a stretch."""
    for path in paths:
        try:
            fs, at = objects.file_system(path)
            if fs.get_file_info(at).is_file and fs.get_file_info(at).size > stretch:
                return True
        except (OSError, pa.ArrowException):  # a store that only Spark reads
            return False
    return False


def read_geojson(spark: SparkSession, *paths: str, properties: T.StructType | None = None, stretch: int = STRETCH) -> DataFrame:
    """All features of the files; the fields of their properties are inferred unless given.

    Files of more than `stretch` bytes are read by many tasks; their features are kept as lines of text then, which both inference and result read."""
    if _large(paths, stretch):
        at = store.scratch(spark, "features")
        features_of(spark, *paths, stretch=stretch).write.text(at)
        if properties is None:
            found = spark.read.json(at).schema
            properties = found["properties"].dataType if "properties" in found.names and isinstance(found["properties"].dataType, T.StructType) else T.StructType()
        rows = spark.read.schema(_feature(properties)).json(at).select(F.struct("geometry", "properties").alias("f"))
    else:
        files = spark.read.option("multiLine", True)
        if properties is None:
            inferred = files.json(list(paths)).schema["features"].dataType.elementType
            properties = inferred["properties"].dataType if "properties" in inferred.names else T.StructType()
        rows = files.schema(T.StructType([T.StructField("features", T.ArrayType(_feature(properties)))])).json(list(paths)).select(F.explode("features").alias("f"))
    return rows.select(*[F.col(f"f.properties.`{c}`").alias(c) for c in properties.names], "f.geometry")


def _feature(properties: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("geometry", GEOMETRY), T.StructField("properties", properties)])


def features(texts: DataFrame, text: str, properties: T.StructType) -> DataFrame:
    """The features of collections that are texts of a column, one row each."""
    rows = texts.select(F.explode(F.from_json(text, T.StructType([T.StructField("features", T.ArrayType(_feature(properties)))]))["features"]).alias("f"))
    return rows.select(*[F.col(f"f.properties.`{c}`").alias(c) for c in properties.names], "f.geometry")
