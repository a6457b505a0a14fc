"""Named objects in a store, written by tasks under their final names, and the manifests that publish them.

    rows.repartition("_of").sortWithinPartitions("_of", "seq").write.format("named_objects").options(root=..., prefix="tracks", key="_of").mode("append").save()

Each task writes an object `prefix_key.parquet` for each key among its rows, one after the other, so it holds a batch. An object is
written beside its place and moved there when it's complete: readers see all of it or nothing, and a task that is repeated leaves it
once, as it was. Each task also leaves a list of its objects; the commit publishes those lists of the tasks that count by one
small file, and nothing of it passes through the driver but one name a task. A job that fails publishes nothing.

`null_seq` names a column: rows in which it's null make the object but aren't stored in it, so an object may be empty.

read_objects() goes the other way: names as a table, read by tasks, so no list of files has to fit on the driver. Store paths are
what pyarrow's file systems take: local paths, file:, hdfs:, s3: (also as s3a:) and gs:.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from halyard.functions.names import track_file
from halyard.schemas import OBJECTS

MANIFESTS = "_manifests"
OBJECTS_SCHEMA = pa.schema([("name", pa.string()), ("key", pa.string()), ("rows", pa.int64())])


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    if root.startswith("s3a://"):
        root = "s3://" + root.removeprefix("s3a://")
    if root.startswith("file:") and not root.startswith("file://"):
        root = "file://" + root.removeprefix("file:")
    return pafs.FileSystem.from_uri(root)


def put(fs: pafs.FileSystem, path: str, data: bytes) -> None:
    """A small file that is there whole or not at all."""
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        out.write(data)
    fs.move(own, path)


@dataclass
class Written(WriterCommitMessage):
    part: str
    objects: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, schema: T.StructType):
        self.root, self.prefix, self.key, self.marks = options["root"], options["prefix"], options["key"], options.get("null_seq")
        self.run = options.get("run") or uuid.uuid4().hex
        self.schema = [f.name for f in schema.fields]

    def write(self, iterator):
        fs, root = file_system(self.root)
        fs.create_dir(root, recursive=True)
        seen, done = set(), []
        key = out = own = None
        rows = 0

        def close():
            nonlocal out
            if out is not None:
                out.close()
                name = track_file(self.prefix, key)
                fs.move(own, f"{root}/{name}")
                done.append((name, key, rows))
                out = None

        try:
            for batch in iterator:
                keys = batch.column(self.schema.index(self.key)).cast(pa.string()).to_pylist()
                stored = batch.select([n for n in self.schema if n != self.key])
                at = 0
                while at < len(keys):
                    end = at + 1
                    while end < len(keys) and keys[end] == keys[at]:
                        end += 1
                    if out is None or keys[at] != key:
                        close()
                        key, rows = keys[at], 0
                        if key is None or key in seen:
                            raise ValueError(f"rows of object {key!r} are apart; sort them by {self.key}")
                        seen.add(key)
                        own = f"{root}/.{track_file(self.prefix, key)}.{uuid.uuid4().hex}"
                        out = pq.ParquetWriter(own, stored.schema, filesystem=fs, compression="lz4")
                    piece = stored.slice(at, end - at)
                    if self.marks:
                        piece = piece.filter(piece.column(self.marks).is_valid())
                    if piece.num_rows:
                        out.write_batch(piece)
                        rows += piece.num_rows
                    at = end
            close()
        except BaseException:
            if out is not None:
                out.close()
                fs.delete_file(own)
            raise
        part = f"{uuid.uuid4().hex}.parquet"
        folder = f"{root}/{MANIFESTS}/objects"
        fs.create_dir(folder, recursive=True)
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True) if done else [[]] * 3, OBJECTS_SCHEMA, strict=True)], schema=OBJECTS_SCHEMA)
        with fs.open_output_stream(f"{folder}/.{part}") as sink:
            pq.write_table(table, sink)
        fs.move(f"{folder}/.{part}", f"{folder}/{part}")
        return Written(part, len(done))

    def commit(self, messages):
        fs, root = file_system(self.root)
        told = [m for m in messages if m is not None]
        manifest = {"run": self.run, "objects": sum(m.objects for m in told), "parts": [m.part for m in told]}
        put(fs, f"{root}/{MANIFESTS}/{self.run}.json", json.dumps(manifest).encode())

    def abort(self, messages):
        """Objects that are complete stay, unpublished; the next run writes them again."""


class NamedObjects(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_objects"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema)


class _TextWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.root = options["root"]

    def write(self, iterator):
        fs, root = file_system(self.root)
        n = 0
        for batch in iterator:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                put(fs, f"{root}/{name}", (body or "").encode())
                n += 1
        return Written("", n)


class NamedTexts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_texts"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _TextWriter(self.options)


def write_texts(rows: DataFrame, root: str) -> None:
    """A file for each row (name, body), as answers of the service are recorded; a name may have folders."""
    rows.sparkSession.dataSource.register(NamedTexts)
    rows.select("name", "body").write.format("named_texts").options(root=root).mode("append").save()


class _Folder(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _ListingReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.prefix = options["root"], options.get("prefix", "")
        self.nested = str(options.get("nested", "false")).lower() == "true"

    def partitions(self):
        if not self.nested:
            return [_Folder("")]
        fs, root = file_system(self.root)
        inside = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return [_Folder(""), *(_Folder(f.base_name) for f in inside if f.type == pafs.FileType.Directory and not f.base_name.startswith((".", "_")))]

    def read(self, piece: _Folder):
        fs, root = file_system(self.root)
        found = fs.get_file_info(pafs.FileSelector(f"{root}/{piece.path}" if piece.path else root, allow_not_found=True))
        folders = {pafs.FileType.Directory} if self.nested and not piece.path else set()  # they are pieces of their own
        some = [f for f in found if f.base_name.startswith(self.prefix) and f.type not in folders]
        for at in range(0, len(some), 10_000):
            part = some[at : at + 10_000]
            names = [f"{piece.path}/{f.base_name}" if piece.path else f.base_name for f in part]
            times = pa.array([f.mtime_ns // 1000 if f.mtime_ns else None for f in part], pa.int64()).cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), times], ["name", "updated"])


class ObjectListing(DataSource):
    """name and updated of a folder's entries, listed by tasks: one for the folder, and with `nested` one for each folder in it."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> T.StructType:
        return OBJECTS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ListingReader(self.options)


def listing(spark: SparkSession, root: str, prefix: str = "", nested: bool = False) -> DataFrame:
    """name and updated of root's entries that start with prefix, none of which passes through the driver; an empty root or none has none.

    nested: those of the folders in root too, by `folder/name`, each folder by a task of its own."""
    spark.dataSource.register(ObjectListing)
    return spark.read.format("object_listing").options(root=root, prefix=prefix, nested=str(nested).lower()).load()


def write_objects(rows: DataFrame, root: str, prefix: str, key: str, *order: str, null_seq: str | None = None) -> str:
    """An object for each key among rows, its rows in order, without the key; the name of the run that published them."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedObjects)
    run = uuid.uuid4().hex
    options = {"root": root, "prefix": prefix, "key": key, "run": run} | ({"null_seq": null_seq} if null_seq else {})
    rows.repartition(key).sortWithinPartitions(key, *order).write.format("named_objects").options(**options).mode("append").save()
    return run


def published(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    """run, name, key and rows of the objects that manifests list: of one run, or of all."""
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("key", T.StringType()), T.StructField("rows", T.LongType())])
    fs, at = file_system(root)
    if not any(f.extension == "json" for f in fs.get_file_info(pafs.FileSelector(f"{at}/{MANIFESTS}", allow_not_found=True))):
        return spark.createDataFrame([], T.StructType([T.StructField("run", T.StringType()), *schema.fields]))
    listed = spark.read.schema("run string, parts array<string>").json(f"{root}/{MANIFESTS}/{run or '*'}.json").select("run", F.explode("parts").alias("part"))
    rows = spark.read.schema(schema).parquet(f"{root}/{MANIFESTS}/objects").withColumn("part", F.col("_metadata.file_name"))
    return rows.join(listed, "part").select("run", "name", "key", "rows")


def _conformed(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """table's columns by name as the schema has them; such that it lacks are null."""
    out = []
    for f in schema:
        if f.name not in table.column_names:
            out.append(pa.nulls(table.num_rows, f.type))
            continue
        column = table.column(f.name)
        if pa.types.is_timestamp(f.type) and pa.types.is_timestamp(column.type) and column.type.tz is None:
            column = column.cast(pa.timestamp("us"), safe=False)
        out.append(column.cast(f.type, safe=False) if column.type != f.type else column)
    return pa.table(out, schema=schema)


def read_objects(names: DataFrame, root: str, schema: T.StructType, tasks: int | None = None, named: str | None = None) -> DataFrame:
    """The rows of the objects that names (a column `name`) lists: the schema's columns, of those only, with types cast to it.

    named: a column more, with the object's name."""
    arrow = to_arrow_schema(schema, timestamp_utc=True)

    def run(batches):
        fs, at = file_system(root)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                path = f"{at}/{name}"
                inside = [path]
                if fs.get_file_info(path).type == pafs.FileType.Directory:  # an object that Spark wrote
                    inside = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if f.extension == "parquet" and not f.base_name.startswith((".", "_")))
                for one in inside:
                    with fs.open_input_file(one) as source:
                        file = pq.ParquetFile(source)
                        have = [f.name for f in arrow if f.name in file.schema_arrow.names]
                        for piece in file.iter_batches(columns=have):
                            table = _conformed(pa.Table.from_batches([piece]), arrow)
                            if named:
                                table = table.append_column(named, pa.repeat(pa.scalar(name, pa.string()), table.num_rows))
                            yield from table.to_batches()

    names = names.select("name").repartition(tasks or names.sparkSession.sparkContext.defaultParallelism)
    return names.mapInArrow(run, T.StructType([*schema.fields, T.StructField(named, T.StringType())]) if named else schema)
