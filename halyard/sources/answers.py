"""Answers of the service as tables: fetched by tasks, kept as text, and typed by what all of them hold.

fetched() runs requests (asked, path) in tasks, a share of them each, and gives one row for each record: its cells as
text beside the names of its own header. What fails is a row with the error, an answer without records one without
cells, so every request leaves a row. Columns whose type is known are checked there, so an answer comes whole or not at all.

discovered() then makes one schema of all headers and cells: what kinds of values a column has is one bit each, united
by Spark over all answers, and the kinds' join in a lattice is the type: long < double < string, date < timestamp < string, boolean
< string, and nothing at all is string. No join loses digits: long values of more than 15 digits don't become double. typed()
reads the cells by that schema. Both read the stored text, so no request is made twice.

Defined results: an empty cell and NA are null; a name that repeats in a header, or is empty, gets its place as in "a...3";
names that differ in case only get a number too, since tables don't tell them apart; records with too few cells are filled with
nulls, such with too many are an error; numbers with leading zeros are strings. The identity of a row is the id asked for, whatever the body has.
"""

from __future__ import annotations

import csv
import io
import time
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.sources import http

ANSWERS = "asked string, seq bigint, names array<string>, cells array<string>, error string"
_ARROW = pa.schema([("asked", pa.string()), ("seq", pa.int64()), ("names", pa.list_(pa.string())), ("cells", pa.list_(pa.string())), ("error", pa.string())])
_AT_ONCE = 10_000
#: Columns of one schema; an answer set with more is an error.
MOST_COLUMNS = 10_000

BOOLEAN, LONG, LONGER, DOUBLE, DATE, TIME, TEXT = (1 << k for k in range(7))
_NUMBER = r"[-+]?(0|[1-9][0-9]*)"
_PATTERNS = (
    (BOOLEAN, r"^(T|F|TRUE|FALSE|True|False|true|false)$", None),
    (LONG, r"^[-+]?(0|[1-9][0-9]{0,14})$", None),
    (LONGER, r"^[-+]?[1-9][0-9]{15,17}$", None),
    (TEXT, r"^[-+]?[0-9]{19,}$", None),  # no number type holds all its digits
    (DOUBLE, rf"^({_NUMBER}(\.[0-9]*)?|[-+]?\.[0-9]+)([eE][-+]?[0-9]{{1,3}})?$|^(NaN|[-+]?Inf)$", None),
    (DATE, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date"),
    (TIME, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$", "timestamp"),
)
_JOINS = ((0, T.StringType()), (BOOLEAN, T.BooleanType()), (LONG | LONGER, T.LongType()), (LONG | DOUBLE, T.DoubleType()), (DATE, T.DateType()), (DATE | TIME, T.TimestampType()))


def header(names: list[str]) -> list[str]:
    """Names that tell columns apart: an empty or repeated one gets its place."""
    seen = [n for n in names if n]
    return [n if n and seen.count(n) == 1 else f"{n}...{k}" for k, n in enumerate(names, 1)]


def _text(value) -> str | None:
    """A known value in the form that Spark casts."""
    if isinstance(value, datetime):
        return value.isoformat()
    return None if value is None else str(value)


def records(body: str, known: T.StructType) -> tuple[list[str], list[list[str | None]]]:
    """The header and the records' cells; an error where a known column holds what isn't of its type."""
    lines = csv.reader(io.StringIO(body), strict=True)
    names = header(next(lines, []))
    kinds = {names.index(f.name): f for f in known.fields if f.name in names}
    out = []
    for cells in lines:
        if not cells:
            continue
        if len(cells) > len(names):
            raise ValueError(f"record {len(out) + 1} has {len(cells)} cells, the header {len(names)}")
        cells = [c if c not in ("", "NA") else None for c in cells] + [None] * (len(names) - len(cells))
        for k, f in kinds.items():
            try:
                cells[k] = _text(http.value(cells[k], f.dataType))
            except ValueError as e:
                raise ValueError(f"record {len(out) + 1}, {f.name}: {e}") from e
        out.append(cells)
    return names, out


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= _AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _ARROW, strict=True)], schema=_ARROW)
            held.clear()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), _ARROW, strict=True)], schema=_ARROW)


def fetched(requests: DataFrame, api: dict, known: T.StructType, tasks: int | None = None, rate: float | None = None, **options) -> DataFrame:
    """The answers to requests (asked, path) as ANSWERS; write them before use, since each reading makes the requests again.

    tasks (as many as there are cores, without it) run side by side; rate: requests a second of all of them together. options are the request's, and attempts, wait and longest of http.fetch()."""
    requests = requests.select(F.col("asked").cast("string"), "path")
    # a table of ids is small, often one file, so it's dealt out: else one task makes all requests, and all that reads its answers is one task too
    tasks = tasks or requests.sparkSession.sparkContext.defaultParallelism
    requests = requests.repartition(tasks)
    pause = tasks / rate if rate else 0.0
    patience = {k: options.pop(k) for k in ("attempts", "wait", "longest", "timeout") if k in options}

    def answers(batches):
        last = 0.0
        for batch in batches:
            for asked, path in zip(batch.column("asked").to_pylist(), batch.column("path").to_pylist(), strict=True):
                if pause and last:
                    time.sleep(max(0.0, last + pause - time.monotonic()))
                last = time.monotonic()
                try:
                    names, cells = records(http.fetch(http.request_url(api["base_url"], api["token"], path, options), api["secret"], **patience), known)
                except Exception as e:
                    yield asked, None, None, None, str(e) or type(e).__name__
                    continue
                if not cells:
                    yield asked, None, names, None, None
                yield from ((asked, k, names, c, None) for k, c in enumerate(cells))

    return requests.mapInArrow(lambda batches: _batches(answers(batches)), ANSWERS)


def kind(cell: Column) -> Column:
    """The bit of a cell's kind; 0 for none."""
    out = F.when(cell.isNull() | cell.isin("", "NA"), F.lit(0))
    for bit, pattern, cast in _PATTERNS:
        fits = F.rlike(cell, F.lit(pattern))
        out = out.when(fits & cell.try_cast(cast).isNotNull() if cast else fits, F.lit(bit))
    return out.otherwise(F.lit(TEXT))


def joined(kinds: int) -> T.DataType:
    """The least type that holds all kinds of a set."""
    return next((t for bits, t in _JOINS if kinds & ~bits == 0), T.StringType())


def kinds_of(answers: DataFrame, known: tuple[str, ...] = ()) -> DataFrame:
    """name and kinds (a bit for each) of each column of any answer; the kinds of known columns aren't looked at (0)."""
    heads = answers.where("names is not null")
    cells = heads.select(F.explode(F.arrays_zip(F.col("names").alias("name"), F.coalesce("cells", F.array().cast("array<string>")).alias("cell"))).alias("x")).select("x.name", "x.cell")
    bit = F.when(F.col("name").isin(*known), F.lit(0)).otherwise(kind(F.col("cell"))) if known else kind(F.col("cell"))
    return cells.groupBy("name").agg(F.bit_or(bit).alias("kinds"))


class Field(T.StructField):
    """A column, and the name that it has in the answers."""

    def __init__(self, name: str, kind: T.DataType, source: str):
        super().__init__(name, kind)
        self.source = source


def discovered(answers: DataFrame, known: T.StructType) -> list[Field]:
    """The known columns, then all others that answers have, by name, with their types."""
    rows = kinds_of(answers, tuple(f.name for f in known.fields)).limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} columns")
    names = {f.name for f in known.fields}
    out = [Field(f.name, f.dataType, f.name) for f in known.fields]
    taken = {f.name.lower() for f in out}
    for name, kinds in sorted(map(tuple, rows)):
        if name in names:
            continue
        own, k = name, 1
        while own.lower() in taken:
            k += 1
            own = f"{name}...{k}"
        taken.add(own.lower())
        out.append(Field(own, joined(kinds), name))
    return out


def _read(cell: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(cell.isNotNull(), cell.isin("T", "TRUE", "True", "true"))
    if isinstance(kind, T.DoubleType):
        return F.when(cell.endswith("Inf"), F.when(cell.startswith("-"), float("-inf")).otherwise(float("inf"))).otherwise(cell.try_cast("double"))
    return cell.try_cast(kind)


def typed(answers: DataFrame, fields: list[Field], identity: str | None = None) -> DataFrame:
    """asked and the fields' columns of each record of the answers that came.

    identity: the column that takes the id asked for, as `seq` takes the record's number. An answer without records keeps one row with a null seq and cells."""
    cells = F.when(F.col("cells").isNotNull(), F.map_from_arrays("names", "cells"))
    rows = answers.where("error is null").select("asked", "seq", cells.alias("cells"))

    def column(f: Field) -> Column:
        if f.name == "seq":
            return F.col("seq")
        if f.name == identity:
            return F.col("asked").try_cast(f.dataType)
        return _read(F.try_element_at("cells", F.lit(f.source)), f.dataType)

    return rows.select("asked", *[column(f).alias(f.name) for f in fields])


def results(answers: DataFrame) -> DataFrame:
    """status, trip_id and message of each request."""
    each = answers.groupBy("asked").agg(F.max("error").alias("error"))
    return each.select(F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), F.col("asked").try_cast("bigint").alias("trip_id"), F.coalesce("error", F.lit("Successfully processed")).alias("message"))
