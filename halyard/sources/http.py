"""Trips and track points over HTTP as Python data sources.

    spark.read.format("trip_points").schema(POINTS).options(base_url=..., token=..., secret=..., ids="1,2").load()

Points come by trip id, one partition an id, or by a range of dates, one partition a day; as a stream (readStream with
from_date, and to_date or up to yesterday) they come day by day, days_at_once in a batch, each day once. Trips come by a range
of dates in one request; equality and IN predicates on IMEI join the request's device list. A status other than 200 fails the task, unless
on_error is "row" (points by id only): then the id comes back as one row with its message in _error, and an
answer without points as one row with an empty _error. A body is parsed whole before its first row is given, so
an answer comes in full or not at all.
"""

from __future__ import annotations

import csv
import io
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from email.utils import parsedate_to_datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegerType, LongType, StructType, TimestampType

from halyard.schemas import POINTS, TRIPS
from halyard.sources import objects


#: Statuses that another attempt may mend.
PASSING = (408, 425, 429, 500, 502, 503, 504)


def _flag(options, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


def _listed(value) -> str:
    """A list as the service takes it; a text stays as it is."""
    return value if isinstance(value, str) else ",".join(map(str, value))


def request_url(base_url: str, token: str, path: str, options) -> str:
    query = {}
    if options.get("imeis"):
        query["imeis"] = _listed(options["imeis"])
    for name in ("deviceInfo", "errant", "withLastSeen"):
        if _flag(options, name):
            query[name] = "true"
    if options.get("tags"):
        query["tags"] = _listed(options["tags"])
    if options.get("format"):
        query["format"] = options["format"]
    return f"{base_url.rstrip('/')}/{token}/v1/{path}" + (f"?{urllib.parse.urlencode(query)}" if query else "")


def trips_path(from_date: str | None, to_date: str | None) -> str:
    if not from_date or not to_date:
        raise ValueError("from_date and to_date are required")
    return f"trips/{from_date}/{to_date}"


def points_path(trip: str | None = None, from_date: str | None = None, to_date: str | None = None) -> str:
    if trip:
        return f"trips/{urllib.parse.quote(str(trip))}/points"
    if not from_date or not to_date:
        raise ValueError("from_date and to_date are required when no id is given")
    return f"points/{from_date}/{to_date}"


def _later(after: str | None) -> float | None:
    """The seconds that a Retry-After header asks for: a number, or a date."""
    if not after:
        return None
    if after.strip().isdigit():
        return float(after)
    try:
        return max(0.0, (parsedate_to_datetime(after) - datetime.now(UTC)).total_seconds())
    except (TypeError, ValueError):
        return None


def _once(url: str, secret: str, timeout: float) -> tuple[int, str, str | None]:
    """Status, body and Retry-After of one attempt."""
    if url.startswith("file:"):  # recorded answers
        url = url.split("?", 1)[0]
    request = urllib.request.Request(url, headers={"X-API-SECRET": secret, "Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status or 200, answer.read().decode(), None
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode(errors="replace"), e.headers.get("Retry-After")


def fetch(url: str, secret: str, timeout: float = 60, attempts: int = 1, wait: float = 0.5, longest: float = 60) -> str:
    """The body of an answer. A status or failure that may pass is tried again, up to `attempts` in all.

    The pause doubles from `wait` up to `longest` seconds, by a random half so that tasks don't meet again, or is what the service asks for
    (no more than `longest`). Any other status than 200 is an error at once."""
    for n in range(1, attempts + 1):
        later = None
        try:
            status, body, later = _once(url, secret, timeout)
            if status == 200:
                return body
            problem = RuntimeError(f"request failed with status {status}\n{body}")
            if status not in PASSING:
                raise problem
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if url.startswith("file:"):
                raise
            problem = e
        if n < attempts:
            asked = _later(later)
            time.sleep(min(longest, asked if asked is not None else wait * 2 ** (n - 1) * (0.5 + random.random() / 2)))
    raise problem


def value(text: str | None, kind):
    if text is None or text in ("", "NA"):
        return None
    if isinstance(kind, LongType | IntegerType):
        return int(float(text)) if "e" in text.lower() or "." in text else int(text)
    if isinstance(kind, DoubleType | FloatType):
        return float(text)
    if isinstance(kind, TimestampType):
        at = datetime.fromisoformat(text.replace("Z", "+00:00"))
        return at if at.tzinfo else at.replace(tzinfo=UTC)
    if isinstance(kind, DateType):
        return date.fromisoformat(text[:10])
    return text


def parse(body: str, schema: StructType, **extra) -> Iterator[tuple]:
    """Rows of a CSV body by column name; `seq` is the row's number in it, columns it lacks are null."""
    for n, row in enumerate(csv.DictReader(io.StringIO(body))):
        row |= {"seq": str(n)} | extra
        yield tuple(value(row.get(f.name), f.dataType) for f in schema.fields)


class _Piece(InputPartition):
    def __init__(self, path: str, trip: str | None = None):
        self.path, self.trip = path, trip


class _Reader(DataSourceReader):
    def __init__(self, options, schema: StructType, pieces: list[_Piece]):
        self.options, self.schema, self.pieces = dict(options), schema, pieces

    def partitions(self):
        return self.pieces

    def read(self, piece: _Piece):
        url = request_url(self.options["base_url"], self.options["token"], piece.path, self.options)
        try:
            rows = list(parse(fetch(url, self.options["secret"]), self.schema))
            message = "" if not rows else None
        except Exception as e:
            if self.options.get("on_error") != "row" or piece.trip is None:
                raise
            rows, message = [], str(e) or type(e).__name__
        yield from rows
        if message is not None and self.options.get("on_error") == "row" and piece.trip is not None:
            mark = {"Trip": piece.trip}
            yield tuple(message if f.name == "_error" else value(mark.get(f.name), f.dataType) for f in self.schema.fields)


class _TripsReader(_Reader):
    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            values = None
            if isinstance(f, EqualTo) and f.attribute == ("IMEI",):
                values = [f.value]
            elif isinstance(f, In) and f.attribute == ("IMEI",):
                values = list(f.value)
            if values and not self.options.get("imeis"):
                self.options["imeis"] = ",".join(map(str, values))
            yield f  # Spark filters again


class TripsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trips"

    def schema(self) -> StructType:
        return TRIPS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TripsReader(self.options, schema, [_Piece(trips_path(self.options.get("from_date"), self.options.get("to_date")))])


class TripPointsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "trip_points"

    def schema(self) -> StructType:
        return POINTS

    def reader(self, schema: StructType) -> DataSourceReader:
        ids = [x for x in str(self.options.get("ids", "")).split(",") if x]
        if ids:
            return _Reader(self.options, schema, [_Piece(points_path(x), x) for x in ids])
        points_path(None, self.options.get("from_date"), self.options.get("to_date"))
        first, last = (date.fromisoformat(self.options[k]) for k in ("from_date", "to_date"))
        if _flag(self.options, "by_day"):
            return _Reader(self.options, schema, [_Piece(points_path(None, str(d), str(d))) for d in (first + timedelta(n) for n in range((last - first).days + 1))])
        return _Reader(self.options, schema, [_Piece(points_path(None, str(first), str(last)))])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _DaysReader(self.options, schema)


class _DaysReader(DataSourceStreamReader):
    """Days as offsets: {"next": the first day that isn't read yet}. A batch has the days between two offsets, a partition each.

    What has been read is in the stream's checkpoint alone; `progress`, a folder, only tells a restarted stream from where to
    count days_at_once, so losing it costs no day and repeats none."""

    def __init__(self, options, schema: StructType):
        self.options, self.schema = dict(options), schema
        points_path(None, self.options.get("from_date"), self.options.get("from_date"))
        self.first = date.fromisoformat(self.options["from_date"])
        self.limit = int(self.options.get("days_at_once", 0))
        self.at: date | None = None

    def _end(self) -> date:
        """The day after the last one that may be read: of to_date, else yesterday, which is complete."""
        to = self.options.get("to_date")
        return date.fromisoformat(to) + timedelta(days=1) if to else datetime.now(UTC).date()

    def _known(self) -> date:
        if folder := self.options.get("progress"):
            fs, at = objects.file_system(folder)
            if fs.get_file_info(f"{at}/next").is_file:
                with fs.open_input_stream(f"{at}/next") as f:
                    return max(self.first, date.fromisoformat(f.read().decode()))
        return self.first

    def initialOffset(self) -> dict:
        return {"next": str(self.first)}

    def latestOffset(self) -> dict:
        at = self._known() if self.at is None else self.at
        end = max(at, self._end())
        self.at = min(end, at + timedelta(days=self.limit)) if self.limit else end
        return {"next": str(self.at)}

    def partitions(self, start: dict, end: dict):
        first, last = date.fromisoformat(start["next"]), date.fromisoformat(end["next"])
        self.at = max(self.at or last, last)
        days = [first + timedelta(days=n) for n in range((last - first).days)]
        return [_Piece(points_path(None, str(d), str(d))) for d in days]

    def read(self, piece: _Piece):
        url = request_url(self.options["base_url"], self.options["token"], piece.path, self.options)
        yield from list(parse(fetch(url, self.options["secret"], attempts=int(self.options.get("attempts", 4))), self.schema))

    def commit(self, end: dict) -> None:
        if folder := self.options.get("progress"):
            fs, at = objects.file_system(folder)
            objects.put(fs, f"{at}/next", end["next"].encode())


def register(spark) -> None:
    """Both sources, and the pushdown that the trips source takes part in."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TripsSource)
    spark.dataSource.register(TripPointsSource)


def save_response(base_url: str, token: str, secret: str, path: str, to: str, options=None) -> str:
    """One response body as a CSV file; an existing file is replaced."""
    body = fetch(request_url(base_url, token, path, dict(options or {}) | {"format": "csv"}), secret)
    with open(to, "w", encoding="utf-8") as f:
        f.write(body)
    return to
