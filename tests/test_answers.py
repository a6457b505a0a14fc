"""Answers with columns that nobody announced, retries, and the ledger of runs."""

import threading
import time
from datetime import UTC, date, datetime, timedelta
from email.utils import format_datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halyard.plans import workflows
from halyard.schemas import POINTS, TRIPS
from halyard.sources import answers, http, objects, store

START = datetime(2024, 1, 1)
HEAD = "Time,Lat,Lng,Speed (M/S),Range (Meters),Heading"


def line(k: int, *more) -> str:
    return ",".join([f"{(START + timedelta(minutes=k)).isoformat()}Z", f"{-4 - 0.005 * k}", "39.0", "1.5", "10", "0", *map(str, more)])


BODIES = {
    # no Trip in any; battery is whole here and not there, vessel text, seen a time, active comes and goes
    "1": f"{HEAD},battery,vessel,seen\n" + "".join(line(k, 90 - k, "Asha", "2024-01-01T00:00:00Z") + "\n" for k in range(8)),
    "2": f"{HEAD},battery,vessel,seen,active\n" + "".join(line(k, 80.5 - k, 7, "2024-01-02", "TRUE") + "\n" for k in range(8)),
    "3": f"Trip,{HEAD},battery\n" + "".join(f"99,{line(k, '')}\n" for k in range(8)),  # says that it's another trip
    "4": f"{HEAD},battery,code\n",
    "5": f"{HEAD}\n" + line(0) + ",one too many\n",
    "6": f"{HEAD},code\n" + line(0, "007") + "\n" + line(1, "8") + "\n",
}


@pytest.fixture
def service():
    """A service that may fail: `plan` has statuses for a path's first requests, with a Retry-After or without."""
    asked, plan = [], {}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlparse(self.path)
            asked.append((url.path, parse_qs(url.query), time.monotonic()))
            trip = url.path.split("/")[-2]
            status, after = plan.get(trip, []).pop(0) if plan.get(trip) else (200, None)
            self.send_response(status)
            if after is not None:
                self.send_header("Retry-After", after)
            self.end_headers()
            self.wfile.write((BODIES.get(trip, "Trip,IMEI,Started,Ended,Harbour\n1,001,2024-01-01T00:00:00Z,,Pemba\n2,002,2024-01-01T00:00:00Z,,\n") if status == 200 else "later").encode())

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield {"base_url": f"http://127.0.0.1:{s.server_port}", "token": "tok", "secret": "sec", "wait": 0.01}, asked, plan
    s.shutdown()


@pytest.fixture
def conf(service, tmp_path):
    return {"api": service[0], "trips": {"prefix": "trips", "version": "latest"}, "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500}, "storage": {"root": f"{tmp_path}/store", "tracks_root": f"{tmp_path}/tracks"}}


def stored(spark, conf, *trips):
    store.write_versioned(spark.createDataFrame([(t,) for t in trips], "Trip long"), conf["storage"]["root"], "trips")


def test_unknown_columns_reach_the_objects(spark, conf):
    stored(spark, conf, 1, 2, 3, 4, 5)
    status = {r.trip_id: (r.status, r.message) for r in workflows.ingest_tracks(spark, conf).collect()}
    assert {k: v[0] for k, v in status.items()} == {1: "success", 2: "success", 3: "success", 4: "success", 5: "error"} and "cells" in status[5][1]
    root = conf["storage"]["tracks_root"]
    rows = spark.read.parquet(f"{root}/tracks_*.parquet")
    kinds = {f.name: f.dataType for f in rows.schema}
    assert {k: kinds[k] for k in ("battery", "vessel", "seen", "active", "code")} == {"battery": T.DoubleType(), "vessel": T.StringType(), "seen": T.TimestampType(), "active": T.BooleanType(), "code": T.StringType()}
    got = {(r.Trip, r.seq): r for r in rows.collect()}
    assert len(got) == 24 and {t for t, _ in got} == {1, 2, 3}  # the id asked for, whatever the body says
    assert (got[1, 2].battery, got[1, 2].vessel, got[1, 2].seen, got[1, 2].active) == (88.0, "Asha", START, None)
    assert (got[2, 1].battery, got[2, 1].vessel, got[2, 1].seen, got[2, 1].active) == (79.5, "7", START + timedelta(days=1), True)
    assert got[3, 0].battery is None and got[3, 0].Time == START
    names = {r.name for r in store.list_objects(spark, root, "tracks_").collect()}
    assert names == {f"tracks_{k}.parquet" for k in (1, 2, 3, 4)}
    assert {(r.name, r.rows) for r in objects.published(spark, root).collect()} == {("tracks_1.parquet", 8), ("tracks_2.parquet", 8), ("tracks_3.parquet", 8), ("tracks_4.parquet", 0)}
    first = workflows.preprocess_tracks(spark, conf, now=START)
    assert spark.read.parquet(f"{conf['storage']['root']}/{first[0]}").select("Trip").distinct().count() == 3


def test_trips_and_points_with_all_columns(spark, service):
    api, asked, _ = service
    trips = workflows.get_trips(spark, api, "2024-01-01", "2024-01-31", imeis=["001", "002"], tags=["a", "b"], deviceInfo=True)
    assert asked[-1][0] == "/tok/v1/trips/2024-01-01/2024-01-31" and asked[-1][1] == {"imeis": ["001,002"], "tags": ["a,b"], "deviceInfo": ["true"]}
    assert {(r.Trip, r.IMEI, r.Harbour, r.Started, r.Ended) for r in trips.collect()} == {(1, "001", "Pemba", START, None), (2, "002", None, START, None)}
    ids = spark.createDataFrame([(1,), (6,)], "trip_id long")
    points = workflows.get_trip_points(spark, api, ids)
    assert dict(points.groupBy("Trip").count().collect()) == {1: 8, 6: 2} and points.schema["code"].dataType == T.StringType()
    assert {r.code for r in points.where("Trip = 6").collect()} == {"007", "8"}
    with pytest.raises(RuntimeError, match="5: record 1 has 7 cells"):
        workflows.get_trip_points(spark, api, spark.createDataFrame([(5,)], "trip_id long"))
    with pytest.raises(ValueError, match="required when no id"):
        workflows.get_trip_points(spark, api, from_date="2024-01-01")


def test_attempts_are_repeated_as_asked(service):
    api, asked, plan = service
    url = http.request_url(api["base_url"], "tok", "trips/1/points", {})
    plan["1"] = [(429, "0.0"), (503, None), (500, "1")]
    began = time.monotonic()
    assert http.fetch(url, "sec", attempts=4, wait=0.01) == BODIES["1"]
    assert len(asked) == 4 and 1 <= time.monotonic() - began < 3
    plan["1"] = [(503, None)] * 3
    with pytest.raises(RuntimeError, match="status 503"):
        http.fetch(url, "sec", attempts=3, wait=0.01)
    plan["1"] = [(404, None)]  # no use in asking again
    asked.clear()
    with pytest.raises(RuntimeError, match="status 404"):
        http.fetch(url, "sec", attempts=5, wait=0.01)
    assert len(asked) == 1
    plan["1"] = [(429, "3600")]  # a long pause is cut
    began = time.monotonic()
    assert http.fetch(url, "sec", attempts=2, longest=0.2) and time.monotonic() - began < 2
    with pytest.raises(OSError):
        http.fetch("http://127.0.0.1:9/x", "sec", attempts=2, wait=0.01)
    assert http._later(format_datetime(datetime.now(UTC) + timedelta(seconds=100), usegmt=True)) > 90
    assert http._later("soon") is None and http._later(None) is None


def test_trips_that_keep_failing_are_left_out(spark, conf, service):
    _, asked, plan = service
    conf["tracks"]["quarantine_after"] = 2
    conf["api"] |= {"attempts": 2}
    stored(spark, conf, 1, 5, 6)
    plan["6"] = [(500, None)] * 2
    assert {r.trip_id: r.status for r in workflows.ingest_tracks(spark, conf).collect()} == {1: "success", 5: "error", 6: "error"}
    assert {r.trip_id: r.status for r in workflows.ingest_tracks(spark, conf).collect()} == {5: "error", 6: "success"}
    asked.clear()
    assert workflows.ingest_tracks(spark, conf).collect() == [] and asked == []
    runs = workflows.ledger(spark, conf["storage"]["tracks_root"])
    assert runs.groupBy("run").count().count() == 2 and [r.trip_id for r in workflows.quarantined(runs, 2).collect()] == [5]


def test_rate(spark, service):
    api, asked, _ = service
    requests = spark.createDataFrame([("1", "trips/1/points")] * 6, "asked string, path string")
    answers.fetched(requests, api, POINTS, tasks=1, rate=10.0).count()
    at = sorted(t for *_, t in asked)
    assert len(at) == 6 and at[-1] - at[0] >= 0.45


@pytest.mark.parametrize(
    "cells, kind",
    [
        ([None, "", "NA"], T.StringType()),
        (["1", "-2", "+3", "0"], T.LongType()),
        (["1", "123456789012345678"], T.LongType()),
        (["1", "2.5", None], T.DoubleType()),
        (["1e5", "NaN", "-Inf", ".5", "2."], T.DoubleType()),
        (["1.5", "123456789012345678"], T.StringType()),
        (["12345678901234567890"], T.StringType()),
        (["007"], T.StringType()),
        (["1", "x"], T.StringType()),
        (["TRUE", "F", "false"], T.BooleanType()),
        (["TRUE", "1"], T.StringType()),
        (["2024-02-29"], T.DateType()),
        (["2023-02-29"], T.StringType()),
        (["2024-02-29", "2024-02-29 10:11", "2024-02-29T10:11:12.5+03:00"], T.TimestampType()),
        (["2024-02-29", "3"], T.StringType()),
    ],
)
def test_the_least_type_of_all_kinds(spark, cells, kind):
    rows = spark.createDataFrame([(str(k), 0, ["x"], [c], None) for k, c in enumerate(cells)] + [("e", None, ["x", "y"], None, None), ("f", None, None, None, "failed")], answers.ANSWERS)
    fields = answers.discovered(rows, T.StructType([]))
    assert [(f.name, f.dataType) for f in fields] == [("x", kind), ("y", T.StringType())]
    lost = answers.typed(rows, fields).where("seq is not null and x is null").count()
    assert lost == sum(c in (None, "", "NA") for c in cells) if kind != T.StringType() else lost <= 3


def test_values_keep_their_meaning(spark):
    rows = spark.createDataFrame([("a", 0, ["b", "d", "t", "n"], ["T", "2024-01-02", "2024-01-02T03:04:05.5+03:00", "-Inf"], None), ("b", 0, ["t", "b", "n"], ["2024-01-02", "false", "NaN"], None)], answers.ANSWERS)
    got = {r.asked: r for r in answers.typed(rows, answers.discovered(rows, T.StructType([]))).collect()}
    assert (got["a"].b, got["a"].d, got["a"].t, got["a"].n) == (True, date(2024, 1, 2), datetime(2024, 1, 2, 0, 4, 5, 500000), float("-inf"))
    assert (got["b"].b, got["b"].d, got["b"].t, str(got["b"].n)) == (False, None, datetime(2024, 1, 2), "nan")


def test_names_that_clash(spark):
    assert answers.header(["a", "", "b", "a"]) == ["a...1", "...2", "b", "a...4"]
    rows = spark.createDataFrame([("a", 0, ["IMEI", "imei", "Imei", "a.b", "`q`"], ["1", "2", "3", "4", "5"], None)], answers.ANSWERS)
    fields = answers.discovered(rows, TRIPS)
    assert [f.name for f in fields][len(TRIPS) :] == ["Imei...2", "`q`", "a.b", "imei...3"]
    row = answers.typed(rows, [f for f in fields if f.name != "`q`"]).first()
    assert (row["IMEI"], row["Imei...2"], row["imei...3"], row["a.b"]) == ("1", 3, 2, 4)


def test_an_answer_set_with_too_many_columns(spark, monkeypatch):
    monkeypatch.setattr(answers, "MOST_COLUMNS", 3)
    rows = spark.createDataFrame([("a", 0, list("wxyz"), list("1234"), None)], answers.ANSWERS)
    with pytest.raises(ValueError, match="more than 3 columns"):
        answers.discovered(rows, TRIPS)


def test_recorded_answers(spark, tmp_path):
    objects.write_texts(spark.createDataFrame([("trips/1/points", BODIES["1"])], "name string, body string"), f"{tmp_path}/tok/v1")
    api = {"base_url": f"file://{tmp_path}", "token": "tok", "secret": ""}
    got = workflows.get_trip_points(spark, api, spark.createDataFrame([(1,)], "trip_id long"), deviceInfo=True)
    assert got.agg(F.sum("battery")).first()[0] == sum(90 - k for k in range(8))
    with pytest.raises(RuntimeError, match="2: "):
        workflows.get_trip_points(spark, api, spark.createDataFrame([(2,)], "trip_id long"))


def test_a_small_table_of_requests_is_dealt_out(spark, tmp_path):
    """Ids in one file aren't asked for by one task, and the kinds of known columns aren't looked at."""
    asked = spark.range(40).coalesce(1).selectExpr("cast(id as string) as asked", "concat('trips/', id, '/points') as path")
    objects.write_texts(asked.selectExpr("path as name", "'Lat,more\n1.5,7\n' as body"), f"{tmp_path}/tok/v1")
    got = answers.fetched(asked, {"base_url": f"file://{tmp_path}", "token": "tok", "secret": ""}, POINTS)
    assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and got.where("error is null").count() == 40
    assert {r["name"]: r.kinds for r in answers.kinds_of(got, tuple(POINTS.names)).collect()} == {"Lat": 0, "more": answers.LONG}


def test_rows_of_objects_with_their_names(spark, tmp_path):
    rows = spark.createDataFrame([(k, s) for k in (1, 2) for s in range(3)], "_of long, seq long")
    objects.write_objects(rows, str(tmp_path), "t", "_of", "seq")
    got = objects.read_objects(objects.listing(spark, str(tmp_path), "t_"), str(tmp_path), rows.drop("_of").schema, named="object")
    assert sorted(tuple(r) for r in got.collect()) == [(s, f"t_{k}.parquet") for s in range(3) for k in (1, 2)]
