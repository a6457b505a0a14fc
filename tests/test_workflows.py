"""The workflows from a stub server to collections, and the file stream."""

import json
import threading
from datetime import date, datetime, timedelta
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from halyard.plans import workflows
from halyard.schemas import POINTS
from halyard.sources import geojson, http, store
from halyard.streaming.tracks import grid_new_files

START = datetime(2024, 1, 1)


def body(trip):
    rows = [f"{trip},{(START + timedelta(minutes=i)).isoformat()}Z,{-4 - 0.005 * i},39.0,1.5,10,0" for i in range(8)]
    return "Trip,Time,Lat,Lng,Speed (M/S),Range (Meters),Heading\n" + "\n".join(rows) + "\n"


@pytest.fixture
def server():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlparse(self.path)
            asked.append((url.path, parse_qs(url.query), self.headers["X-API-SECRET"]))
            parts = url.path.split("/")
            if parts[3] == "trips" and parts[-1] == "points":
                bodies = {"4": body("4").splitlines()[0] + "\n", "5": body("5") + "5,no time,x,y\n", "6": ""}
                code, text = (500, "broken") if parts[4] == "3" else (200, bodies.get(parts[4], body(parts[4])))
            elif parts[3] == "points":
                code, text = 200, body(parts[4].replace("-", ""))
            else:
                code, text = 200, "Trip,IMEI,Started,Ended\n" + "".join(f"{t},00{t},2024-01-01T00:00:00Z,2024-01-02T00:00:00Z\n" for t in (1, 2, 3, 3))
            self.send_response(code)
            self.end_headers()
            self.wfile.write(text.encode())

        def log_message(self, *a):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", asked
    s.shutdown()


@pytest.fixture
def conf(server, tmp_path):
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta/devices.csv").write_text("state,IMEI\nInstalled,001\nInstalled,002\nRetired,009\n")
    return {
        "api": {"base_url": server[0], "token": "tok", "secret": "sec", "from_date": "2023-01-01", "attempts": 1},
        "trips": {"prefix": "trips", "version": "latest"},
        "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500},
        "storage": {"root": f"{tmp_path}/store", "tracks_root": f"{tmp_path}/tracks"},
        "collections": {"root": f"{tmp_path}/db", "grids": "grids", "maps": "maps", "metrics": "metrics"},
        "metadata": {"root": f"{tmp_path}/meta", "tables": ["devices"]},
    }


def test_from_the_server_to_the_collections(spark, conf, server, tmp_path):
    workflows.ingest_trips(spark, conf, date(2024, 2, 1), START)
    path, query, secret = server[1][0]
    assert path == "/tok/v1/trips/2023-01-01/2024-02-01" and query == {"imeis": ["001,002"]} and secret == "sec"

    status = {r.trip_id: (r.status, r.message) for r in workflows.ingest_tracks(spark, conf).collect()}
    assert {k: v[0] for k, v in status.items()} == {1: "success", 2: "success", 3: "error"} and "500" in status[3][1]
    assert store.object_names(spark, conf["storage"]["tracks_root"], "tracks_", "latest") == []
    stored = {r.name for r in store.list_objects(spark, conf["storage"]["tracks_root"], "tracks_").collect()}
    assert stored == {"tracks_1.parquet", "tracks_2.parquet"}

    first = workflows.preprocess_tracks(spark, conf, now=START)
    gridded = spark.read.parquet(f"{conf['storage']['root']}/{first[0]}")
    assert gridded.groupBy("Trip").count().count() == 2 and gridded.count() == 8
    assert workflows.preprocess_tracks(spark, conf) is None  # nothing new: a second run does nothing
    # only the failed trip is asked for again
    assert {r.trip_id for r in workflows.ingest_tracks(spark, conf).collect()} == {3}

    root = conf["storage"]["root"]
    for k, name in enumerate(("region_map_a", "region_map_b")):
        feature = {"type": "Feature", "properties": {"region": f"r{k}", "n": k}, "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}}
        with open(f"{root}/{name}__1__.geojson", "w") as f:
            json.dump({"type": "FeatureCollection", "features": [feature]}, f)
    for country, name in (("kenya", "monthly_summaries_a"), ("zanzibar", "monthly_summaries_b")):
        store.write_versioned(spark.createDataFrame([(country, 1000.0, 1000.0, 1000.0)], "country string, mean_rpue double, mean_rpua double, mean_price_kg double"), root, name)
    workflows.export(spark, conf)
    assert {r.region for r in store.pull(spark, f"{tmp_path}/db", "maps", "portal").collect()} == {"r0", "r1"}
    assert {r.country: round(r.mean_rpue, 4) for r in store.pull(spark, f"{tmp_path}/db", "metrics", "portal").collect()} == {"kenya": 7.7, "zanzibar": 0.37}
    assert store.pull(spark, f"{tmp_path}/db", "grids", "portal").columns[0] == "lat_grid_1km"


def test_answers_are_stored_whole_or_not_at_all(spark, conf, server):
    """A garbled body is an error without a file; one without points is stored, and isn't asked for again."""
    root = conf["storage"]["tracks_root"]
    store.write_versioned(spark.createDataFrame([(t,) for t in (1, 4, 5, 6)], "Trip long"), conf["storage"]["root"], "trips")
    got = {r.trip_id: r.status for r in workflows.ingest_tracks(spark, conf).collect()}
    assert got == {1: "success", 4: "success", 5: "error", 6: "success"}
    names = {r.name for r in store.list_objects(spark, root, "tracks_").collect()}
    assert names == {"tracks_1.parquet", "tracks_4.parquet", "tracks_6.parquet"}
    assert spark.read.schema(POINTS).parquet(*[f"{root}/{n}" for n in sorted(names)]).count() == 8
    server[1].clear()
    assert {r.trip_id: r.status for r in workflows.ingest_tracks(spark, conf).collect()} == {5: "error"}
    assert [p for p, *_ in server[1]] == ["/tok/v1/trips/5/points"]
    assert workflows.preprocess_tracks(spark, conf, now=START) is not None


def test_ids_are_dealt_to_tasks(spark, conf, server):
    conf["api"]["tasks"] = 2
    store.write_versioned(spark.createDataFrame([(t,) for t in (1, 2, 7, 8, 9)], "Trip long"), conf["storage"]["root"], "trips")
    assert sorted(r.trip_id for r in workflows.ingest_tracks(spark, conf, batch_size=2).collect()) == [1, 2]
    assert sorted(r.trip_id for r in workflows.ingest_tracks(spark, conf).collect()) == [7, 8, 9]
    assert workflows.ingest_tracks(spark, conf).count() == 0
    assert len([p for p, *_ in server[1]]) == 5  # each id is asked for once


def test_credentials_reach_the_clients_once(spark):
    conf = spark._jsc.hadoopConfiguration()
    assert store.authenticate(spark, "s3", {"access_key": "a", "secret_key": "b"}) == ["fs.s3a.access.key", "fs.s3a.secret.key"]
    assert store.authenticate(spark, "s3", {"access_key": "c"}) == [] and conf.get("fs.s3a.access.key") == "a"
    for name in ("fs.s3a.access.key", "fs.s3a.secret.key"):
        conf.unset(name)
    with pytest.raises(ValueError, match="gcs, s3"):
        store.authenticate(spark, "other", {})
    with pytest.raises(ValueError, match="unknown"):
        store.authenticate(spark, "gcs", {"pin": 1})


def reader(spark, server, **options):
    http.register(spark)
    return spark.read.format("trip_points").options(base_url=server[0], token="tok", secret="sec", **options)


def test_points_by_date_and_flags(spark, server):
    rows = reader(spark, server, from_date="2024-01-01", to_date="2024-01-03", by_day="true", errant="true", tags="a,b").load()
    assert rows.count() == 24
    assert {p for p, *_ in server[1]} == {f"/tok/v1/points/2024-01-0{d}/2024-01-0{d}" for d in (1, 2, 3)}
    assert server[1][0][1] == {"errant": ["true"], "tags": ["a,b"]}
    row = rows.orderBy("Trip", "seq").first()
    assert row.Time == START and row.seq == 0 and row["Speed (M/S)"] == 1.5


def test_points_need_an_id_or_both_dates(spark, server):
    with pytest.raises(Exception, match="required when no id"):
        reader(spark, server, from_date="2024-01-01").load().count()
    with pytest.raises(ValueError):
        http.trips_path(None, "2024-01-01")


def test_a_failed_request_fails_the_read(spark, server):
    with pytest.raises(Exception, match="status 500"):
        reader(spark, server, ids="3").load().count()


def test_device_predicates_join_the_request(spark, server):
    http.register(spark)
    trips = spark.read.format("trips").options(base_url=server[0], token="tok", secret="sec", from_date="2023-01-01", to_date="2023-01-02").load()
    assert trips.where("IMEI in ('001', '002')").count() == 2
    assert server[1][-1][1] == {"imeis": ["001,002"]}


def test_a_response_is_saved(server, tmp_path):
    to = http.save_response(server[0], "tok", "sec", http.points_path("1"), f"{tmp_path}/x.csv")
    assert open(to).read() == body("1") and server[1][-1][1] == {"format": ["csv"]}


def test_numbers_as_text_are_canonical():
    (row,) = http.parse("Trip\n1e+05\n", POINTS)
    assert row[0] == 100000


def test_geojson_features(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"type": "Feature", "properties": {"a": 2, "b": "x"}, "geometry": None}]
    (tmp_path / "m.geojson").write_text(json.dumps({"features": features}, indent=1))
    rows = sorted(geojson.read_geojson(spark, f"{tmp_path}/m.geojson").collect(), key=lambda r: r.a)
    assert rows[0].geometry.type == "Point" and json.loads(rows[0].geometry.coordinates) == [1, 2] and rows[1].b == "x"


def test_file_stream_grids_each_file_once(spark, tmp_path):
    def put(trip):
        rows = [(trip, START + timedelta(minutes=i), -4 - 0.005 * i, 39.0, 1.0, 1.0, 0.0, i) for i in range(7)]
        spark.createDataFrame(rows, POINTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    for n, trip in enumerate((1, 2)):
        put(trip)
        grid_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out").count() == 3 * (n + 1)
    put(1)  # more of a stored trip is skipped
    grid_new_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6
