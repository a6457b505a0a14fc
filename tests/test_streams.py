"""Points by days as a stream, and feature collections read in stretches."""

import json
import random
import re
from collections import Counter

import numpy as np
import pytest

from halyard.sources import geojson, http

from .test_workflows import server  # noqa: F401


def days_asked(asked):
    return [p.split("/")[-1] for p, *_ in asked]


def test_each_day_comes_once_over_restarts(spark, server, tmp_path):  # noqa: F811
    http.register(spark)
    url, asked = server

    def run(to, **more):
        stream = spark.readStream.format("trip_points").options(base_url=url, token="tok", secret="sec", from_date="2024-01-01", to_date=to, progress=f"{tmp_path}/progress", **more).load()
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None

    run("2024-01-03")
    assert days_asked(asked) == ["2024-01-01", "2024-01-02", "2024-01-03"] or sorted(days_asked(asked)) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    run("2024-01-03")  # nothing new
    assert len(asked) == 3
    run("2024-01-09", days_at_once=2)
    run("2024-01-09", days_at_once=2)
    days = Counter(days_asked(asked))
    assert max(days.values()) == 1 and {"2024-01-04", "2024-01-05"} <= {*days} and len(days) < 9  # no more than the limit at a time
    for _ in range(4):
        run("2024-01-09", days_at_once=2)
    assert Counter(days_asked(asked)) == {f"2024-01-0{d}": 1 for d in range(1, 10)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 9 * 8


def test_a_stream_of_days_plans_by_offsets():
    reader = http._DaysReader({"from_date": "2024-01-01", "to_date": "2024-01-05", "base_url": "", "token": "", "secret": "", "days_at_once": "2"}, None)
    assert reader.initialOffset() == {"next": "2024-01-01"}
    assert [reader.latestOffset()["next"] for _ in range(4)] == ["2024-01-03", "2024-01-05", "2024-01-06", "2024-01-06"]
    assert [p.path for p in reader.partitions({"next": "2024-02-28"}, {"next": "2024-03-02"})] == [f"points/{d}/{d}" for d in ("2024-02-28", "2024-02-29", "2024-03-01")]
    assert reader.partitions({"next": "2024-01-03"}, {"next": "2024-01-03"}) == []
    with pytest.raises(ValueError, match="required"):
        http._DaysReader({}, None)


def some_features(n):
    rng = random.Random(n)
    texts = ["plain", 'quo"te', "back\\slash", "end\\\\", 'a "{[" b', "}}]]", "é漢\n\t", "\\\\\\", ""]
    return [{"type": "Feature", "properties": {"n": k, "name": rng.choice(texts), "more": {"list": [1, {"a": "}"}], "x": rng.choice([None, 1.5])}}, "geometry": None if k % 7 == 0 else {"type": "Polygon", "coordinates": [[[rng.random(), rng.random()] for _ in range(rng.randint(1, 6))]]}} for k in range(n)]


@pytest.mark.parametrize("indent", [None, 1])
def test_a_collection_in_stretches_of_any_size(indent):
    whole = {"type": "FeatureCollection", "name": 'a "[{" name', "bbox": [1, 2], "crs": {"type": "name", "properties": {"name": "x"}}, "features": some_features(23)}
    raw = json.dumps(whole, indent=indent, ensure_ascii=False).encode()
    read = lambda at, n: raw[at : at + n]
    for size in (1, 2, 3, 7, 64, 1000, len(raw)):
        within, depth, found = False, 0, []
        for start in range(0, len(raw), size):
            stretch = min(size, len(raw) - start)
            found += geojson._cut(read, start, stretch, len(raw), within, depth)
            quotes, outside, inside = geojson.summary(np.frombuffer(read(start, stretch), np.uint8), geojson._escapes_before(read, start))
            depth += inside if within else outside
            within ^= quotes % 2 == 1
        assert [x for x in map(json.loads, found) if x.get("type") == "Feature"] == whole["features"], size
        assert depth == 0 and not within


def test_large_files_are_read_by_many_tasks(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": some_features(300 + k)}, indent=k or None))
    paths = [f"{tmp_path}/{k}.geojson" for k in range(2)]
    texts = geojson.features_of(spark, *paths, stretch=4000)
    assert texts.count() == 601 and texts.rdd.getNumPartitions() > 10
    one, many = geojson.read_geojson(spark, *paths), geojson.read_geojson(spark, *paths, stretch=4000)
    assert one.schema == many.schema
    packed = lambda rows: Counter(re.sub(r"\\n|\s", "", str(r)) for r in rows)  # noqa: E731 - white space between JSON values may differ
    assert packed(one.collect()) == packed(many.collect())
    given = geojson.read_geojson(spark, *paths, properties=one.select("n").schema, stretch=4000)
    assert given.columns == ["n", "geometry"] and given.where("n is not null").count() == 601
