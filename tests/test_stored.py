"""Named objects, snapshots and the state of summaries that runs add to."""

import json
import os
import random
import threading
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from halyard.operators import state
from halyard.operators.summaries import grid_summaries
from halyard.plans import workflows
from halyard.schemas import GRIDDED, POINTS
from halyard.sources import objects, snapshots, store

from .test_workflows import START


# --- objects


def rows_of(spark, keys, n=5):
    return spark.createDataFrame([(k, k * 100 + s, s) for k in keys for s in range(n)], "_of long, value long, seq long").repartition(3)


def test_each_key_is_an_object(spark, tmp_path):
    marks = spark.createDataFrame([(77, None, None)], "_of long, value long, seq long")
    run = objects.write_objects(rows_of(spark, range(20)).unionByName(marks), str(tmp_path), "t", "_of", "seq", null_seq="seq")
    for k in range(20):
        assert pq.read_table(f"{tmp_path}/t_{k}.parquet").to_pydict() == {"value": [k * 100 + s for s in range(5)], "seq": list(range(5))}
    assert pq.read_table(f"{tmp_path}/t_77.parquet").num_rows == 0
    assert {(r.run, r.key, r.rows) for r in objects.published(spark, str(tmp_path)).collect()} == {(run, str(k), 5) for k in range(20)} | {(run, "77", 0)}
    assert not [n for n in os.listdir(tmp_path) if n.startswith(".")]


def test_repeated_and_killed_tasks_leave_each_object_once(spark, tmp_path):
    options = {"root": str(tmp_path), "prefix": "t", "key": "_of", "run": "r"}
    batch = pa.RecordBatch.from_pydict({"_of": [1, 1, 2], "value": [10, 11, 20]})
    schema = spark.createDataFrame([], "_of long, value long").schema

    def broken():
        yield batch
        raise RuntimeError("killed")

    writer = objects._Writer(options, schema)
    with pytest.raises(RuntimeError, match="killed"):
        writer.write(broken())
    assert sorted(n for n in os.listdir(tmp_path)) == ["t_1.parquet"]  # whole, and nothing half done
    assert objects.published(spark, str(tmp_path)).count() == 0
    told = [writer.write(iter([batch])) for _ in range(2)]  # a task that ran twice
    writer.commit([told[1], None])
    assert {(r.name, r.rows) for r in objects.published(spark, str(tmp_path)).collect()} == {("t_1.parquet", 2), ("t_2.parquet", 1)}
    assert pq.read_table(f"{tmp_path}/t_1.parquet")["value"].to_pylist() == [10, 11]
    with pytest.raises(ValueError, match="apart"):
        writer.write(iter([batch, batch]))


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    bad = rows_of(spark, range(4)).withColumn("value", F.when(F.col("_of") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        objects.write_objects(bad, str(tmp_path), "t", "_of", "seq")
    assert objects.published(spark, str(tmp_path)).count() == 0
    objects.write_objects(rows_of(spark, range(4)), str(tmp_path), "t", "_of", "seq")
    names = objects.published(spark, str(tmp_path))
    assert objects.read_objects(names, str(tmp_path), names.sparkSession.createDataFrame([], "seq long, value double, other string").schema).agg(F.sum("value"), F.count("other")).first()[:] == (sum(k * 100 + s for k in range(4) for s in range(5)), 0)


def test_objects_that_spark_wrote_are_read_too(spark, tmp_path):
    rows = [(1, START, -4.0, 39.0, 1.0, 2.0, 0.0, k) for k in range(3)]
    spark.createDataFrame(rows, POINTS).write.parquet(f"{tmp_path}/t_1.parquet")
    objects.write_objects(spark.createDataFrame([(2, *r[1:], 2) for r in rows], [*POINTS.names, "_of"]), str(tmp_path), "t", "_of", "seq")
    names = store.list_objects(spark, str(tmp_path), "t_")
    got = objects.read_objects(names, str(tmp_path), POINTS)
    assert got.schema == POINTS and Counter(r.Trip for r in got.collect()) == {1: 3, 2: 3} and {r.Time for r in got.collect()} == {START}
    assert objects.read_objects(names.limit(0), str(tmp_path), POINTS).count() == 0


def test_a_listing_by_tasks(spark, tmp_path):
    for name in ("t_1.parquet", "t_2.parquet", "u_1.parquet", "a/t_3.parquet", "b/t_4.parquet", "b/x", "_hidden/t_5.parquet"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("")
    (tmp_path / "t_6.parquet").mkdir()  # as Spark leaves an object
    flat = objects.listing(spark, str(tmp_path), "t_")
    assert sorted(r.name for r in flat.collect()) == ["t_1.parquet", "t_2.parquet", "t_6.parquet"]
    assert {(r.name, r.updated) for r in flat.collect()} == {(r.name, r.updated) for r in store.list_objects(spark, str(tmp_path), "t_").collect()} or flat.where("updated is null").count() == 0
    nested = objects.listing(spark, str(tmp_path), "t_", nested=True)
    assert {"t_1.parquet", "t_2.parquet", "a/t_3.parquet", "b/t_4.parquet"} <= {r.name for r in nested.collect()} and nested.where("name like '%hidden%'").count() == 0
    assert nested.rdd.getNumPartitions() == 4
    assert objects.listing(spark, f"{tmp_path}/none", "t_").collect() == []


# --- snapshots


def test_versions_follow_each_other(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.current(spark, root) is None
    for k in range(5):
        os.makedirs(f"{root}/p{k}")
        snapshots.commit(spark, root, lambda before: ([f"p{k}"], {"n": (before.meta["n"] if before else 0) + 1}))  # noqa: B023
    assert snapshots.current(spark, root) == snapshots.Version(5, ["p4"], {"n": 5})
    assert sorted(n for n in os.listdir(root) if n.startswith("p")) == ["p3", "p4"]


def test_writers_at_once_lose_no_change(spark, tmp_path):
    def add():
        for _ in range(4):
            snapshots.commit(spark, str(tmp_path), lambda before: ([], {"n": (before.meta["n"] if before else 0) + 1}))

    threads = [threading.Thread(target=add) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert snapshots.current(spark, str(tmp_path)).number == snapshots.current(spark, str(tmp_path)).meta["n"] == 8


def test_a_crash_at_each_step_keeps_a_collection(spark, tmp_path, monkeypatch):
    """What a reader sees after a push that was cut off before, in or after its commit."""
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,), (3,)], "a int")

    def seen():
        return sorted(r.a for r in store.pull(spark, str(tmp_path), "c", "db").collect())

    def crash(*a, **k):
        raise RuntimeError("cut off")

    with pytest.raises(FileNotFoundError):
        store.pull(spark, str(tmp_path), "c", "db")
    store.push(old, str(tmp_path), "c", "db")
    for step, after in (("new_part", [1]), ("_taken", [1]), ("_forget", [2, 3])):
        with monkeypatch.context() as m:
            m.setattr(snapshots, step, crash)
            with pytest.raises(RuntimeError, match="cut off"):
                store.push(new, str(tmp_path), "c", "db")
        assert seen() == after
    reader = store.pull(spark, str(tmp_path), "c", "db")  # planned before the next push, read after it
    store.push(old, str(tmp_path), "c", "db")
    assert sorted(r.a for r in reader.collect()) == [2, 3] and seen() == [1]


# --- the state of summaries


def some_gridded(spark, seed, trips):
    rng = random.Random(seed)
    rows = []
    for _ in range(200):
        rows.append((rng.choice(trips), -4.0 + 0.005 * rng.randint(0, 6), 39.0 + 0.005 * rng.randint(0, 3), rng.choice([None, 5.0, 60.5]) if rng.random() < 0.05 else rng.random() * 90, float("nan") if rng.random() < 0.02 else rng.random(), None if rng.random() < 0.02 else rng.random(), START, START, rng.randint(1, 9)))
    return spark.createDataFrame(rows, GRIDDED)


def rounded(df):
    return Counter(tuple("nan" if v != v else round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_merged_states_sum_up_as_one_table(spark):
    pieces = [some_gridded(spark, k, trips) for k, trips in enumerate(([1, 2, None], [2, 3, 70_000, -5], [None, 2**40], [1]))]
    whole, cells, visits = pieces[0], state.cells(pieces[0]), state.visits(pieces[0])
    for p in pieces[1:]:
        whole, cells, visits = whole.unionByName(p), cells.unionByName(state.cells(p)), visits.unionByName(state.visits(p))
    want = rounded(grid_summaries(whole, 0.0, 100.0))
    assert rounded(state.summed_up(cells, visits, 0.0, 100.0)) == want and len(want) > 4
    assert rounded(state.summed_up(state.merged_cells(cells), state.merged_visits(visits), 0.0, 100.0)) == want
    empty = spark.createDataFrame([], GRIDDED)
    assert state.summed_up(state.cells(empty), state.visits(empty)).count() == 0


def objects_of(spark, root, trips):
    rows = [(t, START, -4.0 - 0.005 * (i + t % 3), 39.0, 1.5, 10.0, 0.0, i, t) for t in trips for i in range(9)]
    at = spark.createDataFrame(rows, [*POINTS.names, "_of"]).withColumn("Time", F.col("Time") + F.make_dt_interval(mins=(F.col("seq") * 7).cast("int")))
    objects.write_objects(at, root, "tracks", "_of", "seq")


def test_runs_add_to_the_summaries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workflows, "INCREMENTS", 2)
    conf = {"storage": {"root": f"{tmp_path}/store", "tracks_root": f"{tmp_path}/tracks"}, "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500}}
    done, read = [], []
    real = objects.read_objects
    monkeypatch.setattr(objects, "read_objects", lambda names, *a: read.append(sorted(r.name for r in names.collect())) or real(names, *a))
    for trips in ([1, 2], [3], [4, 5, 6], [7], [8]):
        objects_of(spark, f"{tmp_path}/tracks", trips)
        done += trips
        name = workflows.append_tracks(spark, conf)
        assert read[-1] == sorted(f"tracks_{t}.parquet" for t in trips)  # the new ones alone
        every = workflows.appended(spark, conf)
        assert {r.Trip for r in every.select("Trip").distinct().collect()} == {*done}
        assert rounded(spark.read.parquet(f"{tmp_path}/store/{name}")) == rounded(grid_summaries(every))
        assert workflows.append_tracks(spark, conf) is None
    at = snapshots.current(spark, f"{tmp_path}/store/tracks-appended")
    assert len(at.meta["cells"]) <= 2 and len(at.meta["gridded"]) == 5


def test_a_run_that_is_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    conf = {"storage": {"root": f"{tmp_path}/store", "tracks_root": f"{tmp_path}/tracks"}, "tracks": {"prefix": "tracks", "version": "latest", "grid_size": 500}}
    objects_of(spark, f"{tmp_path}/tracks", [1, 2])
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_taken", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError, match="cut off"):
            workflows.append_tracks(spark, conf)
    assert workflows.appended(spark, conf) is None
    assert workflows.append_tracks(spark, conf) is not None
    assert Counter(r.Trip for r in workflows.appended(spark, conf).collect()) == {1: 5, 2: 5}
    assert json.loads(open(f"{tmp_path}/store/tracks-appended/_versions/000000000001.json").read())["parts"]
