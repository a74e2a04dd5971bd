"""Staged tables through crashes, catalogues of mixed files, partition names, and keyed streams."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from windrose.operators import layers
from windrose.sources import catalogue, files
from windrose.sources.staged import Conflict, Table, merged
from windrose.streaming import incremental


@pytest.fixture(scope="module", autouse=True)
def folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table_of(spark, values, schema="year int, event string, score int"):
    return spark.createDataFrame(values, schema)


def test_versions_replace_whole_partitions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["year", "event"])
    with pytest.raises(FileNotFoundError):
        t.read()
    a = [(2023, "a/b c", 1), (2023, "x", 2), (2024, None, 3), (2024, "x", 4), (2024, "x", 5)]
    assert t.publish(table_of(spark, a)) == 1
    cols = ["year", "event", "score"]
    assert rows(t.read().select(cols)) == sorted(a, key=str)
    # one partition is replaced, one is new, one goes
    assert t.publish(table_of(spark, [(2024, "x", 9), (2025, "n", 7)]), table_of(spark, [(2023, "a/b c", 0)])) == 2
    assert rows(t.read().select(cols)) == sorted([(2023, "x", 2), (2024, None, 3), (2024, "x", 9), (2025, "n", 7)], key=str)
    assert rows(t.read(1).select(cols)) == sorted(a, key=str)  # the version before is still whole
    assert rows(t.read(where="year = 2024").select(cols)) == sorted([(2024, None, 3), (2024, "x", 9)], key=str)
    t.publish(table_of(spark, [(2025, "n", 8)]))
    assert t.vacuum(keep=1) == 0  # all runs still hold something
    t.publish(table_of(spark, [(2023, "x", 1), (2024, None, 1), (2024, "x", 1), (2025, "n", 1)]))
    assert t.vacuum(keep=1) == 3 and rows(t.read().select("score")) == [(1,)] * 4
    with pytest.raises(ValueError):
        t.read(1)


def test_a_run_that_stops_shows_nothing(spark, tmp_path, monkeypatch):
    t = Table(spark, str(tmp_path / "t"), ["event"])
    old = [("a", 1), ("b", 1)]
    t.publish(table_of(spark, old, "event string, score int"))
    # it stops between two partitions: one of them is written
    t.stage(table_of(spark, [("a", 2)], "event string, score int"), "half")
    assert rows(t.read().select("event", "score")) == old
    # it stops after both are written, before the manifest
    t.stage(table_of(spark, [("a", 3), ("b", 3)], "event string, score int"), "whole")
    assert rows(t.read().select("event", "score")) == old and t.recover() == []
    # it stops between the manifest and its rename: readers see the old version until it is rolled forward
    with monkeypatch.context() as m:
        m.setattr(Table, "_rename", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.commit("whole")
    assert rows(t.read().select("event", "score")) == old
    assert t.recover() == ["rolled forward 2"] and rows(t.read().select("event", "score")) == [("a", 3), ("b", 3)]
    # a manifest that was not finished is left out
    broken = tmp_path / "t" / "manifests" / ".3-half"
    broken.mkdir()
    assert t.recover() == ["left out 3"] and not broken.exists() and t.versions() == [1, 2]
    assert t.vacuum(keep=1) == 2  # the old run and the half one


def test_two_runs_from_one_version_cannot_both_commit(spark, tmp_path, monkeypatch):
    t = Table(spark, str(tmp_path / "t"), ["event"])
    t.publish(table_of(spark, [("a", 1)], "event string, score int"))
    one, two = (t.stage(table_of(spark, [(e, 2)], "event string, score int")) for e in ("b", "c"))
    t._write_manifest(two, 1, None)
    t.commit(one)
    with pytest.raises(Conflict):
        t._rename(2, two)
    assert t.recover() == ["left out 2"] and rows(t.read().select("event")) == [("a",), ("b",)]
    assert t.commit(two) == 3 and rows(t.read().select("event")) == [("a",), ("b",), ("c",)]


def test_runs_with_other_columns_unite(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["event"])
    t.publish(table_of(spark, [(1, 5, "x")], "event int, score int, note string"))
    t.publish(table_of(spark, [(2, 5.5)], "event int, score double"))
    t.publish(table_of(spark, [("three", 7, True)], "event string, score bigint, flag boolean"))
    got = t.read()
    assert dict(got.dtypes) == {"score": "double", "note": "string", "flag": "boolean", "event": "string"}
    assert rows(got.select("event", "score", "note", "flag")) == sorted([("1", 5.0, "x", None), ("2", 5.5, None, None), ("three", 7.0, None, True)], key=str)
    assert rows(t.read(schema="score int").select("event", "score"))[1] == ("2", 5)


def test_partitions_are_chosen_before_files_are_read(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["event"])
    t.publish(spark.range(500).select((F.col("id") % 10).cast("int").alias("event"), "id"))
    plan = t.read(where="event = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(t.read(where="event = 3").agg(F.count("*"), F.min("id"), F.max("id"))) == [(50, 3, 493)]


def test_layer_run_on_a_staged_table(spark, tmp_path):
    out, ledger, bad = (str(tmp_path / n) for n in ("out", "ledger", "bad"))
    schema = "event_id long, fingerprint string, event_year int, value int"

    def run(values, staged):
        src = spark.createDataFrame(values, schema)
        layers.run_layer(spark, "p", src, lambda d: d.select("event_year", "event_id", "value"), [], f"{out}-{staged}", f"{ledger}-{staged}", bad, staged=staged)
        d = Table(spark, f"{out}-{staged}", ["event_year", "event_id"]).read() if staged else spark.read.parquet(f"{out}-{staged}")
        return rows(d.select("event_year", "event_id", "value"))

    for staged in (True, False):
        assert run([(1, "f", 2023, 5), (2, "f", 2023, 6)], staged) == [(2023, 1, 5), (2023, 2, 6)]
        # an event whose year changed leaves nothing behind in its old partition
        assert run([(1, "g", 2024, 7), (2, "f", 2023, 6)], staged) == [(2023, 2, 6), (2024, 1, 7)]


def test_merged_schemas():
    from pyspark.sql import types as T

    a, b = (T.StructType.fromDDL(s) for s in ("x int, y string, n void", "x bigint, z array<int>, n date"))
    assert merged([a, b]).simpleString() == "struct<x:bigint,y:string,n:date,z:array<int>>"
    assert merged([T.StructType.fromDDL("x date"), T.StructType.fromDDL("x int")]).simpleString() == "struct<x:string>"


def test_mixed_files_are_read_as_one(spark, tmp_path):
    top, cat = tmp_path / "holes", str(tmp_path / "cat")

    def put(at, table):
        (top / at).mkdir(parents=True, exist_ok=True)
        pq.write_table(table, top / at / "f.parquet")

    put("event_year=2023/tourn_id=1", pa.table({"hole_number": pa.array([1, 2], pa.int64()), "hole_par": pa.array([3, 4], pa.int64()), "division": ["A", "B"]}))
    put("event_year=2023/tourn_id=2", pa.table({"hole_number": pa.array([1], pa.int32()), "hole_par": pa.nulls(1), "division": ["C"]}))  # all null, and a narrower type
    put("event_year=2024/tourn_id=3", pa.table({"hole_number": pa.array([9], pa.int64()), "extra": [1.5]}))  # columns are missing
    spark.createDataFrame([(4, "D")], "hole_par long, division string").coalesce(1).write.parquet(str(top / "event_year=2024" / "tourn_id=4"))
    assert catalogue.refresh(spark, str(top), cat) == 4 and catalogue.refresh(spark, str(top), cat) == 0
    got = catalogue.hole_inputs(spark, str(top), cat)
    assert len(got.columns) == 37 and dict(got.dtypes)["hole_par"] == "bigint"
    want = [(2023, 1, 1, 3, "A"), (2023, 1, 2, 4, "B"), (2023, 2, 1, None, "C"), (2024, 3, 9, None, None), (2024, 4, None, 4, "D")]
    assert rows(got.select("event_year", "tourn_id", "hole_number", "hole_par", "division")) == sorted(want, key=str)
    pruned = got.where("event_year = 2024 and tourn_id = 4")
    assert "tourn_id" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert pruned.select(F.input_file_name()).distinct().count() == 1
    put("event_year=2025/tourn_id=5", pa.table({"hole_number": pa.array([7], pa.int64())}))
    (top / "event_year=2023" / "tourn_id=1" / "f.parquet").unlink()
    assert catalogue.refresh(spark, str(top), cat) == 1
    every = catalogue.read_as(spark, str(top), None, cat)
    assert set(every.columns) == {"hole_number", "hole_par", "division", "extra"} and every.count() == 4
    assert catalogue.read_as(spark, str(top / "event_year=2025"), "hole_number int", str(tmp_path / "none")).count() == 0


ODD = ["a b/c", "x=1", "100%", "é", "q?", "[z]", "it's", '"', "back\\slash", "", None, "tab\there", "a:b", "^{}", "plain"]


def test_partition_folders_are_named_as_spark_names_them(spark, tmp_path):
    d = spark.createDataFrame([(2024, v, i) for i, v in enumerate(ODD)], "event_year int, tourn_id string, score int")
    path = tmp_path / "t"
    files.write_partitions(d, str(path))
    there = {str(p.parent.relative_to(path)) for p in path.rglob("*.parquet")}
    assert {r[0] for r in d.select(files.partition_folder(["event_year", "tourn_id"])).collect()} == there
    kept = d.where("score % 2 = 0")
    assert files.drop_stale_partitions(spark, str(path), d, children=kept) == len({v or None for v in ODD[1::2]} - {v or None for v in ODD[::2]})
    left = {str(p.parent.relative_to(path)) for p in path.rglob("*.parquet")}
    assert left == {r[0] for r in kept.select(files.partition_folder(["event_year", "tourn_id"])).collect()}


def test_many_stale_partitions(spark, tmp_path):
    for i in range(2000):
        (tmp_path / "t" / f"k={i}").mkdir(parents=True)
    assert files.drop_stale_partitions(spark, str(tmp_path / "t"), spark.range(2100).withColumnRenamed("id", "k"), ["k"], spark.range(5).withColumnRenamed("id", "k")) == 1995
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == [f"k={i}" for i in range(5)]


def test_registered_partitions_are_quoted(spark, tmp_path):
    spark.createDataFrame([(1, "it's")], "v int, k string").write.mode("overwrite").partitionBy("k").saveAsTable("quoted_parts")
    files.register_partition(spark, "quoted_parts", {"k": "o'clock\\"}, str(tmp_path / "it's here"))
    assert any("k=o%27clock%5C" == r[0] for r in spark.sql("SHOW PARTITIONS quoted_parts").collect())


def test_request_fingerprints():
    a = files.request_fingerprint("d", {"model": "m", "depth": 6}, [3, 1])
    assert a == files.request_fingerprint("d", {"depth": 6, "model": "m"}, [1, 3]) and len(a) == 64
    assert len({a, files.request_fingerprint("e", {"model": "m", "depth": 6}, [1, 3]), files.request_fingerprint("d", {"model": "m", "depth": 7}, [1, 3]), files.request_fingerprint("d", {"model": "m", "depth": 6})}) == 4


def test_newest_wins_over_many_batches(spark, tmp_path):
    rng = random.Random(6)
    schema = "k long, day string, n long, note string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    best: dict = {}
    for batch in range(3):
        new = [(rng.randint(0, 30), rng.choice(["a", "b", "c/d", None]), rng.randint(0, 40), f"{batch}-{i}") for i in range(25)]
        new = list({(k, n): (k, d, n, x) for k, d, n, x in new if (k, n) not in {(b[0], b[2]) for b in best.values()}}.values())
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.newest_wins(incremental.new_files(spark, source, schema), out, ["k"], ["n"], "day", state).awaitTermination()
        for r in new:
            if r[0] not in best or best[r[0]][2] < r[2]:
                best[r[0]] = r
        assert rows(spark.read.parquet(out).select("k", "day", "n", "note")) == sorted(best.values(), key=str)


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    schema = "k long, day string, n long"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run(batch):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")} if (tmp_path / "out").exists() else {}
        incremental.newest_wins(incremental.new_files(spark, source, schema), out, ["k"], ["n"], "day", state).awaitTermination()
        now = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
        return {p.parent.name for p in set(before) ^ set(now)} | {p.parent.name for p in set(before) & set(now) if before[p] != now[p]}

    run([(i, f"d{i % 8}", 1) for i in range(80)])
    assert run([(3, "d3", 0), (11, "d3", 1)]) == set()  # old news and a repeat
    assert run([(3, "d3", 2)]) == {"day=d3"}
    assert run([(3, "d5", 3)]) == {"day=d3", "day=d5"}  # the key moves
    changed = spark.createDataFrame([(3, "d5", 4, [("d5",)])], f"{schema}, __been array<struct<p:string>>")
    plan = incremental._old_rows(spark, out, changed, "day")
    assert plan.select(F.input_file_name().alias("f")).distinct().where("f not like '%day=d5%'").count() == 0
    assert "day" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_a_partition_that_all_keys_leave_goes(spark, tmp_path):
    schema = "k long, day string, n long"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in ([(1, "a", 1), (2, "b", 1)], [(1, "b", 2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.newest_wins(incremental.new_files(spark, source, schema), out, ["k"], ["n"], "day", state).awaitTermination()
    assert rows(spark.read.parquet(out).select("k", "day")) == [(1, "b"), (2, "b")] and not (tmp_path / "out" / "day=a").exists()


def test_streams_that_are_run_now(spark, tmp_path):
    e = spark.range(100).select((F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id") % 5)).cast("timestamp").alias("ts"), F.col("id").cast("double").alias("v"))
    e.write.parquet(str(tmp_path / "e"))
    stream = incremental.new_files(spark, str(tmp_path / "e"), e.schema)
    got = incremental.run_now(incremental.hourly(stream, "ts", "v", None), str(tmp_path / "o"), "complete")
    assert [r["n"] for r in got.collect()] == [20] * 5
    assert incremental.run_now(stream, str(tmp_path / "o2")).count() == 100
