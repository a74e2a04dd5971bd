"""Normalised snapshots, files, streams and models."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from windrose.operators import model as M
from windrose.operators import normalize as N
from windrose.plans.adapter import Tables
from windrose.sources import files
from windrose.streaming import incremental


def snapshot(**score):
    base = {"Name": "Ann Lee", "Division": "MPO", "Round": "1", "LayoutID": 7, "ResultID": "211819644", "HoleScores": ["3", "4", "", ""], "Holes": "3", "Rating": "950", "Completed": "1"}
    layout = {"LayoutID": "7", "CourseID": "70", "CourseName": "Park", "Name": "Long", "Par": "9", "Length": "900", "Detail": [{"Ordinal": "1", "Par": "3", "Length": "300", "Label": "1"}, {"Ordinal": "2", "Par": "3", "Length": "330"}]}
    return json.dumps({"data": {"scores": [base | score], "layouts": [layout], "holes": []}})


@pytest.fixture
def events(spark):
    return spark.createDataFrame([(5, "Open", "Final", "2024-05-03", "2024-05-05", "Austin", "TX", "US", {"MPO": 3})], "event_id long, name string, status_text string, start_date string, end_date string, city string, state string, country string, division_rounds map<string,int>")


def rounds_of(spark, events, *payloads):
    df = spark.createDataFrame([(5, "FPO", 1, p, "k", "2024-05-04T00:00:00Z") for p in payloads], "event_id long, division string, round_number int, payload string, source_key string, fetched_at string")
    return N.normalize_rounds(df, events)


def test_normalize_scores(spark, events):
    rounds = rounds_of(spark, events, snapshot(), snapshot(Round="2", TeeTime="9:30 AM", PDGANum="12"), "no json", json.dumps({"data": {"scores": None}}), json.dumps({"data": {"scores": [None]}}))
    got = {r["round_number"]: r for r in rounds.collect()}
    assert len(got) == 2 and got[1]["player_key"] == "RESULT#211819644" and got[2]["player_key"] == "PDGA#12"
    assert (got[1]["event_year"], got[1]["player_rating"], got[1]["course_name"], got[1]["completed_flag"], got[1]["layout_holes"]) == (2024, 950, "Park", True, 3)
    assert got[1]["tee_time_est_method"] == "missing_inputs" and got[1]["tee_time_join_method"] == "round_date_interp_noon_fallback"
    assert got[2]["round_date"] == dt.date(2024, 5, 4) and got[2]["tee_time_join_ts"] == dt.datetime(2024, 5, 4, 9, 30)
    holes = {(r["round_number"], r["hole_number"]): r for r in N.normalize_holes(rounds).collect()}
    assert set(holes) == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert (holes[1, 2]["hole_to_par"], holes[1, 2]["hole_length"], holes[1, 1]["hole_start_est_ts"], holes[1, 1]["played_holes"]) == (1, 330, None, 2)
    assert holes[2, 1]["hole_start_est_ts"] == dt.datetime(2024, 5, 4, 9, 30) and holes[2, 2]["hole_end_est_ts"] == dt.datetime(2024, 5, 4, 13, 30)


def test_scores_as_text_and_round_zero(spark, events):
    r = rounds_of(spark, events, snapshot(HoleScores=[], Scores="3, x,5,6,7", Round="0")).first()
    assert r["round_number"] == 1 and r["hole_scores"] == [3, None, 5]


def test_normalize_weather(spark):
    hourly = {"time": ["2024-05-03T08:00", "2024-05-03T09:00", "bad"], "wind_speed_10m": [3.5], "temperature_2m": [20, None, 1]}
    df = spark.createDataFrame([(5, 1, "p", "GRID#1", json.dumps({"latitude": 1.5, "longitude": 2, "hourly": hourly})), (6, 1, "p", "s", "[]")], "event_id long, round_number int, provider string, source_id string, payload string")
    rows = sorted(N.normalize_weather(df).collect(), key=lambda r: r["observation_hour"])
    assert [(r["wind_speed_mps"], r["temperature_c"]) for r in rows] == [(3.5, 20.0), (None, None)]
    assert len({r["weather_obs_pk"] for r in rows}) == 2


def test_text_extraction(spark):
    texts = ["03-May-2024 to 05-May-2024", "30-Dec to 02-Jan-2025", "03-May – 05-May-2024", "03-May-2024", "05-May-2024 to 03-May-2024", "soon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(map(str, r["d"])) for r in df.orderBy("i").select(N.parse_date_range("t").alias("d")).collect()]
    assert got == [("2024-05-03", "2024-05-05"), ("2024-12-30", "2025-01-02"), ("2024-05-03", "2024-05-05"), ("2024-05-03", "2024-05-03"), ("None", "None"), ("None", "None"), ("None", "None")]
    places = spark.createDataFrame([(0, "Austin, TX, United States"), (1, "Austin, TX"), (2, "Paris, France"), (3, "Paris"), (4, "")], "i int, t string")
    assert [tuple(r["l"]) for r in places.orderBy("i").select(N.split_location("t").alias("l")).collect()] == [("Austin", "TX", "United States"), ("Austin", "TX", ""), ("Paris", "", "France"), ("Paris", "", ""), ("", "", "")]


def test_best_place(spark):
    rows = [("q", "Austin", "Texas", "United States", "US", 900_000, "Austin", "Texas", "United States"), ("q", "Austin", "Minnesota", "United States", "US", 25_000, "Austin", "Texas", "United States")]
    df = spark.createDataFrame(rows, "query_id string, name string, admin1 string, country string, country_code string, population long, wanted_city string, wanted_state string, wanted_country string")
    assert N.best_candidates(df).first()["admin1"] == "Texas"


def test_files(spark, tmp_path):
    folder = tmp_path / "raw" / "event_id=5" / "division=MPO" / "round=1"
    folder.mkdir(parents=True)
    for ts in ("1", "2"):
        (folder / f"fetch_ts={ts}").mkdir()
        (folder / f"fetch_ts={ts}" / "p.json").write_text('{"a": %s}' % ts)
    (folder / "fetch_ts=2" / "p.meta.json").write_text('{"content_sha256": "abc", "fetched_at_utc": "t"}')
    raw = str(tmp_path / "raw")
    latest = files.with_sidecar(files.latest_snapshots(files.read_snapshots(spark, raw)), files.read_sidecars(spark, raw)).collect()
    assert [(r["event_id"], r["round_number"], r["payload"], r["content_sha256"], r["fetched_at"]) for r in latest] == [(5, 1, '{"a": 2}', "abc", "t")]
    out = str(tmp_path / "table")
    rows = lambda *x: spark.createDataFrame(list(x), "event_year int, tourn_id int, v string")
    files.write_partitions(rows((2024, 1, "a"), (2024, 2, "b")), out)
    files.write_partitions(rows((2024, 2, "c")), out)
    assert sorted((r["tourn_id"], r["v"]) for r in files.read_events(spark, out).collect()) == [(1, "a"), (2, "c")]
    pruned = files.read_events(spark, out, [2])
    assert "PartitionFilters: [isnotnull(tourn_id" in pruned._jdf.queryExecution().executedPlan().toString() and pruned.count() == 1
    (tmp_path / "ids.txt").write_text("1, 2\nx,3\n2")
    assert sorted(r["id"] for r in files.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == [1, 2, 3]
    files.publish(rows((1, 1, "p")), "published_rounds", str(tmp_path / "pub"))
    assert spark.table("published_rounds").count() == files.read_published(spark, str(tmp_path / "pub")).count() == 1
    files.write_quarantine(rows((1, 1, "bad")), str(tmp_path / "q"), "run1")
    assert spark.read.json(str(tmp_path / "q")).first()["run_id"] == "run1"


def test_streams(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, day string, n int"
    for batch in ([(1, "a", 1), (2, "b", 5)], [(1, "a", 3), (2, "b", 4)], []):
        if batch:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        incremental.newest_wins(incremental.new_files(spark, source, schema), out, ["k"], ["n"], "day", str(tmp_path / "c1")).awaitTermination()
    assert sorted((r["k"], r["n"]) for r in spark.read.parquet(out).collect()) == [(1, 3), (2, 5)]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "value", F.col("event_id").cast("string").alias("h"))
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "events"))
    stream = incremental.new_files(spark, str(tmp_path / "events"), "ts timestamp_ntz, value double, event_id long").select(F.col("ts").cast("timestamp").alias("ts"), "value", F.col("event_id").cast("string").alias("h"))
    q = incremental.hourly(incremental.drop_repeats(stream, "h", "ts"), "ts", "value", None).writeStream.format("memory").queryName("hours").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["hour"]: r["n"] for r in spark.table("hours").collect()}
    want = {r["hour"]: r["n"] for r in events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n")).collect()}
    assert got and all(want[h] == n for h, n in got.items())


def test_models(spark, tmp_path):
    rounds = Tables(spark, "/root/testdata/sf0.01").rounds.dropna(subset=M.NUMERIC).persist()
    model, metrics = M.train_rounds(rounds, trees=8, depth=3)
    assert {r["split"]: r["r2"] > 0.5 for r in metrics.collect()} == {"train": True, "valid": True, "test": True}
    assert M.importances(model, spark).count() == len(M.NUMERIC) + 1
    scored = M.score_rounds(rounds, model)
    assert scored.columns[: len(rounds.columns)] == rounds.columns
    r = scored.agg(F.max(F.abs(F.col("predicted") - F.col("predicted_total_reference") - F.col("total_impact"))).alias("gap"), F.count("*").alias("n")).first()
    assert r["gap"] < 1e-9 and r["n"] == rounds.count()
    M.save_bundle(spark, model, {"version": "v1"}, str(tmp_path / "bundle"))
    again, manifest = M.load_bundle(spark, str(tmp_path / "bundle"))
    assert manifest == {"version": "v1"} and M.score_rounds(rounds, again, {}).agg(F.sum("predicted")).first()[0] == pytest.approx(scored.agg(F.sum("predicted")).first()[0])
    assert M.linear_benchmark(rounds).count() == 2
    assert M.two_stage(rounds).select("predicted").count() == rounds.count()
