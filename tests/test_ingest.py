"""Places, responses, snapshots, the incremental run of a layer, and models beyond the registered queries."""

import datetime as dt
import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from windrose.operators import ingest, layers, model, quality
from windrose.sources import files


@pytest.fixture(scope="module", autouse=True)
def folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_geopoint_takes_the_first_valid_pair(spark):
    for i, (lat, lon) in enumerate(ingest.POINT_KEYS):
        d = spark.createDataFrame([("91", "0", "1.5", "2.5"), ("-90", "180", "1", "1"), ("x", "", "0", "181"), (None, "1", "0", "0")], f"a string, b string, `{lat}` string, `{lon}` string")
        got = [tuple(r["p"]) if r["p"] else None for r in d.select(ingest.geopoint(d, [("a", "b"), (lat, lon)]).alias("p")).collect()]
        assert got == [(1.5, 2.5), (-90.0, 180.0), None, (0.0, 0.0)], i
    d = spark.createDataFrame([("95", "1", "2", "3")], "latitude string, longitude string, course_lat string, course_lon string")
    assert tuple(d.select(ingest.geopoint(d).alias("p")).first()["p"]) == (2.0, 3.0)
    d = spark.range(1)
    assert d.select(ingest.geopoint(d).alias("p")).first()["p"] is None


@pytest.mark.parametrize("kind", ["struct<lat:string,lon:string>", "struct<latitude:double,longitude:double,lat:double,lon:double>", "map<string,string>", "struct<x:int>"])
def test_nested_locations(spark, kind):
    values = {"struct<lat:string,lon:string>": ("4", "5"), "struct<latitude:double,longitude:double,lat:double,lon:double>": (None, 0.0, 4.0, 5.0), "map<string,string>": {"latitude": "", "lat": "4", "lon": "5"}, "struct<x:int>": (1,)}
    d = spark.createDataFrame([(values[kind],), (None,)], f"location {kind}")
    got = [tuple(r["p"]) if r["p"] else None for r in d.select(ingest.geopoint(d).alias("p")).collect()]
    assert got == [None if "x:int" in kind else (4.0, 5.0), None]


def test_countries_and_canonical_fingerprints(spark):
    import hashlib

    names = [*ingest.COUNTRY_CODES, "UK", " fr ", "Finland", "", None, "U.S.", "New  Zealand"]
    want = [*("UK" if n == "uk" else c for n, c in ingest.COUNTRY_CODES.items()), "UK", "FR", None, None, None, "US", "NZ"]
    d = spark.createDataFrame([(n, "A|b", "é", "") for n in names], "country string, city string, state string, location_raw string")
    got = ingest.geocode_query(d).collect()
    assert [r["query_code"] for r in got] == want
    said = lambda n: json.dumps({"city": "a|b", "state": "é", "country": " ".join((n or "").split()).lower(), "location_raw": ""}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert [r["fingerprint"] for r in got] == [hashlib.sha256(said(n).encode()).hexdigest() for n in names]
    old = spark.createDataFrame([("", "", "", "", " old  place")], "country string, city string, state string, location_raw string, raw_location string")
    assert ingest.geocode_query(old).first()["query_text"] == "old place"


def test_weather_requests(spark):
    import hashlib

    d = spark.createDataFrame([(1.25, -3.0, dt.date(2024, 5, 3), dt.date(2024, 5, 5))], "latitude double, longitude double, from_date date, to_date date")
    r = ingest.weather_request(d).first()
    params = {"latitude": "1.25000", "longitude": "-3.00000", "start_date": "2024-05-03", "end_date": "2024-05-05", **ingest.ARCHIVE_PARAMETERS}
    assert r["request_params"] == params
    said = json.dumps({"url": ingest.ARCHIVE_URL, "params": params}, sort_keys=True, separators=(",", ":"))
    assert r["request_fingerprint"] == hashlib.sha256(said.encode()).hexdigest()


def test_backfill_looks_at_the_raw_text(spark):
    events = spark.createDataFrame([(1, "Rome, IT", "Rome", None), (2, "a", "a", ""), (3, "a", "a", ""), (4, "x", "b", "")], "event_id long, location_raw string, city string, country string")
    parsed = spark.createDataFrame([(1, "Rome,  IT", "Rome", "", ""), (2, "a", "a", "", ""), (4, "", "c", "", "")], "event_id long, location_raw string, city string, state string, country string")
    got = {r["event_id"]: tuple(r)[1:] for r in ingest.backfill_locations(events, parsed).collect()}
    assert got == {1: ("Rome,  IT", "Rome", "", "", "updated"), 2: ("a", "a", "", "", "unchanged"), 3: ("a", "a", "", "", "missing_page"), 4: ("x", "b", "", "", "missing_location")}


def test_geocode_candidates_go_from_specific_to_broad(spark):
    rows = [(" New   York ", "NY", "United States", ""), ("", "", "", " some  place "), ("", "", "", None), ("Oslo", "", "no", "")]
    d = ingest.geocode_query(spark.createDataFrame(rows, "city string, state string, country string, location_raw string")).collect()
    assert d[0]["query_text"] == "New York, NY, United States" and d[0]["query_code"] == "US"
    assert [tuple(c) for c in d[0]["candidates"]] == [("New York, NY", "US"), ("New York, NY", None), ("New York", "US"), ("New York", None), ("New York, NY, United States", "US"), ("New York, NY, United States", None)]
    assert d[1]["query_text"] == "some place" and [tuple(c) for c in d[1]["candidates"]] == [("some place", None)]
    assert d[2]["query_text"] is None and d[2]["candidates"] == [] and d[3]["query_code"] == "NO"


def test_response_classes(spark):
    rows = [("e", 200, '{"a":1}', "failed"), (None, 404, None, "not_found"), (None, 500, "{}", "failed"), (None, None, "{}", "failed"), (None, 200, None, "empty"), (None, 200, " [ ] ", "empty"), (None, 200, '{"cards":[],"x":1}', "empty"), (None, 200, '{"cards":[1]}', "success")]
    d = spark.createDataFrame(rows, "error string, status int, payload string, want string")
    assert all(r["got"] == r["want"] for r in d.withColumn("got", ingest.classify_response("error", "status", "payload")).collect())


def test_fetch_tasks_without_a_known_number_of_rounds(spark):
    day = dt.date
    events = spark.createDataFrame([(1, day(2024, 5, 3), day(2024, 5, 5), 0), (2, None, None, None)], "event_id long, start_date date, end_date date, max_round int")
    rounds = spark.createDataFrame([(1, 2, day(2024, 5, 4)), (1, 2, day(2024, 5, 4)), (1, 2, day(2024, 5, 9)), (1, 3, None)], "event_id long, round_number int, play_date date")
    got = {r["round_number"]: (r["round_date"], r["date_source"]) for r in ingest.fetch_tasks(events, rounds).collect()}
    assert got == {1: (day(2024, 5, 3), "inferred"), 2: (day(2024, 5, 4), "played"), 3: (day(2024, 5, 5), "inferred")}


def test_weather_snapshot_keys(spark, tmp_path):
    base = tmp_path / "event_id=7"
    for name, payload in {"round=1/provider=p/source=s/a.json": '{"x":1}', "round=2/provider=/source=t/b.json": "[1]", "round=3/c.json": "{}", "WEATHER_OBS%23ROUND%234%23PROV%23q%23SRC%23u%23v.json": "{}"}.items():
        (base / name).parent.mkdir(parents=True, exist_ok=True)
        (base / name).write_text(payload)
    got = {r["round_number"]: (r["provider"], r["source_id"], r["payload"]) for r in files.read_weather_snapshots(spark, str(tmp_path)).collect()}
    assert got[1] == ("p", "s", '{"x":1}') and got[2] == ("open_meteo_archive", "t", '{"raw_payload":[1]}') and 3 not in got
    assert got[4][:2] == ("q", "u#v")


def test_snapshots_are_written_once_for_each_fetch(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 5, 3, 4, 5, 6), "<html>"), (1, dt.datetime(2024, 5, 4, 4, 5, 6), "<p>"), (2, dt.datetime(2024, 5, 3, 4, 5, 6), "")]
    d = spark.createDataFrame(rows, "event_id long, fetched_at timestamp, payload string")
    files.write_snapshots(d, str(tmp_path), "html")
    found = sorted((tmp_path / "html").rglob("*.gz"))
    assert [p.parent.name for p in found] == ["fetch_ts=20240503T040506Z", "fetch_ts=20240504T040506Z", "fetch_ts=20240503T040506Z"]
    assert gzip.decompress(found[0].read_bytes()).decode().strip() == "<html>"
    meta = [json.loads(x) for p in (tmp_path / "meta").rglob("*.json") for x in p.read_text().splitlines()]
    assert len(meta) == 3 and all(len(m["content_sha256"]) == 64 for m in meta)


def test_stale_and_registered_partitions(spark, tmp_path):
    holes = spark.createDataFrame([(2024, 1, 5), (2024, 2, 6), (2023, 3, 7)], "event_year int, tourn_id int, score int")
    path = str(tmp_path / "holes")
    files.write_partitions(holes, path)
    rounds = holes.select("event_year", "tourn_id")
    assert files.drop_stale_partitions(spark, path, rounds, children=holes.where("tourn_id != 2")) == 1
    assert sorted(r[0] for r in spark.read.parquet(path).select("tourn_id").collect()) == [1, 3]
    spark.sql("CREATE TABLE IF NOT EXISTS holes_by_event (score int, event_year int, tourn_id int) USING parquet PARTITIONED BY (event_year, tourn_id)")
    for _ in range(2):
        files.register_partition(spark, "holes_by_event", {"event_year": 2024, "tourn_id": 1}, f"{path}/event_year=2024/tourn_id=1")
    assert [tuple(r) for r in spark.table("holes_by_event").collect()] == [(5, 2024, 1)]
    spark.sql("DROP TABLE holes_by_event")


def test_dataset_fingerprint(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "d"))
    listed = files.list_files(spark, str(tmp_path / "d"))
    one = files.dataset_fingerprint(listed).first()[0]
    assert one == files.dataset_fingerprint(listed.union(listed).orderBy(F.rand())).first()[0]
    Path(sorted((tmp_path / "d").glob("*.parquet"))[0]).unlink()
    assert files.dataset_fingerprint(files.list_files(spark, str(tmp_path / "d"))).first()[0] != one
    assert len(files.dataset_fingerprint(listed.limit(0)).first()[0]) == 64


def test_layer_run(spark, tmp_path):
    out, ledger, quarantine = (str(tmp_path / x) for x in ("out", "ledger", "bad"))

    def source(*rows):
        return spark.createDataFrame(rows, "event_id long, fingerprint string, value int")

    def run(src, **options):
        def transform(d):
            return d.where("value is not null").select(F.lit(2024).alias("event_year"), "event_id", "value")

        rules = [lambda d: quality.rule_range(d, "event_id", "value", 0, 100, "value")]
        got = layers.run_layer(spark, "silver", src, transform, rules, out, ledger, quarantine, **options)
        return {r["event_id"]: r["status"] for r in got.collect()}

    first = source((1, "a", 5), (1, "a", 6), (2, "b", 500), (3, "c", None))
    assert run(first, dry_run=True) == dict.fromkeys((1, 2, 3), "planned") and not Path(out).exists()
    assert run(first) == {1: "success", 2: "dq_failed", 3: "failed"}
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == [5, 6]
    assert [r["group"] for r in spark.read.json(quarantine).collect()] == [2]
    # what succeeded is not run again; failures are, quarantined ones only if asked
    assert run(first) == {3: "failed"}
    assert run(first, retry_failed=False, retry_quarantined=True) == {2: "dq_failed"}
    # a changed event replaces its own partition only
    assert run(source((1, "new", 7), (2, "b", 50), (4, "d", 1)), retry_quarantined=True) == {1: "success", 2: "success", 4: "success"}
    assert sorted((r["event_id"], r["value"]) for r in spark.read.parquet(out).collect()) == [(1, 7), (2, 50), (4, 1)]
    assert run(source((1, "new", 7)), force=True) == {1: "success"}
    assert run(source((1, "new", 7))) == {}
    s = layers.summary(spark.createDataFrame([(1, "success"), (2, "failed"), (3, "dq_failed")], "event_id long, status string")).first()
    assert (s["events"], s["ok"], s["failed"], s["quarantined"], s["exceeds"]) == (3, 1, 1, 1, True)


@pytest.fixture(scope="module")
def rounds(spark):
    i = F.col("id")
    d = spark.range(600).select(
        (i % 30).alias("tourn_id"), (850 + i % 200).cast("double").alias("player_rating"), F.lit(18.0).alias("hole_count"), (5000 + i % 700).cast("double").alias("round_total_hole_length"), F.lit(54.0).alias("round_total_par"),
        (i % 11).cast("double").alias("wind_mean"), (i % 11 + i % 3).cast("double").alias("gust_mean"), (i % 25).cast("double").alias("temp_mean"), (i % 2).cast("double").alias("precip_sum"), F.concat(F.lit("D"), (i % 3).cast("string")).alias("division"),
    )
    return d.withColumn("actual_round_strokes", 54 + F.col("wind_mean") * 0.5 - (F.col("player_rating") - 900) / 25 + F.sin("player_rating")).cache()


def test_monotone_scores_and_curves(spark, rounds):
    m, metrics = model.train_rounds(rounds, trees=5)
    grid = [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]
    same = rounds.limit(1).drop("wind_mean").crossJoin(spark.createDataFrame([(x,) for x in grid], "wind_mean double"))
    got = [r["p"] for r in model.score_monotone(same, m, "wind_mean", "p", ["wind_mean"]).orderBy("wind_mean").collect()]
    assert got == sorted(got) and len(got) == len(grid)
    curve = spark.createDataFrame([(0.0, 1.0, 5), (1.0, 3.0, 1), (2.0, 2.0, 3), (3.0, 4.0, 1)], "x double, y double, n int")
    assert [round(r["m"], 6) for r in model.monotone_curve(curve, "x", "y", "n", "m").orderBy("x").collect()] == [1.0, 2.25, 2.25, 4.0]
    compared = model.compare_models({"trees": metrics, "linear": model.linear_benchmark(rounds)})
    assert set(compared.columns) >= {"model", "train_rmse", "test_rmse", "test_r2"} and compared.count() == 2
    best = model.ideal_conditions(rounds, m, {"wind_mean": [0, 5, 10], "temp_mean": [5, 15]}).first()
    assert best["wind_mean"] == 0.0 and best["wind_mean_on_edge"] and best["n"] == 600


def test_spline_ridge_fits_a_bend(rounds):
    bent = rounds.withColumn("actual_round_strokes", F.pow(F.col("wind_mean") - 5, 2) + F.col("player_rating") / 100)
    _, metrics, alpha, scores = model.spline_ridge(bent, ["wind_mean", "temp_mean"], ["player_rating"], "actual_round_strokes", "tourn_id", alphas=(0.001, 1.0), folds=3)
    assert scores.count() == 6 and alpha == 0.001 and {r["split"]: r["r2"] for r in metrics.collect()}["test"] > 0.98


def test_cross_validation_keeps_events_on_one_side(spark):
    """Each event has a level of its own that a dummy for it would learn; folds of whole events give that no credit."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    d = spark.range(400).select((F.col("id") % 20).alias("event"), F.rand(1).alias("x")).withColumn("label", 10 * F.sin(F.col("event") * 7) + F.col("x")).withColumn("e", F.col("event").cast("int"))
    stages = [OneHotEncoder(inputCol="e", outputCol="o", handleInvalid="keep"), VectorAssembler(inputCols=["o", "x"], outputCol="features")]
    grid = [{"regParam": 0.0}, {"regParam": 100.0}]
    best, scores = model.cross_validated(d, stages, LinearRegression(elasticNetParam=0.0), grid, "event", folds=4)
    rows = scores.collect()
    assert len(rows) == 8 and sum(r["rows"] for r in rows) == 800
    # unseen events are not predicted by their own level, so no fold looks good
    assert min(r["rmse"] for r in rows) > 3
    by_fold = d.withColumn("f", model.fold_of("event", 4)).groupBy("event").agg(F.countDistinct("f").alias("n")).collect()
    assert all(r["n"] == 1 for r in by_fold)
    with pytest.raises(ValueError):
        model.cross_validated(d.where("event = 1"), stages, LinearRegression(), grid, "event")
