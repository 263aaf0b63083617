import datetime as dt
import json
import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sensorspark.operators import evaluate, models
from sensorspark.plans import flows, reports, run_store

CONFIG = models.ForecastConfig(
    granularity="hourly", lags=(1, 24), windows=(3, 24), min_date=None, train_end="2024-01-15 00:00:00",
    validation_end="2024-01-18 00:00:00", families=("random_forest", "lightgbm", "random_forest"),
    forest={"numTrees": 8, "maxDepth": 6}, boosted={"maxIter": 8, "maxDepth": 3, "stepSize": 0.3, "minInstancesPerNode": 3})


@pytest.fixture(scope="module")
def series(spark):
    """Daily cycles that a lag can learn, with some gaps."""
    rows = []
    for region, level in (("AIIMS", 40.0), ("SILTARA", 90.0)):
        for i in range(24 * 20):
            if i % 53 == 7:
                continue
            wave = level + 30 * math.sin(2 * math.pi * i / 24)
            rows.append((region, "hourly", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), wave, 2 * wave + 5,
                         None if i % 31 == 3 else wave / 4, 20 + i % 24 / 2, float(i * 15 % 360), {"radiation": float(i % 24)}))
    return spark.createDataFrame(rows, "region string, granularity string, date_time timestamp_ntz, pm2_5 double, "
                                       "pm10 double, so2 double, temp double, wd double, extra map<string,double>")


@pytest.fixture(scope="module")
def run(series):
    return flows.train(series, CONFIG)


def test_candidates_beat_the_median(run):
    board = {r["strategy"]: r["mean_rmse"] for r in run.comparison.collect()}
    assert set(board) == {"baseline_median", "multi_output_random_forest", "single_target_random_forest",
                          "multi_output_lightgbm", "single_target_lightgbm"}
    assert all(board[s] < board["baseline_median"] / 2 for s in board if s != "baseline_median")


def test_joint_and_single_forests_differ(run):
    """A forest learns the targets together in one scope and alone in the other; boosted families do not."""
    rows = {(r["strategy"], r["split"], r["target"]): r["rmse"] for r in evaluate.overall(run.metrics).collect()}
    for target in ("pm2_5", "pm10", "so2"):
        assert rows["multi_output_random_forest", "test", target] != rows["single_target_random_forest", "test", target]
        assert rows["multi_output_lightgbm", "test", target] == rows["single_target_lightgbm", "test", target]
    assert set(run.bundle.joint) == {"random_forest"} and run.bundle.metadata["jointly_fitted"] == ["random_forest"]
    inputs = len(run.bundle.inputs())
    assert run.bundle.joint["random_forest"].numFeatures == inputs + 3
    assert run.bundle.models["random_forest"]["so2"].numFeatures == inputs


def test_targets_are_scaled_for_the_joint_fit(run):
    for middle, spread in run.bundle.scales.values():
        assert spread > 0 and math.isfinite(middle)


def test_store_trains_once(spark, series, tmp_path, monkeypatch):
    fits = []
    real = models.estimator
    monkeypatch.setattr(models, "estimator", lambda family, config: fits.append(family) or real(family, config))
    place = str(tmp_path / "store")
    small = models.ForecastConfig(**{**CONFIG.__dict__, "families": ("random_forest",), "forest": {"numTrees": 3, "maxDepth": 3}})
    first = run_store.trained(series, small, place)
    again = run_store.trained(series.repartition(3), small, place)  # the same rows in other files
    assert fits == ["random_forest"] and first.bundle.metadata == again.bundle.metadata
    shape = lambda df: sorted(map(str, df.collect()))
    for name in run_store.TABLES:
        assert shape(getattr(first, name)) == shape(getattr(again, name))
    both = models.ForecastConfig(**{**small.__dict__, "families": ("random_forest", "lightgbm"), "boosted": CONFIG.boosted})
    told = run_store.trained(series, both, place)
    assert fits == ["random_forest", "lightgbm"], "a family is shared by runs with other families"
    run_store.trained(series, models.ForecastConfig(**{**small.__dict__, "forest": {"numTrees": 2, "maxDepth": 3}}), place)
    assert fits == ["random_forest", "lightgbm", "random_forest"], "learner options are part of the name"
    assert told.bundle.metadata["learner_options"]["random_forest"]["numTrees"] == 3
    assert told.bundle.metadata["dataset"]["rows"] == series.count() and told.bundle.metadata["trained_at"].endswith("+00:00")
    changed = series.where("region <> 'AIIMS'")
    assert run_store.dataset_fingerprint(changed) != run_store.dataset_fingerprint(series)
    assert run_store.run_name(small, {"rows": 1}) != run_store.run_name(both, {"rows": 1})
    request = requests_table(spark)
    assert flows.score(told.bundle, request, "multi_output_random_forest").count() == 2


def test_half_written_runs_are_not_seen(spark, tmp_path):
    def fail(path):
        spark.range(1).write.parquet(f"{path}/part")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        run_store._publish(spark, str(tmp_path / "a"), fail)
    assert not (tmp_path / "a").exists()
    run_store._publish(spark, str(tmp_path / "a"), lambda d: spark.range(1).write.parquet(d))
    run_store._publish(spark, str(tmp_path / "a"), lambda d: spark.range(9).write.parquet(d))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1 and len(list(tmp_path.iterdir())) == 1 + 1


def test_run_tables(spark, run):
    totals = run.bundle.metadata["split_counts"]
    assert totals["train"] > totals["validation"] > 0 and totals["test"] > 0
    regional = evaluate.regional(run.metrics)
    assert regional.count() == 5 * 2 * 3 * 2
    assert run.bundle.best.count() == 6 and {r["split"] for r in run.bundle.best.collect()} == {"validation"}
    assert run.bundle.metadata["best_multi_output_strategy"].startswith("multi_output_")
    assert set(run.bundle.metadata["best_single_target_strategy_by_target"]) == {"pm2_5", "pm10", "so2"}
    names = run.bundle.features
    assert {"radiation", "pm2_5_lag_24", "so2_roll_std_3", "wd_sin", "region_AIIMS", "week_of_year"} <= set(names)
    assert not {"observed_row", "observed_future", "target_pm10", "split"} & set(names)
    report = reports.long_report(models.config_row(spark, CONFIG), run.coverage, run.split_counts, run.metrics, run.bundle.best)
    assert {r["section"] for r in report.select("section").distinct().collect()} == {
        "configuration", "coverage", "split", "split_by_region", "test_metrics", "best_by_target", "best_by_region_target"}
    compact = reports.compact_report(evaluate.overall(run.metrics)).first()
    assert compact["targets"] == ["pm10", "pm2_5", "so2"] and len(compact["test_metrics"]) == 15


def requests_table(spark):
    return spark.createDataFrame(
        [("dcr aiims", "2024-01-19T10:00:00", 50.0, 105.0, 12.0), ("SILTARA", "2024-01-19T10:00:00", 90.0, 185.0, 22.0),
         ("nowhere", "2024-01-19T10:00:00", 1.0, 1.0, 1.0), ("SILTARA", "soon", 1.0, 1.0, 1.0), ("SILTARA", "2024-01-19", -1.0, 1.0, 1.0)],
        "region string, timestamp string, pm25 double, pm10 double, so2 double")


def test_scoring_and_storage(spark, run, tmp_path):
    requests = requests_table(spark)
    valid, rejected = flows.checked_requests(requests)
    assert valid.count() == 2
    assert sorted(tuple(r["violations"]) for r in rejected.collect()) == [("date_time",), ("pm25",), ("region",)]
    run.bundle.save(str(tmp_path / "b"))
    again = models.ForecastBundle.load(spark, str(tmp_path / "b"))
    for name in ("best", "multi_output", "single_target", "single_target_lightgbm"):
        first = flows.score(run.bundle, requests, name).orderBy("region")
        second = flows.score(again, requests, name).orderBy("region")
        rows = first.collect()
        assert rows == second.collect() and len(rows) == 2
        assert [r["region"] for r in rows] == ["AIIMS", "SILTARA"]
        assert 0 < rows[0]["pm2_5_forecast"] < rows[1]["pm2_5_forecast"]
        assert rows[0]["feature_count"] == len(run.bundle.features) and rows[0]["summary"].startswith("Predicted PM2.5 is ")
    best = {(r["region"], r["target"]): r["strategy"] for r in run.bundle.best.collect()}
    for row in flows.score(run.bundle, requests, "best").collect():
        assert row["so2_strategy"] == best[(row["region"], "so2")]
    with pytest.raises(ValueError, match="strategy must be one of"):
        flows.score(run.bundle, requests, "magic")
    with pytest.raises(models.ModelNotReadyError):
        models.ForecastBundle.load(spark, str(tmp_path / "missing"))
    meta = reports.serving_metadata(spark, again).first()
    assert meta["strategies"][:3] == ["best", "multi_output", "single_target"] and meta["model_dir"].endswith("/b")
    assert reports.inference_contract(spark, again).first()["required"] == ["region", "pm2_5", "pm10", "so2"]


def test_incomplete_bundle(spark, run, tmp_path):
    path = str(tmp_path / "b")
    spark.createDataFrame([(json.dumps({"parts": ["models"]}),)], "value string").coalesce(1).write.text(f"{path}/contract")
    with pytest.raises(models.ModelNotReadyError, match="missing parts: features"):
        models.ForecastBundle.load(spark, path)


def test_stored_predictions_agree_with_the_metrics(run):
    row = evaluate.regression_metrics(run.predictions.where("strategy = 'multi_output_lightgbm' and split = 'test' and target = 'pm10'")).first()
    stored = evaluate.overall(run.metrics).where("strategy = 'multi_output_lightgbm' and split = 'test' and target = 'pm10'").first()
    assert row["rmse"] == pytest.approx(stored["rmse"]) and row["rows"] == stored["rows"]


def test_same_seed_same_run(series, run):
    again = flows.train(series, CONFIG)
    a, b = (sorted(map(tuple, r.metrics.select("strategy", "split", "target", F.coalesce("region", F.lit("")), F.round("rmse", 9)).collect()))
            for r in (run, again))
    assert a == b


def test_importance(spark, run):
    top = models.bundle_importance(spark, run.bundle, 3).collect()
    values = [r["importance"] for r in top]
    assert len(top) == 3 and values == sorted(values, reverse=True) and top[0]["feature"] in run.bundle.inputs()
    fallback = models.feature_importance(spark, names=["pm10", "hour"]).collect()
    assert [(r["feature"], r["importance"]) for r in fallback] == [
        ("pm10", 1.0), ("hour", 0.1429), ("region_SILTARA", 0.1111), ("region_BHATAGAON", 0.1)]
    assert models.feature_importance(spark).first()["feature"] == "Previous PM2.5 level"

    class Linear:
        coefficients = Vectors.dense([0.1, -3.0])
    assert [r["feature"] for r in models.feature_importance(spark, Linear(), ["a", "b"]).collect()] == ["b", "a"]
    told = flows.explained(spark, run.bundle).first()
    assert len(told["top_features"]) == 5 and told["top_features"][0]["feature"] in told["summary"]


def test_families():
    assert models.resolve_families(["xgboost", "xgboost", "random_forest", "other"]) == ["xgboost", "random_forest"]
    assert models.resolve_families(None) == ["random_forest", "lightgbm", "xgboost"]
    with pytest.raises(ValueError, match="No requested model family"):
        models.resolve_families(["other"])
    with pytest.raises(ValueError, match="Unsupported"):
        models.estimator("other", CONFIG)


def test_model_queries_use_the_published_run(spark, folder):
    from queries import QUERIES
    from queries.common import SENSORS
    from queries.forecasts import config
    from sensorspark import constants as K

    run = config("random_forest", "lightgbm", "xgboost")
    forest, boosted = models.estimator("random_forest", run), models.estimator("xgboost", run)
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (140, 18)
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (360, 8, 0.045)
    columns = set(QUERIES["model_frame"](spark, folder).columns)
    assert {f"{c}_lag_{k}" for c in SENSORS for k in (1, 3, 6, 12, 24, 48, 168)} <= columns
    assert {f"{c}_roll_{n}_{w}" for c in K.ROLLING_SENSORS for n in ("mean", "std") for w in (3, 6, 24, 72)} <= columns


def test_stream_of_requests_with_a_saved_model(spark, run, tmp_path):
    """Six micro-batches and a restart give the rows of one batch; rejects are listed once."""
    from sensorspark.streaming import jobs

    run.bundle.save(str(tmp_path / "b"))
    bundle = models.ForecastBundle.load(spark, str(tmp_path / "b"))
    rows = [(i, ["AIIMS", "SILTARA", "nowhere"][i % 3], f"2024-01-1{i % 9}T10:00:00", 40.0 + i, -1.0 if i % 7 == 0 else 90.0, 12.0) for i in range(36)]
    schema = "event_id long, region string, timestamp string, pm25 double, pm10 double, so2 double"
    source = str(tmp_path / "in")

    def arrive(parts):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)

    def go():
        job = jobs.ModelScoringJob(spark, str(tmp_path / "job"), bundle, "best", keep=["event_id"])
        job.start(jobs.read_stream(spark, source, spark.read.parquet(source).schema, max_files=1), str(tmp_path / "cp")).awaitTermination()
        return job

    parts = [rows[i * 6:(i + 1) * 6] for i in range(6)]
    arrive(parts[:3])
    go()
    arrive(parts[3:])
    job = go()
    whole = spark.createDataFrame(rows, schema)
    pick = ["event_id", "region", *[f"{t}_{n}" for t in ("pm2_5", "pm10", "so2") for n in ("forecast", "strategy")], "risk.category", "summary"]
    told = lambda df: sorted(map(str, df.select(*pick).collect()))
    assert told(job.scores()) == told(flows.score(bundle, whole, "best", ("event_id",)))
    _, rejected = flows.checked_requests(whole)
    listed = lambda df: sorted((r["event_id"], *r["violations"]) for r in df.collect())
    assert listed(job.rejects()) == listed(rejected) and job.scores().count() + job.rejects().count() == 36
    job.process(spark.createDataFrame(parts[5], schema), 5)
    assert job.scores().count() + job.rejects().count() == 36
