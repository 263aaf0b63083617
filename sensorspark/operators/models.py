"""Forecasters: fitting, comparison, storage and batch prediction with pyspark.ml."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.operators import boosting, evaluate, features, forests, grid, split
from sensorspark.operators.fitted import (
    MedianImputerModel, QuantileClipperModel, TargetTransformer, TargetTransformerModel,
)
from sensorspark.operators.quantiles import quantiles
from sensorspark.operators.series import over_series
from sensorspark.plans.shared import materialize

SCOPES = ("multi_output", "single_target")
BASELINE = "baseline_median"
FEATURES = "_features"
# Families that learn all targets of a row at once in the multi-output scope; the others fit one model per target in both.
JOINT_FAMILIES = ("random_forest",)
# Fits that run at the same time; each launches many small jobs.
PARALLEL_FITS = 6
# Training rows per task: levels of a tree are one job each, so small tables take few tasks.
ROWS_PER_TASK = 20_000
# Rows scored per task: a row meets hundreds of trees, so even a small file is more than one task's work.
SCORED_PER_TASK = 10_000


class ModelNotReadyError(RuntimeError):
    pass


@dataclass(frozen=True)
class ForecastConfig:
    """Options of a training run; defaults are the published ones."""

    granularity: str = "quarter_hourly"
    targets: Sequence[str] = K.TARGETS
    rolling: Sequence[str] = K.ROLLING_SENSORS
    lags: Sequence[int] | None = None
    windows: Sequence[int] | None = None
    horizon: int = 1
    min_date: str | None = K.MIN_DATE
    max_date: str | None = None
    train_end: str = K.TRAIN_END
    validation_end: str = K.VALIDATION_END
    feature_clip: Sequence[float] | None = K.FEATURE_CLIP
    target_clip_upper: float | None = K.TARGET_CLIP_UPPER
    log_target: bool = True
    families: Sequence[str] = K.MODEL_FAMILIES
    forest: Mapping[str, object] = field(default_factory=dict)
    boosted: Mapping[str, object] = field(default_factory=dict)
    seed: int = K.SEED
    exact_quantiles: bool = True
    choose_on: str = "validation"

    def active_lags(self) -> list[int]:
        return sorted(set(self.lags or K.LAGS[self.granularity]))

    def active_windows(self) -> list[int]:
        return sorted(set(self.windows or K.WINDOWS[self.granularity]))


def resolve_families(requested: Sequence[str] | None, available: Sequence[str] = K.MODEL_FAMILIES) -> list[str]:
    """Requested families once each, in order, without those that cannot be built; none left is an error."""
    wanted = dict.fromkeys(requested or K.MODEL_FAMILIES)
    found = [f for f in wanted if f in available]
    if not found:
        raise ValueError("No requested model family is available: " + ", ".join(wanted))
    return found


def strategy(scope: str, family: str) -> str:
    return f"{scope}_{family}"


def model_frame(base: DataFrame, config: ForecastConfig, regions: Sequence[str] | None = None) -> DataFrame:
    """Regular grid, calendar, lags, rolling statistics, targets, one-hot regions and split label.

    All lags, frames and leads share one window, hence one shuffle and one sort.
    """
    lags, windows = config.active_lags(), config.active_windows()
    step = K.STEP_SECONDS[config.granularity]
    sensors = split.sensor_columns(base)
    rolling = [c for c in config.rolling if c in base.columns]
    regions = features.learn_regions(base) if regions is None else regions
    frame = grid.regular_grid(base, config.granularity)

    def build(w):
        return {
            **features.lag_columns(w, sensors, lags),
            **features.rolling_columns(w, rolling, windows),
            **features.target_columns(w, config.targets, config.horizon),
        }

    frame = over_series(frame, build, step=step, back=max(*lags, *windows), ahead=config.horizon)
    frame = features.add_region_one_hot(features.add_calendar(frame), regions)
    label = split.split_label(config.targets, config.train_end, config.validation_end)
    frame = frame.withColumn("split", label)
    return split.remove_implausible(frame, split.feature_columns(frame, config.targets))


def estimator(family: str, config: ForecastConfig):
    if family == "random_forest":
        return RandomForestRegressor(seed=config.seed, **{**K.FOREST_PRESET, **config.forest})
    if family in K.BOOSTED_PRESETS:
        return GBTRegressor(seed=config.seed, **{**K.BOOSTED_PRESETS[family], **config.boosted})
    raise ValueError(f"Unsupported model family: {family}")


def preprocessing(columns: Sequence[str], train: DataFrame, config: ForecastConfig) -> PipelineModel:
    """Clip, fill, assemble; fitted on the training rows.

    All bounds and medians come from one search. Clipping keeps the order of
    values, so the median of clipped values is the clipped median.
    """
    columns = list(columns)
    low, high = config.feature_clip or (0.0, 1.0)
    found = quantiles(train, columns, [low, 0.5, high], config.exact_quantiles)
    counts = train.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in columns]).first()
    stages = []
    if config.feature_clip:
        stages.append(QuantileClipperModel.of({c: (found[c][0], found[c][2]) for c in columns}))
    imputer = MedianImputerModel.of(
        {c: found[c][1] for c in columns}, [c for c, n in zip(columns, counts[1:]) if n < counts[0]])
    stages += [imputer, VectorAssembler(inputCols=imputer.output_columns(), outputCol=FEATURES)]
    return PipelineModel(stages)


@dataclass
class ForecastBundle:
    """Everything scoring needs. `models[family][target]` are fitted regressors; `joint[family]` serve all targets of the
    multi-output scope, on targets less their mean over their deviation (`scales`) and with one more feature per target."""

    preprocess: PipelineModel
    models: dict[str, dict[str, object]]
    target_model: TargetTransformerModel
    features: list[str]
    targets: list[str]
    metadata: dict
    best: DataFrame
    joint: dict[str, object] = field(default_factory=dict)
    scales: dict[str, list[float]] = field(default_factory=dict)

    REQUIRED = ("preprocess", "models", "target_model", "features", "targets")

    def candidates(self) -> list[str]:
        return [strategy(scope, family) for scope in SCOPES for family in self.models]

    def inputs(self) -> list[str]:
        """Names behind the positions of the feature vector."""
        return list(self.preprocess.stages[-1].getInputCols())

    def save(self, path: str) -> None:
        """Models as pipeline folders, the rest as one JSON row and one table."""
        spark = self.best.sparkSession
        self.preprocess.write().overwrite().save(f"{path}/preprocess")
        self.target_model.write().overwrite().save(f"{path}/target_model")
        places = {f"models/{f}/{t}": model for f, per in self.models.items() for t, model in per.items()}
        places |= {f"joint/{f}": model for f, model in self.joint.items()}
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            list(pool.map(lambda place: places[place].write().overwrite().save(f"{path}/{place}"), places))
        self.best.write.mode("overwrite").parquet(f"{path}/best")
        contract = {"features": self.features, "targets": self.targets, "families": list(self.models),
                    "joint": list(self.joint), "scales": self.scales,
                    "metadata": self.metadata, "parts": list(self.REQUIRED)}
        spark.createDataFrame([(json.dumps(contract),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/contract")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForecastBundle":
        try:
            contract = json.loads(spark.read.text(f"{path}/contract").first()[0])
        except Exception as error:
            raise ModelNotReadyError(f"Missing forecast bundle at {path}") from error
        missing = sorted(set(cls.REQUIRED) - set(contract["parts"]))
        if missing:
            raise ModelNotReadyError("Forecast bundle is missing parts: " + ", ".join(missing))
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            models = {f: {t: pool.submit(reader(f).load, f"{path}/models/{f}/{t}") for t in contract["targets"]} for f in contract["families"]}
            joint = {f: pool.submit(reader(f).load, f"{path}/joint/{f}") for f in contract.get("joint", [])}
        models, joint = {f: {t: m.result() for t, m in per.items()} for f, per in models.items()}, {f: m.result() for f, m in joint.items()}
        return cls(PipelineModel.load(f"{path}/preprocess"), models,
                   TargetTransformerModel.load(f"{path}/target_model"), contract["features"],
                   contract["targets"], {**contract["metadata"], "model_dir": path},
                   spark.read.parquet(f"{path}/best"), joint, contract.get("scales", {}))


def reader(family: str):
    """Class that loads the regressors of a family."""
    return RandomForestRegressionModel if family == "random_forest" else GBTRegressionModel


def median_baseline(train: DataFrame, targets: Sequence[str], exact: bool = True) -> dict[str, float | None]:
    """Median of the (transformed) training targets."""
    found = quantiles(train, targets, [0.5], exact)
    return {t: found[t][0] for t in targets}


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows dealt over as many tasks as scoring them is worth; `rows` saves counting them."""
    tasks = -(-(df.count() if rows is None else rows) // SCORED_PER_TASK)
    return df.repartition(tasks) if tasks > 1 else df


def raw_predictions(df: DataFrame, bundle_models: Mapping[str, Mapping[str, object]], preprocess: PipelineModel,
                    joint: Mapping[str, object] | None = None, scales: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Add `_p_{family}_{target}` (transformed scale) for every fitted model, `_j_{family}_{target}` for the joint ones.

    Forests score batches of rows together (`forests.py`); a joint one is asked once per target.
    """
    out, walked = preprocess.transform(df), {}
    for family, per_target in bundle_models.items():
        for target, model in per_target.items():
            if isinstance(model, RandomForestRegressionModel):
                walked[f"_p_{family}_{target}"] = model, (), None
            else:
                out = model.copy({model.featuresCol: FEATURES, model.predictionCol: f"_p_{family}_{target}"}).transform(out)
    for target in scales if joint else ():
        for family, model in joint.items():
            walked[f"_j_{family}_{target}"] = model, [float(t == target) for t in scales], scales[target]
    if not walked:
        return out
    out = out.withColumn("_walked", forests.predictions(out, FEATURES, [(model, more) for model, more, _ in walked.values()]))
    values = {name: F.get("_walked", F.lit(i)) for i, name in enumerate(walked)}
    scaled = {name: value if walked[name][2] is None else value * walked[name][2][1] + walked[name][2][0] for name, value in values.items()}
    return out.withColumns(scaled).drop("_walked")


JOINT_FEATURES = "_joint_features"


def with_target(df: DataFrame, target: str | Column, targets: Sequence[str]) -> DataFrame:
    """Features and one indicator per target as one vector."""
    names = [f"_is_{t}" for t in targets]
    wanted = F.lit(target) if isinstance(target, str) else target
    told = df.withColumns({n: (wanted == t).cast("double") for n, t in zip(names, targets, strict=True)})
    return VectorAssembler(inputCols=[FEATURES, *names], outputCol=JOINT_FEATURES).transform(told).drop(*names)


Keep = Callable[[str, Sequence[str], Callable[[], dict[str, object]]], dict[str, object]]


def fit_now(family: str, names: Sequence[str], train: Callable[[], dict[str, object]]) -> dict[str, object]:
    """Models of a family by name, always trained anew. A store puts its own in this place."""
    return train()


def fit_families(assembled: DataFrame, families: Sequence[str], targets: Sequence[str], scales: Mapping[str, Sequence[float]],
                 config: ForecastConfig, keep: Keep = fit_now, size: tuple[int, int] | None = None) -> dict[str, dict[str, object]]:
    """Regressors of each family by target, and the joint one under the name `joint`. Fits run side by side.

    With a `size` (rows, features) that one task holds, a boosted fit is one task instead of two stages per level of a tree.
    """
    indicators = F.array(*[F.struct(F.lit(t).alias("_target"), ((F.col(f"_y_{t}") - scales[t][0]) / scales[t][1]).alias("_y")) for t in targets])
    stacked = with_target(assembled.select(FEATURES, F.inline(indicators)), F.col("_target"), targets)

    def train(family: str, pool: ThreadPoolExecutor) -> dict[str, object]:
        learner = estimator(family, config)
        jobs = {t: (assembled, {learner.featuresCol: FEATURES, learner.labelCol: f"_y_{t}"}) for t in targets}
        if family in JOINT_FAMILIES:
            jobs["joint"] = (stacked, {learner.featuresCol: JOINT_FEATURES, learner.labelCol: "_y"})
        if size and family in K.BOOSTED_PRESETS and boosting.fits_a_task(learner, *size):
            started = {name: pool.submit(boosting.fit, learner.copy(params), rows) for name, (rows, params) in jobs.items()}
        else:
            started = {name: pool.submit(learner.copy(params).fit, rows) for name, (rows, params) in jobs.items()}
        return {name: task.result() for name, task in started.items()}

    names = {f: [*targets, *(["joint"] if f in JOINT_FAMILIES else [])] for f in families}
    with ThreadPoolExecutor(len(families)) as outer, ThreadPoolExecutor(PARALLEL_FITS) as pool:
        found = {f: outer.submit(keep, f, names[f], lambda f=f: train(f, pool)) for f in families}
        return {f: task.result() for f, task in found.items()}


def fit(frame: DataFrame, config: ForecastConfig, keep: Keep = fit_now) -> tuple[ForecastBundle, DataFrame, DataFrame]:
    """(bundle, long predictions on validation and test, metrics).

    A forest learns all targets together for the multi-output strategy and each by itself for the single-target one;
    boosted families have one model per target in both. `frame` should be a stored table.
    `keep` may hand out models that were trained before.
    """
    families = resolve_families(config.families)
    targets = list(config.targets)
    train = frame.where("split = 'train'")
    columns = split.non_null_columns(train, split.feature_columns(frame, targets))
    names = {t: f"target_{t}" for t in targets}
    target_model = TargetTransformer(
        inputCols=targets, upperQuantile=config.target_clip_upper or 1.0,
        clipUpper=config.target_clip_upper is not None, logTransform=config.log_target,
        exact=config.exact_quantiles,
    ).fit(train.select(*[F.col(c).alias(t) for t, c in names.items()]))
    preprocess = preprocessing(columns, train, config)
    labels = [target_model.forward(F.col(c).cast("double"), t).alias(f"_y_{t}") for t, c in names.items()]
    assembled = preprocess.transform(train.select(*columns, *labels)).select(FEATURES, *[f"_y_{t}" for t in targets])
    assembled = materialize(assembled, "training-rows")
    spreads = assembled.agg(F.count(F.lit(1)), *[f(f"_y_{t}") for t in targets for f in (F.avg, F.stddev_pop)]).first()
    scales = {t: [spreads[1 + 2 * i] or 0.0, spreads[2 + 2 * i] or 1.0] for i, t in enumerate(targets)}
    medians = median_baseline(assembled.select(*[F.col(f"_y_{t}").alias(t) for t in targets]), targets, config.exact_quantiles)
    size = spreads[0], len(preprocess.stages[-1].getInputCols())
    found = fit_families(assembled.coalesce(max(1, spreads[0] // ROWS_PER_TASK)), families, targets, scales, config, keep, size)
    models = {f: {t: per[t] for t in targets} for f, per in found.items()}
    joint = {f: per["joint"] for f, per in found.items() if "joint" in per}
    held_out = frame.where(F.col("split").isin("validation", "test")).select(
        *dict.fromkeys(["region", "date_time", "split", *columns, *names.values()]))
    scored = raw_predictions(spread(held_out), models, preprocess, joint, scales)
    predicted = {BASELINE: {t: F.lit(medians[t]).cast("double") for t in targets}}
    for scope in SCOPES:
        for family in families:
            together = scope == "multi_output" and family in joint
            predicted[strategy(scope, family)] = {t: F.col(f"{'_j' if together else '_p'}_{family}_{t}") for t in targets}
    wide = scored.select("region", "date_time", "split", *names.values(), *[
        target_model.backward(c, t).alias(f"{s}_pred_{t}") for s, cols in predicted.items() for t, c in cols.items()])
    predictions = evaluate.long_predictions(
        wide, {s: {t: f"{s}_pred_{t}" for t in targets} for s in predicted}, names)
    predictions = materialize(predictions, "predictions")
    metrics = materialize(evaluate.metrics_by_region(predictions), "metrics")
    contenders = metrics.where(F.col("strategy") != BASELINE)
    best = evaluate.best_strategies(contenders, config.choose_on)
    scopes = {strategy(scope, family): scope for scope in SCOPES for family in families}
    best_multi, best_single = evaluate.choose_strategies(contenders, scopes, targets)
    metadata = {
        "granularity": config.granularity, "targets": targets, "feature_count": len(columns), "features": columns,
        "lags": config.active_lags(), "rolling_windows": config.active_windows(), "horizon_steps": config.horizon,
        "min_date": config.min_date, "max_date": config.max_date, "train_end": config.train_end,
        "validation_end": config.validation_end,
        "feature_clip": list(config.feature_clip) if config.feature_clip else None,
        "target_clip_upper": config.target_clip_upper, "log_target_transform": config.log_target,
        "model_families": families, "candidate_scopes": scopes, "best_multi_output_strategy": best_multi,
        "best_single_target_strategy_by_target": best_single, "seed": config.seed,
        "regions": [c[len("region_"):] for c in columns if c.startswith("region_")],
        "learner_options": {f: learner_options(f, config) for f in families},
        "jointly_fitted": sorted(joint), "training_rows": spreads[0],
    }
    return ForecastBundle(preprocess, models, target_model, columns, targets, metadata, best, joint, scales), predictions, metrics


def learner_options(family: str, config: ForecastConfig) -> dict:
    """The options a family is trained with."""
    return {"seed": config.seed, **(dict(K.FOREST_PRESET) | dict(config.forest) if family == "random_forest"
                                    else dict(K.BOOSTED_PRESETS[family]) | dict(config.boosted))}


def _served_by(bundle: ForecastBundle, name: str, target: str) -> tuple[bool, str]:
    """(joint model?, family) behind a strategy name for one target."""
    chosen = name
    if name == "multi_output":
        chosen = bundle.metadata.get("best_multi_output_strategy")
    elif name == "single_target":
        chosen = bundle.metadata.get("best_single_target_strategy_by_target", {}).get(target)
    for scope in SCOPES:
        family = (chosen or "").removeprefix(scope + "_")
        if chosen and family != chosen and family in bundle.models:
            return scope == "multi_output" and family in bundle.joint, family
    raise ModelNotReadyError(f"The bundle has no model for strategy {name} and target {target}")


def predict(bundle: ForecastBundle, feature_rows: DataFrame, strategy_name: str = "best", region: str = "region") -> DataFrame:
    """Forecast columns `{target}_forecast` and `{target}_strategy` for rows of features.

    With `best` the winners are laid out one row per region, so a single small
    join picks the strategy of every target in place.
    """
    name = strategy_name.lower().strip()
    served = bundle.candidates() + list(SCOPES)
    if name != "best" and name not in served:
        raise ValueError("strategy must be one of: " + ", ".join(["best", *SCOPES, *sorted(bundle.candidates())]))
    names = served if name == "best" else [name]
    served_by = {(n, t): _served_by(bundle, n, t) for n in names for t in bundle.targets}
    used = {f: {t: bundle.models[f][t] for t in bundle.targets if any(served_by[(n, t)] == (False, f) for n in names)}
            for f in bundle.models}
    joint = {f: m for f, m in bundle.joint.items() if (True, f) in served_by.values()}
    rows = feature_rows
    if name == "best":
        rows = rows.join(best_by_region(bundle), region, "left")
    scored = raw_predictions(rows, used, bundle.preprocess, joint, bundle.scales)

    def restored(n: str, t: str) -> Column:
        together, family = served_by[(n, t)]
        return bundle.target_model.backward(F.col(f"{'_j' if together else '_p'}_{family}_{t}"), t)

    out = {}
    for t in bundle.targets:
        if name == "best":
            pick = F.coalesce(F.col(f"_best_{t}"), F.lit("multi_output"))
            value = restored("multi_output", t)
            for n in names:
                if n != "multi_output":
                    value = F.when(pick == n, restored(n, t)).otherwise(value)
            out[f"{t}_strategy"] = pick
        else:
            value = restored(name, t)
            out[f"{t}_strategy"] = F.lit(name)
        out[f"{t}_forecast"] = F.round(F.greatest(value, F.lit(0.0)), 3)
    return scored.select(*[F.col(f"`{c}`") for c in feature_rows.columns], *[c.alias(n) for n, c in out.items()])


def best_by_region(bundle: ForecastBundle) -> DataFrame:
    from sensorspark.operators.selector import resolve_strategy
    served = resolve_strategy(F.col("strategy"), bundle.candidates())
    return bundle.best.groupBy("region").agg(*[
        F.max(F.when(F.col("target") == t, served)).alias(f"_best_{t}") for t in bundle.targets])


def feature_importance(spark: SparkSession, model=None, names: Sequence[str] = (), k: int = 12) -> DataFrame:
    """(position, feature, importance) of a fitted model, strongest first; fixed values without one."""
    values = None
    if model is not None and hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray().tolist()
    elif model is not None and hasattr(model, "coefficients"):
        values = [abs(x) for x in model.coefficients.toArray().tolist()]
    if values and names:
        rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))]
    elif names:
        rows = [(i, n, round(1.0 / (i + 1), 4)) for i, n in enumerate(K.FALLBACK_MODEL_FEATURES)
                if n in names or n.startswith("region_")]
    else:
        rows = [(i, n, v) for i, (n, v) in enumerate(K.FALLBACK_DISPLAY_IMPORTANCE)]
    table = spark.createDataFrame(rows, "position int, feature string, importance double")
    return evaluate.top_features(table, k)


def bundle_importance(spark: SparkSession, bundle: ForecastBundle, k: int = 12) -> DataFrame:
    """Importance from the multi-output choice for the first target, as in single-model bundles."""
    target = bundle.targets[0]
    together, family = _served_by(bundle, "multi_output", target)
    model = bundle.joint[family] if together else bundle.models[family][target]
    names = bundle.inputs() + ([f"target_{t}" for t in bundle.scales] if together else [])
    return feature_importance(spark, model, names, k)


def config_row(spark: SparkSession, config: ForecastConfig) -> DataFrame:
    text = json.dumps(asdict(config), default=list)
    return spark.createDataFrame([(text,)], "config string")
