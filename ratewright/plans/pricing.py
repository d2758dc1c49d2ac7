"""The pricing study end to end: tables in, frozen datasets, models, exhibits and scores out.

Each step is written before the next one reads it, so the statistics of a later step never repeat
the joins of an earlier one and a lost executor costs at most one step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.columns import key_slot
from ratewright.operators.diagnostics import PREDICTED, gini, metrics, write_exhibits
from ratewright.operators.features import FeaturePlan, FeatureSpec, feature_columns
from ratewright.operators.models import Fit, cross_validate, cv_summary, evaluation_curve
from ratewright.operators.policy import Caps, add_targets, prepare_policies, segment_exposure
from ratewright.sources.store import AlreadyExists, PricingStore, stamp
from ratewright.storage import spread


@dataclass(frozen=True)
class Names:
    view: str = "RATING_FEATURES"
    training: str = "TRAINING"
    validation: str = "VALIDATION"
    experiment: str = "PURE_PREMIUM"


def burning_cost(freq: DataFrame, sev: DataFrame, segment: str = "TERRITORY_CODE") -> DataFrame:
    """Exposure, claims and burning cost per segment, straight from the two source tables."""
    return segment_exposure(prepare_policies(freq, sev), [segment]).drop("IS_THIN")


def freeze_study(
    store: PricingStore,
    freq: DataFrame,
    sev: DataFrame,
    version: str = "1",
    spec: FeatureSpec = FeatureSpec(),
    caps: Caps = Caps(),
    exact: bool = False,
    train_percent: int = 75,
    names: Names = Names(),
) -> FeaturePlan:
    """Prepare policies, fit the feature plan, register the view, freeze both datasets.

    A version is frozen once: where either dataset or the view has it, nothing is written.
    """
    for name in (names.training, names.validation):
        if store.has_dataset(name, version):
            raise AlreadyExists(f"dataset {name} version {version}")
    if store.has_view(names.view, version):
        raise AlreadyExists(f"feature view {names.view} version {version}")
    # a folder of its own: what an earlier attempt left cannot be mistaken for this one's input
    prepared_path = f"{store.root}/prepared/version={version}/at={stamp()}"
    prepare_policies(freq, sev, caps).write.mode("errorifexists").parquet(prepared_path)
    prepared = store.spark.read.parquet(prepared_path)
    plan = FeaturePlan.fit(prepared, spec, exact=exact, cache=False)
    store.register_view(
        plan.transform(prepared, lead=["POLICY_ID"]), names.view, version, description=plan.to_json(), overwrite=False
    )
    spine = add_targets(prepared).select("POLICY_ID", "PURE_PREMIUM", "EXPOSURE")
    in_train = key_slot("POLICY_ID", 100) < train_percent
    # the split depends on the key alone, so each side of the join is cut before it is shuffled
    for name, part, text in (
        (names.training, in_train, "Training split"),
        (names.validation, ~in_train, "Validation split"),
    ):
        store.generate_dataset(
            spine.where(part), name, version, names.view, version, description=text, key_filter=part
        )
    return plan


def train_and_register(
    store: PricingStore,
    model: str,
    run: str,
    version: str,
    fit: Callable[[DataFrame, Sequence[str]], Fit],
    names: Names = Names(),
    folds: int = 5,
) -> dict[str, float]:
    """Fit on the frozen training rows, judge on the frozen validation rows, save the exhibits, log
    the run and register the model. Validation rows are scored once and kept as a table.

    A Tweedie GLM is also cross-validated on the training rows (``cv_rmse_mean``, ``cv_rmse_std``; not with
    ``folds`` of 1 or less); of boosted trees the validation loss of every round is logged (``val_loss``).
    """
    train = spread(store.load_dataset(names.training, version))
    validation = store.load_dataset(names.validation, version)
    fitted = fit(train, feature_columns(train.columns))
    # the curve of losses is logged below, as a metric by round
    plain = {k: v for k, v in fitted.params.items() if k != "val_loss"}
    store.log_params(names.experiment, run, {**plain, "ds_version": version})

    run_path = f"{store.root}/runs/{names.experiment}/{run}"
    scored = store.score_batch(fitted, validation, f"{run_path}/scored")
    errors = metrics(scored, {model: PREDICTED}).first()
    values = {"val_rmse": errors["RMSE"], "val_mae": errors["MAE"], "val_rmse_weighted": errors["RMSE_WEIGHTED"]}
    values["val_gini"] = gini(scored, {model: PREDICTED}).first()["GINI"]
    if fitted.kind == "glm" and folds > 1:
        settings = {k: fitted.params[k] for k in ("power", "collapse")}
        by_fold = cross_validate(train, fitted.features, folds, [fitted.params["alpha"]], **settings)
        summary = cv_summary(by_fold).first()
        values |= {"cv_rmse_mean": summary["CV_RMSE_MEAN"], "cv_rmse_std": summary["CV_RMSE_STD"]}
    store.log_metrics(names.experiment, run, values)
    if fitted.kind in ("gbt", "leafwise"):
        losses = evaluation_curve(fitted, validation).withColumnRenamed("LOSS", "val_loss")
        store.log_metric_table(names.experiment, losses, F.lit(run), ["val_loss"], step="ROUND")
    exhibits = write_exhibits(scored, model, f"{run_path}/exhibits")
    store.log_artifacts(names.experiment, run, list(exhibits.values()))
    store.register_model(
        fitted,
        model,
        run,
        metrics={k: v for k, v in values.items() if v is not None},
        sample=train,
        experiment=names.experiment,
        run=run,
        dataset=names.training,
        dataset_version=version,
        attachments=list(exhibits.values()),
    )
    return values


def score_portfolio(
    store: PricingStore, model: str, version: str, path: str, names: Names = Names()
) -> DataFrame:
    """Score the frozen validation features with the model's default version into ``path``."""
    features = store.load_dataset(names.validation, version, only_features=True)
    return store.score_batch(store.get_model(model), features, path)


def score_policies(
    store: PricingStore, model: str, policies: DataFrame, path: str, version: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Score raw policies with a model version (or the default) through the feature plan it was trained with.

    Returns the stored scores (POLICY_ID, features, prediction) and the stored input report: missing values,
    unseen levels and values out of range by column. Absent and mistyped columns are refused.
    """
    plan = store.feature_plan(model, version)
    plan.check_input(policies).write.mode("overwrite").parquet(f"{path}/input_check")
    features = plan.transform(policies, lead=["POLICY_ID"])
    scores = store.score_batch(store.get_model(model, version), features, f"{path}/scores")
    return scores, store.spark.read.parquet(f"{path}/input_check")
