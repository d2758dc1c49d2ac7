"""Pure-premium models on Spark ML: Tweedie GLM, boosted trees, frequency times severity.

Every fit returns a ``PipelineModel`` that goes from feature columns to PREDICTED_PURE_PREMIUM, so
scoring, storage and registration are the same for all of them.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.functions.columns import weighted_mean
from ratewright.operators.diagnostics import OBSERVED, PREDICTED, WEIGHT
from ratewright.operators.splits import add_fold
from ratewright.storage import shared_dir

VECTOR = "rating_vector"
WATCHED = "rating_watched"
CELLS_PER_PARTITION = 50_000
ROWS_PER_PARTITION = 250_000  # of boosted trees, which keep some hundred bytes a row and read them in every pass


@dataclass
class Fit:
    """A fitted model and what is worth recording about the fit."""

    pipeline: PipelineModel
    kind: str
    features: list[str]
    params: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with PREDICTED_PURE_PREMIUM added; every input column stays on its row."""
        return self.pipeline.transform(df)

    def save(self, path: str) -> None:
        self.pipeline.write().save(path)

    def describe(self) -> str:
        return json.dumps({"kind": self.kind, "features": self.features, "params": self.params})

    @classmethod
    def load(cls, path: str, description: str) -> Fit:
        described = json.loads(description)
        if described["kind"] == "leafwise":
            from ratewright.operators.leafwise import LeafwiseFit

            return LeafwiseFit.restore(path, described)
        return cls(PipelineModel.load(path), **described)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")


def _finish(expression: str, drop: Sequence[str]) -> SQLTransformer:
    hidden = ", ".join(drop)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({hidden}), {expression} AS {PREDICTED} FROM __THIS__")


def usable_rows(df: DataFrame, label: str, weight: str | None) -> DataFrame:
    """Rows a model can learn from: a known target and, if weighted, a positive weight."""
    rows = df.where(F.col(label).isNotNull())
    return rows if weight is None else rows.where(F.col(weight) > 0)


def collapse_cells(
    df: DataFrame, features: Sequence[str], label: str, weight: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct rating cell: total weight and weighted mean of the label.

    Policies with equal features contribute to a GLM only through these two numbers, so the fit is
    unchanged while its input shrinks from policies to cells. ``SQUARES`` keeps the weighted
    squares, from which errors on the original rows follow.
    """
    cells = df.groupBy(*by, *features).agg(
        F.sum(weight).alias(weight),
        weighted_mean(label, weight).alias(label),
        F.sum(F.col(weight) * F.col(label) * F.col(label)).alias("SQUARES"),
    )
    return cells


@dataclass
class _Design:
    """Assembled rows (vector, y, w, ...) without the features that take a single value."""

    rows: DataFrame
    stages: list
    active: list[str]
    weight: float
    mean: float


def _design(assembled: DataFrame, features: Sequence[str], vector: str = VECTOR) -> _Design:
    """One pass over assembled rows: total weight, weighted mean of the target, and which features
    vary. A constant column (an empty bin, say) has no coefficient and would make the normal
    equations singular, so it is sliced off."""
    row = assembled.agg(
        Summarizer.metrics("min", "max").summary(F.col(vector)).alias("s"),
        F.sum("w").alias("w"),
        weighted_mean("y", "w").alias("mean"),
    ).first()
    if not row["mean"] or row["mean"] <= 0:
        raise ValueError("a log-link model needs a positive weighted mean of the target")
    varies = [i for i in range(len(features)) if row["s"]["min"][i] != row["s"]["max"][i]]
    if not varies:
        raise ValueError("no feature varies over the training rows")
    stages = [assembler(features).setOutputCol(vector)]
    if len(varies) < len(features):
        slicer = VectorSlicer(inputCol=vector, outputCol=f"{vector}_active", indices=varies)
        stages.append(slicer)
        assembled = slicer.transform(assembled).drop(vector).withColumnRenamed(f"{vector}_active", vector)
    return _Design(assembled, stages, [features[i] for i in varies], row["w"], row["mean"])


def _glm(design: _Design, vector: str, **settings) -> tuple:
    """Fit on the target divided by its mean; returns the model reading the design's last stage."""
    scaled = design.rows.withColumn("y", F.col("y") / F.lit(design.mean))
    model = GeneralizedLinearRegression(
        featuresCol=vector, labelCol="y", weightCol="w", **settings
    ).fit(scaled)
    if len(design.stages) > 1:
        model = model.setFeaturesCol(f"{vector}_active")
    return model, scaled


@contextmanager
def _assembled(
    rows: DataFrame, features: Sequence[str], label: str, weight: str, vector: str, collapse: bool, by: Sequence[str] = ()
):
    """Cached rows (by, vector, y, w, SQUARES) for the many passes of a fit. Collapsed cells are put into as few
    partitions as their number asks for: adaptive execution leaves a cached frame in all shuffle partitions, and
    every pass would start that many tasks."""
    if collapse:
        rows = collapse_cells(rows, features, label, weight, by)
    else:
        rows = rows.withColumn("SQUARES", F.col(weight) * F.col(label) * F.col(label))
    assembled = assembler(features).setOutputCol(vector).transform(rows)
    assembled = assembled.select(*by, vector, F.col(label).alias("y"), F.col(weight).alias("w"), "SQUARES")
    assembled = assembled.persist(StorageLevel.MEMORY_AND_DISK)
    held = [assembled]
    try:
        if collapse:
            wanted = max(1, -(-assembled.count() // CELLS_PER_PARTITION))
            if wanted < assembled.rdd.getNumPartitions():
                assembled = assembled.coalesce(wanted).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(assembled)
                assembled.count()
                held[0].unpersist()
        yield assembled
    finally:
        for frame in held:
            frame.unpersist()


# -- Tweedie GLM -------------------------------------------------------------------------------


def fit_glm(
    df: DataFrame,
    features: Sequence[str],
    alpha: float = 0.1,
    power: float = 1.5,
    label: str = OBSERVED,
    weight: str = WEIGHT,
    max_iter: int = 1000,
    tol: float = 1e-8,
    refits: int = 1,
    collapse: bool = False,
) -> Fit:
    """Tweedie GLM with log link and ridge penalty ``alpha`` on the mean weighted half-deviance.

    The target is divided by its weighted mean before the fit and predictions are multiplied back.
    Spark's ridge term is relative to the sum of the working weights, so its ``regParam`` is set
    to ``alpha * sum(w) / sum(w * mu ** (2 - power))``; ``mu`` starts at the mean and is replaced
    by the fitted values ``refits`` times. ``collapse=True`` fits on rating cells, which pays
    where the features are indicators.
    """
    features = list(features)
    rows = usable_rows(df, label, weight).select(*features, label, weight)
    with _assembled(rows, features, label, weight, VECTOR, collapse) as assembled:
        design = _design(assembled, features)
        model, params = _fit_tweedie(design, alpha, power, max_iter, tol, refits)
    hidden = [stage.getOutputCol() for stage in design.stages] + ["glm_mean"]
    pipeline = PipelineModel([*design.stages, model, _finish(f"glm_mean * {design.mean!r}D", hidden)])
    params = {
        "alpha": alpha, "power": power, "max_iter": max_iter, "collapse": collapse, "active": design.active, **params
    }
    return Fit(pipeline, "glm", features, params)


def _fit_tweedie(design: _Design, alpha, power, max_iter, tol, refits):
    penalty = alpha * design.mean ** (power - 2)
    refits = refits if alpha else 0
    for attempt in range(refits + 1):
        model, scaled = _glm(
            design,
            VECTOR,
            family="tweedie",
            variancePower=power,
            linkPower=0.0,
            predictionCol="glm_mean",
            regParam=penalty,
            maxIter=max_iter,
            tol=tol if attempt == refits else max(tol, 1e-4),  # only a sum of these fits is used
        )
        if attempt == refits:
            break
        fitted = model.copy().setFeaturesCol(VECTOR).transform(scaled)
        mu = F.col("glm_mean") * F.lit(design.mean)
        working = fitted.agg(F.sum(F.col("w") * F.pow(mu, F.lit(2 - power))).alias("s")).first()["s"]
        penalty = alpha * design.weight / working
    iterations = model.summary.numIterations
    return model, {
        "scale": design.mean,
        "regParam": penalty,
        "iterations": iterations,
        "converged": iterations < max_iter,
        "intercept": model.intercept + math.log(design.mean),
    }


def _stage(fit: Fit, kind: type):
    return next(stage for stage in fit.pipeline.stages if isinstance(stage, kind))


def coefficients(fit: Fit) -> dict[str, float]:
    """Link-scale coefficients by feature name, 0 for features that did not vary in training."""
    from pyspark.ml.regression import GeneralizedLinearRegressionModel

    model = _stage(fit, GeneralizedLinearRegressionModel)
    fitted = dict(zip(fit.params["active"], map(float, model.coefficients)))
    return {f: fitted.get(f, 0.0) for f in fit.features}


def relativities(
    fit: Fit, df: DataFrame, factors: Mapping[str, Sequence[str]], weight: str = WEIGHT
) -> DataFrame:
    """(FACTOR, FEATURE, EXPOSURE, IS_BASE, COEFFICIENT, RELATIVITY) per rating factor.

    Each factor is rescaled so that its level with the most exposure has relativity 1, which makes
    the factors readable although every level owns an indicator. A factor's ``features`` are its
    indicator columns; a single non-indicator feature is reported as it is, per unit. The first
    row, BASE_RATE, is the predicted pure premium with all factors at base and numerics at 0.
    """
    beta = coefficients(fit)
    listed = [f for fs in factors.values() for f in fs]
    unknown = [f for f in listed if f not in beta]
    if unknown:
        raise ValueError(f"not features of the model: {', '.join(unknown)}")
    exposure = df.agg(*[F.sum(F.col(f) * F.col(weight)).alias(f) for f in listed]).first()
    base_rate = fit.params["intercept"]
    rows = []
    for factor, names in factors.items():
        base = max(names, key=lambda f: exposure[f] or 0.0) if len(names) > 1 else None
        shift = beta[base] if base else 0.0
        base_rate += shift
        for f in names:
            rows.append((factor, f, float(exposure[f] or 0.0), f == base, beta[f] - shift, math.exp(beta[f] - shift)))
    rows.insert(0, ("BASE_RATE", "BASE_RATE", None, True, base_rate, math.exp(base_rate)))
    schema = "FACTOR string, FEATURE string, EXPOSURE double, IS_BASE boolean, COEFFICIENT double, RELATIVITY double"
    return df.sparkSession.createDataFrame(rows, schema)


def score_equations(fit: Fit, df: DataFrame, label: str = OBSERVED, weight: str = WEIGHT) -> DataFrame:
    """(FEATURE, RESIDUAL): how far the fit is from solving its penalised likelihood equations,
    relative to the size of the terms that have to cancel. One aggregate over the portfolio."""
    power, alpha = fit.params["power"], fit.params["alpha"]
    scored = fit.predict(usable_rows(df, label, weight))
    pull = F.col(weight) * F.pow(PREDICTED, F.lit(1 - power)) * (F.col(label) - F.col(PREDICTED))
    beta = coefficients(fit)
    terms = {"INTERCEPT": (F.lit(1.0), 0.0), **{f: (F.col(f), alpha * beta[f]) for f in fit.features}}
    sums = [F.sum(weight).alias("w")]
    for i, (x, _) in enumerate(terms.values()):
        sums += [F.sum(pull * x).alias(f"s{i}"), F.sum(F.abs(pull * x)).alias(f"size{i}")]
    entries = [
        F.struct(
            F.lit(name).alias("FEATURE"),
            F.coalesce(
                F.try_divide(F.col(f"s{i}") - F.lit(ridge) * F.col("w"), F.col(f"size{i}")), F.lit(0.0)
            ).alias("RESIDUAL"),
        )
        for i, (name, (_, ridge)) in enumerate(terms.items())
    ]
    return scored.agg(*sums).select(F.inline(F.array(*entries)))


# -- cross-validation --------------------------------------------------------------------------


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    k: int = 5,
    alphas: Sequence[float] = (0.1,),
    power: float = 1.5,
    label: str = OBSERVED,
    weight: str = WEIGHT,
    key: str = "POLICY_ID",
    salt: str = "fold42:",
    refits: int = 1,
    collapse: bool = False,
    parallelism: int = 4,
) -> DataFrame:
    """(ALPHA, FOLD, RMSE): exposure-weighted error on the held-out fold of every Tweedie fit.

    Rows are prepared and cached once; the ``k * len(alphas)`` fits run as concurrent Spark jobs.
    With ``collapse=True`` they all run on rating cells per fold instead of policies.
    """
    features = list(features)
    rows = add_fold(usable_rows(df, label, weight), k, key, salt).select("FOLD", *features, label, weight)

    def one(assembled, task):
        alpha, fold = task
        design = _design(assembled.where(F.col("FOLD") != fold), features)
        model, params = _fit_tweedie(design, alpha, power, 1000, 1e-8, refits)
        held = assembled.where(F.col("FOLD") == fold)
        for stage in design.stages[1:]:
            held = stage.transform(held)
        p = F.col("glm_mean") * F.lit(params["scale"])
        squared = F.sum(F.col("SQUARES") - 2 * p * F.col("w") * F.col("y") + F.col("w") * p * p)
        error = F.sqrt(F.greatest(squared, F.lit(0.0)) / F.sum("w"))
        return float(alpha), fold, model.transform(held).agg(error.alias("rmse")).first()["rmse"]

    with _assembled(rows, features, label, weight, VECTOR, collapse, by=["FOLD"]) as assembled:
        assembled.count()
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            results = list(pool.map(partial(one, assembled), itertools.product(alphas, range(k))))
    return df.sparkSession.createDataFrame(results, "ALPHA double, FOLD int, RMSE double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """(ALPHA, FOLDS, CV_RMSE_MEAN, CV_RMSE_STD): population standard deviation over the folds."""
    return folds.groupBy("ALPHA").agg(
        F.count("RMSE").alias("FOLDS"),
        F.avg("RMSE").alias("CV_RMSE_MEAN"),
        F.stddev_pop("RMSE").alias("CV_RMSE_STD"),
    )


# -- frequency x severity ----------------------------------------------------------------------


def fit_freq_sev(
    df: DataFrame,
    features: Sequence[str],
    reg_param: float = 1e-4,
    max_iter: int = 100,
    tol: float = 1e-8,
    collapse: bool = False,
) -> Fit:
    """Poisson frequency per policy-year times Gamma severity per claim, both with log link.

    Needs CLAIM_COUNT, CLAIM_AMOUNT and EXPOSURE next to the features. Frequency is weighted by
    exposure, severity by claim count; a claim-free policy plays no part in the severity fit.
    """
    features = list(features)
    base = df.select(*features, "CLAIM_COUNT", "CLAIM_AMOUNT", "EXPOSURE")
    frequency = base.where("EXPOSURE > 0 AND CLAIM_COUNT IS NOT NULL").select(
        *features, (F.col("CLAIM_COUNT") / F.col("EXPOSURE")).alias("y"), F.col("EXPOSURE").alias("w")
    )
    severity = base.where("CLAIM_COUNT > 0 AND CLAIM_AMOUNT > 0").select(
        *features,
        (F.col("CLAIM_AMOUNT") / F.col("CLAIM_COUNT")).alias("y"),
        F.col("CLAIM_COUNT").cast("double").alias("w"),
    )
    stages, params, hidden = [], {"regParam": reg_param}, []
    for name, family, rows in (("freq", "poisson", frequency), ("sev", "gamma", severity)):
        vector = f"{name}_vector"
        with _assembled(rows, features, "y", "w", vector, collapse) as assembled:
            design = _design(assembled, features, vector)
            model, _ = _glm(
                design,
                vector,
                family=family,
                link="log",
                predictionCol=f"{name}_mean",
                regParam=reg_param,
                maxIter=max_iter,
                tol=tol,
            )
        stages += [*design.stages, model]
        hidden += [stage.getOutputCol() for stage in design.stages] + [f"{name}_mean"]
        params[f"{name}_scale"] = design.mean
        params[f"{name}_iterations"] = model.summary.numIterations
    factor = params["freq_scale"] * params["sev_scale"]
    finish = _finish(f"freq_mean * sev_mean * {factor!r}D", hidden)
    return Fit(PipelineModel([*stages, finish]), "freq_sev", features, params)


# -- boosted trees -----------------------------------------------------------------------------


def fit_gbt(
    df: DataFrame,
    features: Sequence[str],
    rounds: int = 200,
    step: float = 0.05,
    depth: int = 5,
    label: str = OBSERVED,
    weight: str | None = WEIGHT,
    seed: int = 0,
    max_bins: int = 32,
    partitions: int | None = None,
    watch: DataFrame | None = None,
    tolerance: float = 0.0,
) -> Fit:
    """Boosted regression trees on squared error, exposure-weighted unless ``weight=None``.

    Depth 5 gives at most 32 leaves per tree. The fit (``boosting.py``) follows Spark ML's rules and gives its model; only sums
    by bin travel. ``partitions`` re-splits the rows where the stored files are too few for the executors; more than
    ``ROWS_PER_PARTITION`` rows a partition are re-split in any case, so that what a task keeps and reads does not grow with the table.

    With ``watch``, rows that are not learned from, the loss on them is followed while the trees are fitted: the fit
    ends with the first round that lowers it by less than ``tolerance`` (relative; by nothing, if 0), and keeps the trees up
    to the best round, ``params["best_round"]``.
    """
    from ratewright.operators.boosting import BlockGBTRegressor

    features = list(features)
    shared_dir(df.sparkSession)  # long boosting lineages are checkpointed to the shared folder
    rows = usable_rows(df, label, weight).select(*features, label, *([weight] if weight else []))
    trees = BlockGBTRegressor(
        featuresCol=VECTOR,
        labelCol=label,
        predictionCol=PREDICTED,
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
        maxBins=max_bins,
        lossType="squared",
        seed=seed,
        checkpointInterval=10,
        validationTol=tolerance,
    )
    if weight:
        trees = trees.setWeightCol(weight)
    if watch is not None:
        others = usable_rows(watch, label, weight).select(*rows.columns)
        rows = rows.withColumn(WATCHED, F.lit(False)).unionByName(others.withColumn(WATCHED, F.lit(True)))
        trees = trees.setValidationIndicatorCol(WATCHED)
    vectors = assembler(features)
    assembled = vectors.transform(rows).drop(*features)  # vectors of indicators are sparse, and travel as such
    needed = -(-rows.count() // ROWS_PER_PARTITION)
    if needed > 1:
        assembled = assembled.repartition(max(needed, partitions or df.sparkSession.sparkContext.defaultParallelism))
    elif partitions:
        assembled = assembled.repartition(partitions)
    model = trees.fit(assembled)
    finish = SQLTransformer(statement=f"SELECT * EXCEPT ({VECTOR}) FROM __THIS__")
    params = {"n_estimators": rounds, "learning_rate": step, "max_depth": depth, "weight": weight, "label": label}
    if watch is not None:
        params["best_round"] = model.getNumTrees
    return Fit(PipelineModel([vectors, model, finish]), "gbt", features, params)


def evaluation_curve(fit: Fit, df: DataFrame) -> DataFrame:
    """(ROUND, LOSS): squared loss on ``df`` after each boosting round."""
    if fit.kind == "leafwise":
        from ratewright.operators import leafwise

        return leafwise.evaluation_curve(fit, df)
    from pyspark.ml.regression import GBTRegressionModel

    model = _stage(fit, GBTRegressionModel)
    weight = fit.params["weight"]
    rows = usable_rows(df, fit.params["label"], weight)
    losses = model.evaluateEachIteration(assembler(fit.features).transform(rows), "squared")
    schema = T.StructType([T.StructField("ROUND", T.IntegerType()), T.StructField("LOSS", T.DoubleType())])
    return df.sparkSession.createDataFrame([(i, float(x)) for i, x in enumerate(losses, start=1)], schema)
