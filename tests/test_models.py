import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.operators import models as mdl
from ratewright.operators.diagnostics import PREDICTED, compare_models, double_lift, lift_calibration, metrics
from ratewright.operators.policy import add_targets
from ratewright.storage import materialise, scratch_path, shared_dir


@pytest.fixture(scope="module")
def cells(policies):
    """Three overlapping indicator features over the prepared policies."""
    from ratewright.functions.columns import indicator

    return add_targets(policies).select(
        "POLICY_ID",
        "PURE_PREMIUM",
        "CLAIM_COUNT",
        "CLAIM_AMOUNT",
        "EXPOSURE",
        indicator(F.col("TERRITORY_CODE") == "ASIA").alias("A"),
        indicator(F.col("CONSTRUCTION_TYPE") == "BUILDING").alias("B"),
        indicator(F.col("CONSTRUCTION_QUALITY") <= 2).alias("C"),
        F.lit(0.0).alias("EMPTY"),
    )


FEATURES = ["A", "B", "C", "EMPTY"]


def test_glm_solves_its_equations(design):
    df, names = design
    fit = mdl.fit_glm(df, names, alpha=0.1)
    assert fit.params["converged"]
    assert max(abs(r["RESIDUAL"]) for r in mdl.score_equations(fit, df).collect()) < 1e-8


def test_cells_give_the_same_fit(cells):
    plain = mdl.coefficients(mdl.fit_glm(cells, FEATURES, alpha=0.3))
    grouped = mdl.coefficients(mdl.fit_glm(cells, FEATURES, alpha=0.3, collapse=True))
    assert plain["EMPTY"] == 0.0
    assert all(abs(plain[f] - grouped[f]) < 1e-9 for f in FEATURES)


def test_penalty_shrinks(cells):
    size = [sum(v * v for v in mdl.coefficients(mdl.fit_glm(cells, FEATURES, alpha=a)).values()) for a in (0.0, 5.0, 50.0)]
    assert size[0] > size[1] > size[2]


def test_relativities_multiply_to_the_prediction(cells):
    fit = mdl.fit_glm(cells, FEATURES, alpha=0.1)
    table = {r["FEATURE"]: r["RELATIVITY"] for r in mdl.relativities(fit, cells, {f: [f] for f in FEATURES}).collect()}
    row = fit.predict(cells.where("A = 1 AND C = 1 AND B = 0")).first()
    assert math.isclose(row[PREDICTED], table["BASE_RATE"] * table["A"] * table["C"], rel_tol=1e-9)
    grouped = mdl.relativities(fit, cells, {"AC": ["A", "C"], "B": ["B"]}).where("FACTOR = 'AC'").collect()
    assert [r["RELATIVITY"] for r in grouped if r["IS_BASE"]] == [1.0]


def test_predict_keeps_rows_and_columns(cells):
    fit = mdl.fit_glm(cells, FEATURES)
    out = fit.predict(cells)
    assert out.columns == [*cells.columns, PREDICTED]
    assert out.count() == cells.count()


def test_rows_without_target_or_exposure_are_not_learned_from(cells):
    fit = mdl.fit_glm(cells, FEATURES, alpha=0.1)
    extra = cells.limit(20).withColumns({"EXPOSURE": F.lit(0.0), "PURE_PREMIUM": F.lit(None).cast("double")})
    again = mdl.fit_glm(cells.unionByName(extra), FEATURES, alpha=0.1)
    a, b = mdl.coefficients(fit), mdl.coefficients(again)
    assert all(abs(a[f] - b[f]) < 1e-9 for f in FEATURES)


def test_models_survive_saving(spark, cells):
    for fit in (mdl.fit_glm(cells, FEATURES), mdl.fit_gbt(cells, FEATURES, rounds=2), mdl.fit_freq_sev(cells, FEATURES)):
        path = scratch_path(spark, "fit")
        fit.save(path)
        again = mdl.Fit.load(path, fit.describe())
        assert again.features == FEATURES and again.kind == fit.kind
        before = {r["POLICY_ID"]: r[PREDICTED] for r in fit.predict(cells).select("POLICY_ID", PREDICTED).collect()}
        after = {r["POLICY_ID"]: r[PREDICTED] for r in again.predict(cells).select("POLICY_ID", PREDICTED).collect()}
        assert before == after


def test_cross_validation_on_cells_equals_policies(cells):
    plain = mdl.cross_validate(cells, FEATURES, k=3, alphas=[0.2]).orderBy("FOLD").collect()
    grouped = mdl.cross_validate(cells, FEATURES, k=3, alphas=[0.2], collapse=True).orderBy("FOLD").collect()
    assert [r["FOLD"] for r in plain] == [0, 1, 2]
    assert np.allclose([r["RMSE"] for r in plain], [r["RMSE"] for r in grouped], rtol=1e-8)
    summary = mdl.cv_summary(mdl.cross_validate(cells, FEATURES, k=3, alphas=[0.2], collapse=True)).first()
    assert math.isclose(summary["CV_RMSE_STD"], np.std([r["RMSE"] for r in plain]), rel_tol=1e-6)


def test_two_stage_balances(cells):
    fit = mdl.fit_freq_sev(cells, FEATURES)
    out = fit.predict(cells).agg(
        F.sum(F.col(PREDICTED) * F.col("EXPOSURE")).alias("p"), F.sum("CLAIM_AMOUNT").alias("y")
    ).first()
    assert abs(out["p"] / out["y"] - 1) < 0.02


def test_boosting(cells):
    fit = mdl.fit_gbt(cells, ["A", "B", "C"], rounds=6)
    losses = [r["LOSS"] for r in mdl.evaluation_curve(fit, cells).orderBy("ROUND").collect()]
    assert len(losses) == 6 and all(b <= a * (1 + 1e-12) for a, b in zip(losses, losses[1:]))
    plain = mdl.fit_gbt(cells, ["A", "B", "C"], rounds=2, weight=None)
    a = fit.predict(cells).agg(F.sum(PREDICTED)).first()[0]
    b = plain.predict(cells).agg(F.sum(PREDICTED)).first()[0]
    assert a != b


def test_degenerate_targets_are_refused(cells):
    with pytest.raises(ValueError, match="positive weighted mean"):
        mdl.fit_glm(cells.withColumn("PURE_PREMIUM", F.lit(0.0)), FEATURES)
    with pytest.raises(ValueError, match="varies"):
        mdl.fit_glm(cells, ["EMPTY"])


def test_lift_adds_up(scored):
    lift = double_lift(scored, {"s": "SCORE", "d": "DENSITY"})
    total = scored.agg(F.sum("EXPOSURE")).first()[0]
    for row in lift.groupBy("MODEL").agg(F.sum("EXPOSURE").alias("e"), F.sum("POLICIES").alias("n")).collect():
        assert math.isclose(row["e"], total, rel_tol=1e-12) and row["n"] == scored.count()
    assert lift_calibration(lift).where("DECILE = 1 AND NOT PREDICTED_RISES").count() == 0
    assert lift_calibration(lift).where("MODEL = 's' AND NOT PREDICTED_RISES").count() == 0


def test_lift_of_a_constant_score_is_one_class(scored):
    flat = double_lift(scored.withColumn("K", F.lit(5.0)), {"k": "K"}).collect()
    assert [r["DECILE"] for r in flat] == [1]


def test_perfect_model_has_no_error(scored):
    row = metrics(scored, {"self": "PURE_PREMIUM"}).first()
    assert row["RMSE"] == row["MAE"] == row["RMSE_WEIGHTED"] == 0.0
    best = {r["MODEL"]: r for r in compare_models(scored, {"self": "PURE_PREMIUM", "s": "SCORE"}).collect()}
    assert best["self"]["GINI"] > best["s"]["GINI"] and best["self"]["WORST_GAP"] < 1e-6


@pytest.mark.parametrize("weight", [mdl.WEIGHT, None])
def test_fit_ends_with_the_best_round_on_watched_rows(spark, weight):
    rows = spark.range(1200).select(
        F.col("id").alias("POLICY_ID"), (F.rand(1) * 10).alias("A"), F.rand(2).alias("B"), F.rand(5).alias("C"),
        (0.2 + 0.8 * F.rand(4)).alias("EXPOSURE"),
    )
    rows = materialise(rows.withColumn("PURE_PREMIUM", F.col("A") + 5 * F.randn(7)), "watched")
    train, watch = rows.where("POLICY_ID % 3 > 0"), rows.where("POLICY_ID % 3 = 0")
    names, settings = ["A", "B", "C"], {"rounds": 25, "step": 0.3, "weight": weight}
    whole = mdl.fit_gbt(train, names, **settings)
    losses = [r["LOSS"] for r in mdl.evaluation_curve(whole, watch).orderBy("ROUND").collect()]
    best = next(i for i in range(1, len(losses) + 1) if i == len(losses) or losses[i] >= losses[i - 1])
    stopped = mdl.fit_gbt(train, names, watch=watch, **settings)
    assert stopped.params["best_round"] == best < 25
    kept = [r["LOSS"] for r in mdl.evaluation_curve(stopped, watch).orderBy("ROUND").collect()]
    assert kept == pytest.approx(losses[:best])


def test_boosted_trees_bound_the_rows_of_a_partition(cells, monkeypatch):
    rows = materialise(cells.coalesce(1), "one_partition")
    seen, fit = [], mdl.GBTRegressor.fit

    def watched(self, data):
        seen.append(data.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
        return fit(self, data)

    monkeypatch.setattr(mdl.GBTRegressor, "fit", watched)
    whole = mdl.fit_gbt(rows, ["A", "B", "C"], rounds=2)
    monkeypatch.setattr(mdl, "ROWS_PER_PARTITION", 100)
    split = mdl.fit_gbt(rows, ["A", "B", "C"], rounds=2, partitions=3)
    assert len(seen[0]) == 1 and len(seen[1]) == 15 and max(seen[1]) <= 110 and sum(seen[0]) == sum(seen[1])
    sums = [fit.predict(rows).agg(F.sum(PREDICTED)).first()[0] for fit in (whole, split)]
    assert sums[0] == pytest.approx(sums[1], rel=1e-12)


def test_boosted_trees_equal_those_of_spark(cells, monkeypatch):
    """The same trees as Spark's own fit where features have no more values than bins, on rows that are not sampled."""
    from pyspark.ml.regression import GBTRegressionModel

    from ratewright.operators import boosting

    df = cells.withColumn("D", (F.col("POLICY_ID") % 23 - 11).cast("double")).withColumn("E", F.col("A") * (F.col("POLICY_ID") % 3))
    names, passes, root = ["A", "B", "C", "D", "E"], [], boosting._Booster.root
    monkeypatch.setattr(boosting._Booster, "root", lambda self, *a: passes.append(1) or root(self, *a))
    monkeypatch.setattr(boosting, "BLOCK", 200)  # several blocks
    folder = f"{shared_dir(df.sparkSession)}/ratewright/{df.sparkSession.sparkContext.applicationId}"
    before = set(os.listdir(folder))
    ours = {weight: mdl.fit_gbt(df, names, rounds=12, weight=weight) for weight in ("EXPOSURE", None)}
    assert len(passes) == 26  # one for the first root, then one a tree
    assert not [name for name in set(os.listdir(folder)) - before if name.startswith("boosted_rows")]
    monkeypatch.setattr(boosting.BlockGBTRegressor, "_fit", mdl.GBTRegressor._fit)
    for weight, fit in ours.items():
        theirs = mdl.fit_gbt(df, names, rounds=12, weight=weight)
        a, b = (next(s for s in f.pipeline.stages if isinstance(s, GBTRegressionModel)) for f in (fit, theirs))
        assert a.treeWeights == b.treeWeights and a.numFeatures == b.numFeatures == 5
        assert a.getLabelCol() == b.getLabelCol() and a.getStepSize() == b.getStepSize()
        importances = [m.featureImportances.toArray()[1:4] for m in (a, b)]  # splits on A and on E may tie
        assert np.allclose(*importances, atol=1e-6)
        got, want = ({r["POLICY_ID"]: r[PREDICTED] for r in f.predict(df).collect()} for f in (fit, theirs))
        assert got == {k: pytest.approx(v, rel=1e-9) for k, v in want.items()}


def test_bins_of_many_values(spark):
    """Summaries keep the weight and the order of values, and thresholds share the weight."""
    from ratewright.operators import boosting

    draw = np.random.default_rng(5)
    value, weight = np.round(draw.normal(size=50_000), 3), draw.uniform(0.1, 1, 50_000)
    parts = []
    for k in range(5):
        summary = boosting._Summary([(np.empty(0), np.empty(0))], np.zeros((1, 1), bool))
        for j in range(0, 10_000, 1000):
            v, w = (x[10_000 * k + j :][:1000] for x in (value, weight))
            on = np.flatnonzero(v)
            summary.take(1000, on, np.zeros(len(on), "int64"), v[on], w)
        parts.append(summary)
    whole = parts[0]
    for other in parts[1:]:
        whole = whole.merge(other)
    edges, from_zero = whole.edges(32)
    assert len(edges[0]) == 31 and not from_zero[0] and whole.rows == 50_000
    shares = np.array([weight[value <= e].sum() for e in edges[0]]) / weight.sum()
    assert np.abs(shares - np.arange(1, 32) / 32).max() < 0.004


def test_missing_values_are_refused_by_boosted_trees(cells):
    with pytest.raises(Exception, match="NaN|missing|null|NULL"):
        mdl.fit_gbt(cells.withColumn("A", F.when(F.col("A") > 0, F.col("A"))), ["A", "B"], rounds=1)
