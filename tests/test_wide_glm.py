import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.operators import models as mdl
from ratewright.operators import wide_glm as wide
from ratewright.operators.diagnostics import PREDICTED
from ratewright.storage import materialise


@pytest.fixture(scope="module")
def policies(spark):
    draw = np.random.default_rng(7)
    rows = [
        (int(i), f"r{i % 5}", f"b{draw.integers(9)}", float(draw.normal()), float(draw.gamma(1.2, 80.0)), float(draw.uniform(0.1, 1)))
        for i in range(1500)
    ]
    names = ["POLICY_ID", "REGION", "BROKER", "AGE", "PURE_PREMIUM", "EXPOSURE"]
    return materialise(spark.createDataFrame(rows, names).repartition(4), "policies")


def indicators(df, factors):
    names = []
    for f in factors:
        for level in sorted(r[0] for r in df.select(f).distinct().collect()):
            names.append(f"{f}_{level}")
            df = df.withColumn(names[-1], (F.col(f) == level).cast("double"))
    return df, names


def test_equals_the_usual_fit(policies):
    df, names = indicators(policies, ["REGION", "BROKER"])
    usual = mdl.fit_glm(df, [*names, "AGE"], alpha=0.3, refits=6, tol=1e-10)
    fit = wide.fit_wide_glm(policies, ["REGION", "BROKER"], ["AGE"], alpha=0.3)
    assert fit.params["converged"] and fit.params["features"] == len(names) + 1
    beta = mdl.coefficients(usual)
    for r in fit.coefficients().collect():
        name = r["FACTOR"] if r["LEVEL"] is None else f"{r['FACTOR']}_{r['LEVEL']}"
        expected = usual.params["intercept"] if name == "INTERCEPT" else beta[name]
        assert r["COEFFICIENT"] == pytest.approx(expected, abs=1e-5)


def test_one_way_gives_level_means(policies):
    fit = wide.fit_wide_glm(policies, ["REGION"], alpha=0.0)
    shown = fit.predict(policies).groupBy("REGION").agg(
        F.min(PREDICTED).alias("a"), F.max(PREDICTED).alias("b"), (F.sum(F.col("PURE_PREMIUM") * F.col("EXPOSURE")) / F.sum("EXPOSURE")).alias("m")
    )
    for r in shown.collect():
        assert r["a"] == r["b"] == pytest.approx(r["m"], rel=1e-6)


def test_ten_thousand_levels(spark):
    level = F.concat(F.lit("p"), (F.xxhash64("id") % 10_000).cast("string"))
    rows = spark.range(60_000).select(
        level.alias("POSTCODE"), (F.col("id") % 7).alias("AREA"), (F.rand(3) * 200).alias("PURE_PREMIUM"), F.lit(1.0).alias("EXPOSURE")
    )
    fit = wide.fit_wide_glm(materialise(rows, "postcodes"), ["POSTCODE", "AREA"], alpha=0.01, tol=1e-6)
    assert fit.params["features"] > 10_000 and fit.params["residual"] < 1e-6


def test_nulls_unknown_levels_and_clashing_names(spark, policies):
    odd = policies.withColumn("BROKER", F.when(F.col("POLICY_ID") % 3 > 0, F.col("BROKER"))).withColumn("slots", F.lit(1))
    odd = odd.withColumn("a.b", F.col("BROKER")).withColumn("AGE", F.when(F.col("POLICY_ID") != 4, F.col("AGE")))
    fit = wide.fit_wide_glm(odd, ["a.b"], ["AGE"])
    other = odd.withColumn("a.b", F.lit("nobody")).withColumn("AGE", F.lit(0.0))
    found = fit.predict(other)
    assert found.columns == [*odd.columns, PREDICTED] and found.count() == odd.count()
    assert {round(r[0], 9) for r in found.select(PREDICTED).distinct().collect()} == {round(float(np.exp(fit.beta[0])), 9)}
    with pytest.raises(ValueError):
        wide.fit_wide_glm(policies.limit(0), ["REGION"])


@pytest.mark.parametrize("few", [10_000, 145])
def test_levels_without_a_slot_give_the_same_fit(policies, monkeypatch, few):
    """The widest factor's levels, or those of few rows, are solved for where their rows are; NULL levels have no indicator."""
    odd = materialise(policies.withColumn("BROKER", F.when(F.col("POLICY_ID") % 7 > 0, F.col("BROKER"))), "odd")
    usual = wide.fit_wide_glm(odd, ["REGION", "BROKER"], ["AGE"], alpha=0.05, tol=1e-9)
    monkeypatch.setattr(wide, "MANY", 5)
    monkeypatch.setattr(wide, "FEW", few)
    monkeypatch.setattr(wide, "MAX_LEVELS", 13)
    fit = wide.fit_wide_glm(odd, ["REGION", "BROKER"], ["AGE"], alpha=0.05, tol=1e-9)
    assert fit.params["converged"] and fit.params["features"] == usual.params["features"] == 15
    slots = {r[0] for r in odd.where("BROKER IS NOT NULL").groupBy("BROKER").count().where(F.col("count") >= few).collect()}
    assert len(fit.beta) == 7 + len(slots) and (few == 10_000) == (not slots)
    want = {(r["FACTOR"], r["LEVEL"]): r["COEFFICIENT"] for r in usual.coefficients().collect()}
    got = {(r["FACTOR"], r["LEVEL"]): r["COEFFICIENT"] for r in fit.coefficients().collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-6
    both = fit.predict(odd).join(usual.predict(odd).select("POLICY_ID", F.col(PREDICTED).alias("p")), "POLICY_ID")
    assert both.agg(F.max(F.abs(F.col(PREDICTED) / F.col("p") - 1))).first()[0] < 1e-6
