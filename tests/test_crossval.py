import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.functions.columns import indicator
from ratewright.operators import crossval as cv
from ratewright.operators import models as mdl
from ratewright.operators.policy import add_targets
from ratewright.storage import materialise

FEATURES = ["A", "B", "C", "EMPTY"]


@pytest.fixture(scope="module")
def cells(policies):
    df = add_targets(policies).select(
        "POLICY_ID",
        "PURE_PREMIUM",
        "EXPOSURE",
        indicator(F.col("TERRITORY_CODE") == "ASIA").alias("A"),
        indicator(F.col("CONSTRUCTION_TYPE") == "BUILDING").alias("B"),
        indicator(F.col("CONSTRUCTION_QUALITY") <= 2).alias("C"),
        F.lit(0.0).alias("EMPTY"),
    )
    return materialise(df, "cells")


def errors(df):
    return {(r["ALPHA"], r["FOLD"]): r["RMSE"] for r in df.collect()}


def test_equals_fit_by_fit(cells):
    settings = {"k": 3, "alphas": [0.0, 0.1, 5.0]}
    one = errors(mdl.cross_validate(cells, FEATURES, **settings, refits=3))
    together = errors(cv.cross_validate_grid(cells, FEATURES, **settings))
    grouped = errors(cv.cross_validate_grid(cells, FEATURES, **settings, collapse=True))
    assert one.keys() == together.keys() == grouped.keys() and len(one) == 9
    assert all(abs(one[f] / together[f] - 1) < 1e-6 for f in one)
    assert all(abs(grouped[f] / together[f] - 1) < 1e-9 for f in one)


def test_coefficients_solve_the_penalised_equations(cells):
    fits = cv.fit_grid(cells, FEATURES, k=2, alphas=[0.3])
    rows = mdl.add_fold(mdl.usable_rows(cells, "PURE_PREMIUM", "EXPOSURE"), 2).toPandas()
    for fit in fits:
        mine = rows[rows["FOLD"] != fit.fold]
        x = np.column_stack([np.ones(len(mine)), mine[FEATURES].to_numpy(float)])
        y, w = mine["PURE_PREMIUM"].to_numpy(float), mine["EXPOSURE"].to_numpy(float)
        mu = np.exp(x @ fit.beta)
        pull = x.T @ (w * mu**-0.5 * (y - mu)) - 0.3 * w.sum() * np.r_[0.0, fit.beta[1:]]
        assert fit.converged and np.abs(pull).max() < 1e-7 * (np.abs(x.T) @ (w * mu**-0.5 * np.abs(y - mu))).max()


def test_jobs_grow_with_iterations_only(spark, cells, monkeypatch):
    passes = []
    real = cv._sums
    monkeypatch.setattr(cv, "_sums", lambda rows, fits, power: passes.append(len(fits)) or real(rows, fits, power))
    fits = cv.fit_grid(cells, FEATURES, k=5, alphas=[0.1, 1.0])
    assert passes[0] == 10 and len(passes) == max(f.iterations for f in fits) < 30


def test_collinear_levels_share_their_effect(cells):
    both = cells.withColumn("NOT_A", 1.0 - F.col("A"))
    one = errors(cv.cross_validate_grid(both, ["A"], k=2, alphas=[0.0]))
    two = errors(cv.cross_validate_grid(both, ["A", "NOT_A"], k=2, alphas=[0.0]))
    assert all(abs(one[f] / two[f] - 1) < 1e-9 for f in one)


def test_what_is_refused(cells):
    with pytest.raises(ValueError):
        cv.cross_validate_grid(cells.withColumn("PURE_PREMIUM", F.lit(0.0)), FEATURES)
    with pytest.raises(Exception, match="missing values"):
        cv.cross_validate_grid(cells.withColumn("A", F.lit(None).cast("double")), FEATURES, k=2)
