from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.operators import explain as exp
from ratewright.operators import models as mdl


def shapley(players, value):
    """By definition, over all subsets."""
    n, result = len(players), {}
    for j in players:
        others = [p for p in players if p != j]
        result[j] = sum(
            factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (value({*s, j}) - value(set(s)))
            for size in range(n)
            for s in combinations(others, size)
        )
    return result


@pytest.mark.parametrize("d", [1, 2, 3, 5])
def test_table_equals_the_definition(d):
    shares = np.random.default_rng(d).uniform(0.05, 0.95, d)
    table = exp.shapley_table(shares)
    for pattern in range(2**d):
        obeys = [(pattern >> k) & 1 for k in range(d)]
        expected = shapley(range(d), lambda s: np.prod([obeys[k] if k in s else shares[k] for k in range(d)]))
        assert np.allclose(table[pattern], [expected[j] for j in range(d)])


@pytest.fixture(scope="module")
def small(spark):
    df = spark.range(400).select(
        F.col("id").alias("POLICY_ID"),
        (F.col("id") * 37 % 11).cast("double").alias("X"),
        (F.col("id") * 53 % 7).cast("double").alias("Y"),
        (F.col("id") * 71 % 3).cast("double").alias("Z"),
        (0.2 + (F.col("id") % 9) / 10).alias("EXPOSURE"),
    )
    return df.withColumn("PURE_PREMIUM", F.col("X") * F.col("Y") + 5 * F.col("Z") * (F.col("X") > 5).cast("int"))


def test_tree_attributions_equal_brute_force(small, spark):
    names = ["X", "Y", "Z"]
    fit = mdl.fit_gbt(small, names, rounds=4, depth=4, step=0.3)
    trees = exp.tree_nodes(fit, spark)
    weights = fit.pipeline.stages[1].treeWeights

    def expected(nodes, node, x, known):
        if node["leftChild"] < 0:
            return node["prediction"]
        left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
        f = node["featureIndex"]
        if f in known:
            return expected(nodes, left if x[f] <= node["threshold"] else right, x, known)
        return sum(c["weight"] / node["weight"] * expected(nodes, c, x, known) for c in (left, right))

    rows = exp.explain(fit, small, keep=["POLICY_ID", *names]).where("POLICY_ID < 40").collect()
    indexed = [{n["id"]: n for n in nodes} for nodes in trees]
    for row in rows:
        x = [row[n] for n in names]

        def value(known):
            return sum(w * expected(nodes, nodes[0], x, known) for nodes, w in zip(indexed, weights))

        truth = shapley(range(3), value)
        assert np.isclose(row["BASELINE"], value(set()))
        assert np.allclose([row[f"{n}_explanation"] for n in names], [truth[j] for j in range(3)])


def test_attributions_add_up(small):
    names = ["X", "Y", "Z"]
    for fit in (mdl.fit_gbt(small, names, rounds=3), mdl.fit_glm(small, names)):
        sums = exp.additivity(fit, small)
        worst = sums.agg(F.max(F.abs(F.col("EXPLAINED") - F.col("PREDICTED")) / (1 + F.abs("PREDICTED")))).first()[0]
        assert sums.count() == small.count() and worst < 1e-9


def test_top_factors_and_importance(spark):
    rows = [(1, 0.5, -2.0, 0.1), (2, -1.0, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "POLICY_ID long, A_explanation double, B_explanation double, C_explanation double")
    top = [tuple(r) for r in exp.top_factors(df, 2).orderBy("POLICY_ID", "RANK").collect()]
    assert top == [(1, 1, "B", -2.0), (1, 2, "A", 0.5), (2, 1, "C", 3.0), (2, 2, "A", -1.0)]
    importance = {r["FEATURE"]: r["IMPORTANCE"] for r in exp.global_importance(df).collect()}
    assert importance == {"A": 0.75, "B": 1.5, "C": 1.55}


def test_global_importance_explains_the_whole_ensemble(spark, sf_dir, monkeypatch):
    from workload.queries import QUERIES

    asked = []

    def fit(self, data):
        asked.append(self.getMaxIter())
        raise StopIteration

    monkeypatch.setattr(mdl.GBTRegressor, "fit", fit)
    for name in ("gbt_predictions", "tree_global_importance"):
        with pytest.raises(StopIteration):
            QUERIES[name](spark, sf_dir)
    assert asked == [200, 200]


def test_merged_games_equal_the_games_of_all_leaves():
    draw, games = np.random.default_rng(6), []
    for _ in range(300):
        index = draw.permutation(4)[: draw.integers(1, 4)]
        cut, side = draw.integers(0, 3, len(index)).astype(float), draw.integers(0, 3, len(index))
        low, high = np.where(side == 0, -np.inf, cut), np.where(side == 1, np.inf, cut + (side == 2))
        games.append((index, low, high, draw.normal(size=(1 << len(index), len(index)))))
    conditions, merged = exp.merged_games(games)
    assert len(merged) < len(games) / 1.2
    for x in draw.uniform(-1, 5, (50, 4)):
        plain, found = np.zeros(4), np.zeros(4)
        for index, low, high, table in games:
            plain[index] += table[((x[index] > low) & (x[index] <= high)) @ (1 << np.arange(len(index)))]
        for asked, index, table in merged:
            answers = [conditions[c][1] < x[f] <= conditions[c][2] for c, f in zip(asked, index)]
            found[index] += table[:, sum(a << k for k, a in enumerate(answers))]
        assert np.allclose(plain, found)
