"""Per-policy attributions: GLM contributions and Shapley values of boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.operators.diagnostics import PREDICTED
from ratewright.operators.models import Fit, _stage, coefficients
from ratewright.storage import scratch_path

SUFFIX = "_explanation"
BASELINE = "BASELINE"


def explanation_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.endswith(SUFFIX)]


def explain(fit: Fit, df: DataFrame, background: DataFrame | None = None, keep: Sequence[str] = ("POLICY_ID",)) -> DataFrame:
    """``keep`` columns, BASELINE and one ``<FEATURE>_explanation`` column per feature.

    For a GLM the columns add up to the linear predictor (log scale), with contributions measured
    against the mean of ``background`` (default: ``df``). For boosted trees they add up to the
    prediction itself, and the baseline is the mean over the training rows.
    """
    if fit.kind == "glm":
        return _explain_glm(fit, df, df if background is None else background, keep)
    if fit.kind == "gbt":
        return _explain_trees(fit, df, keep)
    raise ValueError(f"no attribution for a {fit.kind} model")


def _explain_glm(fit: Fit, df: DataFrame, background: DataFrame, keep: Sequence[str]) -> DataFrame:
    beta = coefficients(fit)
    means = background.agg(*[F.avg(f).alias(f) for f in fit.features]).first()
    baseline = fit.params["intercept"] + sum(beta[f] * means[f] for f in fit.features)
    return df.select(
        *keep,
        F.lit(baseline).alias(BASELINE),
        *[(F.lit(beta[f]) * (F.col(f) - F.lit(means[f]))).alias(f"{f}{SUFFIX}") for f in fit.features],
    )


def tree_nodes(fit: Fit, spark) -> list[list[dict]]:
    """Nodes per tree of a boosted model, read from the model's own saved form. Their number is
    rounds times at most 63, whatever the training data."""
    from pyspark.ml.regression import GBTRegressionModel

    path = scratch_path(spark, "trees")
    _stage(fit, GBTRegressionModel).write().save(path)
    rows = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            "nodeData.id",
            "nodeData.prediction",
            F.element_at("nodeData.impurityStats", 1).alias("weight"),
            "nodeData.leftChild",
            "nodeData.rightChild",
            "nodeData.split.featureIndex",
            F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        )
        .orderBy("treeID", "id")
        .collect()
    )
    trees: list[list[dict]] = []
    for row in rows:
        if row["treeID"] == len(trees):
            trees.append([])
        trees[row["treeID"]].append(row.asDict())
    return trees


def leaf_games(trees: list[list[dict]], tree_weights: Sequence[float]) -> tuple[float, list[tuple]]:
    """Turn every leaf into a small game over the features on its path.

    With the features in a set S known, a leaf is reached with the product of 1 or 0 for known
    features (the row obeys the leaf's interval for that feature or not) and of training-weight
    shares for the others. Returns the mean prediction and, per leaf: feature indexes, interval
    bounds, and the Shapley values for every obey/disobey pattern as a table.
    """
    games, baseline = [], 0.0
    for nodes, tree_weight in zip(trees, tree_weights):
        by_id = {n["id"]: n for n in nodes}
        pending = [(0, {})]
        while pending:
            node_id, path = pending.pop()
            node = by_id[node_id]
            if node["leftChild"] < 0:
                value = tree_weight * node["prediction"]
                shares = np.array([p[2] for p in path.values()])
                baseline += value * float(np.prod(shares))
                if path:
                    bounds = np.array([[p[0], p[1]] for p in path.values()])
                    games.append((np.array(list(path)), bounds[:, 0], bounds[:, 1], value * shapley_table(shares)))
                continue
            f, cut = node["featureIndex"], node["threshold"]
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            for child, interval in (
                (node["leftChild"], (low, min(high, cut))),
                (node["rightChild"], (max(low, cut), high)),
            ):
                passed = by_id[child]["weight"] / node["weight"] if node["weight"] else 0.0
                pending.append((child, {**path, f: (*interval, share * passed)}))
    return baseline, games


def shapley_table(shares: np.ndarray) -> np.ndarray:
    """Shapley values of the game prod(o_k for known k) * prod(z_k for others), for each of the
    2**d patterns o of zeros and ones; row = pattern read as a binary number.

    The Shapley value of player j is the integral over t in [0, 1] of
    ``(o_j - z_j) * prod over k != j of (t * o_k + (1 - t) * z_k)``, a polynomial in t that
    Gauss-Legendre nodes integrate exactly.
    """
    d = len(shares)
    patterns = (np.arange(2**d)[:, None] >> np.arange(d)) & 1
    nodes, node_weights = np.polynomial.legendre.leggauss(d // 2 + 1)
    table = np.zeros((2**d, d))
    for node, w in zip((nodes + 1) / 2, node_weights / 2):
        mixed = node * patterns + (1 - node) * shares
        for j in range(d):
            table[:, j] += w * np.prod(np.delete(mixed, j, axis=1), axis=1)
    return table * (patterns - shares)


def merged_games(games: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """(conditions, games) with the games of leaves that ask a row the same questions added up. A condition is (feature,
    low, high); not to be above a cut and to be above it are one, read the other way round. A game is its conditions' places, its
    features and a table of Shapley values, a row for each feature and an entry for each pattern of answers."""
    conditions, sums = {}, {}
    for index, low, high, table in games:
        turned = (high == np.inf) & (low > -np.inf)
        asked = [(int(f), *((-np.inf, a) if t else (a, b))) for f, a, b, t in zip(index, low, high, turned)]
        places = np.array([conditions.setdefault(c, len(conditions)) for c in asked])
        order = np.argsort(places)
        bits = 1 << np.arange(len(order))
        answers = np.arange(1 << len(order))[:, None] & bits > 0
        pattern = (answers ^ turned[order]) @ (1 << order)  # of the leaf's own table
        key = tuple(places[order].tolist())
        found = np.ascontiguousarray(table[pattern][:, order].T)
        sums[key] = sums[key] + found if key in sums else found
    asked = list(conditions)
    return asked, [(key, [asked[c][0] for c in key], table) for key, table in sums.items()]


def _explain_trees(fit: Fit, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    from pyspark.ml.regression import GBTRegressionModel

    spark = df.sparkSession
    model = _stage(fit, GBTRegressionModel)
    baseline, games = leaf_games(tree_nodes(fit, spark), model.treeWeights)
    # a few numbers per leaf: bounded by the model, not by the portfolio
    shared = spark.sparkContext.broadcast(merged_games(games))
    features, keep = list(fit.features), list(keep)
    rows = df.select(*keep, *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    out = [rows.schema[c] for c in keep]
    out += [T.StructField(f"{f}{SUFFIX}", T.DoubleType()) for f in features]

    def attribute(batches):
        import numpy as np
        import pandas as pd

        conditions, merged = shared.value
        for batch in batches:
            x = [batch[f"_f{i}"].to_numpy(dtype=float) for i in range(len(features))]
            obeys = [((x[f] > low) & (x[f] <= high)).astype(np.intp) for f, low, high in conditions]
            phi = np.zeros((len(features), len(batch)))
            for asked, index, table in merged:
                pattern = obeys[asked[0]].copy()
                for k, c in enumerate(asked[1:], start=1):
                    pattern += obeys[c] << k
                for f, values in zip(index, table):
                    phi[f] += values.take(pattern)
            result = pd.DataFrame(phi.T, columns=[f"{f}{SUFFIX}" for f in features], index=batch.index)
            yield pd.concat([batch[keep], result], axis=1)

    explained = rows.mapInPandas(attribute, T.StructType(out))
    return explained.select(*keep, F.lit(baseline).alias(BASELINE), *[f"{f}{SUFFIX}" for f in features])


def _ranked_factors(columns: Sequence[str], k: int):
    entries = F.array(
        *[
            F.struct(
                (-F.abs(F.col(c))).alias("order"),
                F.lit(c.removesuffix(SUFFIX)).alias("FEATURE"),
                F.col(c).alias("CONTRIBUTION"),
            )
            for c in columns
        ]
    )
    return F.slice(F.array_sort(entries), 1, k)


def top_factors(explained: DataFrame, k: int = 5, keep: Sequence[str] = ("POLICY_ID",)) -> DataFrame:
    """(keep, RANK, FEATURE, CONTRIBUTION): the ``k`` largest contributions of each policy by
    size, ties by feature name. Ranked inside the row, so nothing is shuffled."""
    ranked = explained.select(*keep, F.posexplode(_ranked_factors(explanation_columns(explained.columns), k)))
    return ranked.select(*keep, (F.col("pos") + 1).alias("RANK"), "col.FEATURE", "col.CONTRIBUTION")


def explain_policy(
    fit: Fit, df: DataFrame, policy, key: str = "POLICY_ID", background: DataFrame | None = None
) -> DataFrame:
    """(key, RANK, FEATURE, CONTRIBUTION) of the policy picked by its key, every feature, largest first. The
    key filter comes before the attribution, so no other row is explained; the mean contributions of a GLM are
    measured against are those of ``background`` (default: ``df``). No row where no policy has the key."""
    picked = explain(fit, df.where(F.col(key) == F.lit(policy)), df if background is None else background, keep=[key])
    return top_factors(picked, len(fit.features), keep=[key])


def global_importance(explained: DataFrame) -> DataFrame:
    """(FEATURE, IMPORTANCE): mean absolute contribution; one aggregate row, then turned."""
    columns = explanation_columns(explained.columns)
    totals = explained.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in columns])
    entries = [
        F.struct(F.lit(c.removesuffix(SUFFIX)).alias("FEATURE"), F.col(c).alias("IMPORTANCE")) for c in columns
    ]
    return totals.select(F.inline(F.array(*entries)))


def additivity(fit: Fit, df: DataFrame, key: str = "POLICY_ID") -> DataFrame:
    """(key, EXPLAINED, PREDICTED): attributions plus baseline next to the model's own output, both
    computed on the same row."""
    explained = explain(fit, fit.predict(df), keep=[key, PREDICTED])
    total = F.col(BASELINE)
    for c in explanation_columns(explained.columns):
        total = total + F.col(c)
    if fit.kind == "glm":
        total = F.exp(total)
    return explained.select(key, total.alias("EXPLAINED"), F.col(PREDICTED).alias("PREDICTED"))
