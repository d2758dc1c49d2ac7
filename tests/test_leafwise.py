import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.operators import leafwise as lw
from ratewright.operators import models as mdl
from ratewright.operators.diagnostics import PREDICTED
from ratewright.sources.store import PricingStore
from ratewright.storage import materialise, scratch_path

FEATURES = ["A", "B", "C", "FLAG", "EMPTY"]


def frame(spark, rows=400, seed=0, partitions=5):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 12, rows), rng.normal(size=rows).round(2), rng.integers(0, 3, rows)
    flag = (rng.random(rows) < 0.01).astype(int)
    y = 3.0 * (a > 4) + b * (c == 1) + 50 * flag + rng.normal(size=rows)
    w = rng.integers(1, 5, rows) / 4
    data = [(i, int(a[i]), float(b[i]), int(c[i]), int(flag[i]), 0.0, float(y[i]), float(w[i])) for i in range(rows)]
    df = spark.createDataFrame(data, "POLICY_ID long, A int, B double, C int, FLAG int, EMPTY double, PURE_PREMIUM double, EXPOSURE double")
    return materialise(df.repartition(partitions), "frame"), data


def plain_boosting(x, y, w, rounds, step, leaves, min_rows=1):
    """One leaf at a time over all values; returns predictions."""
    p = np.full(len(y), (w * y).sum() / w.sum())

    def best(rows):
        g, found = w[rows] * (y - p)[rows], None
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                low = x[rows, f] <= cut
                if min(low.sum(), (~low).sum()) < min_rows:
                    continue
                gain = g[low].sum() ** 2 / w[rows][low].sum() + g[~low].sum() ** 2 / w[rows][~low].sum()
                gain -= g.sum() ** 2 / w[rows].sum()
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, cut)
        return found

    for done in range(rounds):
        parts = [(np.arange(len(y)), best(np.arange(len(y))))]
        while len(parts) < leaves and any(s for _, s in parts):
            at = max((i for i, (_, s) in enumerate(parts) if s), key=lambda i: parts[i][1][0])
            rows, (_, f, cut) = parts.pop(at)
            low = x[rows, f] <= cut
            parts += [(rows[low], best(rows[low])), (rows[~low], best(rows[~low]))]
        add = np.zeros(len(y))
        for rows, _ in parts:
            add[rows] = (w * (y - p))[rows].sum() / w[rows].sum()
        p = p + (1.0 if done == 0 else step) * add
    return p


@pytest.mark.parametrize("weight, leaves, min_rows", [("EXPOSURE", 7, 1), (None, 31, 5), ("EXPOSURE", 2, 1)])
def test_equals_plain_growth(spark, monkeypatch, weight, leaves, min_rows):
    monkeypatch.setattr(lw, "REWRITE", 2)
    df, data = frame(spark, 200)  # fewer rows than bins, so every value is an edge
    x = np.array([r[1:6] for r in data], float)
    y, w = np.array([r[6] for r in data]), np.array([r[7] if weight else 1.0 for r in data])
    fit = lw.fit_leafwise(df, FEATURES, rounds=5, step=0.3, leaves=leaves, weight=weight, min_rows=min_rows, max_bins=256)
    assert all(len(e) <= 255 for e in lw.bin_edges(df, FEATURES, 256))
    got = {r["POLICY_ID"]: r[PREDICTED] for r in fit.predict(df).collect()}
    want = plain_boosting(x, y, w, 5, 0.3, leaves, min_rows)
    assert max(abs(got[i] - v) for i, v in enumerate(want)) < 1e-9
    assert all(t.leaves <= leaves for t in fit.trees)


def test_rare_flags_and_constants_have_edges(spark):
    df, _ = frame(spark)
    edges = lw.bin_edges(df, FEATURES, 8)
    assert edges[3].tolist() == [0.0] and edges[4].tolist() == [] and len(edges[0]) <= 8


def test_validation_stops_the_fit(spark):
    df, _ = frame(spark, 300)
    held = F.col("POLICY_ID") % 3 == 0
    fit = lw.fit_leafwise(df, FEATURES, rounds=40, step=0.8, leaves=16, validation=held, patience=3)
    losses = fit.params["val_loss"]
    assert len(fit.trees) == fit.params["best_round"] == int(np.argmin(losses)) + 1 < 40
    curve = [r["LOSS"] for r in mdl.evaluation_curve(fit, df.where(held)).orderBy("ROUND").collect()]
    assert np.allclose(curve, losses[: len(curve)], rtol=1e-12)
    apart = lw.fit_leafwise(df.where(~held), FEATURES, rounds=len(fit.trees), step=0.8, leaves=16)
    assert [t.threshold for t in apart.trees] == [t.threshold for t in fit.trees]
    whole = lw.fit_leafwise(df, FEATURES, rounds=3, validation=held)
    assert len(whole.params["val_loss"]) == len(whole.trees) == 3
    with pytest.raises(ValueError):
        lw.fit_leafwise(df, FEATURES, patience=2)


def test_registered_and_read_back(spark):
    df, _ = frame(spark, 120)
    fit = lw.fit_leafwise(df, FEATURES, rounds=3, leaves=5)
    store = PricingStore(spark, scratch_path(spark, "store"))
    store.register_model(fit, "GBM", "1", sample=df)
    again = store.get_model("GBM")
    assert again.trees == fit.trees and again.params == fit.params
    one = store.score_batch(again, df, scratch_path(spark, "scores"))
    assert sorted(map(str, one.collect())) == sorted(map(str, fit.predict(df).collect()))
    assert set(fit.importance()) == set(FEATURES) and fit.importance()["EMPTY"] == 0.0 < fit.importance()["FLAG"]


def test_what_is_refused(spark):
    df, _ = frame(spark, 50)
    with pytest.raises(ValueError):
        lw.fit_leafwise(df.where("false"), FEATURES)
    with pytest.raises(ValueError):
        lw.fit_leafwise(df, FEATURES, max_bins=300)
    fit = lw.fit_leafwise(df.withColumn("EXPOSURE", F.when(F.col("POLICY_ID") > 5, F.col("EXPOSURE"))), FEATURES, rounds=1)
    with pytest.raises(Exception, match="missing values"):
        fit.predict(df.withColumn("A", F.lit(None).cast("int"))).collect()


def test_exclusive_features_share_a_column(spark, monkeypatch):
    """Twelve indicators of one factor cost a byte a row, not twelve, and the trees are those of plain growth."""
    monkeypatch.setattr(lw, "REWRITE", 2)
    monkeypatch.setattr(lw, "BLOCK", 16)
    df, data = frame(spark, 200)
    names = [f"A{i}" for i in range(12)]
    df = materialise(df.withColumns({n: (F.col("A") == i).cast("double") for i, n in enumerate(names)}), "indicators")
    features = [*names, "B", "FLAG", "EMPTY"]
    bundles = lw.bundle(df, features, lw.bin_edges(df, features, 256))
    assert bundles.columns == [list(range(12)), [12], [13]]
    x = np.array([[*(float(r[1] == i) for i in range(12)), r[2], r[4], 0.0] for r in data])
    y, w = np.array([r[6] for r in data]), np.array([r[7] for r in data])
    fit = lw.fit_leafwise(df, features, rounds=5, step=0.3, leaves=9, max_bins=256)
    got = {r["POLICY_ID"]: r[PREDICTED] for r in fit.predict(df).collect()}
    want = plain_boosting(x, y, w, 5, 0.3, 9)
    assert max(abs(got[i] - v) for i, v in enumerate(want)) < 1e-9


def test_codes_fit_a_byte():
    bundles = lw.Bundles.deal([2, 200, 60, 1, 3], {(1, 4)})
    assert bundles.columns == [[0, 1], [2, 4]] and bundles.codes == [201, 62]
    bins = np.array([[0, 199, 0, 0, 0], [1, 0, 59, 0, 0], [0, 0, 0, 0, 2]], "uint8")
    codes = bundles.encode(bins)
    for f in (0, 1, 2, 4):
        for at in range(bundles.place[f][2] - 1):
            assert bundles.above(codes, f, at, np.arange(3)).tolist() == (bins[:, f] > at).tolist()
