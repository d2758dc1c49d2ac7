import numpy as np
import pytest
from pyspark.sql import functions as F

from plan_text import explained
from ratewright.functions.ordered import approximate_quantiles, exact_quantiles, order_buckets
from ratewright.operators.diagnostics import gini, lorenz

POINTS = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of ``tied`` is one value; ``wild`` spans magnitudes; ``holes`` has NULL and NaN."""
    return spark.range(6000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("tied"),
        F.exp((F.col("id") * 104729 % 6000) / 400).alias("wild"),
        F.when(F.col("id") % 5 == 0, None)
        .when(F.col("id") % 5 == 1, float("nan"))
        .otherwise((F.col("id") % 11).cast("double"))
        .alias("holes"),
        F.lit(None).cast("double").alias("nothing"),
        F.lit(3).alias("constant"),
    )


@pytest.mark.parametrize("window_rows", [10**6, 1000, 5])
def test_exact_quantiles_equal_numpy(numbers, window_rows):
    columns = ["tied", "wild", "holes", "nothing", "constant"]
    ours = exact_quantiles(numbers, columns, POINTS, window_rows=window_rows)
    local = numbers.toPandas()
    for c in columns:
        values = local[c].dropna().to_numpy(dtype=float)
        expected = np.quantile(values, POINTS) if len(values) else []
        assert np.allclose(ours[c], expected, rtol=1e-12)


def test_narrow_brackets_only_cost_passes(numbers):
    wide = exact_quantiles(numbers, ["wild"], POINTS, window_rows=20, bracket=0.2)
    tight = exact_quantiles(numbers, ["wild"], POINTS, window_rows=20, bracket=0.0)
    assert wide == tight


def test_approximate_quantiles_are_observed_values_near_the_rank(numbers):
    median = approximate_quantiles(numbers, ["wild"], [0.5])["wild"][0]
    values = np.sort(numbers.select("wild").toPandas()["wild"].to_numpy())
    rank = np.searchsorted(values, median) + 1
    assert median in values and abs(rank - 3000) <= 6


def test_buckets_keep_the_order_and_split_ties(numbers):
    rows = order_buckets(numbers.select("k", "tied"), "tied", "k", cuts=64).toPandas()
    by_bucket = rows.sort_values(["bucket", "part", "tied", "k"])
    by_value = rows.sort_values(["tied", "k"])
    assert (by_bucket["k"].to_numpy() == by_value["k"].to_numpy()).all()
    ties = rows[rows["tied"] == 7.0]
    assert ties["part"].nunique() >= 10
    largest = rows.groupby(["bucket", "part"]).size().max()
    assert largest < len(rows) / 20


@pytest.mark.parametrize("lowest", [0.05, 0.12, 0.5])
def test_ties_on_a_range_of_keys_are_split_among_themselves(spark, lowest):
    """A score tied on a contiguous range of keys, as new business with one default score."""
    count, cuts = 20_000, 64
    tied = F.when(F.col("k") < lowest * count, 7.0).otherwise((F.col("k") * 7919 % count).cast("double"))
    rows = order_buckets(spark.range(count).toDF("k").withColumn("tied", tied), "tied", "k", cuts=cuts).toPandas()
    by_bucket = rows.sort_values(["bucket", "part", "tied", "k"])
    assert (by_bucket["k"].to_numpy() == rows.sort_values(["tied", "k"])["k"].to_numpy()).all()
    assert rows.groupby(["bucket", "part"]).size().max() <= 2 * count / cuts


def test_infinite_values_are_refused(spark):
    df = spark.range(9).select(F.when(F.col("id") == 3, float("inf")).otherwise(F.col("id").cast("double")).alias("x"), "id")
    with pytest.raises(ValueError, match="infinite"):
        exact_quantiles(df, ["x"], [0.5])
    with pytest.raises(ValueError, match="infinite"):
        order_buckets(df, "x", "id")


def _curve(local, score):
    local = local.sort_values([score, "k"])
    exposure, claims = local["w"].to_numpy(), (local["y"] * local["w"]).to_numpy()
    return local["k"].to_numpy(), np.cumsum(exposure) / exposure.sum(), np.cumsum(claims) / claims.sum()


@pytest.mark.parametrize("cuts", [None, 16, 64])
def test_lorenz_and_gini_equal_numpy(numbers, cuts, monkeypatch):
    import ratewright.operators.diagnostics as dia
    import ratewright.functions.ordered as ordered

    if cuts:
        monkeypatch.setattr(
            dia, "order_buckets", lambda df, v, k, c: ordered.order_buckets(df, v, k, cuts=cuts)
        )
    df = numbers.withColumns({"y": F.col("wild"), "w": 0.1 + (F.col("k") % 10) / 10.0})
    keys, exposure, claims = _curve(df.toPandas(), "tied")
    curve = lorenz(df, "tied", "y", "w", "k").toPandas().sort_values("RANK")
    assert (curve["k"].to_numpy() == keys).all()
    assert (curve["RANK"].to_numpy() == np.arange(1, len(keys) + 1)).all()
    assert np.allclose(curve["CUM_EXPOSURE"], exposure, atol=1e-12)
    assert np.allclose(curve["CUM_CLAIMS"], claims, atol=1e-12)
    area = np.trapezoid(claims, exposure)
    row = gini(df, {"m": "tied"}, "y", "w", "k").first()
    assert abs(row["AUC"] - area) < 1e-12 and abs(row["GINI"] - (1 - 2 * area)) < 1e-12
    whole = gini(df, {"m": "tied"}, "y", "w", "k", include_origin=True).first()
    assert abs(whole["AUC"] - np.trapezoid([0, *claims], [0, *exposure])) < 1e-12


def test_gini_properties(scored):
    table = {r["MODEL"]: r["GINI"] for r in gini(scored, {"s": "SCORE", "oracle": "PURE_PREMIUM"}).collect()}
    stretched = scored.withColumn("T", F.exp(F.col("SCORE") / 100))
    monotone = gini(stretched, {"t": "T"}).first()["GINI"]
    assert table["oracle"] > table["s"] and abs(table["s"]) < 0.1
    assert abs(monotone - table["s"]) < 1e-12


def test_gini_without_claims_is_null(scored):
    assert gini(scored.withColumn("PURE_PREMIUM", F.lit(0.0)), {"s": "SCORE"}).first()["GINI"] is None


def test_only_group_totals_meet_in_one_partition(numbers, monkeypatch):
    import ratewright.operators.diagnostics as dia
    import ratewright.functions.ordered as ordered

    monkeypatch.setattr(
        dia, "order_buckets", lambda df, v, k, c: ordered.order_buckets(df, v, k, cuts=16)
    )
    df = numbers.withColumns({"y": F.col("wild"), "w": F.lit(1.0)})
    plan = explained(lorenz(df, "tied", "y", "w", "k"), "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # single-partition exchanges sit above the per-group aggregate, never above policy rows
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert any("HashAggregate(keys=[bucket" in below for below in lines[i + 1 : i + 4])
