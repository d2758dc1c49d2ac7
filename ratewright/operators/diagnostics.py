"""Model exhibits as distributed jobs: errors, double lift, Lorenz curve, Gini, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions.columns import as_column, cap, interval_index, weighted_mean
from ratewright.functions.ordered import exact_quantiles, order_buckets

OBSERVED = "PURE_PREMIUM"
PREDICTED = "PREDICTED_PURE_PREMIUM"
WEIGHT = "EXPOSURE"


def _per_model(df: DataFrame, predictions: Mapping[str, str], extra: Mapping[str, Column]) -> DataFrame:
    """Rows (MODEL, y, pred, w, ...) for every model; consumed by map-side combined aggregates, so
    the multiplied rows never reach a shuffle."""
    entries = [
        F.struct(
            F.lit(model).alias("MODEL"),
            F.col(column).cast("double").alias("pred"),
            *[make.alias(name) for name, make in extra.items()],
        )
        for model, column in predictions.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def metrics(
    df: DataFrame,
    predictions: Mapping[str, str] | None = None,
    observed: str = OBSERVED,
    weight: str = WEIGHT,
) -> DataFrame:
    """One row per model: RMSE and MAE, unweighted and exposure-weighted."""
    predictions = predictions or {"model": PREDICTED}
    rows = _per_model(df, predictions, {"y": F.col(observed), "w": F.col(weight)})
    error = F.col("y") - F.col("pred")
    return rows.groupBy("MODEL").agg(
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(weighted_mean(error * error, "w")).alias("RMSE_WEIGHTED"),
        weighted_mean(F.abs(error), "w").alias("MAE_WEIGHTED"),
    )


def decile_edges(df: DataFrame, columns: Sequence[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Distinct exact quantile edges per prediction column, lowest and highest value included."""
    points = [i / n_bins for i in range(n_bins + 1)]
    return {c: sorted(set(q)) for c, q in exact_quantiles(df, columns, points).items()}


def decile(c: str | Column, edges: Sequence[float]) -> Column:
    """1-based right-closed quantile class, the lowest edge belonging to the first one. Ties never
    straddle two classes, and repeated edges reduce the number of classes."""
    return interval_index(as_column(c), list(edges[1:-1])) + 1


def double_lift(
    df: DataFrame,
    predictions: Mapping[str, str] | None = None,
    observed: str = OBSERVED,
    weight: str = WEIGHT,
    n_bins: int = 10,
) -> DataFrame:
    """(MODEL, DECILE, PREDICTED, OBSERVED, EXPOSURE, POLICIES), means exposure-weighted. Every
    model cuts the portfolio at its own quantiles; all are computed in one pass."""
    predictions = predictions or {"model": PREDICTED}
    edges = decile_edges(df, list(dict.fromkeys(predictions.values())), n_bins)
    entries = [
        F.struct(
            F.lit(model).alias("MODEL"),
            decile(column, edges[column]).alias("DECILE"),
            F.col(column).cast("double").alias("pred"),
        )
        for model, column in predictions.items()
    ]
    rows = df.select(F.col(observed).alias("y"), F.col(weight).alias("w"), F.inline(F.array(*entries)))
    return (
        rows.where("DECILE IS NOT NULL")
        .groupBy("MODEL", "DECILE")
        .agg(
            weighted_mean("pred", "w").alias("PREDICTED"),
            weighted_mean("y", "w").alias("OBSERVED"),
            F.sum("w").alias("EXPOSURE"),
            F.count("*").alias("POLICIES"),
        )
    )


def lift_calibration(lift: DataFrame) -> DataFrame:
    """Reading aid for a lift table: gap per decile and whether both lines rise. The window runs
    over at most ``n_bins`` rows per model."""
    order = Window.partitionBy("MODEL").orderBy("DECILE")
    rises = {
        f"{c}_RISES": F.coalesce(F.col(c) >= F.lag(c).over(order), F.lit(True)) for c in ("PREDICTED", "OBSERVED")
    }
    return lift.withColumns(
        {
            "GAP": F.col("PREDICTED") - F.col("OBSERVED"),
            "RATIO": F.try_divide(F.col("PREDICTED"), F.col("OBSERVED")),
            **rises,
        }
    )


# -- Lorenz curve and Gini ---------------------------------------------------------------------


def _ranked_input(df: DataFrame, prediction, observed, weight, key, cuts) -> DataFrame:
    rows = df.select(
        F.col(key).alias("key"),
        F.col(prediction).cast("double").alias("pred"),
        F.col(weight).alias("e"),
        (F.col(observed) * F.col(weight)).alias("c"),
    ).where("pred IS NOT NULL AND NOT isnan(pred) AND e IS NOT NULL AND c IS NOT NULL")
    return order_buckets(rows, "pred", "key", cuts)


def lorenz(
    df: DataFrame,
    prediction: str = PREDICTED,
    observed: str = OBSERVED,
    weight: str = WEIGHT,
    key: str = "POLICY_ID",
    cuts: int | None = None,
) -> DataFrame:
    """One row per policy, safest first: RANK, CUM_EXPOSURE and CUM_CLAIMS as shares of their
    totals. Ties in the prediction are ordered by key.

    Running sums are taken inside order-preserving groups; each group then adds the totals of the
    groups before it, from a table of a few thousand rows.
    """
    rows = _ranked_input(df, prediction, observed, weight, key, cuts)
    everything = Window.orderBy("bucket", "part")
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("bucket", "part").agg(
        F.sum("e").alias("e"), F.sum("c").alias("c"), F.count("*").alias("n")
    )
    whole = Window.partitionBy()
    offsets = totals.select(
        "bucket",
        "part",
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in ("e", "c", "n")],
        *[F.sum(x).over(whole).alias(f"{x}_total") for x in ("e", "c")],
    )
    inside = Window.partitionBy("bucket", "part").orderBy("pred", "key").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select(
        "bucket",
        "part",
        "key",
        "pred",
        F.sum("e").over(inside).alias("e"),
        F.sum("c").over(inside).alias("c"),
        F.row_number().over(inside).alias("n"),
    )
    # one row per group: their number is bounded by the cuts, whatever the size of the portfolio
    # every group has its row; a left join keeps Spark from testing the bucket for NULL at the scan
    joined = running.join(F.broadcast(offsets), ["bucket", "part"], "left")
    return joined.select(
        F.col("key").alias(key),
        F.col("pred").alias("PREDICTION"),
        (F.col("n") + F.col("n_before")).cast("long").alias("RANK"),
        F.try_divide(F.col("e") + F.col("e_before"), F.col("e_total")).alias("CUM_EXPOSURE"),
        F.try_divide(F.col("c") + F.col("c_before"), F.col("c_total")).alias("CUM_CLAIMS"),
    )


def lorenz_display(curve: DataFrame, points: int = 200) -> DataFrame:
    """Thin a Lorenz curve for a chart: the last policy of each of ``points`` equal exposure slots,
    with the diagonal a random ranking would follow."""
    slot = F.least(F.floor(F.col("CUM_EXPOSURE") * points), F.lit(points - 1)).cast("int")
    thinned = curve.groupBy(slot.alias("POINT")).agg(
        F.max_by(F.struct("CUM_EXPOSURE", "CUM_CLAIMS"), "RANK").alias("p")
    )
    return thinned.select("POINT", "p.CUM_EXPOSURE", "p.CUM_CLAIMS", F.col("p.CUM_EXPOSURE").alias("RANDOM"))


def gini(
    df: DataFrame,
    predictions: Mapping[str, str] | None = None,
    observed: str = OBSERVED,
    weight: str = WEIGHT,
    key: str = "POLICY_ID",
    include_origin: bool = False,
    cuts: int | None = None,
) -> DataFrame:
    """(MODEL, AUC, GINI): trapezoid area under each Lorenz curve and ``1 - 2 * AUC``.

    The area starts at the first policy; ``include_origin`` starts it at (0, 0). Both are NULL when
    there are no claims. Each group of the ordering contributes its own area plus a rectangle
    below it, so the per-policy curve is never joined or sorted globally.
    """
    predictions = predictions or {"model": PREDICTED}
    result = None
    for model, column in predictions.items():
        row = _area(df, column, observed, weight, key, include_origin, cuts).select(
            F.lit(model).alias("MODEL"), "AUC", (1 - 2 * F.col("AUC")).alias("GINI")
        )
        result = row if result is None else result.unionByName(row)
    return result


def _area(df, prediction, observed, weight, key, include_origin, cuts) -> DataFrame:
    rows = _ranked_input(df, prediction, observed, weight, key, cuts)
    inside = Window.partitionBy("bucket", "part").orderBy("pred", "key").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("cc", F.sum("c").over(inside))
    groups = local.groupBy("bucket", "part").agg(
        F.sum("e").alias("e"),
        F.sum("c").alias("c"),
        F.sum(F.col("e") * (F.col("cc") - F.col("c") / 2)).alias("area"),
        F.min_by(F.struct("e", "c"), F.struct("pred", "key")).alias("first"),
    )
    order = Window.orderBy("bucket", "part")
    below = F.coalesce(F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    # a few thousand group rows from here on
    stacked = groups.select("bucket", "part", "e", "c", "first", (F.col("area") + F.col("e") * below).alias("area"))
    total = stacked.agg(
        F.sum("area").alias("area"),
        F.sum("e").alias("e"),
        F.sum("c").alias("c"),
        F.min_by("first", F.struct("bucket", "part")).alias("first"),
    )
    area = F.col("area")
    if not include_origin:
        area = area - F.col("first.e") * F.col("first.c") / 2
    return total.select(F.try_divide(area, F.col("e") * F.col("c")).alias("AUC"))


# -- portfolio exhibits ------------------------------------------------------------------------


def exposure_histogram(
    df: DataFrame, columns: Sequence[str], weight: str = WEIGHT, max_bins: int = 30
) -> DataFrame:
    """(COLUMN_NAME, BIN, LOWER, UPPER, EXPOSURE): ``min(max_bins, distinct values)`` equal-width
    bins per column, the last one closed. Empty bins are left out.

    Distinct values are counted exactly only where a sketch says they may be fewer than the bins.
    """
    summary = df.agg(
        *[
            f
            for i, c in enumerate(columns)
            for f in (
                F.min(c).cast("double").alias(f"min{i}"),
                F.max(c).cast("double").alias(f"max{i}"),
                F.approx_count_distinct(c).alias(f"n{i}"),
            )
        ]
    ).first()
    few = [i for i in range(len(columns)) if summary[f"n{i}"] <= 2 * max_bins]
    exact = df.agg(*[F.count_distinct(columns[i]).alias(f"n{i}") for i in few]).first() if few else {}
    entries = []
    for i, c in enumerate(columns):
        if summary[f"min{i}"] is None:
            continue
        low, high = summary[f"min{i}"], summary[f"max{i}"]
        bins = min(max_bins, exact[f"n{i}"]) if i in few else max_bins
        if low == high:
            low, high = low - 0.5, high + 0.5
        x = F.col(c).cast("double")
        slot = cap(F.floor((x - F.lit(low)) * bins / F.lit(high - low)), bins - 1).cast("int")
        entries.append(
            F.struct(
                F.lit(c).alias("COLUMN_NAME"),
                slot.alias("BIN"),
                (F.lit(low) + slot * F.lit((high - low) / bins)).alias("LOWER"),
                (F.lit(low) + (slot + 1) * F.lit((high - low) / bins)).alias("UPPER"),
            )
        )
    if not entries:
        raise ValueError("nothing to draw: every value is missing")
    return (
        df.select(F.col(weight).alias("w"), F.inline(F.array(*entries)))
        .where("BIN IS NOT NULL")
        .groupBy("COLUMN_NAME", "BIN", "LOWER", "UPPER")
        .agg(F.sum("w").alias("EXPOSURE"))
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(COLUMN_NAME, DISTINCT_VALUES), NULL not counted. One distinct over tagged values instead of
    one shuffle copy of the table per column."""
    tagged = F.inline(
        F.array(*[F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(c).cast("string").alias("v")) for c in columns])
    )
    distinct = df.select(tagged).where("v IS NOT NULL").distinct()
    return distinct.groupBy("COLUMN_NAME").agg(F.count("*").alias("DISTINCT_VALUES"))


def compare_models(
    df: DataFrame,
    predictions: Mapping[str, str],
    observed: str = OBSERVED,
    weight: str = WEIGHT,
    key: str = "POLICY_ID",
) -> DataFrame:
    """One row per model: errors, Gini and the lift between the outer deciles."""
    lift = double_lift(df, predictions, observed, weight)
    ends = lift.groupBy("MODEL").agg(
        F.try_divide(F.max_by("OBSERVED", "DECILE"), F.min_by("OBSERVED", "DECILE")).alias("LIFT_RATIO"),
        F.max(F.abs(F.col("PREDICTED") - F.col("OBSERVED"))).alias("WORST_GAP"),
    )
    return (
        metrics(df, predictions, observed, weight)
        .join(gini(df, predictions, observed, weight, key), "MODEL")
        .join(ends, "MODEL")
    )


def write_exhibits(df: DataFrame, model: str, path: str, prediction: str = PREDICTED) -> dict[str, str]:
    """Save lift, Lorenz points, Gini and errors of one scored frame below ``path``; returns the
    paths. ``df`` is read several times, so give a stored table rather than a long plan."""
    exhibits = {
        "double_lift": lift_calibration(double_lift(df, {model: prediction})),
        "lorenz": lorenz_display(lorenz(df, prediction)).withColumn("MODEL", F.lit(model)),
        "gini": gini(df, {model: prediction, "oracle": OBSERVED}),
        "metrics": metrics(df, {model: prediction}),
    }
    paths = {}
    for name, table in exhibits.items():
        paths[name] = f"{path.rstrip('/')}/{name}"
        table.write.mode("overwrite").parquet(paths[name])
    return paths
