"""Cross-validation of Tweedie GLMs over folds and penalties, all fits iterated together.

Each iteration is one pass over the rows: every row adds to the normal equations of all fits whose training rows it
belongs to, and to the held-out error of the others. Tasks send sums, whose size depends on features and fits
alone, so the number of jobs grows with the iterations, not with folds times penalties.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.operators.diagnostics import OBSERVED, WEIGHT
from ratewright.operators.models import CELLS_PER_PARTITION, collapse_cells, usable_rows
from ratewright.operators.splits import add_fold
from ratewright.storage import materialise

LARGEST_STEP = 4.0  # of a linear predictor in one iteration, on average over the rows


@dataclass
class GridFit:
    """One fit: its penalty, the fold it leaves out, coefficients (intercept first) and what the last pass found."""

    alpha: float
    fold: int
    beta: np.ndarray
    rmse: float | None = None
    iterations: int = 0
    converged: bool = False


def _rows(df: DataFrame, features: Sequence[str], k: int, label: str, weight: str, key: str, salt: str, collapse: bool) -> DataFrame:
    """FOLD, x, y, w and squares (the weighted squares of the target), written once for all passes."""
    rows = add_fold(usable_rows(df, label, weight), k, key, salt).select("FOLD", *features, label, weight)
    if collapse:
        rows = collapse_cells(rows, features, label, weight, ["FOLD"])
    else:
        rows = rows.withColumn("SQUARES", F.col(weight) * F.col(label) * F.col(label))
    wide = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features])
    rows = rows.select(
        F.col("FOLD").cast("int").alias("FOLD"), wide.alias("x"), F.col(label).cast("double").alias("y"),
        F.col(weight).cast("double").alias("w"), F.col("SQUARES").cast("double").alias("squares"),
    )
    table = materialise(rows, "folds")
    return table.coalesce(max(1, -(-table.count() // CELLS_PER_PARTITION))) if collapse else table


def _sums(rows: DataFrame, fits: Sequence[GridFit], power: float) -> np.ndarray:
    """By fit: the normal equations of the training rows (matrix, right side) and the held-out rows' weight and squared
    error, one after another."""
    width = len(fits[0].beta)
    folds = np.array([f.fold for f in fits])
    betas = np.column_stack([f.beta for f in fits])
    size = width * width + width + 2

    def batches(source):
        out = np.zeros((len(fits), size))
        for batch in source:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if np.isnan(x).any():
                raise ValueError("missing values in the features")
            fold = batch.column("FOLD").to_numpy()
            y, w, squares = (batch.column(c).to_numpy() for c in ("y", "w", "squares"))
            mu = np.exp(np.clip(x @ betas, -500, 500))
            for j in range(len(fits)):
                held = fold == folds[j]
                m = mu[:, j]
                working = np.where(held, 0.0, w * m ** (2 - power))
                target = np.log(m) + (y - m) / m
                weighted = x * working[:, None]
                out[j, : width * width] += (weighted.T @ x).ravel()
                out[j, width * width : -2] += weighted.T @ target
                out[j, -2] += w[held].sum()
                out[j, -1] += (squares - 2 * m * w * y + w * m * m)[held].sum()
        fit, at = np.nonzero(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(fit.astype("int32")), pa.array(at.astype("int32")), pa.array(out[fit, at])], names=["fit", "at", "s"]
        )

    parts = rows.mapInArrow(batches, "fit int, at int, s double")
    summed = parts.groupBy("fit", "at").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((len(fits), size))
    out[summed["fit"].to_numpy(), summed["at"].to_numpy()] = summed["s"].to_numpy()
    return out


def fit_grid(
    df: DataFrame,
    features: Sequence[str],
    k: int = 5,
    alphas: Sequence[float] = (0.1,),
    power: float = 1.5,
    label: str = OBSERVED,
    weight: str = WEIGHT,
    key: str = "POLICY_ID",
    salt: str = "fold42:",
    collapse: bool = False,
    max_iter: int = 100,
    tol: float = 1e-10,
) -> list[GridFit]:
    """Every fit of ``k`` folds and ``alphas``: a Tweedie GLM with log link whose ridge penalty ``alpha`` stands beside
    the mean weighted half-deviance, as in ``fit_glm``. A fit is done when its coefficients no longer move; collinear
    features without a penalty share their effect. Folds without training rows or claims are refused."""
    features = list(features)
    rows = _rows(df, features, k, label, weight, key, salt, collapse)
    by_fold = rows.groupBy("FOLD").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).collect()
    whole = {r["FOLD"]: (r["w"], r["wy"]) for r in by_fold}  # at most k rows
    fits, weights = [], []
    for alpha in alphas:
        for fold in range(k):
            w, wy = (sum(v[i] for f, v in whole.items() if f != fold) for i in (0, 1))
            if not wy or wy <= 0:
                raise ValueError("a log-link model needs a positive weighted mean of the target")
            beta = np.zeros(len(features) + 1)
            beta[0] = np.log(wy / w)
            fits.append(GridFit(float(alpha), fold, beta))
            weights.append(w)
    width = len(features) + 1
    for _ in range(max_iter):
        open_fits = [j for j, f in enumerate(fits) if not f.converged]
        if not open_fits:
            break
        sums = _sums(rows, [fits[j] for j in open_fits], power)
        for j, found in zip(open_fits, sums):
            fit = fits[j]
            fit.rmse = float(np.sqrt(max(found[-1], 0.0) / found[-2])) if found[-2] else None
            fit.iterations += 1
            matrix = found[: width * width].reshape(width, width)
            ridge = np.diag([0.0] + [fit.alpha * weights[j]] * (width - 1))
            # scaled to a unit diagonal, so that rare levels and large amounts solve alike
            scale = 1 / np.sqrt(np.maximum(np.diag(matrix + ridge), 1e-300))
            solved = np.linalg.lstsq((matrix + ridge) * scale * scale[:, None], found[width * width : -2] * scale, rcond=1e-12)[0]
            step = solved * scale - fit.beta
            moved = float(np.sqrt(max(step @ matrix @ step, 0.0) / max(matrix[0, 0], 1e-300)))
            if moved < tol * max(1.0, abs(float(fit.beta[0]))):
                fit.converged = True
                continue
            fit.beta = fit.beta + step * min(1.0, LARGEST_STEP / moved)
    return fits


def cross_validate_grid(df: DataFrame, features: Sequence[str], k: int = 5, alphas: Sequence[float] = (0.1,), **settings) -> DataFrame:
    """(ALPHA, FOLD, RMSE): the exposure-weighted error on the held-out fold of every fit, as ``models.cross_validate`` gives
    it fit by fit; ``settings`` as in ``fit_grid``. A fold without rows has a NULL error."""
    fits = fit_grid(df, features, k, alphas, **settings)
    rows = [(f.alpha, f.fold, f.rmse) for f in fits]
    return df.sparkSession.createDataFrame(rows, "ALPHA double, FOLD int, RMSE double")
