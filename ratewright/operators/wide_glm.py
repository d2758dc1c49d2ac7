"""Tweedie GLM with tens of thousands of indicator columns, fitted by a quasi-Newton method.

The normal equations of a GLM need a square of the number of features; a rating factor with a level per broker or
postcode is beyond that. Here a policy is stored as the numbers of its levels, one per factor, beside its plain numeric
features, so a row costs as many numbers as it has factors, whatever their levels. Each evaluation of the likelihood and
its gradient is one pass over the stored rows; partitions send their sums, as long as the features that occur in
them.

The factor with the most levels needs no place in those vectors where they are many: given all other coefficients, a level's own
coefficient solves an equation in two sums over the level's policies. So the rows of such a level are stored together, every
pass solves its equation on the spot, and the quasi-Newton steps run over the other coefficients alone; what they
descend is the likelihood with those levels at their best, whose gradient is the usual one there. The optimum is the same. The
driver holds vectors as long as the other factors' levels, and those of the widest factor that hold many policies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.columns import weighted_mean
from ratewright.operators.diagnostics import OBSERVED, PREDICTED, WEIGHT
from ratewright.operators.models import usable_rows
from ratewright.storage import materialise

MAX_LEVELS = 1_000_000  # with a place in the model's vectors, which live on the driver; more are refused
MANY = 1_000  # levels of the widest factor; with more, those of few rows are solved for where their rows are
FEW = 10_000  # rows of such a level
MEMORY = 12  # pairs of steps that the quasi-Newton direction remembers
SLOT = "glm_slot"


@dataclass
class WideFit:
    """Link-scale coefficients. ``levels``: FACTOR, LEVEL, SLOT as a table; slot 0 is the intercept, the next are
    the numeric features. ``nested``: FACTOR, LEVEL, COEFFICIENT of the levels without a slot."""

    factors: list[str]
    numeric: list[str]
    levels: DataFrame
    beta: np.ndarray
    params: dict = field(default_factory=dict)
    nested: DataFrame | None = None

    def coefficients(self) -> DataFrame:
        """FACTOR, LEVEL (NULL for numeric features and the intercept), COEFFICIENT."""
        spark = self.levels.sparkSession
        values = spark.createDataFrame(list(enumerate(map(float, self.beta))), "SLOT long, COEFFICIENT double")
        named = [(name, i) for i, name in enumerate(["INTERCEPT", *self.numeric])]
        plain = spark.createDataFrame(named, "FACTOR string, SLOT long").select("FACTOR", F.lit(None).alias("LEVEL"), "SLOT")
        held = self.levels.unionByName(plain).join(values, "SLOT").select("FACTOR", "LEVEL", "COEFFICIENT")
        return held if self.nested is None else held.unionByName(self.nested)

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with PREDICTED_PURE_PREMIUM; a level unknown to the model, or NULL, adds nothing."""
        eta = F.lit(float(self.beta[0]))
        for i, name in enumerate(self.numeric, 1):
            eta = eta + F.col(f"`{name}`") * F.lit(float(self.beta[i]))
        table = self.coefficients()
        out = df
        for i, factor in enumerate(self.factors):
            own = table.where(F.col("FACTOR") == factor)
            own = own.select(F.col("LEVEL").alias(f"{SLOT}_l{i}"), F.col("COEFFICIENT").alias(f"{SLOT}_{i}"))
            if factor != self.params.get("nested"):  # one row per level, at most MAX_LEVELS
                own = F.broadcast(own)
            out = out.join(own, F.col(f"`{factor}`").cast("string") == F.col(f"{SLOT}_l{i}"), "left")
            eta = eta + F.coalesce(F.col(f"{SLOT}_{i}"), F.lit(0.0))
        return out.select(*[F.col(f"`{c}`") for c in df.columns], F.exp(eta).alias(PREDICTED))


def level_rows(df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """FACTOR, LEVEL, ROWS: every level of every factor as text, written."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("FACTOR"), F.col(f"`{f}`").cast("string").alias("LEVEL")) for f in factors]))
    levels = df.select(pairs.alias("p")).select("p.*").where("LEVEL IS NOT NULL").groupBy("FACTOR", "LEVEL")
    return materialise(levels.agg(F.count(F.lit(1)).alias("ROWS")), "levels")


def level_slots(found: DataFrame, first: int) -> DataFrame:
    """FACTOR, LEVEL, SLOT: levels numbered from ``first`` by factor and level."""
    if (count := found.count()) > MAX_LEVELS:
        raise ValueError(f"{count} levels, at most {MAX_LEVELS} are fitted")
    rows = sorted(tuple(r) for r in found.select("FACTOR", "LEVEL").collect())
    schema = "FACTOR string, LEVEL string, SLOT long"
    return found.sparkSession.createDataFrame([(f, v, first + i) for i, (f, v) in enumerate(rows)], schema)


def _stored(
    rows: DataFrame, factors, numeric, levels: DataFrame, label: str, weight: str, nested: str | None
) -> tuple[DataFrame, DataFrame | None]:
    """Written once for all passes: slots array<int> (-1 where a row has no level), x array<double>, y, w; and, of
    rows whose level of ``nested`` has no slot, LEVEL and its rows as an array, fewer than FEW."""
    out = rows
    for i, factor in enumerate(factors):
        own = levels.where(F.col("FACTOR") == factor)
        own = own.select(F.col("LEVEL").alias(f"{SLOT}_l{i}"), F.col("SLOT").cast("int").alias(f"{SLOT}_{i}"))
        out = out.join(F.broadcast(own), F.col(f"`{factor}`").cast("string") == F.col(f"{SLOT}_l{i}"), "left")
    slots = F.array(*[F.coalesce(F.col(f"{SLOT}_{i}"), F.lit(-1)) for i in range(len(factors))]).cast("array<int>")
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in numeric]).cast("array<double>")
    alone = []
    if nested is not None:
        i = factors.index(nested)
        alone = [F.when(F.col(f"{SLOT}_{i}").isNull(), F.col(f"`{nested}`").cast("string")).alias("level")]
    wanted = out.select(
        slots.alias("slots"), x.alias("x"), F.col(f"`{label}`").cast("double").alias("y"),
        F.col(f"`{weight}`").cast("double").alias("w"), *alone,
    )
    if nested is None:
        return materialise(wanted, "design"), None
    wanted = materialise(wanted, "design")
    together = wanted.where("level IS NOT NULL").groupBy(F.col("level").alias("LEVEL"))
    together = together.agg(F.collect_list(F.struct("slots", "x", "y", "w")).alias("rows"))
    return wanted.where("level IS NULL").drop("level"), materialise(together, "nested")


@dataclass
class _Solved:
    """Rows of some levels, with the best coefficient of each level given ``beta``."""

    row_level: np.ndarray
    coefficient: np.ndarray
    missed: np.ndarray  # by level, as a share of the equation's terms


def _solve(row_level: np.ndarray, levels: int, y, w, eta, power: float, ridge: float) -> _Solved:
    """Newton's method on every level's equation a exp((2-p) b) - c exp((1-p) b) + ridge b = 0, whose left side rises with b."""
    up, down = 2 - power, power - 1
    a = np.bincount(row_level, w * np.exp(up * eta), levels)
    c = np.bincount(row_level, w * y * np.exp(-down * eta), levels)
    b = np.zeros(levels)
    for _ in range(200):
        high, low = a * np.exp(up * b), c * np.exp(-down * b)
        step = np.clip((high - low + ridge * b) / np.maximum(up * high + down * low + ridge, 1e-300), -2.0, 2.0)
        b = b - step
        if (np.abs(step) <= 1e-14 * (1 + np.abs(b))).all():
            break
    mean = eta + b[row_level]
    terms = w * (y * np.exp(-down * mean) - np.exp(up * mean))
    left = np.abs(ridge * b - np.bincount(row_level, terms, levels))
    size = np.bincount(row_level, np.abs(terms), levels) + np.abs(ridge * b)
    return _Solved(row_level, b, left / np.maximum(size, 1e-300))


def _opened(batch, n_factors: int, n_numeric: int) -> tuple[np.ndarray, ...]:
    """slots, x, y, w, and the level of every row, of a batch of (LEVEL, rows)."""
    import pyarrow as pa

    inner = batch.column("rows").flatten()
    slots, x, y, w = (inner.field(i) for i in range(4))
    lengths = batch.column("rows").value_lengths().to_numpy(zero_copy_only=False)
    assert isinstance(inner, pa.StructArray) and lengths.sum() == len(inner)
    return (
        slots.flatten().to_numpy(zero_copy_only=False).reshape(len(inner), n_factors),
        x.flatten().to_numpy(zero_copy_only=False).reshape(len(inner), n_numeric),
        y.to_numpy(zero_copy_only=False),
        w.to_numpy(zero_copy_only=False),
        np.repeat(np.arange(batch.num_rows), lengths),
    )


def _linear(b: np.ndarray, slots: np.ndarray, x: np.ndarray) -> np.ndarray:
    return b[0] + x @ b[1 : x.shape[1] + 1] + np.where(slots >= 0, b[slots], 0.0).sum(axis=1)


def _pass(
    design: DataFrame, nested: DataFrame | None, beta: Broadcast, power: float, n_factors: int, n_numeric: int, ridge: float
) -> DataFrame:
    """slot, pull, curve, size: by feature the sums of w mu^(1-p) (y - mu) x, of w mu^(2-p) x^2 and of the absolute
    terms of the first; slot -1 has the half-deviance, and the penalty of levels without slot, as pull."""

    def flat(batch):
        n = batch.num_rows
        slots = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, n_factors)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, n_numeric)
        y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        return slots, x, y, w, _linear(beta.value, slots, x), 0.0

    def together(batch):
        slots, x, y, w, row_level = _opened(batch, n_factors, n_numeric)
        eta = _linear(beta.value, slots, x)
        own = _solve(row_level, batch.num_rows, y, w, eta, power, ridge).coefficient
        return slots, x, y, w, eta + own[row_level], 0.5 * ridge * float((own * own).sum())

    def sums_of(read):
        def run(batches):
            import pyarrow as pa

            b = beta.value
            sums = np.zeros((3, len(b)))
            loss = 0.0
            for batch in batches:
                slots, x, y, w, eta, penalty = read(batch)
                there = slots >= 0
                mean = np.exp(eta)
                low, high = mean ** (1 - power), mean ** (2 - power)
                loss += penalty + float((w * (high / (2 - power) - y * low / (1 - power))).sum())
                pull, curve = w * (y * low - high), w * high
                for k, terms in enumerate((pull, curve, np.abs(pull))):
                    sums[k, 0] += terms.sum()
                    for j in range(n_numeric):
                        c = x[:, j]
                        sums[k, j + 1] += (terms * (c, c * c, np.abs(c))[k]).sum()
                    for j in range(n_factors):
                        on = there[:, j]
                        sums[k] += np.bincount(slots[on, j], terms[on], len(b))
            at = np.flatnonzero(sums.any(axis=0))
            names = ["slot", "pull", "curve", "size"]
            columns = [np.append(at, -1), *[np.append(s[at], v) for s, v in zip(sums, (loss, 0.0, 0.0))]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        return run

    schema = "slot long, pull double, curve double, size double"
    partial = design.mapInArrow(sums_of(flat), schema)
    if nested is not None:
        partial = partial.unionByName(nested.mapInArrow(sums_of(together), schema))
    return partial.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("pull", "curve", "size")])


def _nested_levels(
    nested: DataFrame, beta: Broadcast, power: float, n_factors: int, n_numeric: int, ridge: float
) -> DataFrame:
    """LEVEL, COEFFICIENT, MISSED of the levels without slot, written."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            slots, x, y, w, row_level = _opened(batch, n_factors, n_numeric)
            found = _solve(row_level, batch.num_rows, y, w, _linear(beta.value, slots, x), power, ridge)
            columns = [batch.column("LEVEL"), pa.array(found.coefficient), pa.array(found.missed)]
            yield pa.RecordBatch.from_arrays(columns, names=["LEVEL", "COEFFICIENT", "MISSED"])

    return materialise(nested.mapInArrow(run, "LEVEL string, COEFFICIENT double, MISSED double"), "nested_levels")


class _Likelihood:
    """Mean weighted half-deviance plus the ridge penalty, with gradient; one job a call."""

    def __init__(
        self, design: DataFrame, nested: DataFrame | None, factors: int, numeric: int, weight: float, alpha: float, power: float
    ):
        self.design, self.nested, self.weight, self.alpha = design, nested, weight, alpha
        self.settings = power, factors, numeric, alpha * weight
        self.calls = 0

    def __call__(self, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """(value, gradient, diagonal of the expected curvature, size of the terms a component adds up)."""
        context = self.design.sparkSession.sparkContext
        share = context.broadcast(beta)
        rows = _pass(self.design, self.nested, share, *self.settings).toArrow()
        share.destroy()
        self.calls += 1
        at = rows["slot"].to_numpy()
        sums = np.zeros((3, len(beta) + 1))  # the last place, -1, is the loss
        for k, name in enumerate(("pull", "curve", "size")):
            sums[k, at] = rows[name].to_numpy()
        ridge = np.where(np.arange(len(beta)) > 0, self.alpha, 0.0)  # the intercept is free
        value = sums[0, -1] / self.weight + 0.5 * float((ridge * beta * beta).sum())
        pull, curve, size = sums[:, :-1] / self.weight
        return value, ridge * beta - pull, ridge + curve, np.maximum(size + np.abs(ridge * beta), 1e-300)


    def levels(self, beta: np.ndarray) -> DataFrame:
        share = self.design.sparkSession.sparkContext.broadcast(beta)
        found = _nested_levels(self.nested, share, *self.settings)
        share.destroy()
        return found


def _direction(gradient: np.ndarray, steps: list, scale: np.ndarray) -> np.ndarray:
    """Two-loop recursion from a diagonal start."""
    q, kept = gradient.copy(), []
    for s, d in reversed(steps):
        a = s @ q / (s @ d)
        q -= a * d
        kept.append(a)
    q /= scale
    for (s, d), a in zip(steps, reversed(kept)):
        q += (a - d @ q / (s @ d)) * s
    return -q


def fit_wide_glm(
    df: DataFrame,
    factors: Sequence[str],
    numeric: Sequence[str] = (),
    alpha: float = 0.1,
    power: float = 1.5,
    label: str = OBSERVED,
    weight: str = WEIGHT,
    max_iter: int = 500,
    tol: float = 1e-7,
) -> WideFit:
    """Tweedie GLM with log link, an indicator per level of each factor, and the ridge penalty of ``models.fit_glm``.

    Ends when no likelihood equation misses by more than ``tol`` of the size of its terms (``params["residual"]`` has what
    is left, ``converged`` says so). Rows without target, or without positive weight, or with a NULL numeric feature are
    not learned from; a NULL level has no indicator.
    """
    if not 1 < power < 2:
        raise ValueError("power must lie between 1 and 2")
    factors, numeric = list(factors), list(numeric)
    rows = usable_rows(df, label, weight).dropna(subset=numeric) if numeric else usable_rows(df, label, weight)
    rows = rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*factors, *numeric, label, weight])])
    found = level_rows(rows, factors)
    counts = {r["FACTOR"]: r["n"] for r in found.groupBy("FACTOR").agg(F.count("*").alias("n")).collect()}
    inner = max(counts, key=lambda f: (counts[f], f), default=None)
    inner = inner if counts.get(inner, 0) > MANY else None
    held = found if inner is None else found.where((F.col("FACTOR") != inner) | (F.col("ROWS") >= FEW))
    levels = level_slots(held, 1 + len(numeric))
    whole = rows.select(F.col(f"`{label}`").cast("double").alias("y"), F.col(f"`{weight}`").cast("double").alias("w"))
    whole = whole.agg(F.sum("w").alias("w"), weighted_mean("y", "w").alias("mean")).first()
    if not whole["mean"] or whole["mean"] <= 0:
        raise ValueError("a log-link model needs a positive weighted mean of the target")
    design, together = _stored(rows, factors, numeric, levels, label, weight, inner)
    likelihood = _Likelihood(design, together, len(factors), len(numeric), whole["w"], alpha, power)
    beta = np.zeros(1 + len(numeric) + levels.count())
    beta[0] = math.log(whole["mean"])
    value, gradient, curve, size = likelihood(beta)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for iteration in range(max_iter):
        if (residual := float(np.max(np.abs(gradient) / size))) <= tol:
            break
        direction = _direction(gradient, steps, np.maximum(curve, 1e-12))
        slope = float(direction @ gradient)
        if slope >= 0:
            steps, direction = [], -gradient / np.maximum(curve, 1e-12)
            slope = float(direction @ gradient)
        length = min(1.0, 4.0 / max(float(np.max(np.abs(direction))), 1e-300))
        while True:
            tried = beta + length * direction
            found = likelihood(tried)
            # near the end the value's last digits no longer tell, the slope does
            flat = abs(found[0] - value) <= 1e-12 * abs(value) and abs(float(direction @ found[1])) <= abs(slope)
            if found[0] <= value + 1e-4 * length * slope or flat or length < 1e-9:
                break
            length /= 2
        step, change = tried - beta, found[1] - gradient
        if float(step @ change) > 1e-14 * float(np.linalg.norm(step) * np.linalg.norm(change)):
            steps = [*steps, (step, change)][-MEMORY:]
        beta = tried
        value, gradient, curve, size = found
    residual, nested = float(np.max(np.abs(gradient) / size)), None
    if together is not None:
        solved = likelihood.levels(beta)
        residual = max(residual, solved.agg(F.max("MISSED").alias("m")).first()["m"] or 0.0)
        nested = solved.select(F.lit(inner).alias("FACTOR"), "LEVEL", "COEFFICIENT")
    params = {
        "alpha": alpha, "power": power, "features": len(numeric) + sum(counts.values()), "passes": likelihood.calls,
        "residual": residual, "converged": residual <= tol, "nested": inner,
    }
    return WideFit(factors, numeric, levels, beta, params, nested)
