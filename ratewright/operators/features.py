"""Rating factors: a plan fitted once on the portfolio, then applied as literals.

The plan holds medians, bin boundaries, factor levels and log statistics, so the width and the
order of the feature matrix are decided at ``fit`` and never change at ``transform``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.functions.columns import feature_name, indicator, interval_index
from ratewright.functions.ordered import exact_quantiles, number

SPINE = ("POLICY_ID", "PURE_PREMIUM", "EXPOSURE")
MATRIX_LEAD = ("POLICY_ID", "CLAIM_COUNT", "EXPOSURE", "CLAIM_AMOUNT")
DECILES = tuple(i / 10 for i in range(1, 10))


@dataclass(frozen=True)
class FeatureSpec:
    """Which column gets which encoding."""

    imputed: tuple[str, ...] = (
        "LOSS_HISTORY_SCORE",
        "POPULATION_DENSITY",
        "PROPERTY_AGE",
        "POLICYHOLDER_AGE",
    )
    binned: tuple[str, ...] = ("PROPERTY_AGE", "POLICYHOLDER_AGE")
    categorical: tuple[str, ...] = (
        "CONSTRUCTION_TYPE",
        "CONSTRUCTION_QUALITY",
        "OCCUPANCY_TYPE",
        "REGION_CODE",
        "TERRITORY_CODE",
    )
    numeric: tuple[str, ...] = ("LOSS_HISTORY_SCORE",)
    log_scaled: tuple[str, ...] = ("POPULATION_DENSITY",)
    points: tuple[float, ...] = DECILES


def feature_columns(columns: Sequence[str], excluded: Sequence[str] = SPINE) -> list[str]:
    """Everything but the spine, in order."""
    return [c for c in columns if c not in excluded]


@dataclass(frozen=True)
class FeaturePlan:
    spec: FeatureSpec
    medians: dict[str, float]
    ranges: dict[str, list[float]]
    boundaries: dict[str, list[float]]
    levels: dict[str, list]
    log_stats: dict[str, list[float]]
    exact: bool = False
    log_floor: float | None = None
    names: list[str] = field(default_factory=list)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        spec: FeatureSpec = FeatureSpec(),
        exact: bool = False,
        fit_on: Column | None = None,
        max_levels: int = 1000,
        log_floor: float | None = None,
        cache: bool = True,
    ) -> FeaturePlan:
        """Learn all statistics in two passes: medians, ranges and level counts, then boundaries,
        log statistics and the levels themselves (their number is checked in between, so no
        unbounded set is ever collected). ``exact=True`` replaces the two quantile sketches by
        exact interpolated quantiles. ``fit_on`` restricts the fit, for instance to the training
        split; by default the whole portfolio is used.
        """
        if fit_on is not None:
            df = df.where(fit_on)
        df = df.select(*dict.fromkeys([*spec.imputed, *spec.categorical]))
        if cache:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return cls._fit(df, spec, exact, max_levels, log_floor)
        finally:
            if cache:
                df.unpersist()

    @classmethod
    def _fit(cls, df, spec, exact, max_levels, log_floor):
        first = []
        for c in spec.imputed:
            first += [F.min(c).cast("double").alias(f"min_{c}"), F.max(c).cast("double").alias(f"max_{c}")]
            first.append(F.count(number(c)).alias(f"rows_{c}"))
            if not exact:
                first.append(F.percentile_approx(F.col(c).cast("double"), 0.5, 1000).alias(f"med_{c}"))
        first += [F.approx_count_distinct(c).alias(f"n_{c}") for c in spec.categorical]
        first.append(F.count("*").alias("rows"))
        row = df.agg(*first).first()
        empty = [c for c in spec.imputed if row[f"min_{c}"] is None]
        if empty:
            raise ValueError(f"no median: every value is missing in {', '.join(empty)}")
        wide = [c for c in spec.categorical if row[f"n_{c}"] > 1.2 * max_levels]
        if wide:
            raise ValueError(f"more than {max_levels} levels in {', '.join(wide)}")
        if exact:
            counts = {c: row[f"rows_{c}"] for c in spec.imputed}
            medians = {c: q[0] for c, q in exact_quantiles(df, spec.imputed, [0.5], counts=counts).items()}
        else:
            medians = {c: row[f"med_{c}"] for c in spec.imputed}

        clean = df.withColumns({f"{c}_CLEAN": F.coalesce(F.col(c), F.lit(medians[c])) for c in spec.imputed})
        second = []
        for c in spec.log_scaled:
            x = _floored(F.col(f"{c}_CLEAN"), log_floor)
            second += [
                F.mean(F.ln(x)).alias(f"mean_{c}"),
                F.stddev_samp(F.ln(x)).alias(f"std_{c}"),
                F.count_if(x <= 0).alias(f"bad_{c}"),
            ]
        second += [F.sort_array(F.collect_set(c)).alias(f"levels_{c}") for c in spec.categorical]
        if not exact:
            second += [
                F.percentile_approx(F.col(f"{c}_CLEAN").cast("double"), list(spec.points), 1000).alias(f"cut_{c}")
                for c in spec.binned
            ]
        row2 = clean.agg(*second).first()
        for c in spec.log_scaled:
            if row2[f"bad_{c}"]:
                raise ValueError(f"{row2[f'bad_{c}']} values of {c} are not positive; set log_floor")
            if not row2[f"std_{c}"]:
                raise ValueError(f"{c} does not vary, so it cannot be standardised")
        levels = {c: list(row2[f"levels_{c}"]) for c in spec.categorical}
        wide = [c for c, found in levels.items() if len(found) > max_levels]
        if wide:
            raise ValueError(f"more than {max_levels} levels in {', '.join(wide)}")
        binned = [f"{c}_CLEAN" for c in spec.binned]
        if exact:
            counts = {f"{c}_CLEAN": row["rows"] for c in spec.binned}
            boundaries = exact_quantiles(clean, binned, spec.points, counts=counts) if binned else {}
        else:
            boundaries = {f"{c}_CLEAN": list(row2[f"cut_{c}"]) for c in spec.binned}

        return cls(
            spec=spec,
            medians=medians,
            ranges={c: [row[f"min_{c}"], row[f"max_{c}"]] for c in spec.imputed},
            boundaries=boundaries,
            levels=levels,
            log_stats={c: [row2[f"mean_{c}"], row2[f"std_{c}"]] for c in spec.log_scaled},
            exact=exact,
            log_floor=log_floor,
            names=_names(spec, boundaries, levels),
        )

    # -- application ---------------------------------------------------------------------------

    def impute(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_CLEAN``; the original column stays."""
        return df.withColumns(
            {f"{c}_CLEAN": F.coalesce(F.col(c), F.lit(self.medians[c])) for c in self.spec.imputed}
        )

    def assign_bins(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_BIN": interval_index(c, cuts) for c, cuts in self.boundaries.items()})

    def bin_indicators(self) -> dict[str, Column]:
        return {
            f"{c}_BIN_{b}": indicator(F.col(f"{c}_BIN") == b)
            for c, cuts in self.boundaries.items()
            for b in range(len(cuts) + 1)
        }

    def level_indicators(self) -> dict[str, Column]:
        return {
            feature_name(c, level): indicator(F.col(c) == F.lit(level))
            for c in self.spec.categorical
            for level in self.levels[c]
        }

    def factors(self) -> dict[str, list[str]]:
        """The indicator columns of each binned and each categorical factor."""
        binned = {c: [f"{c}_BIN_{b}" for b in range(len(cuts) + 1)] for c, cuts in self.boundaries.items()}
        return binned | {c: [feature_name(c, level) for level in self.levels[c]] for c in self.spec.categorical}

    def log_features(self) -> dict[str, Column]:
        result = {}
        for c in self.spec.log_scaled:
            mean, std = self.log_stats[c]
            x = _floored(F.col(f"{c}_CLEAN"), self.log_floor)
            result[f"{c}_LOG_SCALED"] = (F.ln(x) - F.lit(mean)) / F.lit(std)
        return result

    def features(self) -> dict[str, Column]:
        """All feature columns over an imputed, binned frame, in plan order."""
        return {
            **self.bin_indicators(),
            **self.level_indicators(),
            **{f"{c}_CLEAN": F.col(f"{c}_CLEAN").cast("double") for c in self.spec.numeric},
            **self.log_features(),
        }

    def transform(self, df: DataFrame, lead: Sequence[str] = MATRIX_LEAD) -> DataFrame:
        """``lead`` columns followed by the feature matrix; one projection, no shuffle."""
        ready = self.assign_bins(self.impute(df))
        return ready.select(*lead, *[expr.alias(name) for name, expr in self.features().items()])

    # -- storage -------------------------------------------------------------------------------

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FeaturePlan:
        raw = json.loads(text)
        spec = FeatureSpec(**{k: tuple(v) for k, v in raw.pop("spec").items()})
        return cls(spec=spec, **raw)

    # -- checks at scoring time ----------------------------------------------------------------

    def check_input(self, df: DataFrame) -> DataFrame:
        """Per input column: missing values, levels never seen at fit, values outside the fitted
        range. One aggregate over the frame; a column that is absent or mistyped raises."""
        absent = [c for c in (*self.spec.imputed, *self.spec.categorical) if c not in df.columns]
        if absent:
            raise ValueError(f"missing input columns: {', '.join(absent)}")
        kinds = dict(df.dtypes)
        textual = [c for c in self.spec.imputed if kinds[c] in ("string", "boolean", "date", "timestamp")]
        if textual:
            raise ValueError(f"not numeric: {', '.join(textual)}")
        records = []
        for c in self.spec.imputed:
            low, high = self.ranges[c]
            outside = (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high))
            records.append((c, F.count_if(F.col(c).isNull()), F.lit(0).cast("long"), F.count_if(outside)))
        for c in self.spec.categorical:
            unseen = ~F.col(c).isin(self.levels[c])
            records.append((c, F.count_if(F.col(c).isNull()), F.count_if(unseen), F.lit(0).cast("long")))
        totals = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("COLUMN_NAME"),
                        nulls.alias("NULLS"),
                        unseen.alias("UNSEEN_LEVELS"),
                        outside.alias("OUT_OF_RANGE"),
                    )
                    for c, nulls, unseen, outside in records
                ]
            ).alias("rows")
        )
        return totals.select(F.inline("rows"))


def _floored(x: Column, floor: float | None) -> Column:
    return x if floor is None else F.greatest(x, F.lit(float(floor)))


def _names(spec: FeatureSpec, boundaries: dict[str, list[float]], levels: dict[str, list]) -> list[str]:
    names = [f"{c}_BIN_{b}" for c, cuts in boundaries.items() for b in range(len(cuts) + 1)]
    names += [feature_name(c, level) for c in spec.categorical for level in levels[c]]
    names += [f"{c}_CLEAN" for c in spec.numeric] + [f"{c}_LOG_SCALED" for c in spec.log_scaled]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"different levels give the same feature name: {', '.join(clashes)}")
    return names


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-missing levels as rows (COLUMN_NAME, LEVEL): the distributed counterpart of
    ``plan.levels`` for factors of any cardinality."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(c).cast("string").alias("LEVEL")) for c in columns])
    )
    return df.select(pairs.alias("p")).select("p.*").where("LEVEL IS NOT NULL").distinct()
