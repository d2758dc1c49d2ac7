"""Every operator of the library as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.functions.columns import indicator, key_slot
from ratewright.functions.ordered import approximate_quantiles, exact_quantiles
from ratewright.operators import crossval as cv
from ratewright.operators import diagnostics as dia
from ratewright.operators import dictionary as dic
from ratewright.operators import explain as exp
from ratewright.operators import leafwise as lw
from ratewright.operators import models as mdl
from ratewright.operators import policy as pol
from ratewright.operators import sketches as sk
from ratewright.operators import splits as spl
from ratewright.operators import wide_glm as wide
from ratewright.operators.features import DECILES, FeaturePlan, FeatureSpec, feature_columns, level_table
from ratewright.plans.pricing import Names, burning_cost, freeze_study, score_policies, train_and_register
from ratewright.sources import catalog, feeds
from ratewright.sources.adapter import policy_freq, policy_sev, read_table, sample_score
from ratewright.sources.store import PricingStore, entity_check, spine_join
from ratewright.storage import materialise, scratch_path, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TERRITORIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SPEC = FeatureSpec()


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Floating sums differ in the last digits with their order; compare them rounded."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pol.prepare_policies(policy_freq(spark, sf_dir), policy_sev(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared policies as a written table, for queries that pass over them more than once."""
    return materialise(prepared(spark, sf_dir), "prepared")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies with targets and two model-free scores, written: SCORE is heavily tied, DENSITY is
    continuous."""
    df = pol.add_targets(prepared(spark, sf_dir)).select(
        "POLICY_ID",
        "EXPOSURE",
        "PURE_PREMIUM",
        sample_score().alias("SCORE"),
        F.coalesce("POPULATION_DENSITY", F.lit(0.0)).alias("DENSITY"),
    )
    return materialise(df, "scored")


SCORES = {"score": "SCORE", "density": "DENSITY"}


def exact_plan(df: DataFrame) -> FeaturePlan:
    return FeaturePlan.fit(df, SPEC, exact=True, cache=False)


# -- ingestion and conditioning ----------------------------------------------------------------


@query
def policy_table(spark, sf_dir):
    return policy_freq(spark, sf_dir)


@query
def claim_table(spark, sf_dir):
    return policy_sev(spark, sf_dir)


@query
def claims_by_policy(spark, sf_dir):
    return rounded(pol.claims_per_policy(policy_sev(spark, sf_dir)), CLAIM_AMOUNT=4)


@query
def policies_with_claims(spark, sf_dir):
    joined = pol.attach_claims(policy_freq(spark, sf_dir), policy_sev(spark, sf_dir))
    return rounded(joined.select("POLICY_ID", "CLAIM_COUNT", "CLAIM_AMOUNT"), CLAIM_AMOUNT=4)


@query
def prep_policies(spark, sf_dir):
    columns = ["POLICY_ID", "EXPOSURE", "CLAIM_COUNT", "CLAIM_AMOUNT"]
    return rounded(prepared(spark, sf_dir).select(*columns), CLAIM_AMOUNT=4)


@query
def targets(spark, sf_dir):
    df = pol.add_targets(prepared(spark, sf_dir))
    df = df.select("POLICY_ID", "PURE_PREMIUM", "FREQUENCY", "AVG_CLAIM_AMOUNT")
    return rounded(df, PURE_PREMIUM=6, FREQUENCY=6, AVG_CLAIM_AMOUNT=6)


@query
def territory_burning_cost(spark, sf_dir):
    df = burning_cost(policy_freq(spark, sf_dir), policy_sev(spark, sf_dir))
    return rounded(df, EXPOSURE=6, CLAIM_AMOUNT=4, PURE_PREMIUM=4)


@query
def segment_exposure(spark, sf_dir):
    df = pol.segment_exposure(prepared(spark, sf_dir), ["TERRITORY_CODE", "CONSTRUCTION_TYPE"], min_exposure=350.0)
    return rounded(df, EXPOSURE=6, CLAIM_AMOUNT=4, PURE_PREMIUM=4)


@query
def portfolio_counts(spark, sf_dir):
    """Global counts of policies, claims and policies with claims."""
    freq, sev = policy_freq(spark, sf_dir), policy_sev(spark, sf_dir)
    policies = freq.agg(F.count("*").alias("POLICIES"))
    claims = sev.agg(F.count("*").alias("CLAIMS"), F.count_distinct("POLICY_ID").alias("CLAIMING_POLICIES"))
    counts = policies.unionByName(claims, allowMissingColumns=True)
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns])


def bucketed(df: DataFrame, label: str) -> str:
    """A catalog table of its own, bucketed by policy."""
    name = f"{label}_{uuid.uuid4().hex}"
    catalog.save_bucketed(df, name, "POLICY_ID", catalog.buckets_for(df))
    return name


@query
def bucketed_policies_with_claims(spark, sf_dir):
    """Claims summed and joined inside the buckets of two catalog tables."""
    tables = bucketed(policy_freq(spark, sf_dir), "policies"), bucketed(policy_sev(spark, sf_dir), "claims")
    joined = catalog.bucketed_claims(spark, *tables)
    return rounded(joined.select("POLICY_ID", "CLAIM_COUNT", "CLAIM_AMOUNT"), CLAIM_AMOUNT=4)


@query
def bucketed_spine_features(spark, sf_dir):
    df = pol.add_targets(prepared(spark, sf_dir))
    train, _ = spl.hash_split(df.select("POLICY_ID", "PURE_PREMIUM", "EXPOSURE"))
    view = df.select("POLICY_ID", indicator(F.col("OCCUPANCY_TYPE") == "Owner-Occupied").alias("OWNER"))
    joined = catalog.bucketed_spine(spark, bucketed(train, "spine"), bucketed(view, "view"))
    return rounded(joined, PURE_PREMIUM=6)


# -- features ----------------------------------------------------------------------------------


@query
def medians_exact(spark, sf_dir):
    medians = exact_quantiles(stored(spark, sf_dir), SPEC.imputed, [0.5])
    rows = [(c, q[0]) for c, q in medians.items()]
    return rounded(spark.createDataFrame(rows, "COLUMN_NAME string, MEDIAN double"), MEDIAN=6)


@query
def decile_boundaries(spark, sf_dir):
    columns = [*SPEC.imputed, "CLAIM_AMOUNT"]
    found = exact_quantiles(stored(spark, sf_dir), columns, DECILES)
    rows = [(c, i, b) for c, cuts in found.items() for i, b in enumerate(cuts, start=1)]
    return rounded(spark.createDataFrame(rows, "COLUMN_NAME string, DECILE int, BOUNDARY double"), BOUNDARY=4)


@query
def sketched_quantile_ranks(spark, sf_dir):
    """Quantile sketches judged on the whole table: is each value's true rank within a thousandth?"""
    df, points = stored(spark, sf_dir), [0.1, 0.5, 0.9]
    found = approximate_quantiles(df, SPEC.imputed, points)
    entries = []
    for c in SPEC.imputed:
        for p, value in zip(points, found[c]):
            below, upto, n = F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value), F.count(c)
            close = (below <= (p + 0.001) * n + 1) & (upto >= (p - 0.001) * n - 1)
            entries.append(F.struct(F.lit(c).alias("COLUMN_NAME"), F.lit(p).alias("POINT"), close.alias("WITHIN")))
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def batch_sketches(spark: SparkSession, df: DataFrame, table: str, path: str) -> None:
    """Two batches of a table, each read alone and appended to the table of sketches."""
    for batch in (0, 1):
        rows = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == batch)
        sk.sketch_batch(rows, table, str(batch)).write.mode("append").parquet(path)


@query
def batch_quantile_ranks(spark, sf_dir):
    """Quantiles merged from the sketches of two batches, judged by their true ranks in the whole table."""
    df, points, path = stored(spark, sf_dir), [0.1, 0.5, 0.9], scratch_path(spark, "sketches")
    batch_sketches(spark, df.select(*SPEC.imputed), "policies", path)
    merged = sk.merge_batches(spark.read.parquet(path))
    found = {r["COLUMN_NAME"]: r["VALUES"] for r in sk.profile(merged, points).collect()}  # a row per column
    entries = []
    for c in SPEC.imputed:
        for p, value in zip(points, found[c]):
            below, upto, n = F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value), F.count(c)
            close = (below <= (p + 0.002) * n + 1) & (upto >= (p - 0.002) * n - 1)
            entries.append(F.struct(F.lit(c).alias("COLUMN_NAME"), F.lit(p).alias("POINT"), close.alias("WITHIN")))
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


@query
def batch_distinct_counts(spark, sf_dir):
    """Distinct counts of every column of every table, merged from two batches, within 2 % of the exact ones."""
    path, exact = scratch_path(spark, "sketches"), None
    for name in TABLES:
        df = read_table(spark, sf_dir, name)
        batch_sketches(spark, df, name, path)
        counts = [
            F.struct(F.lit(name).alias("TABLE_NAME"), F.lit(c).alias("COLUMN_NAME"), F.count_distinct(c).alias("EXACT"))
            for c in df.columns
        ]
        part = df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))
        exact = part if exact is None else exact.unionByName(part)
    found = sk.profile(sk.merge_batches(spark.read.parquet(path))).join(exact, ["TABLE_NAME", "COLUMN_NAME"])
    close = F.abs(F.col("DISTINCT_COUNT") - F.col("EXACT")) <= F.greatest(F.lit(1), 0.02 * F.col("EXACT"))
    return found.select("TABLE_NAME", "COLUMN_NAME", "ROW_COUNT", "NULL_COUNT", close.alias("WITHIN"))


@query
def impute(spark, sf_dir):
    df = stored(spark, sf_dir)
    clean = exact_plan(df).impute(df).select("POLICY_ID", *[f"{c}_CLEAN" for c in SPEC.imputed])
    return clean.withColumns({f"{c}_CLEAN": F.round(F.col(f"{c}_CLEAN").cast("double"), 6) for c in SPEC.imputed})


@query
def bin_assign(spark, sf_dir):
    df = stored(spark, sf_dir)
    plan = exact_plan(df)
    return plan.assign_bins(plan.impute(df)).select("POLICY_ID", *[f"{c}_CLEAN_BIN" for c in SPEC.binned])


@query
def bin_indicators(spark, sf_dir):
    df = stored(spark, sf_dir)
    plan = exact_plan(df)
    binned = plan.assign_bins(plan.impute(df))
    return binned.select("POLICY_ID", *[e.alias(n) for n, e in plan.bin_indicators().items()])


@query
def one_hot(spark, sf_dir):
    df = stored(spark, sf_dir)
    return df.select("POLICY_ID", *[e.alias(n) for n, e in exact_plan(df).level_indicators().items()])


@query
def level_sets(spark, sf_dir):
    return level_table(policy_freq(spark, sf_dir), SPEC.categorical)


@query
def log_scaled_density(spark, sf_dir):
    df = stored(spark, sf_dir)
    plan = exact_plan(df)
    scaled = plan.impute(df).select("POLICY_ID", *[e.alias(n) for n, e in plan.log_features().items()])
    return rounded(scaled, POPULATION_DENSITY_LOG_SCALED=6)


@query
def feature_matrix(spark, sf_dir):
    df = stored(spark, sf_dir)
    matrix = exact_plan(df).transform(df)
    return rounded(matrix, CLAIM_AMOUNT=4, LOSS_HISTORY_SCORE_CLEAN=6, POPULATION_DENSITY_LOG_SCALED=6)


@query
def feature_matrix_sketched(spark, sf_dir):
    """The default plan, with quantile sketches as in production; no exact counterpart in SQL."""
    df = stored(spark, sf_dir)
    return FeaturePlan.fit(df, SPEC, cache=False).transform(df)


@query
def scoring_input_check(spark, sf_dir):
    """A plan fitted on three territories, checked against the whole portfolio."""
    df = stored(spark, sf_dir)
    plan = FeaturePlan.fit(df, SPEC, fit_on=F.col("REGION_CODE").like("NATION_1%") & (F.col("EXPOSURE") > 0.5))
    return plan.check_input(df)


# -- splits and datasets -----------------------------------------------------------------------


@query
def hash_split(spark, sf_dir):
    return spl.add_split(policy_freq(spark, sf_dir).select("POLICY_ID"))


@query
def fold_assignment(spark, sf_dir):
    return spl.add_fold(policy_freq(spark, sf_dir).select("POLICY_ID"), 5)


@query
def split_disjoint(spark, sf_dir):
    population = policy_freq(spark, sf_dir)
    train, validation = spl.hash_split(population)
    return spl.split_check(population, train, validation)


@query
def entity_key_check(spark, sf_dir):
    """Claims keyed by policy: many repeat, so they could not serve as a feature view."""
    return entity_check(policy_sev(spark, sf_dir), ["POLICY_ID"])


@query
def spine(spark, sf_dir):
    df = pol.add_targets(prepared(spark, sf_dir))
    return rounded(df.select("POLICY_ID", "PURE_PREMIUM", "EXPOSURE"), PURE_PREMIUM=6)


@query
def spine_features(spark, sf_dir):
    df = pol.add_targets(prepared(spark, sf_dir))
    train, _ = spl.hash_split(df.select("POLICY_ID", "PURE_PREMIUM", "EXPOSURE"))
    view = df.select("POLICY_ID", indicator(F.col("OCCUPANCY_TYPE") == "Owner-Occupied").alias("OWNER"))
    return rounded(spine_join(train, view, ["POLICY_ID"]), PURE_PREMIUM=6)


def study(spark: SparkSession, sf_dir: str, spec: FeatureSpec = SPEC, exact: bool = True) -> PricingStore:
    store = PricingStore(spark, scratch_path(spark, "study"))
    freeze_study(store, policy_freq(spark, sf_dir), policy_sev(spark, sf_dir), spec=spec, exact=exact)
    return store


@query
def dataset_read(spark, sf_dir):
    store = study(spark, sf_dir)
    validation = store.load_dataset(Names.validation, "1")
    keep = ["POLICY_ID", "PURE_PREMIUM", "EXPOSURE", "OCCUPANCY_TYPE_OWNER_OCCUPIED", "LOSS_HISTORY_SCORE_CLEAN"]
    return rounded(validation.select(*keep), PURE_PREMIUM=6, LOSS_HISTORY_SCORE_CLEAN=6)


@query
def dataset_versions(spark, sf_dir):
    store = study(spark, sf_dir)
    columns = [F.array_size("columns").alias("column_count"), F.array_join("labels", ",").alias("label_columns")]
    return store.records("datasets").select("name", "version", "feature_view", "rows", *columns)


@query
def dataset_audit(spark, sf_dir):
    """Frozen versions read again: the digest of their keys, and whether all rows are those that were written."""
    return study(spark, sf_dir).audit_datasets()


@query
def dataset_features_only(spark, sf_dir):
    features = study(spark, sf_dir).load_dataset(Names.training, "1", only_features=True)
    held = F.lit(0.0)
    for c in features.columns[1:]:
        if not c.endswith(("_CLEAN", "_LOG_SCALED")):
            held = held + F.col(c)
    return features.select("POLICY_ID", held.alias("INDICATORS_SET"), F.lit(len(features.columns)).alias("WIDTH"))


# -- models ------------------------------------------------------------------------------------


def territory_design(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Policies with targets and identified territory indicators (the first level is the base)."""
    names = [f"T_{t.replace(' ', '_')}" for t in TERRITORIES[1:]]
    df = pol.add_targets(spread(stored(spark, sf_dir))).withColumns(
        {n: indicator(F.col("TERRITORY_CODE") == t) for n, t in zip(names, TERRITORIES[1:])}
    )
    return df, names


def full_design(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Targets and the sketched feature matrix of the whole portfolio."""
    df, plan = planned_design(spark, sf_dir)
    return df, plan.names


def planned_design(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FeaturePlan]:
    df = pol.add_targets(spread(stored(spark, sf_dir)))
    plan = FeaturePlan.fit(df, SPEC, cache=False)
    return plan.transform(df, lead=["POLICY_ID", "PURE_PREMIUM", "CLAIM_COUNT", "CLAIM_AMOUNT", "EXPOSURE"]), plan


def train_validation(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return spl.hash_split(df)


@query
def glm_one_way(spark, sf_dir):
    """A one-factor GLM without penalty predicts the weighted mean of each level."""
    df, features = territory_design(spark, sf_dir)
    train, validation = train_validation(df)
    fit = mdl.fit_glm(train, features, alpha=0.0, collapse=True)
    return rounded(fit.predict(validation).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def glm_score_equations(spark, sf_dir):
    """Residuals of the penalised likelihood equations of the full GLM; all are zero at the fit."""
    df, features = full_design(spark, sf_dir)
    fit = mdl.fit_glm(df, features, alpha=0.1)
    residuals = mdl.score_equations(fit, df)
    return residuals.select("FEATURE", F.round(F.abs("RESIDUAL"), 5).alias("RESIDUAL"))


@query
def glm_wide_one_way(spark, sf_dir):
    """The quasi-Newton GLM on one factor: every level's mean."""
    df = pol.add_targets(stored(spark, sf_dir))
    fit = wide.fit_wide_glm(df, ["TERRITORY_CODE"], alpha=0.0, tol=1e-11)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def glm_wide_factors(spark, sf_dir):
    """A level per customer beside the usual factors, more than normal equations hold at scale: levels by factor, and
    the largest miss of any likelihood equation."""
    owners = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("POLICY_ID"), F.col("o_custkey").alias("CUSTOMER"))
    df = materialise(pol.add_targets(prepared(spark, sf_dir)).join(owners, "POLICY_ID"), "owned")
    fit = wide.fit_wide_glm(df, ["CUSTOMER", "REGION_CODE", "CONSTRUCTION_TYPE", "OCCUPANCY_TYPE"], ["PROPERTY_AGE"], alpha=0.1)
    levels = fit.coefficients().groupBy("FACTOR").agg(F.count("*").alias("LEVELS"))
    return levels.withColumn("RESIDUAL", F.round(F.lit(fit.params["residual"]), 6))


@query
def glm_predictions(spark, sf_dir):
    df, features = full_design(spark, sf_dir)
    train, validation = train_validation(df)
    return mdl.fit_glm(train, features, alpha=0.1).predict(validation).select("POLICY_ID", dia.PREDICTED)


@query
def glm_cv_one_way(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    return rounded(mdl.cross_validate(df, features, k=5, alphas=[0.0], collapse=True), RMSE=3)


@query
def cv_mean_and_std(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    folds = cv.cross_validate_grid(df, features, k=5, alphas=[0.0], collapse=True)
    return rounded(mdl.cv_summary(folds), CV_RMSE_MEAN=3, CV_RMSE_STD=3)


@query
def alpha_grid(spark, sf_dir):
    """Regularisation strengths compared by cross-validated error, five folds and all features."""
    df, features = full_design(spark, sf_dir)
    return mdl.cv_summary(cv.cross_validate_grid(df, features, k=5, alphas=[0.1, 0.5]))


@query
def alpha_grid_one_way(spark, sf_dir):
    """Two ends of the grid on one factor: without a penalty a fold is predicted by the level means of the others, with a
    boundless one by their overall mean."""
    df, features = territory_design(spark, sf_dir)
    folds = cv.cross_validate_grid(df, features, k=5, alphas=[0.0, 1e15], collapse=True)
    return rounded(mdl.cv_summary(folds), CV_RMSE_MEAN=3, CV_RMSE_STD=3)


@query
def glm_relativities_one_way(spark, sf_dir):
    df, _ = territory_design(spark, sf_dir)
    names = [f"TERRITORY_CODE_{t.replace(' ', '_')}" for t in TERRITORIES]
    df = df.withColumns({n: indicator(F.col("TERRITORY_CODE") == t) for n, t in zip(names, TERRITORIES)})
    fit = mdl.fit_glm(df, names[1:], alpha=0.0, collapse=True)
    levels = mdl.relativities(fit, df, {n: [n] for n in names[1:]})
    return rounded(levels.select("FEATURE", "RELATIVITY"), RELATIVITY=4)


@query
def glm_relativities(spark, sf_dir):
    df, plan = planned_design(spark, sf_dir)
    return mdl.relativities(mdl.fit_glm(df, plan.names, alpha=0.1), df, plan.factors())


@query
def freq_sev_one_way(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    fit = mdl.fit_freq_sev(df, features, reg_param=0.0, collapse=True)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def freq_sev_product(spark, sf_dir):
    df, features = full_design(spark, sf_dir)
    return mdl.fit_freq_sev(df, features).predict(df).select("POLICY_ID", dia.PREDICTED)


@query
def gbt_one_way(spark, sf_dir):
    """Trees on one factor, exposure-weighted: every leaf is a level's weighted mean."""
    df, features = territory_design(spark, sf_dir)
    fit = mdl.fit_gbt(df, features, rounds=3)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def gbt_unweighted_one_way(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    fit = mdl.fit_gbt(df, features, rounds=3, weight=None, partitions=8)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def gbt_predictions(spark, sf_dir):
    df, features = full_design(spark, sf_dir)
    train, validation = train_validation(df)
    return mdl.fit_gbt(train, features).predict(validation).select("POLICY_ID", dia.PREDICTED)


@query
def gbt_eval_curve(spark, sf_dir):
    """Validation loss per boosting round; one factor is exhausted by the first tree."""
    df, features = territory_design(spark, sf_dir)
    train, validation = train_validation(df)
    curve = mdl.evaluation_curve(mdl.fit_gbt(train, features, rounds=3), validation)
    return curve.select("ROUND", F.round(F.sqrt("LOSS"), 3).alias("ROOT_LOSS"))


@query
def gbt_stopped_early(spark, sf_dir):
    """All features, up to 200 rounds: validation loss by round of the trees that were kept."""
    df, features = full_design(spark, sf_dir)
    train, validation = train_validation(df)
    fit = mdl.fit_gbt(train, features, watch=validation)
    curve = mdl.evaluation_curve(fit, validation)
    return curve.select("ROUND", F.round(F.sqrt("LOSS"), 3).alias("ROOT_LOSS"), F.lit(fit.params["best_round"]).alias("BEST_ROUND"))


@query
def gbt_leafwise(spark, sf_dir):
    """Leaf-limited trees on one factor, exposure-weighted: every leaf is a level's weighted mean."""
    df, features = territory_design(spark, sf_dir)
    fit = lw.fit_leafwise(df, features, rounds=3)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


@query
def gbt_leafwise_unweighted(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    fit = lw.fit_leafwise(df, features, rounds=3, weight=None)
    return rounded(fit.predict(df).select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


def in_validation():
    """The rows that ``train_validation`` keeps for validation."""
    return key_slot("POLICY_ID", 100) >= 75


@query
def gbt_leafwise_watched(spark, sf_dir):
    """Validation loss by round, watched while one factor is fitted."""
    df, features = territory_design(spark, sf_dir)
    fit = lw.fit_leafwise(df, features, rounds=3, validation=in_validation())
    rows = [(i, float(x)) for i, x in enumerate(fit.params["val_loss"], start=1)]
    curve = spark.createDataFrame(rows, "ROUND int, LOSS double")
    return curve.select("ROUND", F.round(F.sqrt("LOSS"), 3).alias("ROOT_LOSS"))


@query
def gbt_leafwise_predictions(spark, sf_dir):
    """31 leaves, up to 200 rounds on all features, ended where 20 rounds bring no better validation loss."""
    df, features = full_design(spark, sf_dir)
    df = materialise(df, "design")
    held = in_validation()
    fit = lw.fit_leafwise(df, features, validation=held, patience=20)
    return fit.predict(df.where(held)).select("POLICY_ID", dia.PREDICTED)


# -- exhibits ----------------------------------------------------------------------------------


@query
def prediction_errors(spark, sf_dir):
    df = dia.metrics(scored(spark, sf_dir), SCORES)
    return rounded(df, RMSE=4, MAE=4, RMSE_WEIGHTED=4, MAE_WEIGHTED=4)


@query
def double_lift(spark, sf_dir):
    df = dia.double_lift(scored(spark, sf_dir), SCORES)
    return rounded(df, PREDICTED=4, OBSERVED=4, EXPOSURE=6)


@query
def lift_calibration(spark, sf_dir):
    lift = dia.lift_calibration(dia.double_lift(scored(spark, sf_dir), SCORES))
    lift = lift.select("MODEL", "DECILE", "GAP", "RATIO", "PREDICTED_RISES", "OBSERVED_RISES")
    return rounded(lift, GAP=4, RATIO=6)


@query
def lorenz_points(spark, sf_dir):
    return rounded(dia.lorenz(scored(spark, sf_dir), "SCORE"), CUM_EXPOSURE=6, CUM_CLAIMS=6)


@query
def lorenz_clustered_ties(spark, sf_dir):
    """A score tied on the tenth of policies with the lowest keys, as a batch of new business."""
    df = scored(spark, sf_dir)
    highest = df.agg(F.max("POLICY_ID")).first()[0]
    tied = df.withColumn("SCORE", F.when(F.col("POLICY_ID") * 10 <= highest, 300.0).otherwise(F.col("SCORE")))
    return rounded(dia.lorenz(tied, "SCORE"), CUM_EXPOSURE=6, CUM_CLAIMS=6)


@query
def lorenz_display(spark, sf_dir):
    points = dia.lorenz_display(dia.lorenz(scored(spark, sf_dir), "DENSITY"), 50)
    return rounded(points, CUM_EXPOSURE=6, CUM_CLAIMS=6, RANDOM=6)


@query
def lorenz_gini(spark, sf_dir):
    return rounded(dia.gini(scored(spark, sf_dir), SCORES), AUC=9, GINI=9)


@query
def lorenz_gini_from_origin(spark, sf_dir):
    return rounded(dia.gini(scored(spark, sf_dir), SCORES, include_origin=True), AUC=9, GINI=9)


@query
def oracle_gini(spark, sf_dir):
    df = dia.gini(scored(spark, sf_dir), {"oracle": dia.OBSERVED})
    return rounded(df, AUC=9, GINI=9)


@query
def model_comparison(spark, sf_dir):
    df = dia.compare_models(scored(spark, sf_dir), SCORES)
    df = df.select("MODEL", "RMSE", "MAE", "GINI", "LIFT_RATIO", "WORST_GAP")
    return rounded(df, RMSE=4, MAE=4, GINI=8, LIFT_RATIO=6, WORST_GAP=4)


@query
def exposure_histogram(spark, sf_dir):
    columns = ["POLICYHOLDER_AGE", "PROPERTY_AGE", "LOSS_HISTORY_SCORE"]
    df = dia.exposure_histogram(stored(spark, sf_dir), columns)
    return rounded(df.select("COLUMN_NAME", "BIN", "LOWER", "EXPOSURE"), LOWER=6, EXPOSURE=6)


@query
def distinct_counts(spark, sf_dir):
    return dia.distinct_counts(policy_freq(spark, sf_dir), [*SPEC.categorical, *SPEC.imputed])


@query
def diagnostic_bundle(spark, sf_dir):
    """The saved exhibits of one model, all four read back, a row per point and measure."""
    df = scored(spark, sf_dir).withColumn(dia.PREDICTED, F.col("SCORE"))
    paths = dia.write_exhibits(df, "score", scratch_path(spark, "exhibits"))
    parts = []
    for name, point, digits in (
        ("double_lift", F.col("DECILE"), {"PREDICTED": 4, "OBSERVED": 4, "EXPOSURE": 6, "GAP": 4, "RATIO": 6}),
        ("lorenz", F.col("POINT"), {"CUM_EXPOSURE": 6, "CUM_CLAIMS": 6, "RANDOM": 6}),
        ("gini", F.lit(0), {"AUC": 9, "GINI": 9}),
        ("metrics", F.lit(0), {"RMSE": 4, "MAE": 4, "RMSE_WEIGHTED": 4, "MAE_WEIGHTED": 4}),
    ):
        values = [F.struct(F.lit(m).alias("MEASURE"), F.round(m, n).alias("VALUE")) for m, n in digits.items()]
        parts.append(
            spark.read.parquet(paths[name]).select(
                F.lit(name).alias("EXHIBIT"), "MODEL", point.cast("int").alias("POINT"), F.inline(F.array(*values))
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def glm_against_trees(spark, sf_dir):
    """Both model families judged on the same validation rows; on one factor they agree with its means."""
    df, features = territory_design(spark, sf_dir)
    train, validation = train_validation(df)
    both = validation
    for name, fit in (
        ("GLM", mdl.fit_glm(train, features, alpha=0.0, collapse=True)),
        ("GBM", mdl.fit_gbt(train, features, rounds=5)),
    ):
        both = fit.predict(both).withColumnRenamed(dia.PREDICTED, name)
    judged = dia.compare_models(materialise(both, "judged"), {"GLM": "GLM", "GBM": "GBM"})
    judged = judged.select("MODEL", "RMSE", "MAE", "RMSE_WEIGHTED", "GINI", "LIFT_RATIO", "WORST_GAP")
    return rounded(judged, RMSE=3, MAE=3, RMSE_WEIGHTED=3, GINI=8, LIFT_RATIO=6, WORST_GAP=3)


# -- explanations ------------------------------------------------------------------------------


def territory_explained(spark, sf_dir):
    df, features = territory_design(spark, sf_dir)
    fit = mdl.fit_glm(df, features, alpha=0.0, collapse=True)
    return exp.explain(fit, df)


@query
def glm_contributions(spark, sf_dir):
    explained = territory_explained(spark, sf_dir)
    return explained.select(
        "POLICY_ID", *[F.round(c, 5).alias(c) for c in explained.columns if c != "POLICY_ID"]
    )


@query
def top_factors(spark, sf_dir):
    return rounded(exp.top_factors(territory_explained(spark, sf_dir), 2), CONTRIBUTION=5)


@query
def global_importance(spark, sf_dir):
    return rounded(exp.global_importance(territory_explained(spark, sf_dir)), IMPORTANCE=5)


@query
def explain_policy(spark, sf_dir):
    """The contributions of one policy picked by its key, the highest, largest first."""
    df, features = territory_design(spark, sf_dir)
    fit = mdl.fit_glm(df, features, alpha=0.0, collapse=True)
    highest = df.agg(F.max("POLICY_ID")).first()[0]
    return rounded(exp.explain_policy(fit, df, highest), CONTRIBUTION=5)


@query
def tree_attributions(spark, sf_dir):
    """Trees on one feature: its attribution is the prediction less the training mean."""
    df = pol.add_targets(stored(spark, sf_dir)).withColumn("AGE", F.coalesce("PROPERTY_AGE", F.lit(-1)).cast("double"))
    fit = mdl.fit_gbt(df, ["AGE"], rounds=2, depth=8)
    explained = exp.explain(fit, df)
    return rounded(explained, BASELINE=2, AGE_explanation=2)


@query
def tree_attributions_add_up(spark, sf_dir):
    """All features: baseline plus attributions against the prediction, for every policy."""
    df, features = full_design(spark, sf_dir)
    fit = mdl.fit_gbt(df, features, rounds=5)
    sums = exp.additivity(fit, df)
    gap = F.abs(F.col("EXPLAINED") - F.col("PREDICTED")) <= 1e-9 * F.abs(F.col("PREDICTED")) + 1e-6
    return sums.select("POLICY_ID", gap.alias("ADDS_UP"))


@query
def tree_global_importance(spark, sf_dir):
    """All features and the whole ensemble, as many rounds as a model takes."""
    df, features = full_design(spark, sf_dir)
    fit = mdl.fit_gbt(df, features)
    return exp.global_importance(exp.explain(fit, df))


# -- runs, model versions, scoring -------------------------------------------------------------


@query
def run_comparison(spark, sf_dir):
    store = PricingStore(spark, scratch_path(spark, "runs"))
    errors = dia.metrics(scored(spark, sf_dir), SCORES)
    store.log_metric_table("pricing", errors, "MODEL", ["RMSE", "MAE"])
    return rounded(store.compare_runs("pricing", ["RMSE", "MAE"]), RMSE=4, MAE=4)


@query
def boosting_run_log(spark, sf_dir):
    """Training and validation loss of every round, logged as steps of two runs and compared."""
    df, features = territory_design(spark, sf_dir)
    train, validation = train_validation(df)
    fit = mdl.fit_gbt(train, features, rounds=2)
    store = PricingStore(spark, scratch_path(spark, "runs"))
    for run, rows in (("train", train), ("validation", validation)):
        store.log_metric_table("boosting", mdl.evaluation_curve(fit, rows), F.lit(run), ["LOSS"], step="ROUND")
    last = store.compare_runs("boosting", ["LOSS"])
    return last.select("run", F.round(F.sqrt("LOSS"), 3).alias("ROOT_LOSS"))


def registered(spark: SparkSession, sf_dir: str) -> tuple[PricingStore, DataFrame]:
    store = PricingStore(spark, scratch_path(spark, "registry"))
    df, features = territory_design(spark, sf_dir)
    train, validation = train_validation(df)
    for version, used in (("v1", features), ("v2", features[:1])):
        fit = mdl.fit_glm(train, used, alpha=0.0, collapse=True)
        errors = dia.metrics(fit.predict(validation)).first()
        store.register_model(
            fit, "TWEEDIE_GLM", version, {"val_rmse": errors["RMSE"]}, sample=train, make_default=version == "v1"
        )
    return store, validation


@query
def model_versions(spark, sf_dir):
    store, _ = registered(spark, sf_dir)
    versions = store.model_versions()
    return versions.select(
        "model", "version", "is_default", F.round(F.col("metrics")["val_rmse"], 3).alias("val_rmse")
    )


@query
def batch_scores(spark, sf_dir):
    """Registered default version, loaded back, scoring the validation features into a table."""
    store, validation = registered(spark, sf_dir)
    features = validation.select("POLICY_ID", *store.get_model("TWEEDIE_GLM").features)
    fit = store.get_model("TWEEDIE_GLM")
    scores = store.score_batch(fit, features, f"{store.root}/scores")
    return rounded(scores.select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


def trained(spark: SparkSession, sf_dir: str, folds: int) -> PricingStore:
    """A one-factor study with its GLM trained and registered; the first level is the base."""
    spec = FeatureSpec(categorical=("TERRITORY_CODE",), binned=(), numeric=(), log_scaled=())
    store = study(spark, sf_dir, spec, exact=False)
    fit = lambda df, features: mdl.fit_glm(df, features[1:], alpha=0.0, collapse=True)
    train_and_register(store, "GLM", "glm_1", "1", fit, folds=folds)
    return store


@query
def training_run_log(spark, sf_dir):
    """Validation and cross-validation errors of a training run, read back from the run log."""
    names = ["val_rmse", "val_mae", "cv_rmse_mean", "cv_rmse_std"]
    found = trained(spark, sf_dir, folds=5).compare_runs(Names.experiment, names)
    return rounded(found, **{n: 3 for n in names})


@query
def score_new_policies(spark, sf_dir):
    """Raw policies scored by the default version through the feature plan it was trained with."""
    store = trained(spark, sf_dir, folds=0)
    scores, _ = score_policies(store, "GLM", policy_freq(spark, sf_dir), f"{store.root}/new")
    return rounded(scores.select("POLICY_ID", dia.PREDICTED), PREDICTED_PURE_PREMIUM=3)


# -- feeds -------------------------------------------------------------------------------------


def inbound(spark: SparkSession, sf_dir: str) -> str:
    """Both feeds written into one inbound directory."""
    path = scratch_path(spark, "inbound")
    feeds.write_policy_feed(policy_freq(spark, sf_dir), f"{path}/home_policy_freq.xml")
    feeds.write_claim_feed(policy_sev(spark, sf_dir), f"{path}/home_policy_sev.xml")
    return path


@query
def xml_policy_roundtrip(spark, sf_dir):
    return feeds.read_policy_feed(spark, inbound(spark, sf_dir), feeds.POLICY_PATTERN)


@query
def xml_claim_roundtrip(spark, sf_dir):
    """Claims through the feed, per policy: every claim arrives, amounts within half a cent."""
    read = feeds.read_claim_feed(spark, inbound(spark, sf_dir), feeds.CLAIM_PATTERN)
    total = F.sum("CLAIM_AMOUNT")
    arrived = read.groupBy("POLICY_ID").agg(F.count("*").alias("CLAIMS"), total.alias("fed"))
    sent = policy_sev(spark, sf_dir).groupBy("POLICY_ID").agg(F.count("*").alias("SENT"), total.alias("sent_amount"))
    close = F.abs(F.col("fed") - F.col("sent_amount")) <= 0.005 * F.col("CLAIMS") + 1e-6
    return arrived.join(sent, "POLICY_ID", "full").select("POLICY_ID", "CLAIMS", "SENT", close.alias("AMOUNT_KEPT"))


@query
def xml_variant_landing(spark, sf_dir):
    landed = feeds.land_feed(spark, inbound(spark, sf_dir), feeds.POLICY_FEED, feeds.POLICY_PATTERN)
    return feeds.extract_fields(landed)


def extended_feed(spark: SparkSession, sf_dir: str) -> str:
    """A policy feed whose sender has added elements: a roof type, a sprinkler flag within the risk, notes that repeat, and an
    inspection date, each on some policies only."""
    key = F.col("PolicyId")
    rows = feeds.feed_rows(policy_freq(spark, sf_dir), feeds.POLICY_FEED)
    rows = rows.withColumns(
        {
            "RoofType": F.when(key % 3 == 0, F.concat(F.lit("R"), key % 5)),
            "Risk": F.col("Risk").withField("Sprinkler", F.when(key % 4 == 1, key % 2 == 1)),
            "Note": F.when(key % 7 == 0, F.array(F.lit("first"), F.lit("second"))),
            "Inspection": F.when(
                key % 5 == 2, F.struct(F.date_add(F.lit("2020-01-01").cast("date"), (key % 28).cast("int")).alias("Day"))
            ),
            "Storeys": F.when(key % 2 == 0, key % 4),
        }
    )
    path = scratch_path(spark, "extended")
    feeds.write_elements(rows, path, feeds.POLICY_FEED)
    return path


@query
def feed_unknown_paths(spark, sf_dir):
    """Elements that landed though the feed's fields do not list them."""
    return feeds.feed_unknown_paths(feeds.land_feed(spark, extended_feed(spark, sf_dir)))


@query
def xml_extended_landing(spark, sf_dir):
    """The known columns of a feed with additions, and the additions by their paths."""
    landed = feeds.land_feed(spark, extended_feed(spark, sf_dir))
    added = {
        "ROOF_TYPE": ("$.RoofType", "string"), "SPRINKLER": ("$.Risk.Sprinkler", "string"),
        "SECOND_NOTE": ("$.Note[1]", "string"), "INSPECTED": ("$.Inspection.Day", "string"), "STOREYS": ("$.Storeys", "int"),
    }
    known = feeds.POLICY_FEED[2][:1] + feeds.POLICY_FEED[2][6:7]
    columns = [F.try_variant_get("SRC", f"$.{path}", kind).alias(c) for c, path, kind in known]
    return landed.select(*columns, *[F.try_variant_get("SRC", path, kind).alias(c) for c, (path, kind) in added.items()])


@query
def feed_quality(spark, sf_dir):
    return feeds.feed_quality(spark, inbound(spark, sf_dir), feeds.POLICY_FEED, feeds.POLICY_PATTERN)


@query
def feed_row_counts(spark, sf_dir):
    root = scratch_path(spark, "loaded")
    feeds.load_feeds(spark, inbound(spark, sf_dir), f"{root}/policies", f"{root}/claims")
    parts = [
        spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("ROW_COUNT")).select(F.lit(name).alias("FEED"), "ROW_COUNT")
        for name in ("policies", "claims")
    ]
    return parts[0].unionByName(parts[1])


@query
def source_normalise(spark, sf_dir):
    """Source-shaped rows (quoted codes, text numbers, some codes unknown) made into policies."""
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    raw = orders.select(
        key.cast("string").alias("IDpol"),
        (key % 5).cast("string").alias("ClaimNb"),
        ((1 + key % 13).cast("double") / 16).alias("Exposure"),
        F.concat(F.lit("'"), F.substring("o_orderpriority", 3, 20), F.lit("'")).alias("Area"),
        F.when(key % 7 == 0, "n/a").otherwise((key % 12).cast("string")).alias("VehPower"),
        (key % 40).cast("string").alias("VehAge"),
        (18 + key % 70).cast("string").alias("DrivAge"),
        (50 + key % 180).cast("string").alias("BonusMalus"),
        F.concat(F.lit("'B"), (F.col("o_custkey") % 16).cast("string"), F.lit("'")).alias("VehBrand"),
        F.when(F.col("o_orderstatus") == "F", "'Regular'")
        .when(F.col("o_orderstatus") == "O", "Diesel")
        .otherwise("'Electric'")
        .alias("VehGas"),
        F.col("o_totalprice").alias("Density"),
        F.concat(F.lit("''"), F.col("o_orderstatus"), F.lit("'")).alias("Region"),
    )
    return feeds.normalise_policies(raw)


@query
def source_claims_normalise(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    raw = lines.select(F.col("l_orderkey").cast("string").alias("IDpol"), F.col("l_extendedprice").alias("ClaimAmount"))
    return feeds.normalise_claims(raw).groupBy("POLICY_ID").agg(
        F.count("CLAIM_AMOUNT").alias("CLAIMS"), F.round(F.max("CLAIM_AMOUNT"), 4).alias("LARGEST")
    )


@query
def predictions_xml(spark, sf_dir):
    """Predictions to a table, the table to XML, the XML read back."""
    path = scratch_path(spark, "predictions")
    scored(spark, sf_dir).select("POLICY_ID", F.col("SCORE").alias(dia.PREDICTED)).write.parquet(f"{path}/table")
    table = spark.read.parquet(f"{path}/table")
    feeds.write_predictions_feed(table, f"{path}/feed.xml")
    return feeds.read_predictions_feed(spark, f"{path}/feed.xml", table.schema)


@query
def model_predictions_xml(spark, sf_dir):
    """A registered model's scores of the validation rows, exported to XML and read back."""
    store, validation = registered(spark, sf_dir)
    features = validation.select("POLICY_ID", *store.get_model("TWEEDIE_GLM").features)
    scores = store.export_scores("TWEEDIE_GLM", features, f"{store.root}/export")
    read = feeds.read_predictions_feed(spark, f"{store.root}/export/scores.xml", scores.schema)
    return rounded(read, PREDICTED_PURE_PREMIUM=3)


# -- data dictionary ---------------------------------------------------------------------------


def all_tables(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    return {("testdata", name): read_table(spark, sf_dir, name) for name in TABLES}


def descriptions(spark: SparkSession) -> DataFrame:
    first = [
        ("testdata", "orders", None, "Orders, played as policies.", "2024-01-01 00:00:00"),
        ("testdata", "orders", "o_orderkey", "Key of the order.", "2024-01-01 00:00:00"),
        ("testdata", "orders", "o_custkey", "Customer who placed the order.", "2024-01-01 00:00:00"),
        ("testdata", "lineitem", "l_quantity", "Units ordered.", "2024-01-01 00:00:00"),
    ]
    update = [("testdata", "orders", "o_orderkey", "Identifier of the order.", "2024-02-01 00:00:00")]
    names = "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DESCRIPTION string, at string"

    def frame(rows):
        df = spark.createDataFrame(rows, names)
        return df.withColumn("UPDATED_AT", F.to_timestamp("at")).drop("at")

    return dic.describe(frame(first), frame(update))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = all_tables(spark, sf_dir)
    return dic.build_dictionary(dic.table_profile(tables), dic.column_profile(tables), descriptions(spark))


@query
def table_counts(spark, sf_dir):
    return dic.table_profile(all_tables(spark, sf_dir))


@query
def table_sizes(spark, sf_dir):
    """Files and bytes per table; file paths are not known to SQL."""
    paths = {("testdata", name): f"{sf_dir}/{name}.parquet" for name in TABLES}
    return dic.table_sizes(spark, paths).drop("LAST_ALTERED")


@query
def schema_rollup(spark, sf_dir):
    return dic.schema_rollup(dic.table_profile(all_tables(spark, sf_dir)))


@query
def dictionary_columns(spark, sf_dir):
    columns = dic.column_profile(all_tables(spark, sf_dir))
    return columns.select("TABLE_NAME", "ORDINAL_POSITION", "COLUMN_NAME", "DATA_TYPE", "MAX_LENGTH", "NULL_COUNT")


@query
def dictionary_view(spark, sf_dir):
    """The dictionary with bytes and distinct counts as a view, asked in SQL: a row per column, whether its table has a size,
    and its distinct values within 2 %."""
    tables = all_tables(spark, sf_dir)
    paths = {("testdata", t): f"{sf_dir}/{t}.parquet" for t in TABLES}
    sized = dic.with_sizes(dic.table_profile(tables), dic.table_sizes(spark, paths))
    sketched = None
    for name in TABLES:
        part = sk.sketch_batch(tables["testdata", name], name, "1")
        sketched = part if sketched is None else sketched.unionByName(part)
    known = dic.with_distincts(dic.column_profile(tables), sk.profile(sk.merge_batches(sketched)))
    view = dic.register_dictionary(dic.build_dictionary(sized, known, descriptions(spark)))
    return spark.sql(
        f"""SELECT TABLE_NAME, COLUMN_NAME, ROW_COUNT, COL_POSITION, BYTES > 0 AS HAS_BYTES,
          DISTINCT_COUNT <= greatest(1.02 * ROW_COUNT, 1) AS DISTINCT_KNOWN, COLUMN_DESCRIPTION FROM {view}"""
    )


@query
def data_dictionary(spark, sf_dir):
    return dictionary(spark, sf_dir)


@query
def dictionary_one_table(spark, sf_dir):
    return dic.of_table(dictionary(spark, sf_dir), "orders").select(
        "TABLE_NAME", "ROW_COUNT", "COL_POSITION", "COLUMN_NAME", "DATA_TYPE", "COLUMN_DESCRIPTION"
    )


@query
def undocumented_columns(spark, sf_dir):
    return dic.undocumented(dictionary(spark, sf_dir)).drop("TABLE_SCHEMA")


@query
def doc_coverage(spark, sf_dir):
    return rounded(dic.coverage(dictionary(spark, sf_dir)).drop("TABLE_SCHEMA"), COVERAGE=4)
