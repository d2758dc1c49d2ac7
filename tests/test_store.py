import pytest
from plan_text import explained
from pyspark.sql import functions as F

from ratewright.operators import models as mdl
from ratewright.operators.diagnostics import PREDICTED
from ratewright.operators.features import FeaturePlan, FeatureSpec
from ratewright.plans.pricing import Names, freeze_study, score_policies, score_portfolio, train_and_register
from ratewright.sources import claims
from ratewright.sources.adapter import policy_freq, policy_sev
from ratewright.sources.store import AlreadyExists, PricingStore, spine_join
from ratewright.storage import scratch_path, shared_dir, spread

SPEC = FeatureSpec(categorical=("TERRITORY_CODE", "OCCUPANCY_TYPE"))


@pytest.fixture
def store(spark):
    return PricingStore(spark, scratch_path(spark, "store"))


@pytest.fixture(scope="module")
def study(spark, sf_dir):
    store = PricingStore(spark, scratch_path(spark, "study"))
    plan = freeze_study(store, policy_freq(spark, sf_dir), policy_sev(spark, sf_dir), spec=SPEC)
    return store, plan


def test_frozen_datasets(study, sf_dir, spark):
    store, plan = study
    train, validation = store.load_dataset(Names.training, "1"), store.load_dataset(Names.validation, "1")
    assert train.columns == ["POLICY_ID", "PURE_PREMIUM", "EXPOSURE", *plan.names]
    assert train.join(validation, "POLICY_ID", "left_semi").count() == 0
    assert train.count() + validation.count() == policy_freq(spark, sf_dir).count()
    features = store.load_dataset(Names.training, "1", only_features=True)
    assert features.columns == ["POLICY_ID", *plan.names]
    with pytest.raises(AlreadyExists):
        store.generate_dataset(train.select("POLICY_ID"), Names.training, "1", Names.view, "1")
    with pytest.raises(KeyError):
        store.load_dataset(Names.training, "2")
    record = store.records("feature_views").first()
    assert FeaturePlan.from_json(record["description"]) == plan


def test_freezing_again_changes_nothing(study, sf_dir, spark):
    store, _ = study
    kinds = ("feature_views", "datasets")
    before = {k: sorted(map(repr, store.records(k).collect())) for k in kinds}
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store.root)
    files = sorted((r["path"], r["modificationTime"]) for r in stored.select("path", "modificationTime").collect())
    half = policy_freq(spark, sf_dir).where("POLICY_ID % 2 = 0")
    with pytest.raises(AlreadyExists):
        freeze_study(store, half, policy_sev(spark, sf_dir), spec=SPEC)
    assert {k: sorted(map(repr, store.records(k).collect())) for k in kinds} == before
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(store.root)
    assert sorted((r["path"], r["modificationTime"]) for r in stored.select("path", "modificationTime").collect()) == files


def frozen(spark, store):
    rows = spark.range(200).selectExpr("id AS POLICY_ID", "id * 0.5 AS PURE_PREMIUM", "1.0D AS EXPOSURE")
    if not store.has_view("V", "1"):
        store.register_view(spark.range(200).selectExpr("id AS POLICY_ID", "nullif(id % 7, 3) AS X"), "V", "1")
    return rows


def test_of_two_writers_one_freezes_a_version(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    rows = frozen(spark, store)

    def write(k):
        try:
            store.generate_dataset(rows.where(F.col("POLICY_ID") % 4 == k), "D", "1", "V", "1")
        except AlreadyExists:
            return None
        return k

    with ThreadPoolExecutor(4) as pool:
        won = [k for k in pool.map(write, range(4)) if k is not None]
    assert len(won) == 1 and store.records("datasets").count() == 1
    assert {r["POLICY_ID"] % 4 for r in store.load_dataset("D", "1").collect()} == set(won)


def test_a_failed_write_leaves_the_version_free(spark, store):
    rows = frozen(spark, store)
    broken = rows.withColumn("EXPOSURE", F.when(F.col("POLICY_ID") == 150, F.raise_error(F.lit("no"))).otherwise(1.0))
    with pytest.raises(Exception, match="no"):
        store.generate_dataset(broken, "D", "1", "V", "1")
    assert store.records("datasets").count() == 0
    assert store.generate_dataset(rows, "D", "1", "V", "1").count() == 200
    with pytest.raises(AlreadyExists):
        store.abandon("datasets", "D", "1")


def test_audit_finds_changed_rows(spark, store):
    rows = frozen(spark, store)
    store.generate_dataset(rows, "D", "1", "V", "1")
    store.generate_dataset(rows.limit(0), "EMPTY", "1", "V", "1")
    assert {(r["name"], r["ROWS"], r["INTACT"]) for r in store.audit_datasets().collect()} == {
        ("D", 200, True),
        ("EMPTY", 0, True),
    }
    path = store.records("datasets").where("name = 'D'").first()["path"]
    stored = spark.read.parquet(path)
    again = stored.orderBy(F.desc("POLICY_ID")).toArrow()
    other = spark.createDataFrame(again).repartition(3)
    other.write.mode("overwrite").parquet(path)  # the same rows in other files and order
    assert store.audit_datasets().where("name = 'D'").first()["INTACT"]
    for column in ("PURE_PREMIUM", "X"):
        changed = F.when(F.col("POLICY_ID") == 17, F.lit(99)).otherwise(F.col(column)).cast(other.schema[column].dataType)
        other.withColumn(column, changed).write.mode("overwrite").parquet(path)
        assert not store.audit_datasets().where("name = 'D'").first()["INTACT"]


def test_row_digests_need_no_text_of_rows(spark):
    rows = spark.createDataFrame(
        [(1, None, 2.0, "a", [1, None]), (2, 2.0, None, None, None)], "K long, A double, B double, S string, N array<int>"
    )
    assert "json" in explained(claims.marked(rows, ["K"])).lower()  # of the array alone
    assert "json" not in explained(claims.marked(rows.drop("N"), ["K"])).lower()

    def digest(df):
        return claims.marked(df, ["K"]).agg(*claims.digests()).first()["row_digest"]

    whole = digest(rows)
    assert digest(rows.orderBy(F.desc("K"))) == whole and digest(rows.union(rows)) != whole
    swapped = rows.select("K", F.col("B").alias("A"), F.col("A").alias("B"), "S", "N")
    assert digest(swapped) != whole  # a NULL has a place
    assert digest(rows.withColumn("S", F.coalesce("S", F.lit("")))) != whole
    assert digest(rows.withColumn("N", F.reverse("N"))) != whole


def test_audit_of_records_with_digests_of_json_text(spark, store):
    store.generate_dataset(frozen(spark, store), "D", "1", "V", "1")
    table = f"{store.root}/records/datasets"
    record = store.records("datasets")
    path = record.first()["path"]
    stored = spark.read.parquet(path)
    before = claims.marked(stored, ["POLICY_ID"], form="").agg(*claims.digests("")).first()["row_digest"]
    old = spark.createDataFrame([r.asDict() | {"row_digest": before} for r in record.collect()], record.schema)
    old.write.mode("overwrite").parquet(table)
    assert before.isdigit() and store.audit_datasets().first()["INTACT"]
    changed = spark.createDataFrame(stored.toArrow()).withColumn("X", F.lit(5).cast(stored.schema["X"].dataType))
    changed.write.mode("overwrite").parquet(path)
    assert not store.audit_datasets().first()["INTACT"]


def test_training_scoring_and_comparison(study):
    store, _ = study
    glm = train_and_register(store, "GLM", "glm_1", "1", lambda df, f: mdl.fit_glm(df, f, alpha=0.5), folds=2)
    gbt = train_and_register(store, "GBT", "gbt_1", "1", lambda df, f: mdl.fit_gbt(df, f, rounds=2))
    assert glm["val_rmse"] > 0 and gbt["val_rmse"] > 0
    runs = {r["run"]: r for r in store.compare_runs(Names.experiment, ["val_rmse", "val_gini"]).collect()}
    assert runs["glm_1"]["val_rmse"] == glm["val_rmse"] and runs["gbt_1"]["val_gini"] == gbt["val_gini"]
    params = store.records("run_params").where("run = 'glm_1'").select("param").collect()
    assert {"alpha", "power", "ds_version"} <= {r["param"] for r in params}
    versions = {(r["model"], r["version"]): r for r in store.model_versions().collect()}
    record = versions["GLM", "glm_1"]
    assert record["is_default"] and record["run"] == "glm_1" and record["dataset_version"] == "1"
    assert store.spark.read.parquet(record["sample_path"]).count() == 10
    assert len(record["attachments"]) == 4
    lift = store.spark.read.parquet(next(p for p in record["attachments"] if p.endswith("double_lift")))
    assert {"GAP", "PREDICTED_RISES"} <= set(lift.columns)

    path = f"{store.root}/scores"
    first = score_portfolio(store, "GLM", "1", path)
    again = score_portfolio(store, "GLM", "1", path)
    validation = store.load_dataset(Names.validation, "1")
    assert "PURE_PREMIUM" not in first.columns and again.count() == validation.count()
    stored = store.spark.read.parquet(f"{store.root}/runs/{Names.experiment}/glm_1/scored")
    gap = stored.select("POLICY_ID", F.col(PREDICTED).alias("p")).join(again, "POLICY_ID")
    assert gap.where(F.col("p") != F.col(PREDICTED)).count() == 0
    with pytest.raises(ValueError, match="lacks"):
        store.score_batch(store.get_model("GLM"), validation.select("POLICY_ID"), path)
    fit = store.get_model("GLM")
    with pytest.raises(ValueError, match=f"not numeric: {fit.features[0]}"):
        store.score_batch(fit, validation.withColumn(fit.features[0], F.col(fit.features[0]).cast("string")), path)

    # cross-validation of the GLM and the losses of every boosting round are in the run log
    logged = store.records("run_metrics")
    cv = mdl.cross_validate(store.load_dataset(Names.training, "1"), fit.features, 2, [0.5])
    assert glm["cv_rmse_mean"] == pytest.approx(mdl.cv_summary(cv).first()["CV_RMSE_MEAN"])
    assert "cv_rmse_mean" not in gbt
    steps = {r["step"]: r["value"] for r in logged.where("run = 'gbt_1' AND metric = 'val_loss'").collect()}
    assert sorted(steps) == [1, 2] and all(v > 0 for v in steps.values())
    once = train_and_register(store, "GLM", "glm_2", "1", lambda df, f: mdl.fit_glm(df, f, alpha=0.5), folds=1)
    assert not [k for k in once if k.startswith("cv_")]


def test_raw_policies_are_scored_through_the_stored_plan(study, sf_dir, spark):
    store, plan = study
    train_and_register(store, "RAW", "raw_1", "1", lambda df, f: mdl.fit_glm(df, f, alpha=0.5), folds=0)
    policies = policy_freq(spark, sf_dir)
    scores, check = score_policies(store, "RAW", policies, f"{store.root}/raw")
    frozen = store.score_batch(store.get_model("RAW"), store.load_dataset(Names.validation, "1", True), f"{store.root}/f")
    both = frozen.select("POLICY_ID", F.col(PREDICTED).alias("p")).join(scores, "POLICY_ID")
    assert scores.count() == policies.count() and both.count() == frozen.count()
    assert both.where(F.abs(F.col("p") - F.col(PREDICTED)) > 1e-9 * F.col("p")).count() == 0
    assert {r["COLUMN_NAME"] for r in check.collect()} == {*plan.spec.imputed, *plan.spec.categorical}
    new = policies.withColumn("OCCUPANCY_TYPE", F.lit("Houseboat"))
    _, check = score_policies(store, "RAW", new, f"{store.root}/raw_new")
    assert {r["COLUMN_NAME"]: r["UNSEEN_LEVELS"] for r in check.collect()}["OCCUPANCY_TYPE"] == policies.count()
    with pytest.raises(ValueError, match="missing input"):
        score_policies(store, "RAW", policies.drop("OCCUPANCY_TYPE"), f"{store.root}/raw_bad")


def test_versions_and_defaults(store, policies):
    df = policies.selectExpr("EXPOSURE", "CLAIM_AMOUNT / EXPOSURE AS PURE_PREMIUM", "double(CONSTRUCTION_QUALITY) AS Q")
    fit = mdl.fit_glm(df, ["Q"], collapse=True)
    store.register_model(fit, "M", "v1", {"rmse": 1.0})
    store.register_model(fit, "M", "v2", make_default=False)
    with pytest.raises(AlreadyExists):
        store.register_model(fit, "M", "v1")
    state = lambda: {r["version"]: r["is_default"] for r in store.model_versions().collect()}
    assert state() == {"v1": True, "v2": False}
    store.set_default("M", "v2")
    assert state() == {"v1": False, "v2": True}
    assert store.get_model("M").params["alpha"] == store.get_model("M", "v1").params["alpha"]
    with pytest.raises(KeyError):
        store.get_model("N")


def test_entity_keys_are_checked(store, spark):
    twice = spark.createDataFrame([(1, 2.0), (1, 3.0)], "POLICY_ID long, X double")
    with pytest.raises(ValueError, match="1 repeated keys"):
        store.register_view(twice, "V", "1")
    missing = spark.createDataFrame([(None, 2.0)], "POLICY_ID long, X double")
    with pytest.raises(ValueError, match="1 rows without a key"):
        store.register_view(missing, "V", "1")
    assert store.records("feature_views").count() == 0


def test_view_versions_replace_but_datasets_stay(store, spark):
    one = spark.createDataFrame([(1, 2.0)], "POLICY_ID long, X double")
    two = spark.createDataFrame([(1, 9.0)], "POLICY_ID long, X double")
    spine = spark.createDataFrame([(1, 5.0, 1.0), (2, 6.0, 1.0)], "POLICY_ID long, PURE_PREMIUM double, EXPOSURE double")
    store.register_view(one, "V", "1")
    store.generate_dataset(spine, "D", "1", "V", "1")
    store.register_view(two, "V", "1")
    assert store.view("V", "1").first()["X"] == 9.0
    frozen = {r["POLICY_ID"]: r["X"] for r in store.load_dataset("D", "1").collect()}
    assert frozen == {1: 2.0, 2: None}
    with pytest.raises(ValueError, match="both sides"):
        spine_join(spine, spine, ["POLICY_ID"])


def test_metrics_keep_the_highest_step(store):
    store.log_metrics("E", "r", {"loss": 3.0}, step=1)
    store.log_metrics("E", "r", {"loss": 2.0}, step=2)
    store.log_metrics("E", "s", {"loss": None})
    rows = {r["run"]: r["loss"] for r in store.compare_runs("E", ["loss"]).collect()}
    assert rows == {"r": 2.0, "s": None}


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_spread_leaves_wide_tables_alone(spark, policies):
    assert spread(policies.repartition(9)).rdd.getNumPartitions() == 9
    assert spread(policies.coalesce(1)).rdd.getNumPartitions() == 4
