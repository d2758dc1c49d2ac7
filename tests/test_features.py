import pytest
from pyspark.sql import functions as F

from plan_text import explained
from ratewright.functions.columns import cap, interval_index, key_slot, relabel, strip_quotes
from ratewright.operators.features import FeaturePlan, FeatureSpec, feature_columns
from ratewright.operators.policy import Caps, add_targets, condition, prepare_policies
from ratewright.operators.splits import add_fold, hash_split, split_check
from ratewright.sources.adapter import policy_freq, policy_sev

SPEC = FeatureSpec()


def test_conditioning_edges(spark):
    rows = [
        (1, 9, 1.5, 500.0),
        (2, 2, 0.5, 0.0),
        (3, None, 0.5, 10.0),
        (4, 1, None, 300_000.0),
        (5, 0, 0.0, 40.0),
    ]
    df = spark.createDataFrame(rows, "POLICY_ID long, CLAIM_COUNT int, EXPOSURE double, CLAIM_AMOUNT double")
    once = condition(df, Caps())
    got = {r["POLICY_ID"]: r for r in add_targets(once).collect()}
    assert got[1]["CLAIM_COUNT"] == 4 and got[1]["EXPOSURE"] == 1.0
    assert got[2]["CLAIM_COUNT"] == 0
    assert got[3]["CLAIM_COUNT"] is None and got[3]["AVG_CLAIM_AMOUNT"] is None
    assert got[4]["EXPOSURE"] is None and got[4]["CLAIM_AMOUNT"] == 200_000.0 and got[4]["PURE_PREMIUM"] is None
    assert got[5]["PURE_PREMIUM"] is None and got[5]["FREQUENCY"] is None
    assert condition(once, Caps()).collect() == once.collect()


def test_expressions(spark):
    df = spark.createDataFrame([("''A'",), ("B",), (None,)], "c string")
    assert [r[0] for r in df.select(strip_quotes("c")).collect()] == ["A", "B", None]
    assert [r[0] for r in df.select(relabel("c", {"B": "bee"})).collect()] == [None, "bee", None]
    n = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (9.0,), (None,)], "x double")
    assert [r[0] for r in n.select(interval_index("x", [1.0, 2.0, 2.0, 3.0])).collect()] == [0, 1, 3, 4, None]
    assert [r[0] for r in n.select(cap("x", 2.0)).collect()] == [1.0, 2.0, 2.0, 2.0, None]


def test_fit_uses_two_jobs(spark, policies):
    context = spark.sparkContext
    context.setJobGroup("fit", "feature statistics")
    try:
        FeaturePlan.fit(policies, SPEC, cache=False)
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("fit") for s in tracker.getJobInfo(j).stageIds}
        # with adaptive execution an aggregate is one map job and one result job
        assert len(tracker.getJobIdsForGroup("fit")) <= 4 and len(stages) <= 6
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("exact", [True, False])
def test_matrix_invariants(policies, exact):
    plan = FeaturePlan.fit(policies, SPEC, exact=exact)
    matrix = plan.transform(policies)
    assert matrix.columns == ["POLICY_ID", "CLAIM_COUNT", "EXPOSURE", "CLAIM_AMOUNT", *plan.names]
    assert set(dict(matrix.select(*plan.names).dtypes).values()) == {"double"}
    groups = {c: [f for f in plan.names if f.startswith(f"{c}_CLEAN_BIN_")] for c in SPEC.binned}
    assert all(len(g) == 10 for g in groups.values())
    groups |= {c: [f for f in plan.names if f.startswith(f"{c}_")] for c in SPEC.categorical}
    sums = matrix.select("POLICY_ID", *[sum((F.col(f) for f in g), F.lit(0.0)).alias(c) for c, g in groups.items()])
    joined = sums.join(policies.select("POLICY_ID", F.col("OCCUPANCY_TYPE").alias("raw")), "POLICY_ID")
    bad = F.lit(False)
    for c in groups:
        expected = F.col("raw").isNotNull().cast("double") if c == "OCCUPANCY_TYPE" else F.lit(1.0)
        bad |= F.col(c) != expected
    assert joined.where(bad).count() == 0


def test_plan_survives_json_and_repartition(policies):
    plan = FeaturePlan.fit(policies, SPEC, exact=True)
    again = FeaturePlan.from_json(plan.to_json())
    assert again == plan
    first = plan.transform(policies)
    second = again.transform(policies.repartition(7))
    assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0
    assert FeaturePlan.fit(policies.repartition(5), SPEC, exact=True).boundaries == plan.boundaries


def test_unseen_level_gives_zeros(policies):
    plan = FeaturePlan.fit(policies, SPEC, fit_on=F.col("TERRITORY_CODE") != "ASIA")
    assert "TERRITORY_CODE_ASIA" not in plan.names
    asia = plan.transform(policies.where("TERRITORY_CODE = 'ASIA'"))
    seen = sum((F.col(f) for f in plan.names if f.startswith("TERRITORY_CODE_")), F.lit(0.0))
    assert asia.where(seen != 0).count() == 0
    check = {r["COLUMN_NAME"]: r for r in plan.check_input(policies).collect()}
    assert check["TERRITORY_CODE"]["UNSEEN_LEVELS"] == asia.count()


def test_fit_refuses_what_it_cannot_encode(spark, policies):
    with pytest.raises(ValueError, match="LOSS_HISTORY_SCORE"):
        FeaturePlan.fit(policies.withColumn("LOSS_HISTORY_SCORE", F.lit(None).cast("double")), SPEC)
    clash = policies.withColumn("REGION_CODE", F.when(F.col("POLICY_ID") % 2 == 0, "a-b").otherwise("A b"))
    with pytest.raises(ValueError, match="REGION_CODE_A_B"):
        FeaturePlan.fit(clash, SPEC)
    with pytest.raises(ValueError, match="levels"):
        FeaturePlan.fit(policies.withColumn("REGION_CODE", F.col("POLICY_ID").cast("string")), SPEC, max_levels=50)
    flat = policies.withColumn("POPULATION_DENSITY", F.col("POPULATION_DENSITY") - 1e7)
    with pytest.raises(ValueError, match="not positive"):
        FeaturePlan.fit(flat, SPEC)
    floored = FeaturePlan.fit(
        policies.withColumn("POPULATION_DENSITY", F.col("POPULATION_DENSITY") - 2000), SPEC, log_floor=1.0
    )
    assert floored.log_stats["POPULATION_DENSITY"][1] > 0
    with pytest.raises(ValueError, match="missing input"):
        floored.check_input(policies.drop("REGION_CODE"))


def test_single_level_and_tied_boundaries(policies):
    one = policies.withColumns({"REGION_CODE": F.lit("X"), "PROPERTY_AGE": F.lit(3)})
    plan = FeaturePlan.fit(one, SPEC, exact=True)
    assert plan.levels["REGION_CODE"] == ["X"] and plan.boundaries["PROPERTY_AGE_CLEAN"] == [3.0] * 9
    assert plan.transform(one).where("PROPERTY_AGE_CLEAN_BIN_0 = 1 AND REGION_CODE_X = 1").count() == one.count()


def test_feature_list_by_exclusion():
    assert feature_columns(["POLICY_ID", "A", "PURE_PREMIUM", "EXPOSURE", "B"]) == ["A", "B"]


def test_split_is_stable_disjoint_and_complete(policies):
    train, validation = hash_split(policies)
    shuffled, _ = hash_split(policies.repartition(11))
    assert {r[0] for r in train.select("POLICY_ID").collect()} == {r[0] for r in shuffled.select("POLICY_ID").collect()}
    assert split_check(policies, train, validation).first().asDict() == {"SHARED": 0, "LOST": 0}
    assert 0.7 < train.count() / policies.count() < 0.8
    with pytest.raises(ValueError):
        add_fold(policies, 1)
    sizes = add_fold(policies, 4).groupBy("FOLD").count().collect()
    assert len(sizes) == 4 and policies.select(key_slot("POLICY_ID", 4, "other:")).distinct().count() == 4


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    plan = explained(prepare_policies(policy_freq(spark, sf_dir), policy_sev(spark, sf_dir)).select("POLICY_ID", "CLAIM_AMOUNT"))
    lineitem = [s for s in plan.split("\n\n") if "lineitem.parquet" in s]
    assert lineitem and all("l_shipdate" not in s and "l_comment" not in s for s in lineitem)
    assert any("EqualTo(l_returnflag,R)" in s for s in lineitem)
    assert "CartesianProduct" not in plan


def test_factors_list_their_own_indicators(policies):
    spec = FeatureSpec(categorical=("TERRITORY_CODE",), binned=("PROPERTY_AGE",))
    plan = FeaturePlan.fit(policies, spec, cache=False)
    factors = plan.factors()
    assert list(factors) == ["PROPERTY_AGE_CLEAN", "TERRITORY_CODE"]
    assert sum(factors.values(), []) == [*plan.bin_indicators(), *plan.level_indicators()]
