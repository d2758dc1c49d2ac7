import numpy as np
from plan_text import explained
from pyspark.sql import functions as F

from ratewright.operators import sketches as sk
from ratewright.operators.policy import attach_claims
from ratewright.sources import catalog
from ratewright.sources.adapter import policy_freq, policy_sev
from ratewright.storage import materialise


def two_batches(spark, df, name):
    first, second = (df.where(F.pmod(F.xxhash64(*df.columns), F.lit(2)) == i) for i in (0, 1))
    rows = sk.sketch_batch(first, name, "1").unionByName(sk.sketch_batch(second, name, "2"))
    return materialise(rows, "sketches")


def test_merged_batches_count_and_rank(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    merged = sk.merge_batches(two_batches(spark, df, "lineitem"))
    found = {r["COLUMN_NAME"]: r for r in sk.profile(merged, [0.1, 0.5, 0.9]).collect()}
    rows = df.toPandas()
    assert set(found) == set(df.columns)
    for c in df.columns:
        exact = rows[c].nunique()
        assert abs(found[c]["DISTINCT_COUNT"] - exact) <= max(1, 0.02 * exact)
        assert found[c]["ROW_COUNT"] == len(rows) and found[c]["BATCHES"] == 2
    values = np.sort(rows["l_extendedprice"].to_numpy(float))
    for p, v in zip([0.1, 0.5, 0.9], found["l_extendedprice"]["VALUES"]):
        assert np.searchsorted(values, v, "left") <= (p + 0.003) * len(values) and np.searchsorted(values, v, "right") >= (p - 0.003) * len(values)
    assert found["l_returnflag"]["VALUES"] is None


def test_columns_of_every_kind(spark):
    df = spark.sql(
        "SELECT 1 AS a, CAST(NULL AS double) AS b, array(1, 2) AS c, true AS d, named_struct('x', 1) AS e, 1.5BD AS `f.g`, date'2020-01-01' AS h"
    )
    found = {r["COLUMN_NAME"]: r for r in sk.profile(sk.merge_batches(sk.sketch_batch(df, "t", "1"))).collect()}
    assert {c: r["DISTINCT_COUNT"] for c, r in found.items()} == {"a": 1, "b": 0, "c": 1, "d": 1, "e": 1, "f.g": 1, "h": 1}
    assert found["b"]["VALUES"] is None and found["a"]["VALUES"] == [1.0] * 5
    empty = sk.profile(sk.merge_batches(sk.sketch_batch(df.where("false"), "t", "1"))).collect()
    assert {r["DISTINCT_COUNT"] for r in empty} == {0} and {r["VALUES"] for r in empty} == {None}


def test_no_shuffle_between_bucketed_tables(spark, sf_dir):
    freq, sev = policy_freq(spark, sf_dir), policy_sev(spark, sf_dir)
    catalog.save_bucketed(freq, "bucketed_policies_t", "POLICY_ID", 8)
    catalog.save_bucketed(sev, "bucketed_claims_t", "POLICY_ID", 8)
    joined = catalog.bucketed_claims(spark, "bucketed_policies_t", "bucketed_claims_t")
    joined.collect()
    assert "Exchange" not in explained(joined)
    plain = attach_claims(freq, sev).select("POLICY_ID", F.round("CLAIM_AMOUNT", 4))
    assert sorted(joined.select("POLICY_ID", F.round("CLAIM_AMOUNT", 4)).collect()) == sorted(plain.collect())
    view = freq.select("POLICY_ID", F.col("EXPOSURE").alias("E2"))
    catalog.save_bucketed(view, "bucketed_view_t", "POLICY_ID", 8)
    spine = catalog.bucketed_spine(spark, "bucketed_policies_t", "bucketed_view_t")
    assert "Exchange" not in explained(spine) and spine.where("E2 = EXPOSURE").count() == spine.where("EXPOSURE IS NOT NULL").count()


def test_buckets_are_powers_of_two(spark):
    assert catalog.buckets_for(spark.range(10)) == 8
    assert catalog.buckets_for(spark.range(100), rows_per_bucket=5) == 32
