"""Tables of the session catalog, bucketed by key, so that joins and groupings on the key need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.sources.store import spine_join
from ratewright.storage import scratch_path

ROWS_PER_BUCKET = 5_000_000


def buckets_for(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, least: int = 8) -> int:
    """A power of two, so that tables of different sizes can still be joined bucket by bucket."""
    wanted = max(least, -(-df.count() // rows_per_bucket))
    return 1 << (wanted - 1).bit_length()


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as the catalog table ``name``, one sorted file per bucket of ``key``, replacing it; returns its scan. The one
    shuffle is paid here. Files go to ``path``, or to a folder of their own in the shared folder."""
    spark = df.sparkSession
    (
        df.repartition(buckets, key)
        .write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .mode("overwrite")
        .option("path", path or scratch_path(spark, "bucketed"))
        .saveAsTable(name)
    )
    return spark.table(name)


def bucketed_claims(spark: SparkSession, policies: str, claims: str, key: str = "POLICY_ID") -> DataFrame:
    """The policies of a bucketed table with the claims of another: claims are summed and joined inside each bucket, rows of
    either table never leave it. Policies without claims have 0."""
    per_policy = spark.table(claims).groupBy(key).agg(F.sum("CLAIM_AMOUNT").alias("CLAIM_AMOUNT"))
    joined = spark.table(policies).join(per_policy.hint("merge"), key, "left")
    return joined.withColumn("CLAIM_AMOUNT", F.coalesce("CLAIM_AMOUNT", F.lit(0.0)))


def bucketed_spine(spark: SparkSession, spine: str, view: str, key: str = "POLICY_ID") -> DataFrame:
    """``store.spine_join`` of two bucketed tables."""
    return spine_join(spark.table(spine), spark.table(view).hint("merge"), [key])
