"""Policy and claim tables derived from the star-schema test tables.

Orders play policies, returned line items play claims. Missing values, exposures above one year
and claim counts above the cap are planted by arithmetic on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.storage import spread


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def policy_sev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOME_POLICY_SEV: one row per claim."""
    return (
        read_table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount > 0")
        .select(
            F.col("l_orderkey").alias("POLICY_ID"),
            (F.col("l_extendedprice") * F.col("l_quantity") * F.col("l_discount")).alias("CLAIM_AMOUNT"),
        )
    )


def policy_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOME_POLICY_FREQ: one row per policy."""
    claims = policy_sev(spark, sf_dir).groupBy("POLICY_ID").agg(F.count("*").alias("n"))
    key = F.col("o_orderkey")

    def missing_every(step: int, value):
        return F.when(key % step != 0, value)

    return (
        spread(read_table(spark, sf_dir, "orders"))
        .join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(read_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(claims, key == F.col("POLICY_ID"), "left")
        .select(
            key.alias("POLICY_ID"),
            ((1 + key % 13).cast("double") / 12).alias("EXPOSURE"),
            missing_every(29, (18 + F.col("c_custkey") % 63).cast("int")).alias("POLICYHOLDER_AGE"),
            missing_every(31, F.col("c_acctbal")).alias("LOSS_HISTORY_SCORE"),
            missing_every(37, F.col("o_totalprice")).alias("POPULATION_DENSITY"),
            F.col("n_name").alias("REGION_CODE"),
            F.col("r_name").alias("TERRITORY_CODE"),
            F.col("c_mktsegment").alias("CONSTRUCTION_TYPE"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("CONSTRUCTION_QUALITY"),
            missing_every(41, (2002 - F.year("o_orderdate")).cast("int")).alias("PROPERTY_AGE"),
            F.when(F.col("o_orderstatus") == "F", "Owner-Occupied")
            .when(F.col("o_orderstatus") == "O", "Tenant-Occupied")
            .alias("OCCUPANCY_TYPE"),
            (F.coalesce("n", F.lit(0)) + F.when(key % 17 == 0, 1).otherwise(0)).cast("int").alias("CLAIM_COUNT"),
        )
    )


def sample_score():
    """A deterministic, heavily tied score for exhibits that need a prediction but no model."""
    return (
        50 * F.col("CONSTRUCTION_QUALITY")
        + 3 * F.coalesce("POLICYHOLDER_AGE", F.lit(49))
        + F.coalesce("PROPERTY_AGE", F.lit(4))
    ).cast("double")
