"""Claims onto policies, outlier caps and pricing targets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.columns import cap

KEY = "POLICY_ID"


@dataclass(frozen=True)
class Caps:
    """Conditioning limits: claims per policy, policy-years, and policy-level claim amount."""

    claim_count: int = 4
    exposure: float = 1.0
    claim_amount: float = 200_000.0


def claims_per_policy(sev: DataFrame) -> DataFrame:
    """Total claim amount per policy, so the join below stays one to one."""
    return sev.groupBy(KEY).agg(F.sum("CLAIM_AMOUNT").alias("CLAIM_AMOUNT"))


def attach_claims(freq: DataFrame, sev: DataFrame) -> DataFrame:
    """Every policy with its claim amount, 0 where it never claimed."""
    joined = freq.join(claims_per_policy(sev), KEY, "left")
    return joined.withColumn("CLAIM_AMOUNT", F.coalesce("CLAIM_AMOUNT", F.lit(0.0)))


def condition(policies: DataFrame, caps: Caps = Caps()) -> DataFrame:
    """Cap outliers, then reset the count of policies whose claims amount to nothing."""
    capped = policies.withColumns(
        {
            "CLAIM_COUNT": cap("CLAIM_COUNT", caps.claim_count),
            "EXPOSURE": cap("EXPOSURE", caps.exposure),
            "CLAIM_AMOUNT": cap("CLAIM_AMOUNT", caps.claim_amount),
        }
    )
    empty = (F.col("CLAIM_AMOUNT") == 0) & (F.col("CLAIM_COUNT") >= 1)
    return capped.withColumn("CLAIM_COUNT", F.when(empty, F.lit(0)).otherwise(F.col("CLAIM_COUNT")))


def prepare_policies(freq: DataFrame, sev: DataFrame, caps: Caps = Caps()) -> DataFrame:
    return condition(attach_claims(freq, sev), caps)


def add_targets(df: DataFrame) -> DataFrame:
    """PURE_PREMIUM, FREQUENCY and AVG_CLAIM_AMOUNT; a zero exposure gives NULL, not an error."""
    return df.withColumns(
        {
            "PURE_PREMIUM": F.try_divide("CLAIM_AMOUNT", "EXPOSURE"),
            "FREQUENCY": F.try_divide("CLAIM_COUNT", "EXPOSURE"),
            "AVG_CLAIM_AMOUNT": F.col("CLAIM_AMOUNT")
            / F.when(F.col("CLAIM_COUNT") > 1, F.col("CLAIM_COUNT")).when(F.col("CLAIM_COUNT").isNotNull(), 1),
        }
    )


def segment_exposure(df: DataFrame, segments: Sequence[str], min_exposure: float = 0.0) -> DataFrame:
    """Exposure, policies, claims and burning cost per segment, thin segments flagged."""
    return (
        df.groupBy(*segments)
        .agg(
            F.count("*").alias("POLICIES"),
            F.sum("EXPOSURE").alias("EXPOSURE"),
            F.sum("CLAIM_COUNT").alias("CLAIM_COUNT"),
            F.sum("CLAIM_AMOUNT").alias("CLAIM_AMOUNT"),
        )
        .withColumns(
            {
                "PURE_PREMIUM": F.try_divide("CLAIM_AMOUNT", "EXPOSURE"),
                "IS_THIN": F.col("EXPOSURE") < F.lit(float(min_exposure)),
            }
        )
    )
