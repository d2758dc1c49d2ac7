"""Reproducible splits: assignment depends on the key only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.functions.columns import key_slot


def add_split(df: DataFrame, key: str = "POLICY_ID", train_percent: int = 75, salt: str = "") -> DataFrame:
    """Add IS_TRAIN."""
    return df.withColumn("IS_TRAIN", key_slot(key, 100, salt) < train_percent)


def hash_split(
    df: DataFrame, key: str = "POLICY_ID", train_percent: int = 75, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(train, validation); a row with a NULL key goes to neither."""
    marked = add_split(df, key, train_percent, salt)
    return marked.where("IS_TRAIN").drop("IS_TRAIN"), marked.where("NOT IS_TRAIN").drop("IS_TRAIN")


def add_fold(df: DataFrame, k: int, key: str = "POLICY_ID", salt: str = "fold42:") -> DataFrame:
    """Add FOLD in ``0..k-1``."""
    if k < 2:
        raise ValueError("cross-validation needs at least two folds")
    return df.withColumn("FOLD", key_slot(key, k, salt))


def split_check(population: DataFrame, train: DataFrame, validation: DataFrame, key: str = "POLICY_ID") -> DataFrame:
    """One row: keys on both sides (SHARED), and keys of the population on neither (LOST). All
    three sides meet in one grouping by key."""
    sides = {"p": population, "t": train, "v": validation}
    tagged = None
    for name, side in sides.items():
        part = side.select(key, *[F.lit(name == other).alias(other) for other in sides])
        tagged = part if tagged is None else tagged.unionByName(part)
    per_key = tagged.groupBy(key).agg(*[F.bool_or(name).alias(name) for name in sides])
    return per_key.agg(
        F.count_if(F.col("t") & F.col("v")).alias("SHARED"),
        F.count_if(F.col("p") & ~F.col("t") & ~F.col("v")).alias("LOST"),
    )
