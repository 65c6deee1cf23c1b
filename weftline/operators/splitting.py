"""Families to splits: a frozen registry first, the records' own split next, a hash of the family last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.hashing import hash_split

RATIOS = {"train": 0.70, "dev": 0.15, "test": 0.15}
SEED = 20260818


def assignments(records: DataFrame, registry: DataFrame | None = None, seed: int = SEED, ratios: dict[str, float] | None = None) -> DataFrame:
    """``family_id, split, origin`` of each family; records without a family have none.

    ``registry`` has ``family_id, split``. Splits other than those of the ratios have no say; a family whose records name
    more than one is reported by ``violations`` and falls back on its hash here.
    """
    ratios = ratios or RATIOS
    own = F.when(F.col("split").isin(list(ratios)), F.col("split"))
    families = records.where("family_id is not null").groupBy("family_id").agg(F.min(own).alias("low"), F.max(own).alias("high"))
    frozen = registry.select("family_id", F.col("split").alias("frozen")) if registry is not None else families.select("family_id", F.lit(None).cast("string").alias("frozen")).limit(0)
    joined = families.join(frozen, "family_id", "left")
    voted = F.when(F.col("low") == F.col("high"), F.col("low"))
    split = F.coalesce("frozen", voted, hash_split(seed, F.col("family_id"), ratios))
    origin = F.when(F.col("frozen").isNotNull(), "registry").when(voted.isNotNull(), "records").otherwise("hash")
    return joined.select("family_id", split.alias("split"), origin.alias("origin"))


def violations(records: DataFrame, registry: DataFrame | None = None, ratios: dict[str, float] | None = None) -> DataFrame:
    """Families whose records name several splits, or another than the registry's."""
    own = records.where(F.col("family_id").isNotNull() & F.col("split").isin(list(ratios or RATIOS))).groupBy("family_id").agg(F.array_sort(F.collect_set("split")).alias("splits"))
    several = own.where(F.size("splits") > 1).select("family_id", F.lit("several_splits").alias("rule"), F.array_join("splits", ",").alias("detail"))
    if registry is None:
        return several
    other = own.join(registry.select("family_id", F.col("split").alias("frozen")), "family_id").where(F.exists("splits", lambda s: s != F.col("frozen")))
    return several.unionByName(other.select("family_id", F.lit("differs_from_registry").alias("rule"), F.concat_ws("<>", F.array_join("splits", ","), "frozen").alias("detail")))


def leakage(records: DataFrame) -> DataFrame:
    """Families in more than one split, candidates and judge records aside."""
    kept = records.where("family_id is not null and split is not null and split not in ('candidate', 'judge_gold')")
    return kept.groupBy("family_id").agg(F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"), F.count("*").alias("records")).where(F.col("splits").contains(","))
