"""Merging shards, and what changed between two snapshots or two reviews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERGE_ORDER = ["benchmark", "language", "locale", "source_id", "id"]


def merged(*shards: DataFrame) -> DataFrame:
    """All rows of all shards; columns a shard lacks are null there. In no order: see ``ordered``."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def ordered(records: DataFrame) -> DataFrame:
    """Merged records in their total order: by benchmark, language, locale, source id and id, nulls as empty texts."""
    source = "source" in records.columns
    key = {k: F.col(f"source.{k}") if source and k in ("benchmark", "source_id") else F.col(k) for k in MERGE_ORDER}
    return records.orderBy(*[F.coalesce(key[k], F.lit("")) for k in MERGE_ORDER])


class DuplicateIds(ValueError):
    pass


def merged_unique(*shards: DataFrame) -> DataFrame:
    """``merged`` in order; an id that two rows have is an error that names it."""
    whole = merged(*shards)
    if twice := duplicate_ids(whole).orderBy("id").take(3):
        raise DuplicateIds(", ".join(str(r.id) for r in twice))
    return ordered(whole)


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """``id, change`` of records added, removed or changed, with canonical and accepted outputs and status of both sides.

    Of several changes the first counts of: canonical, accepted, units, status, metadata.

    Both: ``id, canonical, accepted (array), units (text), status, meta``. Fewer or equally many accepted outputs count as
    removed ones.
    """
    a = old.select("id", *[F.col(c).alias(f"o_{c}") for c in ("canonical", "accepted", "units", "status", "meta")], F.lit(True).alias("in_old"))
    b = new.select("id", *[F.col(c).alias(f"n_{c}") for c in ("canonical", "accepted", "units", "status", "meta")], F.lit(True).alias("in_new"))
    differs = lambda c: ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    change = (
        F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(differs("canonical"), "canonical_change")
        .when(differs("accepted"), F.when(size("n_accepted") > size("o_accepted"), "accepted_addition").otherwise("accepted_removal"))
        .when(differs("units"), "unit_change").when(differs("status"), "status_change").when(differs("meta"), "metadata_change")
    )
    payload = [F.col(f"{side}_{c}").alias(f"{name}_{c}") for side, name in (("o", "old"), ("n", "new")) for c in ("canonical", "accepted", "status")]
    return a.join(b, "id", "full").select("id", change.alias("change"), *payload).where("change is not null")


def compared_reviews(one: DataFrame, other: DataFrame, dimensions: list[str]) -> DataFrame:
    """Where two reviews of the same items differ: one flag per dimension, and the items only one of them has."""
    a = one.select("id", *[F.col(d).alias(f"a_{d}") for d in dimensions], F.lit(True).alias("in_a"))
    b = other.select("id", *[F.col(d).alias(f"b_{d}") for d in dimensions], F.lit(True).alias("in_b"))
    side = F.when(F.col("in_a").isNull(), "second_only").when(F.col("in_b").isNull(), "first_only").otherwise("both")
    flags = [(~F.col(f"a_{d}").eqNullSafe(F.col(f"b_{d}"))).alias(f"{d}_differs") for d in dimensions]
    return a.join(b, "id", "full").select("id", side.alias("side"), *flags)


#: What two annotations of one sentence are compared by.
DIMENSIONS = ("span", "category", "semantic", "ambiguity", "policy", "unit_canonical", "unit_accepted", "sentence_canonical", "sentence_accepted", "rejected_variants")


def annotation(records: DataFrame) -> DataFrame:
    """``id`` and a text per dimension of an annotation, from ``id, units, status, canonical, accepted, rejected``.

    Semantics are compared as objects, so the order of their keys does not matter; other fields as they stand.
    """
    of = lambda field: F.to_json(F.coalesce(F.transform("units", lambda u: F.struct(u[field].alias("x"))), F.array().cast("array<struct<x:string>>")))
    semantic = F.array_join(F.transform("units", lambda u: F.coalesce(F.to_json(F.try_parse_json(u["semantic"])), u["semantic"], F.lit("null"))), "\n")
    listed = lambda c: F.to_json(F.struct(F.col(c).alias("x")))
    return records.select(
        "id", F.to_json("units").alias("span"), of("category").alias("category"), F.coalesce(semantic, F.lit("")).alias("semantic"), (F.col("status") == "ambiguous").alias("ambiguity"), of("policy").alias("policy"),
        of("canonical").alias("unit_canonical"), F.to_json(F.transform("units", lambda u: F.struct(u["accepted"].alias("x")))).alias("unit_accepted"), F.col("canonical").alias("sentence_canonical"), listed("accepted").alias("sentence_accepted"), listed("rejected").alias("rejected_variants"),
    )


def compared_annotations(one: DataFrame, other: DataFrame) -> DataFrame:
    """``id, side`` and whether the two annotations differ in each of ``DIMENSIONS``, and in any; an ambiguous one always does in that."""
    flags = compared_reviews(annotation(one), annotation(other), list(DIMENSIONS))
    ambiguous = annotation(one).select("id", F.col("ambiguity").alias("_a")).join(annotation(other).select("id", F.col("ambiguity").alias("_b")), "id", "full")
    out = flags.drop("ambiguity_differs").join(ambiguous.select("id", (F.coalesce("_a", F.lit(False)) | F.coalesce("_b", F.lit(False))).alias("ambiguity_differs")), "id")
    any_ = None
    for d in DIMENSIONS:
        any_ = F.col(f"{d}_differs") if any_ is None else any_ | F.col(f"{d}_differs")
    return out.select("id", "side", *[f"{d}_differs" for d in DIMENSIONS], any_.alias("disagreement"))
