"""Oracle hashes, the audit of a corpus, and what a release may not hold. Rows are ``record_id, rule, detail``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.hashing import sha256
from weftline.operators import constraints, duplicates

# The states of a finished review, the policies of handing texts on, and the states of redistribution.
FINISHED_REVIEWS = ("adjudicated", "release_ready")
POLICIES = ("embedded_public", "external_ref_only", "importer_only", "review_required")
REFERENCE_ONLY = ("metadata_only", "not_redistributable")
FORBIDDEN_STATUSES = ("ambiguous", "quarantine")
FORBIDDEN_SPLITS = ("candidate", "judge_gold")


def assertion(records: DataFrame) -> Column:
    """What a record asserts, as compact JSON with sorted keys: language, locale, input, status, units, oracle and three versions.

    ``semantic`` and ``features`` of the units, and ``semantic`` of interpretations, are JSON texts and stand as objects.
    Missing units are an empty list, a missing oracle an empty object. Numbers in those texts take their shortest form.
    """
    fields = records.schema["units"].dataType.elementType.names
    parsed = lambda u: F.struct(*[(F.try_parse_json(u[f]) if f in ("semantic", "features") else u[f]).alias(f) for f in fields])
    units = F.transform("units", parsed)
    oracle = F.col("oracle")
    names = records.schema["oracle"].dataType.names
    if "interpretations" in names:
        read = lambda i: F.struct(i["label"].alias("label"), F.try_parse_json(i["semantic"]).alias("semantic"), i["accepted_outputs"].alias("accepted_outputs"))
        oracle = F.struct(*[(F.transform("oracle.interpretations", read) if n == "interpretations" else F.col("oracle")[n]).alias(n) for n in names])
    keep = {"ignoreNullFields": "false"}
    text = lambda c: F.coalesce(F.to_json(F.struct(c.alias("x")), keep), F.lit('{"x":null}'))
    part = lambda c: F.substring(text(c), F.lit(6), F.length(text(c)) - 6)
    values = {
        "comparison_profile": F.lit(constraints.PROFILE), "input": F.col("input"), "language": F.col("language"), "locale": F.col("locale"), "oracle": F.when(F.col("oracle").isNotNull(), oracle), "policy_version": F.col("policy_version"),
        "status": F.col("status"), "taxonomy_version": F.col("taxonomy_version"), "units": F.when(F.col("units").isNotNull(), units),
    }
    empty = {"oracle": "{}", "units": "[]"}
    parts = [F.concat(F.lit(f'"{k}":'), F.when(v.isNull(), F.lit(empty[k])).otherwise(part(v)) if k in empty else part(v)) for k, v in values.items()]
    return F.to_json(F.parse_json(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))))


def with_hash(records: DataFrame) -> DataFrame:
    """Records with ``assertion_hash``, the hash of what they assert."""
    return records.withColumn("assertion_hash", sha256(assertion(records)))


def _rows(records: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda r: r.isNotNull())
    return records.select(F.col("id").alias("record_id"), F.explode(broken).alias("rule"), F.lit("").alias("detail"))


def review_complete(review: Column) -> Column:
    """At least two reviewers, an adjudicator, a finished state and a protocol."""
    said = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.coalesce((F.size(F.array_distinct(review["reviewers"])) >= 2) & review["status"].isin(*FINISHED_REVIEWS), F.lit(False)) & said(review["adjudicator"]) & said(review["protocol_version"])


def audit(records: DataFrame, strict: bool = False, curated: tuple[str, ...] = ()) -> DataFrame:
    """All violations, oracles that are missing, and reviewed records that disagree or contradict each other.

    Strict also asks for complete reviews, explicit oracles, right hashes and no quarantined records. ``records`` are whole
    gold records, each id once.
    """
    hashed = with_hash(records)
    flat = hashed.withColumns({"canonical": F.col("oracle.canonical_output"), "accepted": F.col("oracle.accepted_outputs"), "rejected": F.col("oracle.rejected_outputs")["output"]})
    status = F.col("status")
    parts = [constraints.violations(hashed, curated)]
    parts.append(duplicates.contradictions(flat).select(F.col("id_l").alias("record_id"), F.lit("oracles_contradict").alias("rule"), F.col("id_r").alias("detail")))
    parts.append(duplicates.canonical_disagreements(flat).select(F.col("min_id").alias("record_id"), F.lit("canonical_outputs_disagree").alias("rule"), F.col("sentence").alias("detail")))
    if strict:
        bound = status.isin(*constraints.REVIEWED, "no_change", "ambiguous") & F.col("oracle").isNotNull()
        parts.append(_rows(hashed, {
            "review_incomplete": status.isin(*constraints.REVIEWED, "no_change") & ~review_complete(F.col("review")), "oracle_not_explicit": bound & ~F.coalesce(F.col("oracle.variant_mode") == "explicit", F.lit(False)),
            "oracle_hash_missing_or_wrong": bound & ~F.col("oracle_hash").eqNullSafe(F.col("assertion_hash")), "quarantined": status == "quarantine",
        }))
    return reduce(DataFrame.unionByName, parts)


def not_for_release(records: DataFrame) -> DataFrame:
    """Records with a state or split that no release may hold."""
    return _rows(records, {"forbidden_status": F.col("status").isin(*FORBIDDEN_STATUSES), "forbidden_split": F.col("split").isin(*FORBIDDEN_SPLITS)})


def materialization_policy(policy: Column, redistribution: Column) -> Column:
    """The policy of a source: its own if it is a known one, else what its state of redistribution allows."""
    allowed = F.when(redistribution == "allowed", "embedded_public").when(redistribution.isin(*REFERENCE_ONLY), "external_ref_only").when(redistribution == "importer_only", "importer_only").otherwise("review_required")
    return F.when(policy.isin(*POLICIES), policy).otherwise(allowed)


def materialization_violations(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records that hold a text, or refer to one, against the policy of their source. Sources that are not listed bind nothing.

    ``manifest``: ``benchmark, materialization_policy, redistribution_status``. Records without ``materialization`` are embedded.
    """
    own = F.coalesce("materialization", F.lit("embedded")) if "materialization" in records.columns else F.lit("embedded")
    rows = records.select("id", F.col("source.benchmark").alias("benchmark"), own.alias("own"))
    policies = manifest.select("benchmark", materialization_policy(F.col("materialization_policy"), F.col("redistribution_status")).alias("policy"))
    joined = rows.join(policies, "benchmark")
    rule = F.when(~F.col("own").isin("embedded", "external_ref"), "unknown_materialization").when((F.col("own") == "embedded") & (F.col("policy") != "embedded_public"), "embeds_against_policy").when((F.col("own") == "external_ref") & ~F.col("policy").isin("embedded_public", "external_ref_only"), "refers_against_policy")
    return joined.select(F.col("id").alias("record_id"), rule.alias("rule"), F.col("policy").alias("detail")).where("rule is not null")


def registry_violations(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Records whose family has no registered split, one that is no release split, or another than their own.

    ``registry``: ``family_id, split``. Records without a family are not registered either.
    """
    joined = records.select("id", "family_id", "split").join(registry.select("family_id", F.col("split").alias("frozen")), "family_id", "left")
    known = F.col("frozen").isNotNull()
    rules = {"family_not_registered": ~known, "registered_split_unknown": known & ~F.col("frozen").isin("train", "dev", "test"), "split_differs_from_registry": known & ~F.col("split").eqNullSafe(F.col("frozen"))}
    return _rows(joined, rules)
