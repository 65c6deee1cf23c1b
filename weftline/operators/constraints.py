"""Rules a corpus must keep, as rows ``record_id, rule, detail``; a corpus is valid where there are none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.semantics import valid_semantic
from weftline.functions.spans import reconstruction, selects_surface
from weftline.functions.text import exact_keys
from weftline.operators.splitting import leakage

# Names of record states, splits and mapping states.
STATUSES = ("gold", "multi_valid", "policy_choice", "ambiguous", "quarantine", "no_change")
REVIEWED = ("gold", "multi_valid", "policy_choice")
SPLITS = ("train", "dev", "test", "challenge", "judge_gold", "candidate")
MAPPINGS = ("exact", "broader", "narrower", "ambiguous", "unsupported")
PROFILE = "sentence-exact-v1"


def _blank(column: str) -> Column:
    return F.coalesce(F.trim(column), F.lit("")) == ""


def record_rules(records: DataFrame) -> dict[str, Column]:
    """Rules of one record at a time: name to the condition that breaks it."""
    columns = set(records.columns)
    rules = {f"missing_{c}": _blank(c) for c in ("schema_version", "taxonomy_version", "policy_version", "family_id") if c in columns}
    if "status" in columns:
        rules["unknown_status"] = ~F.coalesce(F.col("status").isin(list(STATUSES)), F.lit(False))
    if "split" in columns:
        rules["unknown_split"] = ~F.coalesce(F.col("split").isin(list(SPLITS)), F.lit(False))
    status = F.col("status") if "status" in columns else F.lit(None).cast("string")
    if {"status", "expected_output"} <= columns:
        rules["output_missing"] = status.isin(*REVIEWED, "no_change") & F.col("expected_output").isNull()
        rules["output_not_allowed"] = status.isin("ambiguous", "quarantine") & F.col("expected_output").isNotNull()
    if {"status", "units", "negative_for"} <= columns:
        unchanged = status == "no_change"
        rules["negative_control_with_units"] = unchanged & (F.coalesce(F.size("units"), F.lit(0)) > 0)
        rules["negative_control_of_nothing"] = unchanged & (F.coalesce(F.size("negative_for"), F.lit(0)) < 1)
    if {"status", "expected_output", "input"} <= columns:
        rules["unchanged_output_differs"] = (status == "no_change") & F.col("input").isNotNull() & ~F.col("expected_output").eqNullSafe(F.col("input"))
    return rules


def oracle_rules(records: DataFrame) -> dict[str, Column]:
    """Rules of the oracle of a record, which reviewed, unchanged and ambiguous ones outside the candidates must have.

    Outputs are compared in their exact form, in ``_keys``: the canonical one, the accepted and the rejected ones.
    """
    fields, columns = set(records.schema["oracle"].dataType.names), set(records.columns)
    status, o = F.col("status"), lambda name: F.col("oracle").getField(name)
    bound = status.isin(*REVIEWED, "no_change", "ambiguous") & F.coalesce(F.col("split") != "candidate", F.lit(True))
    there = bound & F.col("oracle").isNotNull()
    n = F.coalesce(F.size(o("accepted_outputs")), F.lit(0))
    n = F.greatest(n, F.lit(0))
    canonical, accepted = F.get("_keys", F.lit(0)), F.slice("_keys", F.lit(2), n)
    rejected = F.slice("_keys", n + 2, F.size("_keys"))
    reviewed, unchanged, ambiguous = there & status.isin(*REVIEWED), there & (status == "no_change"), there & (status == "ambiguous")
    said = o("canonical_output").isNotNull()
    rules = {
        "oracle_missing": bound & F.col("oracle").isNull(), "accepted_outputs_missing": there & o("accepted_outputs").isNull(),
        "accepted_repeated": there & (F.size(F.array_distinct(accepted)) < F.size(accepted)), "accepted_and_rejected": there & F.arrays_overlap(accepted, rejected),
        "canonical_missing": reviewed & ~said, "output_not_canonical": reviewed & said & ~F.col("expected_output").eqNullSafe(o("canonical_output")), "canonical_not_accepted": reviewed & said & ~F.array_contains(accepted, canonical),
        "unchanged_canonical_differs": unchanged & ~o("canonical_output").eqNullSafe(F.col("input")), "unchanged_accepted_differs": unchanged & ~o("accepted_outputs").eqNullSafe(F.array("input")),
        "ambiguous_canonical": ambiguous & said, "ambiguous_accepted": ambiguous & (n > 0),
    }
    if "canonical" in records.schema["units"].dataType.elementType.names:
        rules["reconstruction_differs"] = reviewed & said & F.col("input").isNotNull() & ~reconstruction(F.col("input"), F.col("units")).eqNullSafe(o("canonical_output"))
    if "variant_mode" in fields:
        rules["variants_not_explicit"] = there & ~F.coalesce(o("variant_mode") == "explicit", F.lit(False))
    if "comparison_profile" in fields:
        rules["unknown_profile"] = there & (F.coalesce(o("comparison_profile"), F.lit(PROFILE)) != PROFILE)
    if "interpretations" in fields:
        kinds = F.array_distinct(F.transform(o("interpretations"), lambda i: F.coalesce(F.to_json(F.try_parse_json(i["semantic"])), i["semantic"])))
        rules["too_few_interpretations"] = ambiguous & (F.coalesce(F.size(kinds), F.lit(0)) < 2)
        rules["interpretation_without_output"] = ambiguous & F.exists(o("interpretations"), lambda i: F.coalesce(F.size(i["accepted_outputs"]), F.lit(0)) < 1)
    if "oracle_hash" in columns and "assertion_hash" in columns:
        rules["oracle_hash_differs"] = there & F.col("oracle_hash").isNotNull() & (F.col("oracle_hash") != F.col("assertion_hash"))
    return rules


def _broken(rules: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda r: r.isNotNull())


def record_violations(records: DataFrame) -> DataFrame:
    """All broken rules of records and their oracles in one pass over them; texts take their exact form in one pass of Python."""
    rules = record_rules(records)
    if {"oracle", "status", "split", "expected_output", "input", "units"} <= set(records.columns):
        none = F.array().cast("array<string>")
        outputs = F.coalesce(F.col("oracle.rejected_outputs")["output"], none)
        records = records.withColumn("_keys", exact_keys(F.concat(F.array("oracle.canonical_output"), F.coalesce("oracle.accepted_outputs", none), outputs)))
        rules |= oracle_rules(records)
    return records.select(F.col("id").alias("record_id"), F.explode(_broken(rules)).alias("rule")).withColumn("detail", F.lit(""))


def unit_violations(records: DataFrame, curated: tuple[str, ...] = ()) -> DataFrame:
    """Rules of the units of a record.

    Spans select their surface; semantics are valid where the record is reviewed or ambiguous or there are any; reviewed
    records have a canonical form among the accepted ones, ambiguous ones none; accepted and rejected forms are apart, all
    in the exact form of texts. Units that can have one need a source category and a known mapping, but for the benchmarks
    in ``curated``.
    """
    columns = set(records.columns)
    fields = set(records.schema["units"].dataType.elementType.names)
    status = F.col("status") if "status" in columns else F.lit(None).cast("string")
    benchmark = F.col("benchmark") if "benchmark" in columns else F.lit(None).cast("string")
    units = records.select(F.col("id").alias("record_id"), "input", status.alias("status"), benchmark.alias("benchmark"), F.explode("units").alias("u"))
    none = F.array().cast("array<string>")
    accepted, rejected = F.coalesce("u.accepted", none), F.coalesce("u.rejected", none)
    units = units.withColumn("_keys", exact_keys(F.concat(F.array("u.canonical"), accepted, rejected)))
    n, blank = F.size(accepted), lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    reviewed = F.coalesce(F.col("status").isin(*REVIEWED), F.lit(False))
    closed = reviewed | F.coalesce(F.col("status") == "ambiguous", F.lit(False))
    said = F.coalesce(F.col("u.semantic"), F.lit("{}"))
    rules = {
        "surface_missing": F.coalesce("u.surface", F.lit("")) == "",
        "span_not_surface": F.col("u.start").isNotNull() & ~selects_surface(F.col("input"), F.col("u")),
        "invalid_semantic": ~F.coalesce(valid_semantic(F.col("u.category"), F.when(closed & (said == "{}"), F.lit("{ }")).otherwise(said)), F.lit(True)),
        "canonical_missing": reviewed & blank("u.canonical"),
        "canonical_not_accepted": reviewed & ~blank("u.canonical") & ~F.array_contains(F.slice("_keys", F.lit(2), n), F.get("_keys", F.lit(0))),
        "ambiguous_canonical": F.coalesce(F.col("status") == "ambiguous", F.lit(False)) & F.col("u.canonical").isNotNull(),
        "accepted_and_rejected": F.arrays_overlap(F.slice("_keys", F.lit(2), n), F.slice("_keys", n + 2, F.size("_keys"))),
    }
    if {"mapping_status", "source_category"} <= fields:
        foreign = ~F.coalesce(F.col("benchmark").isin(list(curated)), F.lit(False)) if curated else F.lit(True)
        rules["source_category_missing"] = foreign & (F.coalesce("u.source_category", F.lit("")) == "")
        rules["unknown_mapping"] = foreign & ~F.coalesce(F.col("u.mapping_status").isin(list(MAPPINGS)), F.lit(False))
    return units.select("record_id", F.explode(_broken(rules)).alias("rule"), F.coalesce("u.surface", F.lit("")).alias("detail"))


def ambiguity_violations(records: DataFrame, families: DataFrame) -> DataFrame:
    """Units that name an ambiguity family which is not registered, or not for their category. ``families``: ``family, category``, a row per allowed pair."""
    named = records.select(F.col("id").alias("record_id"), F.explode("units").alias("u")).select("record_id", F.col("u.category").alias("category"), F.get_json_object("u.features", "$.ambiguity_family").alias("family")).where("family is not null")
    known = families.select("family").distinct().withColumn("known", F.lit(True))
    allowed = families.select("family", "category").distinct().withColumn("allowed", F.lit(True))
    marked = named.join(known, "family", "left").join(allowed, ["family", "category"], "left").where("allowed is null")
    return marked.select("record_id", F.when(F.col("known").isNull(), "unknown_ambiguity_family").otherwise("ambiguity_family_of_other_category").alias("rule"), F.col("family").alias("detail"))


def unknown_names(records: DataFrame, column: str, known: DataFrame, key: str, rule: str) -> DataFrame:
    """Records whose value of a column is not registered. The registry is joined, small or not."""
    values = records.select(F.col("id").alias("record_id"), F.col(column).alias(key)).where(F.col(key).isNotNull())
    return values.join(known.select(key).distinct(), key, "left_anti").select("record_id", F.lit(rule).alias("rule"), F.col(key).alias("detail"))


def source_mismatches(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records whose version, licence or address differs from the manifest's, whose benchmark is not in it, or whose hash is none.

    ``manifest``: ``benchmark, source_version, license`` and, if there is, ``source_url``, one row per benchmark.
    """
    fields = set(records.schema["source"].dataType.names)
    field = lambda name: F.col("source").getField(name) if name in fields else F.lit(None).cast("string")
    own = records.select(F.col("id").alias("record_id"), field("benchmark").alias("benchmark"), field("source_version").alias("version"), field("license").alias("licence"), field("source_url").alias("url"), field("source_hash").alias("hash"))
    url = F.col("source_url") if "source_url" in manifest.columns else F.lit(None).cast("string")
    joined = own.join(manifest.select("benchmark", F.col("source_version").alias("m_version"), F.col("license").alias("m_licence"), url.alias("m_url"), F.lit(True).alias("listed")), "benchmark", "left")
    rules = {
        "unknown_benchmark": F.col("listed").isNull(), "version_differs": F.col("version") != F.col("m_version"), "license_differs": F.col("licence") != F.col("m_licence"), "license_missing": F.col("licence").isNull() & F.col("m_licence").isNotNull(),
        "url_differs": F.col("m_url").isNotNull() & ~F.col("url").eqNullSafe(F.col("m_url")), "hash_malformed": F.col("hash").isNotNull() & ~F.col("hash").startswith("sha256:"),
    }
    return joined.select("record_id", F.explode(_broken(rules)).alias("rule"), F.coalesce("benchmark", F.lit("")).alias("detail"))


def repeated_ids(records: DataFrame) -> DataFrame:
    return records.groupBy(F.col("id").alias("record_id")).agg(F.count("*").alias("n")).where("n > 1").select("record_id", F.lit("duplicate_id").alias("rule"), F.col("n").cast("string").alias("detail"))


def violations(records: DataFrame, curated: tuple[str, ...] = ()) -> DataFrame:
    """Every rule on every record, with families in several splits under the family's id. ``curated``: see ``unit_violations``."""
    torn = leakage(records).select(F.col("family_id").alias("record_id"), F.lit("family_in_several_splits").alias("rule"), F.col("splits").alias("detail"))
    return reduce(DataFrame.unionByName, [repeated_ids(records), record_violations(records), unit_violations(records, curated), torn])


def forbidden_keys(records: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """Records whose JSON text has one of the keys at any depth."""
    pattern = '"(' + "|".join(keys) + ')"\\s*:'
    return records.select(F.col("id").alias("record_id"), F.explode(F.array_distinct(F.regexp_extract_all(json, F.lit(pattern), F.lit(1)))).alias("detail")).withColumn("rule", F.lit("forbidden_key")).select("record_id", "rule", "detail")
