"""Scores of predictions against records, controls and human labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.spans import variants
from weftline.functions.text import exact_keys
from weftline.operators.counts import by_each

SCORABLE = ("gold", "multi_valid", "policy_choice", "no_change")


def evaluated(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Match flags of each scorable record; a missing prediction counts as empty, which matches an empty canonical output.

    Records: ``id, language, locale, status, split, input, canonical, accepted, n_units`` and, if there are, ``units,
    expected_output, has_oracle``. A record without an oracle has its expected output as the canonical one and the product
    of its units' options as accepted ones; where an oracle lists outputs, nothing that nobody listed is accepted. A record
    given again counts once. All texts of a record take their comparison form in one pass of Python.
    """
    columns = set(records.columns)
    has = F.col("has_oracle") if "has_oracle" in columns else F.lit(True)
    expected = F.col("expected_output") if "expected_output" in columns else F.lit(None).cast("string")
    target = F.when(has, F.col("canonical")).otherwise(expected)
    derived = variants(F.col("input"), F.col("units"), expected) if "units" in columns else F.array().cast("array<string>")
    listed = F.when(has & F.col("accepted").isNotNull(), F.col("accepted")).otherwise(derived if "units" in columns else F.coalesce("accepted", derived))
    kept = records.where(F.col("status").isin(list(SCORABLE)) & F.coalesce(F.col("split") != "candidate", F.lit(True)))
    narrow = kept.select("id", "language", "locale", "status", "categories", "n_units", target.alias("target"), F.coalesce(listed, F.array().cast("array<string>")).alias("listed"))
    joined = narrow.join(predictions.select("id", "output", F.lit(True).alias("present")), "id", "left")
    keyed = joined.withColumn("keys", exact_keys(F.concat(F.array("output", "target"), "listed")))
    output, canonical = F.get("keys", F.lit(0)), F.get("keys", F.lit(0)) == F.get("keys", F.lit(1))
    accepted = canonical | F.array_contains(F.expr("slice(keys, 3, size(keys))"), output)
    return keyed.select(
        "id", "language", "locale", "status", "categories", F.col("present").isNull().alias("missing"), canonical.alias("canonical_match"), accepted.alias("accepted_match"),
        F.greatest(F.col("n_units"), (F.col("status") == "no_change").cast("int")).alias("weight"), ((F.col("status") == "no_change") & ~canonical).alias("mutated"),
    )


def rate(hits: Column, of: Column) -> Column:
    """A share with 0 for an empty denominator."""
    return F.round(F.coalesce(F.try_divide(hits, of), F.lit(0.0)), 6)


def score(evaluations: DataFrame) -> DataFrame:
    """Accuracies by language, locale and status and overall."""
    count = lambda c: F.count_if(c)
    no_change = F.col("status") == "no_change"
    return by_each(
        evaluations, {k: F.col(k) for k in ("language", "locale", "status")}, F.count("*").alias("records"), count(F.col("missing")).alias("missing"),
        rate(count(F.col("canonical_match")), F.count("*")).alias("canonical_accuracy"), rate(count(F.col("accepted_match")), F.count("*")).alias("accepted_accuracy"),
        rate(F.sum(F.when(F.col("canonical_match"), F.col("weight")).otherwise(0)), F.sum("weight")).alias("unit_accuracy"),
        rate(count(no_change & F.col("canonical_match")), count(no_change)).alias("no_change_accuracy"), rate(count(F.col("mutated")), count(no_change)).alias("false_positive_rate"),
    )


def score_categories(evaluations: DataFrame) -> DataFrame:
    """Accuracy per category; a record counts once for each of its units."""
    units = evaluations.select(F.explode("categories").alias("category"), "canonical_match", "accepted_match")
    return units.groupBy("category").agg(F.count("*").alias("units"), rate(F.count_if("canonical_match"), F.count("*")).alias("canonical_accuracy"), rate(F.count_if("accepted_match"), F.count("*")).alias("accepted_accuracy"))


def calibration(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Confusion of accept and reject with precision, recall and false rates, by language, category, ambiguity family and overall.

    Records: ``id, language, category, human_label`` and, if there is, ``ambiguity_family``, where none counts as ``none``;
    predictions: ``id, label``. Ids on one side only are an error in the command and listed by ``unmatched``; they are left out here.
    """
    both = records.join(predictions, "id")
    human, judge = F.col("human_label") == "accept", F.col("label") == "accept"
    ta, fa, tr, fr = F.count_if(human & judge), F.count_if(~human & judge), F.count_if(~human & ~judge), F.count_if(human & ~judge)
    keys = {k: F.col(k) for k in ("language", "category")}
    if "ambiguity_family" in records.columns:
        keys["ambiguity_family"] = F.coalesce("ambiguity_family", F.lit("none"))
    return by_each(
        both, keys, ta.alias("true_accept"), fa.alias("false_accept"), tr.alias("true_reject"), fr.alias("false_reject"),
        rate(ta + tr, F.count("*")).alias("accuracy"), rate(ta, ta + fa).alias("precision"), rate(ta, ta + fr).alias("recall"), rate(fa, tr + fa).alias("false_accept_rate"), rate(fr, ta + fr).alias("false_reject_rate"),
    )


def unmatched(records: DataFrame, predictions: DataFrame) -> DataFrame:
    """Ids without a prediction and predictions without a record."""
    missing = records.select("id").join(predictions.select("id"), "id", "left_anti").select("id", F.lit("missing_prediction").alias("side"))
    return missing.unionByName(predictions.select("id").join(records.select("id"), "id", "left_anti").select("id", F.lit("unknown_id").alias("side")))


def control_results(controls: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each expectation of a control with its flags; a missing prediction has no output and no rules.

    Controls: ``id, control, language, expectations`` (``profile_id, expected_output, required_rules, forbidden_rules``);
    predictions: ``id, profiles``, a map from profile to ``output, rules``.
    """
    each = controls.select("id", "control", "language", F.inline("expectations")).join(predictions.select("id", "profiles"), "id", "left")
    given = F.element_at("profiles", F.col("profile_id"))
    rules = F.coalesce(given["rules"], F.array().cast("array<string>"))
    flags = each.withColumn("output_match", F.coalesce(given["output"] == F.col("expected_output"), F.lit(False))).withColumn("required_met", F.size(F.array_except(F.coalesce("required_rules", F.array().cast("array<string>")), rules)) == 0)
    flags = flags.withColumn("forbidden_hit", F.coalesce(F.arrays_overlap(F.coalesce("forbidden_rules", F.array().cast("array<string>")), rules), F.lit(False)))
    return flags.select("id", "control", "language", "profile_id", "output_match", "required_met", "forbidden_hit", (F.col("output_match") & F.col("required_met") & ~F.col("forbidden_hit")).alias("full_match"))


def score_controls(results: DataFrame) -> DataFrame:
    n = F.count("*")
    return by_each(results, {"control": F.col("control"), "language": F.col("language")}, n.alias("expectations"), rate(F.count_if("output_match"), n).alias("output_accuracy"), rate(F.count_if("required_met"), n).alias("required_accuracy"), F.count_if("forbidden_hit").alias("forbidden_violations"), rate(F.count_if("full_match"), n).alias("full_accuracy"))


def control_counts(controls: DataFrame, configured: list[str] | None = None) -> DataFrame:
    """Per control: records, expectations, those that name a rule, languages and profiles; configured controls without records too."""
    rules = lambda e: (F.coalesce(F.size(e["required_rules"]), F.lit(0)) > 0) | (F.coalesce(F.size(e["forbidden_rules"]), F.lit(0)) > 0)
    none = F.array().cast(controls.schema["expectations"].dataType)
    each = controls.where("control <> ''").select("id", "control", "language", F.coalesce("expectations", none).alias("e"))
    counted = each.groupBy("control").agg(
        F.count("*").alias("records"), F.sum(F.size("e")).alias("expectations"), F.sum(F.size(F.filter("e", rules))).alias("rule_expectations"),
        F.array_join(F.array_sort(F.collect_set("language")), ",").alias("languages"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("e.profile_id")))), ",").alias("profiles"),
    )
    wanted = controls.sparkSession.createDataFrame([(c,) for c in configured or []], "control string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return counted.join(wanted, "control", "full").select("control", *map(zero, ("records", "expectations", "rule_expectations")), *[F.coalesce(c, F.lit("")).alias(c) for c in ("languages", "profiles")])


def control_coverage(controls: DataFrame, least: int, languages: list[str], configured: list[str] | None = None) -> DataFrame:
    """Controls with fewer records than required or without a language, among those seen in records or configured."""
    missing = F.array_join(F.array_except(F.array(*map(F.lit, languages)), F.split("languages", ",")), ",")
    have = control_counts(controls, configured)
    return have.select("control", "records", missing.alias("missing_languages")).where((F.col("records") < least) | (F.col("missing_languages") != ""))
