"""Exact duplicates by fingerprint, overlap of sources, conflicting outputs and contradicting oracles.

Texts are hashed to 16 bytes in the scan, so that no shuffle carries them. Groups are counted, with their smallest id; who
belongs to them is a table of its own, a row per record, as a group may hold any number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import conflict_value, exact_keys, fingerprint

REVIEWED = ("gold", "multi_valid", "policy_choice")


def output_of(upstream: Column, expected: Column) -> Column:
    """The output a record is compared by: the upstream one unless it is empty, else its own."""
    return F.coalesce(F.nullif(upstream, F.lit("")), expected, F.lit(""))


def _short(text: Column) -> Column:
    return F.unhex(F.md5(text))


def fingerprinted(records: DataFrame) -> DataFrame:
    """``id, benchmark, fp, output`` of each record once, the latter two as hashes; an output without any text is null.

    A null input has the fingerprint of the empty text and groups with it. Outputs are compared by their fingerprints too.
    """
    output = fingerprint(output_of(F.col("upstream_expected"), F.col("expected_output")))
    return records.select("id", F.coalesce("benchmark", F.lit("")).alias("benchmark"), _short(fingerprint(F.col("input"))).alias("fp"), F.when(output != "", _short(output)).alias("output")).distinct()


def _name(key: str) -> Column:
    return F.lower(F.hex(key)).alias(key)


def input_groups(records: DataFrame) -> DataFrame:
    """Inputs that two records or more share: how many, in how many sources, with how many outputs, and the smallest id."""
    grouped = fingerprinted(records).groupBy("fp").agg(F.count("*").alias("n"), F.size(F.collect_set("benchmark")).cast("bigint").alias("n_sources"), F.countDistinct("output").alias("n_outputs"), F.min("id").alias("min_id"))
    return grouped.where("n >= 2").select(_name("fp"), "n", "n_sources", "n_outputs", "min_id")


def input_members(records: DataFrame) -> DataFrame:
    """``fp, id, benchmark`` of every record whose input another one shares. A hot input is counted before it is joined."""
    rows = fingerprinted(records).select("fp", "id", "benchmark")
    shared = rows.groupBy("fp").agg(F.count("*").alias("n")).where("n >= 2").select("fp")
    return rows.join(shared, "fp", "left_semi").select(_name("fp"), "id", "benchmark")


def pair_groups(records: DataFrame) -> DataFrame:
    """Pairs of input and output that two records or more share."""
    grouped = fingerprinted(records).groupBy("fp", "output").agg(F.count("*").alias("n"), F.min("id").alias("min_id")).where("n >= 2")
    return grouped.select(_name("fp"), F.lower(F.hex("output")).alias("output"), "n", "min_id")


def conflicting_outputs(records: DataFrame) -> DataFrame:
    """Inputs with more than one non-empty output."""
    return input_groups(records).where("n_outputs > 1").select("fp", "n", "n_outputs")


def conflicting_members(records: DataFrame) -> DataFrame:
    """``fp, output, id`` of the records with a non-empty output whose input has more than one of them."""
    rows = fingerprinted(records).where("output is not null").select("fp", "output", "id")
    several = rows.groupBy("fp").agg(F.min("output").alias("low"), F.max("output").alias("high")).where("low < high").select("fp")
    return rows.join(several, "fp", "left_semi").select(_name("fp"), _name("output"), "id")


def source_overlap(records: DataFrame) -> DataFrame:
    """For each two sources, the inputs both have. The sources of an input are few, whatever its copies."""
    sets = fingerprinted(records).groupBy("fp").agg(F.array_sort(F.collect_set("benchmark")).alias("s")).where(F.size("s") > 1)
    both = F.flatten(F.transform("s", lambda a, i: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("source_a"), b.alias("source_b")))))
    return sets.select(F.explode(both).alias("p")).groupBy("p.source_a", "p.source_b").agg(F.count("*").alias("n_inputs"))


def summary(records: DataFrame) -> DataFrame:
    """Counts of records, distinct inputs and pairs, shared inputs and inputs with conflicting outputs."""
    pairs = fingerprinted(records).groupBy("fp", "output").agg(F.count("*").alias("n"))
    grouped = pairs.groupBy("fp").agg(F.sum("n").alias("n"), F.count("*").alias("p"), F.count("output").alias("o"))
    return grouped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.count("*").alias("unique_inputs"), F.count_if(F.expr("n >= 2")).alias("duplicate_groups"), F.count_if(F.expr("n >= 2 and o > 1")).alias("conflict_groups"), F.coalesce(F.sum("p"), F.lit(0)).alias("unique_pairs"))


def _disputed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with two rows or more and more than one value, with the number of both and the first and last value."""
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"), F.min("value").alias("first_value"), F.max("value").alias("last_value"))
    return grouped.where("n >= 2 and n_values > 1")


def _sentences(records: DataFrame) -> DataFrame:
    return records.select("id", F.coalesce("locale", F.lit("")).alias("locale"), "input", conflict_value(F.col("expected_output")).alias("value")).distinct()


def _spans(records: DataFrame) -> DataFrame:
    units = records.select("id", F.coalesce("locale", F.lit("")).alias("locale"), F.posexplode("units").alias("nth", "u"))
    return units.select("id", "nth", "locale", F.col("u.category").alias("category"), F.col("u.surface").alias("surface"), conflict_value(F.col("u.canonical")).alias("value"))


def record_conflicts(records: DataFrame) -> DataFrame:
    """Inputs of a locale with more than one expected output, outer space and case aside."""
    return _disputed(_sentences(records), ["locale", "input"])


def unit_conflicts(records: DataFrame) -> DataFrame:
    """Surfaces of a category and locale with more than one canonical form."""
    return _disputed(_spans(records), ["locale", "category", "surface"])


def _items(rows: DataFrame, keys: list[str]) -> DataFrame:
    low = rows.groupBy(*keys).agg(F.min("value").alias("_low"), F.max("value").alias("_high")).where("_low < _high")
    same = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}")) if same is None else same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(low.select(*[F.col(k).alias(f"_{k}") for k in keys]), same, "left_semi").select(*keys, "value", "id").distinct()


def record_conflict_items(records: DataFrame) -> DataFrame:
    """``locale, input, value, id``: who says what in each conflict; a null value is an item too, but no variant."""
    return _items(_sentences(records), ["locale", "input"])


def unit_conflict_items(records: DataFrame) -> DataFrame:
    """``locale, category, surface, value, id`` of each conflict."""
    return _items(_spans(records), ["locale", "category", "surface"])


def _asserted(records: DataFrame) -> DataFrame:
    """Reviewed records by the sentence they speak about, with the comparison forms of all outputs, from one pass of Python."""
    none = F.array().cast("array<string>")
    accepted, rejected = F.coalesce("accepted", none), F.coalesce("rejected", none)
    canonical = F.col("canonical") if "canonical" in records.columns else F.lit(None).cast("string")
    keys = exact_keys(F.concat(F.array(F.col("input"), canonical), accepted, rejected))
    reviewed = records.where(F.col("status").isin(list(REVIEWED))) if "status" in records.columns else records
    rows = reviewed.select("id", F.coalesce("locale", F.lit("")).alias("locale"), F.coalesce("policy_version", F.lit("")).alias("policy_version"), keys.alias("k"), F.size(accepted).alias("a"))
    return rows.select("id", "locale", _short(F.get("k", F.lit(0))).alias("sentence"), "policy_version", F.get("k", F.lit(1)).alias("canonical"), F.expr("slice(k, 3, a)").alias("accepted"), F.expr("slice(k, 3 + a, size(k))").alias("rejected")).distinct()


def contradictions(records: DataFrame) -> DataFrame:
    """Pairs of reviewed records of one sentence, locale and policy version where one accepts what the other rejects.

    Accepted and rejected outputs are joined on their own text, so copies that agree are never paired.
    """
    rows, key = _asserted(records), ["locale", "sentence", "policy_version", "o"]
    accepted = rows.select("id", *key[:3], F.explode("accepted").alias("o")).distinct()
    rejected = rows.select(F.col("id").alias("other"), *key[:3], F.explode("rejected").alias("o")).distinct()
    pairs = accepted.join(rejected, key).where("id <> other")
    return pairs.groupBy(F.least("id", "other").alias("id_l"), F.greatest("id", "other").alias("id_r")).agg(F.countDistinct("o").alias("n_outputs"))


def canonical_disagreements(records: DataFrame) -> DataFrame:
    """Sentences of a locale and policy version for which reviewed records have more than one canonical output."""
    grouped = _asserted(records).groupBy("locale", "sentence", "policy_version").agg(F.count("*").alias("n"), F.countDistinct("canonical").alias("n_outputs"), F.min("id").alias("min_id"))
    return grouped.where("n_outputs > 1").select("locale", _name("sentence"), "policy_version", "n", "n_outputs", "min_id")
