"""Additive priorities of records and capped selections from their order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators import counts, duplicates

#: All reasons of a candidate's priority (W2).
REASONS = {
    "category_missing": 100, "category_below_minimum": 50, "required_pattern_missing": 40, "new_language_for_category": 30, "source_disagreement": 25, "multi_unit": 20, "ambiguity_family": 15, "rare_surface_pattern": 10,
    "cross_source_duplicate": 5, "metadata_only": -50, "broad_or_ambiguous_mapping": -30, "duplicate_exact_input_output": -20,
}
RISKY = ("date", "time", "decimal", "fraction", "currency", "ip_address", "version")


def prioritised(flagged: DataFrame, weights: dict[str, int]) -> DataFrame:
    """``priority`` and sorted ``reasons`` from one boolean column per reason; each reason counts once."""
    reasons = F.array_sort(F.filter(F.array(*[F.when(F.col(k), F.lit(k)) for k in weights]), lambda r: r.isNotNull()))
    total = F.lit(0)
    for k, w in weights.items():
        total = total + F.when(F.col(k), w).otherwise(0)
    return flagged.withColumn("priority", total.cast("int")).withColumn("reasons", F.array_join(reasons, ","))


def _in_conflict(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Ids of the records with a unit of a conflicting (locale, category, surface)."""
    units = records.select("id", F.coalesce("locale", F.lit("")).alias("locale"), F.inline(F.transform("units", lambda u: F.struct(u["category"].alias("category"), u["surface"].alias("surface")))))
    keys = conflicts.select(*[F.col(c).alias(f"_{c}") for c in ("locale", "category", "surface")])
    return units.join(keys, F.expr("locale <=> _locale and category <=> _category and surface <=> _surface"), "left_semi").select("id").distinct()


def _shared(records: DataFrame) -> DataFrame:
    """Per id, whether its input is in several sources, its pair of input and output is there twice, its input is, and its output is one of several."""
    rows = duplicates.fingerprinted(records).withColumn("said", F.coalesce("output", F.unhex(F.lit(""))))
    pairs = rows.groupBy("fp", "said").agg(F.count("*").alias("n_pair"))
    inputs = rows.groupBy("fp").agg(F.count("*").alias("n"), F.size(F.collect_set("benchmark")).alias("n_sources"), F.countDistinct("output").alias("n_outputs")).where("n >= 2")
    flags = {"cross_source_duplicate": "n_sources > 1", "exact_pair": "n_pair >= 2", "duplicate_input": "n >= 2", "conflicting_output": "n_outputs > 1 and output is not null"}
    return rows.join(inputs, "fp").join(pairs, ["fp", "said"]).groupBy("id").agg(*[F.max(F.expr(e)).alias(k) for k, e in flags.items()])


def candidate_flags(candidates: DataFrame, reviewed: DataFrame, least: DataFrame, required: DataFrame) -> DataFrame:
    """``id, language, family_id, categories`` and one boolean per reason of ``REASONS``.

    ``least``: ``category, min_units``, the row with a null category is the default; ``required``: ``category, pattern``.
    Coverage is that of the reviewed records; a pattern is rare if one unit of all candidates has it. What a record's units
    say depends on its language and units only, so equal ones are looked up once.
    """
    keyed = candidates.withColumn("_key", F.unhex(F.md5(F.to_json(F.struct("language", "units")))))
    units = counts.units_of(keyed, "_key", "language").withColumn("pattern", F.nullif("pattern", F.lit("")))
    done = counts.units_of(reviewed, "language").where("category is not null")
    have = done.groupBy("category").agg(F.count("*").alias("have"))
    spoken = done.where("language <> ''").select("category", "language").distinct().withColumn("spoken", F.lit(True))
    named, default = least.where("category is not null").select("category", "min_units"), least.where("category is null").select(F.col("min_units").alias("d"))
    wanting = required.join(done.select("category", "pattern"), ["category", "pattern"], "left_anti").distinct().withColumn("wanting", F.lit(True))
    each = units.where("category is not null").select("_key", "category", "language", "pattern").distinct()
    known = each.join(F.broadcast(have), "category", "left").join(F.broadcast(spoken), ["category", "language"], "left").join(F.broadcast(named), "category", "left").join(F.broadcast(wanting), ["category", "pattern"], "left").join(F.broadcast(default), F.lit(True), "left")
    by_units = known.groupBy("_key").agg(
        F.max(F.col("have").isNull()).alias("category_missing"), F.max(F.coalesce(F.col("have") < F.coalesce("min_units", "d", F.lit(0)), F.lit(False))).alias("category_below_minimum"),
        F.max(F.col("spoken").isNull()).alias("new_language_for_category"), F.max(F.col("wanting").isNotNull()).alias("required_pattern_missing"),
    )
    once = units.where("pattern is not null").groupBy("pattern").agg(F.count("*").alias("n"), F.min("_key").alias("_key"), F.min("category").alias("category")).where("n = 1 and category is not null")
    disputed = _in_conflict(candidates, duplicates.unit_conflicts(candidates)).withColumn("disputed", F.lit(True))
    some = lambda test: F.coalesce(F.exists("units", test), F.lit(False))
    size = F.coalesce(F.size("units"), F.lit(0))
    said = lambda u: F.coalesce(F.get_json_object(u["features"], "$.ambiguity_family"), F.lit("")) != ""
    own = (F.coalesce("ambiguity_family", F.lit("")) != "") if "ambiguity_family" in candidates.columns else F.lit(False)
    categories = F.array_sort(F.array_distinct(F.filter("units.category", lambda c: c.isNotNull())))
    alone = {"multi_unit": size > 1, "ambiguity_family": own | some(said), "metadata_only": size < 1, "broad_or_ambiguous_mapping": some(lambda u: F.coalesce(u["mapping_status"].isin("broader", "ambiguous"), F.lit(False)))}
    rows = keyed.select("id", "_key", "language", "family_id", categories.alias("categories"), *[c.alias(k) for k, c in alone.items()])  # without the units, which are wide
    joined = rows.join(by_units, "_key", "left").join(once.select("_key").distinct().withColumn("rare_surface_pattern", F.lit(True)), "_key", "left").join(_shared(candidates), "id", "left").join(disputed, "id", "left")
    flags = {
        "source_disagreement": F.coalesce("disputed", F.lit(False)) | F.coalesce("conflicting_output", F.lit(False)),
        "duplicate_exact_input_output": F.col("exact_pair") | (F.col("duplicate_input") & ~F.col("cross_source_duplicate")),
    }
    return joined.select("id", "language", "family_id", "categories", *[F.coalesce(flags.get(k, F.col(k)), F.lit(False)).alias(k) for k in REASONS])


def adjudication(records: DataFrame, conflicts: DataFrame, gaps: DataFrame, regressions: DataFrame) -> DataFrame:
    """``id, priority, reasons`` of the adjudication queue (W1); each category of a record that has a gap adds 15.

    ``regressions``: the ``benchmark`` names of records that come from failures in production, a few rows.
    """
    hit = _in_conflict(records, conflicts).withColumn("source_disagreement", F.lit(True))
    short = gaps.select("category").distinct().agg(F.collect_set("category").alias("_short"))
    failed = regressions.select("benchmark").distinct().withColumn("_failed", F.lit(True))
    rows = records.join(hit, "id", "left").join(failed, "benchmark", "left").join(F.broadcast(short), F.lit(True), "left")
    own = F.coalesce(F.array_intersect("units.category", "_short"), F.array().cast("array<string>"))
    flags = rows.select(
        "id", own.alias("_gaps"), F.coalesce("_failed", F.lit(False)).alias("production_regression"), F.coalesce("source_disagreement", F.lit(False)).alias("source_disagreement"),
        F.coalesce(F.arrays_overlap("units.category", F.array(*map(F.lit, RISKY))), F.lit(False)).alias("semantic_risk"), (F.col("status") == "quarantine").alias("quarantine_review"),
    )
    ranked = prioritised(flags, {"production_regression": 50, "source_disagreement": 40, "semantic_risk": 10, "quarantine_review": 5})
    reasons = F.array_sort(F.concat(F.filter(F.split("reasons", ","), lambda x: x != ""), F.transform("_gaps", lambda c: F.concat(F.lit("coverage_gap:"), c))))
    return ranked.select("id", (F.col("priority") + 15 * F.size("_gaps")).cast("int").alias("priority"), F.array_join(reasons, ",").alias("reasons"))


def order() -> list[Column]:
    return [F.desc("priority"), F.asc("id")]


def capped(ranked: DataFrame, key: str, cap: int, limit: int) -> DataFrame:
    """The best rows with at most ``cap`` of each key. Rows past the cap are dropped before the window's shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order()))
    return ranked.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place").orderBy(*order()).limit(limit)


def greedy(ranked: Iterable, limit: int, max_per_category: int, max_per_family: int, languages: set[str] | None = None) -> list:
    """Rows in order, each taken unless a category of its own or its family is at its cap; a skip uses nothing up.

    Takes the rows one by one, so that a caller can stream them from a sorted table: it stops at the limit.
    """
    taken, categories, families = [], {}, {}
    for r in ranked:
        if len(taken) >= limit:
            break
        if languages and r["language"] not in languages:
            continue
        if any(categories.get(c, 0) >= max_per_category for c in r["categories"]) or families.get(r["family_id"], 0) >= max_per_family:
            continue
        taken.append(r)
        families[r["family_id"]] = families.get(r["family_id"], 0) + 1
        for c in r["categories"]:
            categories[c] = categories.get(c, 0) + 1
    return taken


def greedy_batch(ranked: DataFrame, limit: int, max_per_category: int, max_per_family: int, languages: set[str] | None = None) -> DataFrame:
    """``greedy`` over a table: rows stream from its sorted partitions one partition at a time, and only as far as needed.

    A row whose category has ``max_per_category`` better ones of its own set of categories and family can't be taken, so
    each such group is cut to what it could fill at most before the sort. No category cap binds rows without categories.
    """
    own = Window.partitionBy("language", "family_id", F.array_sort("categories")).orderBy(*order())
    most = F.when(F.size("categories") == 0, max_per_family).otherwise(min(max_per_category, max_per_family))
    useful = ranked.withColumn("_place", F.row_number().over(own)).where(F.col("_place") <= most).drop("_place")
    rows = greedy(useful.orderBy(*order()).select("id", "language", "family_id", "categories", "priority").toLocalIterator(), limit, max_per_category, max_per_family, languages)
    return ranked.sparkSession.createDataFrame([(r["id"], r["language"], r["family_id"], r["priority"], i + 1) for i, r in enumerate(rows)], "id string, language string, family_id string, priority int, place int")
