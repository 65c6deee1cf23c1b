"""Counts over a corpus: statistics, coverage against targets, pool and import summaries, exclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.shapes import surface_shape
from weftline.functions.text import fingerprint


def by_each(rows: DataFrame, keys: dict[str, Column], *measures: Column) -> DataFrame:
    """The measures by each key on its own and overall, in one aggregation over grouping sets: ``section, key, ...``.

    A null key is named ``null``. An empty table has no rows, not even the overall one.
    """
    named = rows.select("*", *[c.alias(f"_by_{k}") for k, c in keys.items()])
    columns = [f"_by_{k}" for k in keys]
    sets = [[F.col(c)] for c in columns] + [[]]
    out = named.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), *measures)
    section, key = F.lit("all"), F.lit("")
    for i, k in enumerate(keys):
        bits = 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i)
        section = F.when(F.col("_set") == bits, k).otherwise(section)
        key = F.when(F.col("_set") == bits, F.coalesce(F.col(f"_by_{k}"), F.lit("null"))).otherwise(key)
    return out.select(section.alias("section"), key.alias("key"), *[c for c in out.columns if c not in columns and c != "_set"])


def statistics(records: DataFrame) -> DataFrame:
    """Records and families by status, language, locale, source and split, and overall. Empty family ids do not count."""
    keys = {k: F.col(k) for k in ("status", "language", "locale", "benchmark", "split")}
    return by_each(records, keys, F.count("*").alias("records"), F.countDistinct(F.nullif("family_id", F.lit(""))).alias("families"))


def release_counts(records: DataFrame) -> DataFrame:
    """Records and families by language, locale, status and source, and overall. Records without a family are one family."""
    keys = {k: F.col(k) for k in ("language", "locale", "status", "benchmark")}
    one = F.when(F.col("family_id").isNull(), "null").otherwise(F.concat(F.lit("="), "family_id"))
    return by_each(records, keys, F.count("*").alias("records"), F.countDistinct(one).alias("families"))


def units_of(records: DataFrame, *columns: str) -> DataFrame:
    """One row per unit: the given columns, ``category, surface, pattern, unit``."""
    units = records.select(*columns, F.posexplode("units").alias("nth", "unit"))
    return units.select(*columns, "nth", F.col("unit.category").alias("category"), F.col("unit.surface").alias("surface"), F.get_json_object("unit.features", "$.surface_pattern").alias("pattern"), "unit")


def coverage(records: DataFrame) -> DataFrame:
    """Per category: units, records, languages, units of ambiguous records, and records that name it as negative control."""
    units = _named(records, "id", "language", "status").groupBy("category").agg(F.count("*").alias("units"), F.countDistinct("id").alias("records"), F.size(F.collect_set("language")).cast("bigint").alias("languages"), F.count_if(F.col("status") == "ambiguous").alias("ambiguous"))
    negative = records.select(F.explode("negative_for").alias("category")).groupBy("category").agg(F.count("*").alias("negatives"))
    return units.join(negative, "category", "left").select("category", "units", "records", "languages", "ambiguous", F.coalesce("negatives", F.lit(0)).alias("negatives"))


def _named(records: DataFrame, *columns: str) -> DataFrame:
    return units_of(records, *columns).where("category <> ''")


def coverage_histograms(records: DataFrame) -> DataFrame:
    """``category, section, key, units``: units by language, locale, status of the record and surface pattern. Nulls do not count."""
    units = _named(records, "language", "locale", "status")
    each = units.select("category", F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.col(c).alias("key")) for s, c in (("language", "language"), ("locale", "locale"), ("status", "status"), ("pattern", "pattern"))])))
    return each.where("key <> ''").groupBy("category", "section", "key").agg(F.count("*").alias("units"))


def coverage_gaps(records: DataFrame, least: DataFrame, languages: list[str], required: DataFrame | None = None) -> DataFrame:
    """Where a category has fewer units, ambiguous units or negative controls than required, or none in a language or of a pattern.

    ``least``: ``category, min_units, min_ambiguous, min_negatives``, a row per configured category; the row with a null
    category is the default of the others. ``required``: ``category, pattern``; only categories that are seen or configured
    can lack one.
    """
    have = coverage(records)
    named, default = least.where("category is not null"), least.where("category is null").drop("category")
    needs = ("min_units", "min_ambiguous", "min_negatives")
    both = have.join(F.broadcast(named), "category", "full").join(F.broadcast(default.select(*[F.col(c).alias(f"d_{c}") for c in needs])), F.lit(True), "left")
    row = both.select("category", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("units", "ambiguous", "negatives")], *[F.coalesce(c, f"d_{c}", F.lit(0)).alias(c) for c in needs])
    kinds = (("low_volume", "units", "min_units"), ("ambiguous", "ambiguous", "min_ambiguous"), ("negative_controls", "negatives", "min_negatives"))
    short = row.select("category", F.inline(F.array(*[F.struct(F.lit(k).alias("gap"), F.lit("").alias("detail"), F.col(h).cast("bigint").alias("have"), F.col(n).cast("bigint").alias("need")) for k, h, n in kinds]))).where("have < need")
    absent = lambda wanted, seen, gap: wanted.join(seen, ["category", "detail"], "left_anti").select("category", F.lit(gap).alias("gap"), "detail", F.lit(0).cast("bigint").alias("have"), F.lit(1).cast("bigint").alias("need"))
    seen = _named(records, "language")
    out = short.unionByName(absent(row.select("category", F.explode(F.array(*map(F.lit, languages))).alias("detail")), seen.select("category", F.col("language").alias("detail")).distinct(), "language"))
    if required is not None:
        wanted = required.select("category", F.col("pattern").alias("detail")).distinct().join(row.select("category"), "category", "left_semi")
        out = out.unionByName(absent(wanted, seen.select("category", F.col("pattern").alias("detail")).distinct(), "surface_pattern"))
    return out


def excluded_units(records: DataFrame) -> DataFrame:
    """Exclusion rows of a pool: records without an input, and units whose surface was not found in theirs."""
    whole = records.where("input is null").select(F.col("benchmark").alias("source"), "source_id", F.lit("malformed_row").alias("reason"), F.lit("unknown").alias("source_category"), "language", F.lit(None).cast("string").alias("surface"))
    units = units_of(records.where("input is not null"), "benchmark", "source_id", "language").where("unit.start is null")
    part = units.select(F.col("benchmark").alias("source"), "source_id", F.lit("unresolved_span").alias("reason"), F.coalesce("unit.source_category", "category").alias("source_category"), "language", "surface")
    return whole.unionByName(part).withColumn("surface_shape", surface_shape(F.col("surface")))


def exclusion_analysis(exclusions: DataFrame) -> DataFrame:
    """Exclusions by source, reason, category, language and shape; what a row does not know is ``unknown``."""
    keys = ["source", "reason", "source_category", "language", "surface_shape"]
    return exclusions.select(*[F.coalesce(k, F.lit("unknown")).alias(k) for k in keys]).groupBy(*keys).agg(F.count("*").alias("n"))


def exclusion_totals(exclusions: DataFrame) -> DataFrame:
    """Exclusions by source, by reason, and overall."""
    return by_each(exclusions, {k: F.coalesce(k, F.lit("unknown")) for k in ("source", "reason")}, F.count("*").alias("n"))


def pool_summary(records: DataFrame, observed: DataFrame) -> DataFrame:
    """Per source: records, distinct inputs, records of several units, and the share of observed rows that became records.

    ``observed``: ``benchmark, source_rows``. A source without rows has the yield 0.
    """
    per = records.groupBy("benchmark").agg(F.count("*").alias("records"), F.countDistinct(F.unhex(F.md5(fingerprint(F.col("input"))))).alias("unique_inputs"), F.count_if(F.size("units") > 1).alias("multi_unit"))
    both = per.join(observed, "benchmark", "left")
    return both.select("benchmark", "records", "unique_inputs", "multi_unit", F.round(F.coalesce(F.try_divide("records", "source_rows"), F.lit(0.0)), 6).alias("yield"))


def pool_histograms(records: DataFrame) -> DataFrame:
    """``section, key, n``: records by source and language, with and without units, and units by category, pattern and mapping."""
    unknown = lambda c, name: F.coalesce(c, F.lit(name))
    size = F.greatest(F.coalesce(F.size("units"), F.lit(0)), F.lit(0))
    kind = F.when(size < 1, "metadata_only").when(size > 1, "multi_unit").otherwise("one_unit")
    pairs = lambda rows, keys: rows.select(F.inline(F.array(*[F.struct(F.lit(k).alias("section"), v.alias("key")) for k, v in keys.items()])))
    whole = pairs(records, {"source": unknown(F.col("benchmark"), "unknown"), "language": unknown(F.col("language"), "unknown"), "units": kind})
    units = units_of(records, "id")
    mapping = F.col("unit.mapping_status") if "mapping_status" in units.schema["unit"].dataType.names else F.lit(None).cast("string")
    parts = pairs(units, {"category": unknown(F.col("category"), "unknown"), "surface_pattern": unknown(F.col("pattern"), "unresolved"), "mapping_status": unknown(mapping, "unmapped")})
    return whole.unionByName(parts).groupBy("section", "key").agg(F.count("*").alias("n"))


def import_diagnostics(records: DataFrame, exclusions: DataFrame, observed: DataFrame) -> DataFrame:
    """Row accounting per source: every observed row is a record or an exclusion. ``observed``: ``benchmark, source_rows``."""
    size = F.greatest(F.coalesce(F.size("units"), F.lit(0)), F.lit(0)) if "units" in records.columns else F.lit(0)
    made = records.groupBy("benchmark").agg(F.count("*").alias("created"), F.count_if(size > 0).alias("with_units"), F.count_if(size < 1).alias("metadata_only"), F.count_if(size > 1).alias("multi_unit"), F.sum(size).alias("units"))
    reason = F.col("reason") if "reason" in exclusions.columns else F.lit("unknown")
    unaligned = reason.contains("span") | reason.contains("alignment") | reason.contains("unresolved")
    unmapped = reason.contains("category") | reason.contains("unmappable")
    lost = exclusions.groupBy(F.col("source").alias("benchmark")).agg(F.count("*").alias("excluded"), F.count_if(unaligned).alias("span_failures"), F.count_if(unmapped).alias("category_failures"))
    both = observed.join(made, "benchmark", "full").join(lost, "benchmark", "full")
    number = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = both.select("benchmark", *map(number, ("source_rows", "created", "with_units", "metadata_only", "multi_unit", "units", "excluded", "span_failures", "category_failures")))
    return out.withColumn("row_accounting_ok", F.col("source_rows") == F.col("created") + F.col("excluded"))


def import_histograms(records: DataFrame, exclusions: DataFrame) -> DataFrame:
    """``benchmark, section, key, n``: languages, locales, source splits and hashes of records, categories, patterns and mappings of units, reasons of exclusions."""
    units = units_of(records, "benchmark")
    mapping = F.col("unit.mapping_status") if "mapping_status" in units.schema["unit"].dataType.names else F.lit(None).cast("string")
    pairs = lambda rows, keys: rows.select("benchmark", F.inline(F.array(*[F.struct(F.lit(k).alias("section"), v.alias("key")) for k, v in keys.items()])))
    of = lambda c, name: F.coalesce(c if c in records.columns else F.lit(None).cast("string"), F.lit(name))
    parts = [pairs(records, {"language": of("language", ""), "locale": of("locale", ""), "source_split": F.coalesce(F.nullif(of("source_split", ""), F.lit("")), F.lit("unspecified"))})]
    parts.append(pairs(units, {"category": F.coalesce("category", F.lit("")), "surface_pattern": F.coalesce("pattern", F.lit("unresolved")), "mapping_status": F.coalesce(mapping, F.lit("unmapped"))}))
    parts.append(pairs(exclusions.withColumn("benchmark", F.col("source")), {"exclusion_reason": F.coalesce("reason", F.lit("unknown"))}))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.groupBy("benchmark", "section", "key").agg(F.count("*").alias("n"))


def maturity_gaps(records: DataFrame, least: dict[str, int], categories: list[str] | None = None, patterns: DataFrame | None = None, gaps: DataFrame | None = None, controls: DataFrame | None = None, suites: list[str] | None = None, languages: list[str] | None = None, sources: DataFrame | None = None) -> DataFrame:
    """Release thresholds that the corpus misses: ``gate, have, need``.

    ``least`` bounds records, languages, negative controls (unchanged records) and families. ``categories`` must all have
    units, ``patterns`` (``category, pattern``) all be seen, ``suites`` and ``languages`` all occur in ``controls``, ``gaps`` be
    empty and all ``sources`` be ``release_ready``.
    """
    spark = records.sparkSession
    measured = records.agg(F.count("*").alias("records"), F.countDistinct(F.nullif("language", F.lit(""))).alias("languages"), F.count_if(F.col("status") == "no_change").alias("negative_controls"), F.countDistinct("family_id").alias("families"))
    rows = F.array(*[F.struct(F.lit(k).alias("gate"), F.coalesce(F.col(k), F.lit(0)).alias("have"), F.lit(n).cast("bigint").alias("need")) for k, n in least.items()])
    out = measured.select(F.inline(rows)).where("have < need")
    gate = lambda missing, name, need: missing.agg(F.count("*").alias("m")).where("m > 0").select(F.lit(name).alias("gate"), (F.lit(need).cast("bigint") - F.col("m")).alias("have"), F.lit(need).cast("bigint").alias("need"))
    listed = lambda names, column: spark.createDataFrame([(x,) for x in names], f"{column} string")
    if categories:
        out = out.unionByName(gate(listed(categories, "category").join(_named(records).select("category").distinct(), "category", "left_anti"), "required_categories", len(categories)))
    if patterns is not None:
        wanted = patterns.distinct()
        missing = wanted.join(_named(records).select("category", "pattern").distinct(), ["category", "pattern"], "left_anti").agg(F.count("*").alias("m")).where("m > 0")
        out = out.unionByName(missing.join(wanted.agg(F.count("*").alias("need"))).select(F.lit("required_patterns").alias("gate"), (F.col("need") - F.col("m")).alias("have"), "need"))
    if suites and controls is not None:
        out = out.unionByName(gate(listed(suites, "control").join(controls.select("control").distinct(), "control", "left_anti"), "control_suites", len(suites)))
    if languages and controls is not None:
        out = out.unionByName(gate(listed(languages, "language").join(controls.select("language").distinct(), "language", "left_anti"), "control_languages", len(languages)))
    if gaps is not None:
        out = out.unionByName(gaps.agg(F.count("*").alias("have")).where("have > 0").select(F.lit("coverage_gaps").alias("gate"), "have", F.lit(0).cast("bigint").alias("need")))
    if sources is not None:
        out = out.unionByName(sources.agg(F.count("*").alias("need"), F.count_if(F.coalesce("release_ready", F.lit(False))).alias("have")).where("have < need").select(F.lit("sources_ready").alias("gate"), "have", "need"))
    return out
