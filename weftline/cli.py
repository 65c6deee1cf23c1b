"""Commands over record files: ``python -m weftline COMMAND PATH... [--out FOLDER]``. Results are JSON lines."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import audit, census, constraints, counts, discovery, duplicates, lifecycle, ranking, scoring, snapshots, splitting
from weftline.sources import jsonl, records, sinks, upstream

#: Commands whose rows are faults, which give the exit code 1.
FINDINGS = ("validate", "gold-audit", "validate-controls", "not-for-release")
LEAST = "category string, min_units int, min_ambiguous int, min_negatives int"
#: Commands of one table of records: name to the operator.
SIMPLE = {
    "stats": counts.statistics, "coverage": counts.coverage, "validate": constraints.violations, "dedupe": duplicates.input_groups, "dedupe-pairs": duplicates.pair_groups, "dedupe-summary": duplicates.summary,
    "source-overlap": duplicates.source_overlap, "conflicts": duplicates.unit_conflicts, "record-conflicts": duplicates.record_conflicts, "contradictions": duplicates.contradictions, "clusters": census.clusters, "blind-review": census.blind_batch,
    "family-suggestions": lambda r: census.numbered(census.families(r)), "leakage": splitting.leakage, "split": splitting.assignments, "split-violations": splitting.violations,
    "exclusions": lambda r: counts.exclusion_analysis(counts.excluded_units(r)), "exclusion-totals": lambda r: counts.exclusion_totals(counts.excluded_units(r)), "duplicate-ids": snapshots.duplicate_ids,
    "dedupe-members": duplicates.input_members, "conflict-items": duplicates.unit_conflict_items, "cluster-members": census.cluster_members, "blind-refs": census.blind_refs, "family-members": census.family_members, "release-counts": counts.release_counts,
    "coverage-histograms": counts.coverage_histograms, "pool-histograms": counts.pool_histograms, "gold-audit": audit.audit, "not-for-release": audit.not_for_release, "oracle-hashes": lambda r: audit.with_hash(r).select("id", "oracle_hash", "assertion_hash"),
    "census-rows": lambda r: census.ledger(*_accounted(r)), "census-stats": lambda r: census.summary(*_accounted(r)),
}


def _accounted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are records, and those without an input as exclusions."""
    return rows.where("input is not null"), rows.where("input is null").select(F.col("benchmark").alias("source"), "source_id", "language", F.lit("malformed_row").alias("reason"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weftline", description=__doc__)
    p.add_argument("command", choices=[*SIMPLE, "merge", "migrate-oracle", "compare-reviews", "rank-candidates", "adjudicate-queue", "validate-controls", "control-coverage", "score-controls", "pool-stats", "discover", "census", "score", "judge-calibrate", "oracle-diff", "review-batch", "import-async", "import-polynorm", "import-proteno", "source-lock"])
    p.add_argument("paths", nargs="+")
    p.add_argument("--out", help="write the result there, sorted by its first column")
    p.add_argument("--fail-on-conflict", action="store_true", help="exit with 2 if the result has rows")
    p.add_argument("--predictions", nargs="*", default=[], help="prediction lines (score, judge-calibrate)")
    p.add_argument("--corpus", help="text file (discover)")
    p.add_argument("--new", nargs="*", default=[], help="the newer records (oracle-diff)")
    p.add_argument("--reviewed", nargs="*", default=[], help="reviewed records (rank-candidates, review-batch, adjudicate-queue)")
    p.add_argument("--targets", help="JSON list of category, min_units, min_ambiguous, min_negatives; a null category is the default (coverage gaps, rankings)")
    p.add_argument("--patterns", help="JSON list of category, pattern that must be covered (rankings)")
    p.add_argument("--regressions", nargs="*", default=[], help="benchmarks of failures in production (adjudicate-queue)")
    p.add_argument("--curated", nargs="*", default=[], help="benchmarks whose units were not imported and need no mapping (validate, gold-audit)")
    p.add_argument("--profiles", nargs="*", default=[], help="known profiles (validate-controls)")
    p.add_argument("--source-rows", type=int, help="rows the sources delivered (pool-stats)")
    p.add_argument("--strict", action="store_true", help="ask for reviews, explicit oracles and hashes (gold-audit)")
    p.add_argument("--rare-below", type=int, default=3)
    p.add_argument("--limit", type=int, default=50)
    p.add_argument("--max-per-category", type=int, default=10)
    p.add_argument("--max-per-family", type=int, default=2)
    p.add_argument("--languages", nargs="*")
    p.add_argument("--mapping", help="JSON list of name, category, status (imports)")
    p.add_argument("--form", default="projection", help="english, multilingual, raw, projection or official (imports)")
    p.add_argument("--exclusions", help="folder for what an import leaves out")
    return p


def _imported(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rules = jsonl.registry(spark, a.mapping, schema="name string, category string, status string, position int")
    path = a.paths[0]
    if a.command == "import-async":
        rows = upstream.async_multilingual(spark, path) if a.form == "multilingual" else upstream.async_english(spark, path)
        made, lost = upstream.imported(rows, "async_tn", rules, boundary=True)
    elif a.command == "import-polynorm":
        made, lost = upstream.imported(upstream.polynorm(spark, path, a.form), "polynorm", rules)
    else:
        made, lost = upstream.imported(upstream.proteno(spark, path), "proteno", rules)
    if a.exclusions:
        sinks.guard_output(a.exclusions, a.paths)
        sinks.write_jsonl(lost, a.exclusions, ["source_id"])
    return made


def result(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.command.startswith("import-"):
        return _imported(spark, a)
    if a.command == "source-lock":
        return sinks.file_hashes(spark, a.paths[0])
    if a.command in ("validate-controls", "control-coverage", "score-controls"):
        controls = jsonl.controls(jsonl.read_lines(spark, jsonl.expand_paths(a.paths)))
        if a.command == "validate-controls":
            return lifecycle.control_violations(controls, spark.createDataFrame([(x,) for x in a.profiles], "profile_id string"))
        if a.command == "control-coverage":
            return scoring.control_counts(controls)
        given, twice = jsonl.control_predictions(jsonl.read_lines(spark, jsonl.expand_paths(a.predictions)))
        if found := twice.take(1):
            raise snapshots.DuplicateIds(found[0].id)
        return scoring.score_controls(scoring.control_results(controls, given))
    rows = records.read(spark, a.paths)
    if a.command == "validate":
        return constraints.violations(rows, tuple(a.curated))
    if a.command == "gold-audit":
        return audit.audit(rows, a.strict, tuple(a.curated))
    if a.command in SIMPLE:
        return SIMPLE[a.command](rows)
    if a.command == "pool-stats":  # without a number of delivered rows every row of the files counts as delivered
        seen = rows.groupBy("benchmark").agg(F.count("*").alias("source_rows"))
        return counts.pool_summary(rows.where("input is not null"), seen if a.source_rows is None else seen.withColumn("source_rows", F.lit(a.source_rows).cast("bigint")))
    if a.command == "merge":
        return snapshots.merged_unique(rows).drop("benchmark", "source_id", "upstream_expected", "canonical", "accepted", "rejected")
    if a.command == "migrate-oracle":
        made = lifecycle.derived_oracle(F.col("status"), F.col("input"), F.col("expected_output"), F.col("units"), F.col("language"))
        return rows.select("id", F.when(F.col("oracle").isNull(), made).alias("oracle")).where("oracle is not null")
    if a.command == "compare-reviews":
        side = lambda r: r.select("id", "units", "status", "canonical", "accepted", "rejected")
        return snapshots.compared_annotations(side(rows), side(records.read(spark, a.new)))
    if a.command in ("rank-candidates", "review-batch"):
        least = jsonl.registry(spark, a.targets, schema=LEAST) if a.targets else spark.createDataFrame([], LEAST)
        required = jsonl.registry(spark, a.patterns, schema="category string, pattern string") if a.patterns else spark.createDataFrame([], "category string, pattern string")
        ranked = ranking.prioritised(ranking.candidate_flags(rows, records.read(spark, a.reviewed), least, required), ranking.REASONS)
        if a.command == "rank-candidates":
            return ranked.select("id", "priority", "reasons", "language", "family_id", "categories")
        return ranking.greedy_batch(ranked, a.limit, a.max_per_category, a.max_per_family, set(a.languages) if a.languages else None)
    if a.command == "adjudicate-queue":
        least = jsonl.registry(spark, a.targets, schema=LEAST) if a.targets else spark.createDataFrame([], LEAST)
        reviewed = records.read(spark, a.reviewed)
        live = spark.createDataFrame([(b,) for b in a.regressions], "benchmark string")
        return ranking.adjudication(rows, duplicates.unit_conflicts(rows), counts.coverage_gaps(reviewed, least, a.languages or sorted(upstream.LOCALES)), live)
    if a.command == "census":
        return census.ledger_summary(rows, counts.excluded_units(rows.where("input is null")))
    if a.command == "discover":
        texts = jsonl.read_lines(spark, [a.corpus]).select(F.col("_line").alias("line"), F.col("value").alias("text"))
        return discovery.rare_tokens(texts, rows, "line", a.rare_below)
    if a.command == "score":
        given = jsonl.predictions(jsonl.read_lines(spark, jsonl.expand_paths(a.predictions)))
        listed = F.when(F.col("oracle.accepted_outputs").isNotNull(), F.col("accepted"))
        whole = rows.withColumn("accepted", listed).select("*", F.col("oracle").isNotNull().alias("has_oracle"), F.size("units").alias("n_units"), F.col("units.category").alias("categories"))
        return scoring.score(scoring.evaluated(whole, given))
    if a.command == "judge-calibrate":
        lines = jsonl.read_lines(spark, jsonl.expand_paths(a.paths))
        human = lines.select(*[F.get_json_object("value", f"$.{c}").alias(c) for c in ("id", "language", "category", "human_label", "ambiguity_family")])
        given = jsonl.predictions(jsonl.read_lines(spark, jsonl.expand_paths(a.predictions)), "label")
        if alone := scoring.unmatched(human, given).orderBy("side", "id").take(1):
            raise records.BrokenLines(f"{alone[0].side}: {alone[0].id}")
        return scoring.calibration(human, given)
    if a.command == "oracle-diff":
        plain = lambda r: r.select("id", "canonical", "accepted", F.to_json("units").alias("units"), "status", F.to_json("source").alias("meta"))
        return snapshots.difference(plain(rows), plain(records.read(spark, a.new)))
    raise ValueError(a.command)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0; 1 if ``validate`` found violations or a file is broken; 2 if conflicts were found and are not allowed."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("weftline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        found = result(spark, a)
    except (records.BrokenLines, snapshots.DuplicateIds) as e:
        print(e, file=sys.stderr)
        return 1
    if a.out:
        sinks.guard_output(a.out, a.paths)
        sinks.write_jsonl(found, a.out, [found.columns[0]] if a.command != "merge" else ["source.benchmark", "language", "locale", "source.source_id", "id"])
        bad = (a.command in FINDINGS or a.fail_on_conflict) and not found.isEmpty()
    else:
        bad = False
        for row in sinks.stable_json(found if a.command == "merge" else found.orderBy(found.columns[0])).toLocalIterator():
            print(row.value)
            bad = True
    if bad and a.command in FINDINGS:
        return 1
    return 2 if bad and a.fail_on_conflict else 0
