import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import audit, census, constraints, counts, discovery, duplicates, ranking, scoring, snapshots, splitting

POOL = "id string, benchmark string, input string, upstream_expected string, expected_output string"


def test_duplicates_and_overlap(spark):
    rows = [("a", "s1", "Same  Text", "1", None), ("b", "s2", "same text", "2", None), ("c", "s3", " SAME TEXT ", "1", None), ("d", "s1", None, None, None), ("e", "s1", "", "", "x"), ("f", None, "alone", None, None)]
    df = spark.createDataFrame(rows, POOL).withColumn("clash", F.lit(1)).withColumn("fp", F.lit("clash"))
    groups = {r.n: (r.n_sources, r.n_outputs, r.min_id) for r in duplicates.input_groups(df).collect()}
    assert groups == {3: (3, 2, "a"), 2: (1, 1, "d")}
    assert {(r.source_a, r.source_b): r.n_inputs for r in duplicates.source_overlap(df).collect()} == {("s1", "s2"): 1, ("s1", "s3"): 1, ("s2", "s3"): 1}
    assert [r.n for r in duplicates.pair_groups(df).collect()] == [2]
    assert duplicates.conflicting_outputs(df).count() == 1
    assert tuple(duplicates.summary(df).first()) == (6, 3, 2, 1, 5)
    assert {(r.id, r.benchmark) for r in duplicates.input_members(df).collect()} == {("a", "s1"), ("b", "s2"), ("c", "s3"), ("d", "s1"), ("e", "s1")}
    assert {r.id for r in duplicates.conflicting_members(df).collect()} == {"a", "b", "c"}
    spaced = spark.createDataFrame([("a", "s", "t", "Out A", None), ("b", "s", "T", "out  a", None), ("c", "s", "t", " ", "x")], POOL)
    assert duplicates.conflicting_outputs(spaced).count() == 0 and [r.n_outputs for r in duplicates.input_groups(spaced).collect()] == [1]
    empty = df.limit(0)
    assert duplicates.input_groups(empty).count() == 0 and tuple(duplicates.summary(empty).first()) == (0, 0, 0, 0, 0)


def test_results_do_not_depend_on_order_or_partitions(spark):
    rows = [(f"r{i}", f"s{i % 3}", f"text {i % 7}", str(i % 2), None) for i in range(60)]
    want = None
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, POOL).repartition(3 + 4 * seed)
        got = sorted(map(tuple, duplicates.input_groups(df).collect()))
        assert want in (None, got)
        want = got


def test_conflicts(spark):
    unit = "array<struct<category string, surface string, canonical string>>"
    df = spark.createDataFrame([("a", "en-US", [("fraction", "3/4", "three quarters")]), ("b", "en-US", [("fraction", "3/4", "three over four"), ("fraction", "3/4", " Three Quarters ")]), ("c", None, None)], f"id string, locale string, units {unit}")
    assert [(r.surface, r.n, r.n_values) for r in duplicates.unit_conflicts(df).collect()] == [("3/4", 3, 2)]
    assert {(r.id, r.value) for r in duplicates.unit_conflict_items(df).collect()} == {("a", "three quarters"), ("b", "three over four"), ("b", "three quarters")}
    rec = spark.createDataFrame([("a", "en", "x", "1"), ("b", "en", "x", " 1"), ("c", "en", "y", "1"), ("d", "en", "y", None), ("e", "en", "z", "1"), ("f", "en", "z", "2")], "id string, locale string, input string, expected_output string")
    assert [r.input for r in duplicates.record_conflicts(rec).collect()] == ["z"]


def test_contradictions_match_all_pairs(spark):
    draw = random.Random(3)
    rows = [(f"r{i}", "en", draw.choice(["A", "a ", "b"]), "p", draw.sample("uvwx", 2), draw.sample("uvwx", draw.randrange(2))) for i in range(20)] + [("n", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, locale string, input string, policy_version string, accepted array<string>, rejected array<string>")
    got = {(r.id_l, r.id_r) for r in duplicates.contradictions(df).collect()}
    same = lambda a, b: a[2].strip().lower() == b[2].strip().lower()
    want = {tuple(sorted((a[0], b[0]))) for a in rows[:-1] for b in rows[:-1] if a[0] != b[0] and same(a, b) and set(a[4]) & set(b[5])}
    assert got == want


def test_disagreements_of_reviewed_records(spark):
    rows = [("a", "gold", "en", "One  x", "p", "Out", ["Out", "v"], ["w"]), ("b", "multi_valid", "en", "one x", "p", "ｏut", ["W"], None), ("c", "quarantine", "en", "one x", "p", "else", ["w"], ["v"]), ("d", "gold", "en", "one X", "p", "third", None, ["V"]), ("e", "gold", None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, status string, locale string, input string, policy_version string, canonical string, accepted array<string>, rejected array<string>")
    assert [(r.n, r.n_outputs, r.min_id) for r in duplicates.canonical_disagreements(df).collect()] == [(3, 2, "a")]
    assert {(r.id_l, r.id_r) for r in duplicates.contradictions(df).collect()} == {("a", "b"), ("a", "d")}


def test_statistics_and_null_keys(spark):
    df = spark.createDataFrame([("a", "gold", "en", "en-US", "s", "train", "f"), ("b", "gold", None, None, None, None, ""), ("c", "no_change", "en", "en-US", "s", "train", "f")], "id string, status string, language string, locale string, benchmark string, split string, family_id string")
    got = {(r.section, r.key): (r.records, r.families) for r in counts.statistics(df).collect()}
    assert got[("all", "")] == (3, 1) and got[("language", "null")] == (1, 0) and got[("status", "gold")] == (2, 1)
    assert {k for k, _ in got} == {"all", "language", "locale", "benchmark", "split", "status"}


COVER = "id string, language string, status string, negative_for array<string>, units array<struct<category string, surface string, features string>>"


def test_coverage_and_gaps(spark):
    df = spark.createDataFrame([("a", "en", "ambiguous", [], [("date", "1", None), ("date", "2", None)]), ("b", "de", "gold", ["date"], [("time", "3", "{}")]), ("c", "de", "gold", None, None)], COVER)
    got = {r.category: tuple(r)[1:] for r in counts.coverage(df).collect()}
    assert got == {"date": (2, 1, 1, 2, 1), "time": (1, 1, 1, 0, 0)}
    least = spark.createDataFrame([("date", 3, 1, 1), ("music", 1, 0, 0), (None, 1, 1, 0)], "category string, min_units int, min_ambiguous int, min_negatives int")
    gaps = {(r.category, r.gap, r.detail) for r in counts.coverage_gaps(df, least, ["en", "de"]).collect()}
    required = spark.createDataFrame([("date", "iso"), ("time", "p"), ("never", "q")], "category string, pattern string")
    more = {(r.category, r.gap, r.detail) for r in counts.coverage_gaps(df, least, ["en", "de"], required).collect()}
    assert more - gaps == {("date", "surface_pattern", "iso"), ("time", "surface_pattern", "p")} and gaps <= more
    assert gaps == {("date", "low_volume", ""), ("date", "language", "de"), ("time", "ambiguous", ""), ("time", "language", "en"), ("music", "low_volume", ""), ("music", "language", "en"), ("music", "language", "de")}


def test_pool_yield_and_accounting(spark):
    df = spark.createDataFrame([("a", "s", "x", [1, 2]), ("b", "s", "X ", []), ("c", "s", None, [])], "id string, benchmark string, input string, units array<int>")
    observed = spark.createDataFrame([("s", 4), ("t", 0)], "benchmark string, source_rows bigint")
    assert tuple(counts.pool_summary(df, observed).first()) == ("s", 3, 2, 1, 0.75)
    lost = spark.createDataFrame([("s",)], "source string")
    assert {r.benchmark: r.row_accounting_ok for r in counts.import_diagnostics(df, lost, observed).collect()} == {"s": True, "t": True}


def test_discovery(spark):
    texts = spark.createDataFrame([(2, "Order QK-417/3D. (1.2.3.4) 50%"), (1, "50% QK-417/3D."), (3, None), (4, "")], "k int, text string")
    records = spark.createDataFrame([("r", [("1.1.1.1",)] * 3 + [("5%",)])], "id string, units array<struct<surface string>>")
    got = {r.token: (r.shape, r.n, r.first_key, r.first_nth, r.reason) for r in discovery.rare_tokens(texts, records, "k").collect()}
    assert got == {"QK-417/3D.": ("mixed_alnum", 2, 1, 1, "unseen_shape"), "50%": ("percent", 2, 1, 0, "rare_shape")}
    odd = spark.createDataFrame([(1, " \u2003a 3:45\u00a0uhr\x1f7/8😀 b\n4/5 ")], "k int, text string")
    text = odd.first().text
    places = {r.token: (r.nth, r.start, r.end) for r in discovery.placed_tokens(odd, "k").collect()}
    assert places == {t: (n, text.index(t), text.index(t) + len(t)) for n, t in enumerate(text.split()) if t in ("3:45", "4/5", "7/8😀")}
    assert sorted(r.token for r in discovery.tokens(odd, "k").collect()) == ["3:45", "4/5", "7/8😀"]


def test_census_clusters_and_families(spark):
    unit = "array<struct<start int, end int, category string, features string>>"
    rows = [("a", "en", "en-US", "s", "1:de", "On 5", None, [(3, 4, "n", None)]), ("b", "en", "en-US", "s", "1:en", "on  5", "x", []), ("c", "en", "en-US", "t", "7", "On 6", None, [(3, 4, "n", None)]), ("d", "en", "en-US", "t", None, "On 7", None, [(3, 4, "n", None)]), ("e", "en", "en-US", "t", "9", None, None, [])]
    df = spark.createDataFrame(rows, f"id string, language string, locale string, benchmark string, source_id string, input string, upstream_expected string, units {unit}").withColumn("expected_output", F.lit(None).cast("string"))
    clusters = {r.min_id: (r.records, r.refs, r.outputs) for r in census.clusters(df).collect()}
    assert clusters == {"a": (2, 2, 1), "c": (1, 1, 0), "d": (1, 1, 0), "e": (1, 1, 0)}
    assert {r.id for r in census.cluster_members(df).collect()} == set("abcde")
    blind = census.blind_batch(df)
    assert {"upstream_expected", "expected_output", "units"}.isdisjoint(blind.columns) and blind.count() == 4 and census.blind_refs(df).count() == 5
    groups = census.numbered(census.families(df)).orderBy("number").collect()
    assert [(r.number, r.n, r.min_id) for r in groups] == [(1, 2, "a"), (2, 2, "c"), (3, 1, "e")]
    assert census.family_members(df).count() == 5
    lost = spark.createDataFrame([("t", "8", "en", "bad")], "source string, source_id string, language string, reason string")
    assert {(r.benchmark, r.state): r.n for r in census.ledger_summary(df, lost).collect()} == {("s", "candidate"): 2, ("t", "candidate"): 3, ("t", "explicit_exclusion"): 1}
    total = census.summary(df, lost).first()
    assert (total.rows_observed, total.rows_parsed, total.rows_excluded, total.sentence_clusters, total.row_accounting_ok) == (6, 5, 1, 4, True)
    assert not census.summary(df, lost, spark.createDataFrame([(9,)], "source_rows bigint")).first().row_accounting_ok
    marked = df.withColumn("mapping_status", F.when(F.col("id") == "a", "unsupported"))
    assert census.summary(marked, lost.limit(0)).first().rows_metadata_only == 1


def test_splits(spark):
    df = spark.createDataFrame([("1", "fa", "dev"), ("2", "fa", None), ("3", "fb", "candidate"), ("4", "fc", "train"), ("5", "fc", "test"), ("6", None, "train")], "id string, family_id string, split string")
    registry = spark.createDataFrame([("fa", "test")], "family_id string, split string")
    got = {r.family_id: (r.split, r.origin) for r in splitting.assignments(df, registry, seed=7).collect()}
    assert got["fa"] == ("test", "registry") and got["fb"][1] == "hash" and got["fc"][1] == "hash" and len(got) == 3
    assert {r.family_id: r.origin for r in splitting.assignments(df).collect()}["fa"] == "records"
    assert {(r.family_id, r.rule) for r in splitting.violations(df, registry).collect()} == {("fc", "several_splits"), ("fa", "differs_from_registry")}
    assert [(r.family_id, r.splits) for r in splitting.leakage(df).collect()] == [("fc", "test,train")]


def test_scores(spark):
    rows = [("a", "en", "l", "gold", "test", "i", "Out", ["Out", "Ａlt"], 2, ["x", "y"]), ("b", "en", "l", "no_change", "test", "same", "same", ["same"], 0, []), ("c", "de", "l", "gold", "candidate", "i", "o", [], 1, ["x"]), ("d", "de", "l", "ambiguous", "test", "i", None, [], 1, ["x"]), ("e", "de", "l", "multi_valid", None, "i", "q", [f"v{i}" for i in range(301)], 1, ["x"]), ("f", "de", "l", "gold", "test", "i", None, None, 1, ["x"])]
    df = spark.createDataFrame(rows, "id string, language string, locale string, status string, split string, input string, canonical string, accepted array<string>, n_units int, categories array<string>")
    predictions = spark.createDataFrame([("a", " alt "), ("b", "changed"), ("e", "V299")], "id string, output string")
    flags = {r.id: (r.missing, r.canonical_match, r.accepted_match, r.weight, r.mutated) for r in scoring.evaluated(df, predictions).collect()}
    assert flags == {"a": (False, False, True, 2, False), "b": (False, False, False, 1, True), "e": (False, False, True, 1, False), "f": (True, True, True, 1, False)}
    total = {(r.section, r.key): r for r in scoring.score(scoring.evaluated(df, predictions)).collect()}[("all", "")]
    assert (total.records, total.missing, total.canonical_accuracy, total.accepted_accuracy, total.unit_accuracy, total.false_positive_rate) == (4, 1, 0.25, 0.75, 0.2, 1.0)
    assert {r.category: r.units for r in scoring.score_categories(scoring.evaluated(df, predictions)).collect()} == {"x": 3, "y": 1}
    assert scoring.score(scoring.evaluated(df.limit(0), predictions)).count() == 0


def test_calibration_and_controls(spark):
    human = spark.createDataFrame([("a", "en", "date", "accept"), ("b", "en", "date", "reject"), ("c", "en", "time", "accept"), ("z", "en", "time", "accept")], "id string, language string, category string, human_label string")
    judge = spark.createDataFrame([("a", "accept"), ("b", "accept"), ("c", "reject"), ("q", "accept")], "id string, label string")
    total = {r.section: r for r in scoring.calibration(human, judge).collect()}["all"]
    assert (total.true_accept, total.false_accept, total.true_reject, total.false_reject, total.precision, total.recall) == (1, 1, 0, 1, 0.5, 0.5)
    assert {(r.id, r.side) for r in scoring.unmatched(human, judge).collect()} == {("z", "missing_prediction"), ("q", "unknown_id")}
    controls = spark.createDataFrame([("1", "k", "en", [("p", "out", ["r"], ["f"]), ("q", "o2", [], [])]), ("2", "k", "de", [("p", "o", ["r"], None)])], "id string, control string, language string, expectations array<struct<profile_id string, expected_output string, required_rules array<string>, forbidden_rules array<string>>>")
    given = spark.createDataFrame([("1", {"p": ("out", ["r", "f"])})], "id string, profiles map<string,struct<output string, rules array<string>>>")
    results = {(r.id, r.profile_id): (r.output_match, r.required_met, r.forbidden_hit, r.full_match) for r in scoring.control_results(controls, given).collect()}
    assert results == {("1", "p"): (True, True, True, False), ("1", "q"): (False, True, False, False), ("2", "p"): (False, False, False, False)}
    assert [(r.control, r.records, r.missing_languages) for r in scoring.control_coverage(controls, 3, ["de", "fr"]).collect()] == [("k", 2, "fr")]


def test_greedy_batch_takes_what_a_loop_takes(spark):
    draw = random.Random(9)
    rows = [(f"r{i:03}", draw.choice(["de", "en"]), draw.choice("fgh"), draw.sample("abcd", draw.randrange(1, 3)), draw.randrange(5)) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, language string, family_id string, categories array<string>, priority int")
    for languages in (None, {"de"}):
        taken, cats, fams = [], Counter(), Counter()
        for i, lang, fam, cs, _ in sorted(rows, key=lambda r: (-r[4], r[0])):
            if len(taken) < 9 and (not languages or lang in languages) and fams[fam] < 3 and all(cats[c] < 4 for c in cs):
                taken.append(i)
                fams[fam] += 1
                cats.update(cs)
        assert [r.id for r in ranking.greedy_batch(df, 9, 4, 3, languages).orderBy("place").collect()] == taken


def test_greedy_batch_binds_rows_without_categories_by_family_only(spark):
    rows = [(f"r{i}", "en", "f", [] if i < 6 else ["a"], 9 - i) for i in range(9)]
    df = spark.createDataFrame(rows, "id string, language string, family_id string, categories array<string>, priority int")
    assert [r.id for r in ranking.greedy_batch(df, 9, 1, 5).orderBy("place").collect()] == ["r0", "r1", "r2", "r3", "r4"]


def test_candidates_have_all_reasons(spark):
    unit = "array<struct<category string, surface string, canonical string, features string, mapping_status string>>"
    u = lambda c, s, out, pattern=None, family=None, status="exact": (c, s, out, json.dumps({"surface_pattern": pattern, "ambiguity_family": family}), status)
    rows = [
        ("a", "en", "f", "en", "s1", "One", "x", None, [u("date", "1", "one", "p")]), ("b", "en", "f", "en", "s2", "one", "X ", None, [u("date", "1", "one", "p")]),
        ("c", "de", "f", None, "s1", "two", None, "y", [u("date", "2", "zwei", "q"), u("new", "3", "drei", "p", "m", "broader")]),
        ("d", "en", "f", None, "s1", "three", None, None, []), ("e", "en", "f", None, "s1", "three", None, "z", None), ("g", "en", "f", "en", "s1", "four", None, "1", [u("time", "4", "four", "p")]), ("h", "en", "f", "en", "s1", "four", None, "2", [u("time", "4", "vier", "p")]),
    ]
    df = spark.createDataFrame(rows, f"id string, language string, family_id string, locale string, benchmark string, input string, upstream_expected string, expected_output string, units {unit}")
    reviewed = spark.createDataFrame([("1", "en", [u("date", "9", "nine", "p")] * 2), ("2", "en", [u("time", "9", "nine", "p")])], f"id string, language string, units {unit}")
    least = spark.createDataFrame([("time", 1), (None, 3)], "category string, min_units int")
    required = spark.createDataFrame([("date", "p"), ("date", "q")], "category string, pattern string")
    ranked = ranking.prioritised(ranking.candidate_flags(df, reviewed, least, required), ranking.REASONS)
    got = {r.id: (r.priority, set(r.reasons.split(","))) for r in ranked.collect()}
    same = {"category_below_minimum", "cross_source_duplicate", "duplicate_exact_input_output"}
    assert got["a"] == got["b"] == (35, same)
    assert got["c"] == (100 + 50 + 40 + 30 + 20 + 15 + 10 - 30, {"category_missing", "category_below_minimum", "required_pattern_missing", "new_language_for_category", "multi_unit", "ambiguity_family", "rare_surface_pattern", "broad_or_ambiguous_mapping"})
    assert got["d"] == got["e"] == (-70, {"metadata_only", "duplicate_exact_input_output"})
    assert got["g"] == got["h"] == (25 - 20, {"source_disagreement", "duplicate_exact_input_output"})
    assert len(got) == ranked.count() == 7 and ranking.candidate_flags(df.limit(0), reviewed, least, required).count() == 0


def test_adjudication_counts_each_gap_category(spark):
    unit = "array<struct<category string, surface string, canonical string>>"
    df = spark.createDataFrame([("a", "live", None, "gold", [("date", "1", "x"), ("date", "2", "x"), ("k", "3", "x"), ("ok", "3", "x")]), ("b", "s", "en", "quarantine", [(None, "5", "x")]), ("c", None, None, None, None)], f"id string, benchmark string, locale string, status string, units {unit}")
    conflicts = spark.createDataFrame([("en", None, "5")], "locale string, category string, surface string")
    gaps = spark.createDataFrame([("date",), ("date",), ("k",)], "category string")
    live = spark.createDataFrame([("live",), ("live",), (None,)], "benchmark string")
    got = {r.id: (r.priority, r.reasons) for r in ranking.adjudication(df, conflicts, gaps, live).collect()}
    assert got == {"a": (90, "coverage_gap:date,coverage_gap:k,production_regression,semantic_risk"), "b": (45, "quarantine_review,source_disagreement"), "c": (0, "")}
    assert ranking.adjudication(df, conflicts, gaps.limit(0), live).where("id = 'a'").first().priority == 60


def test_priorities(spark):
    df = spark.createDataFrame([("a", True, True), ("b", False, None)], "id string, x boolean, y boolean")
    assert [(r.priority, r.reasons) for r in ranking.prioritised(df, {"y": -30, "x": 20}).orderBy("id").collect()] == [(-10, "x,y"), (0, "")]


def test_differences_between_snapshots(spark):
    schema = "id string, canonical string, accepted array<string>, units string, status string, meta string"
    old = spark.createDataFrame([("a", "x", ["x"], "u", "gold", "m"), ("b", "x", ["x"], "u", "gold", "m"), ("c", None, None, "u", "gold", "m"), ("d", "x", ["x"], "u", "gold", "m"), ("e", "x", ["x"], "u", "gold", "m"), ("f", "x", ["x"], "u", "gold", "m")], schema)
    new = spark.createDataFrame([("a", "x", ["x"], "u", "gold", "m"), ("b", "y", ["x"], "u", "gold", "m"), ("c", None, ["q"], "u", "gold", "m"), ("d", "x", ["z"], "u", "gold", "m"), ("e", "x", ["x"], "v", "quarantine", "m"), ("g", "x", ["x"], "u", "gold", "m")], schema)
    assert {r.id: r.change for r in snapshots.difference(old, new).collect()} == {"b": "canonical_change", "c": "accepted_addition", "d": "accepted_removal", "e": "unit_change", "f": "removed", "g": "added"}
    assert snapshots.difference(old, old).count() == 0
    assert snapshots.duplicate_ids(snapshots.merged(old, new)).count() == 5


UNIT = "struct<surface string, start int, end int, category string, semantic string, canonical string, accepted array<string>, rejected array<string>>"
ORACLE = "struct<canonical_output string, accepted_outputs array<string>, rejected_outputs array<struct<output string, reason string>>, variant_mode string, comparison_profile string, interpretations array<struct<label string, semantic string, accepted_outputs array<string>>>>"
RECORD = f"id string, schema_version string, taxonomy_version string, policy_version string, family_id string, status string, split string, expected_output string, input string, negative_for array<string>, units array<{UNIT}>, oracle {ORACLE}"
NAMES = ("id", "sv", "tv", "pv", "fam", "status", "split", "out", "input", "neg", "units", "oracle")
OK = ("1", "1", "1", "1", "f", "gold", "train", "a five", "a 5", [], [("5", 2, 3, "fraction", '{"numerator": 1, "denominator": 2}', "five", ["FIVE "], [])], ("a five", ["a  Five"], [], "explicit", "sentence-exact-v1", None))


def _change(**k):
    return tuple(k.get(n, v) for n, v in zip(NAMES, OK, strict=True))


def _unit(**k):
    return [tuple(k.get(n, v) for n, v in zip(("surface", "start", "end", "category", "semantic", "canonical", "accepted", "rejected"), OK[10][0], strict=True))]


def _oracle(**k):
    return tuple(k.get(n, v) for n, v in zip(("canonical", "accepted", "rejected", "mode", "profile", "readings"), OK[11], strict=True))


def test_each_rule_is_found(spark):
    same = {"status": "no_change", "out": "a 5", "units": [], "neg": ["d"]}
    readings = [("one", '{"day": 1, "month": 2}', ["x"]), ("two", '{"month": 2, "day": 1}', ["y"])]
    open_ = {"status": "ambiguous", "out": None, "units": _unit(canonical=None)}
    cases = {
        "missing_schema_version": _change(sv=" "), "unknown_status": _change(status="x"), "unknown_split": _change(split=None), "output_not_allowed": _change(**open_ | {"out": "o", "oracle": _oracle(canonical=None, accepted=[], readings=[*readings, ("three", '{"day": 2}', ["z"])])}),
        "negative_control_with_units": _change(**same | {"units": OK[10], "oracle": _oracle(canonical="a 5", accepted=["a 5"])}), "negative_control_of_nothing": _change(**same | {"neg": [], "oracle": _oracle(canonical="a 5", accepted=["a 5"])}), "unchanged_output_differs": _change(**same | {"out": "b", "oracle": _oracle(canonical="a 5", accepted=["a 5"])}),
        "unchanged_canonical_differs": _change(**same | {"oracle": _oracle(canonical="b", accepted=["a 5"])}), "unchanged_accepted_differs": _change(**same | {"oracle": _oracle(canonical="a 5", accepted=["a 5", "b"])}),
        "oracle_missing": _change(oracle=None), "accepted_repeated": _change(oracle=_oracle(accepted=["a five", "A  five"])), "accepted_and_rejected": _change(oracle=_oracle(rejected=[("ａ five", "r")])), "canonical_not_accepted": _change(oracle=_oracle(accepted=["b"])), "variants_not_explicit": _change(oracle=_oracle(mode="all")), "unknown_profile": _change(oracle=_oracle(profile="other")),
        "output_not_canonical": _change(out="a  five"), "reconstruction_differs": _change(units=_unit(canonical="V", accepted=["V"])), "ambiguous_accepted": _change(**open_ | {"oracle": _oracle(canonical=None, accepted=["x"], readings=[readings[0], ("q", "{}", ["y"])])}),
        "too_few_interpretations": _change(**open_ | {"oracle": _oracle(canonical=None, accepted=[], readings=readings)}), "interpretation_without_output": _change(**open_ | {"oracle": _oracle(canonical=None, accepted=[], readings=[readings[0], ("q", "{}", [])])}),
        "span_not_surface": _change(units=_unit(start=1, end=3)), "invalid_semantic": _change(units=_unit(semantic="{}")),
    }
    also = {"output_not_canonical": set(), "span_not_surface": {"reconstruction_differs"}, "unknown_split": set()}
    df = spark.createDataFrame([OK, *[(k, *v[1:4], f"f-{k}", *v[5:]) for k, v in cases.items()]], RECORD)
    broken = {}
    for r in constraints.violations(df).collect():
        broken.setdefault(r.record_id, set()).add(r.rule)
    assert broken == {k: {k} | also.get(k, set()) for k in cases}
    units = {"canonical_missing": _unit(canonical=" "), "canonical_not_accepted": _unit(accepted=["six"]), "accepted_and_rejected": _unit(rejected=["ＦＩＶＥ"]), "surface_missing": _unit(surface="", start=None, end=None)}
    broken = {(r.record_id, r.rule) for r in constraints.unit_violations(spark.createDataFrame([(k, *_change(units=u)[1:]) for k, u in units.items()], RECORD)).collect()}
    assert broken == {(k, k) for k in units}
    twice = spark.createDataFrame([OK, _change(split="test")], RECORD)
    assert {r.rule for r in constraints.violations(twice).collect()} == {"duplicate_id", "family_in_several_splits"}
    assert constraints.violations(df.limit(0)).count() == 0
    assert [r.detail for r in constraints.forbidden_keys(spark.createDataFrame([("a", '{"x": [{"oracle": 1}]}'), ("b", '{"oracles": 1}')], "id string, j string"), "j", ["oracle"]).collect()] == ["oracle"]


def test_imported_units_and_ambiguity_families(spark):
    schema = "id string, status string, benchmark string, input string, units array<struct<surface string, start int, end int, category string, semantic string, canonical string, accepted array<string>, rejected array<string>, features string, source_category string, mapping_status string>>"
    unit = lambda source, mapping, family=None: [("5", None, None, "n", None, None, None, None, json.dumps({"ambiguity_family": family}), source, mapping)]
    df = spark.createDataFrame([("a", "quarantine", "s", "5", unit("N", "exact")), ("b", "quarantine", "s", None, unit(None, "odd", "f")), ("c", "quarantine", "own", "5", unit(None, None, "g")), ("d", None, None, None, None)], schema)
    assert {(r.record_id, r.rule) for r in constraints.unit_violations(df, curated=("own",)).collect()} == {("b", "source_category_missing"), ("b", "unknown_mapping")}
    families = spark.createDataFrame([("g", "other"), ("g", "more"), ("h", "n")], "family string, category string")
    assert {(r.record_id, r.rule) for r in constraints.ambiguity_violations(df, families).collect()} == {("b", "unknown_ambiguity_family"), ("c", "ambiguity_family_of_other_category")}


def test_oracle_hash_and_audit(spark):
    import hashlib

    schema = f"{RECORD}, language string, locale string, oracle_hash string, review struct<protocol_version string, status string, reviewers array<string>, adjudicator string>"
    done, open_ = ("1", "adjudicated", ["x", "y"], "z"), ("1", "adjudicated", ["x", "x"], "z")
    rows = [("a", *OK[1:], "en", None, None, done), ("b", *_change(input='quote " \\ \n é 😀', fam="g")[1:], "en", "l", "sha256:0", open_), ("c", *_change(status="quarantine", out=None, units=None, oracle=None, fam="h")[1:], None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    for r in audit.with_hash(df).collect():
        x = r.asDict(recursive=True)
        units = [{**u, "semantic": json.loads(u["semantic"])} for u in x["units"] or []]
        body = {**{k: x[k] for k in ("language", "locale", "input", "status", "policy_version", "taxonomy_version")}, "units": units, "oracle": x["oracle"] or {}, "comparison_profile": "sentence-exact-v1"}
        assert r.assertion_hash == "sha256:" + hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    plain, strict = ({(r.record_id, r.rule) for r in audit.audit(df, strict=s).collect()} for s in (False, True))
    assert ("b", "oracle_hash_differs") in plain and plain <= strict
    assert {(i, rule) for i, rule in strict - plain} == {("a", "oracle_hash_missing_or_wrong"), ("b", "oracle_hash_missing_or_wrong"), ("b", "review_incomplete"), ("c", "quarantined")}
    assert {(r.record_id, r.rule) for r in audit.not_for_release(df).collect()} == {("c", "forbidden_status")}
    assert audit.audit(df.limit(0), strict=True).count() == 0


def test_policies_and_registry(spark):
    manifest = spark.createDataFrame([("a", "importer_only", "allowed"), ("b", None, "not_redistributable"), ("c", "odd", "allowed"), ("d", None, None)], "benchmark string, materialization_policy string, redistribution_status string")
    df = spark.createDataFrame([(f"{b}{m or ''}", (b,), m) for b in "abcdz" for m in ("external_ref", None)], "id string, source struct<benchmark string>, materialization string")
    got = {(r.record_id, r.rule) for r in audit.materialization_violations(df, manifest).collect()}
    assert got == {("a", "embeds_against_policy"), ("aexternal_ref", "refers_against_policy"), ("b", "embeds_against_policy"), ("d", "embeds_against_policy"), ("dexternal_ref", "refers_against_policy")}
    rows = spark.createDataFrame([("1", "f", "train"), ("2", "g", "dev"), ("3", None, "train"), ("4", "h", None)], "id string, family_id string, split string")
    registry = spark.createDataFrame([("f", "train"), ("g", "challenge"), ("h", "test")], "family_id string, split string")
    assert {(r.record_id, r.rule) for r in audit.registry_violations(rows, registry).collect()} == {("2", "registered_split_unknown"), ("2", "split_differs_from_registry"), ("3", "family_not_registered"), ("4", "split_differs_from_registry")}


@pytest.mark.parametrize("f", [duplicates.unit_conflicts, counts.coverage])
def test_null_units(spark, f):
    df = spark.createDataFrame([("a", None, None, None, None, None)], "id string, locale string, language string, status string, negative_for array<string>, units array<struct<category string, surface string, canonical string, features string>>")
    assert f(df).count() == 0
