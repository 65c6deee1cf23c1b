import pytest
from pyspark.sql import functions as F

from weftline.operators import lifecycle


def test_derived_oracles(spark):
    unit = "array<struct<start int, end int, surface string, category string, semantic string, canonical string, accepted array<string>>>"
    two = '{"candidates": [{"day": 3, "month": 4, "year": 2020}, {"day": 4, "month": 3, "year": 2020}]}'
    rows = [("no_change", "same", None, []), ("gold", "a 5", "a five", []), ("multi_valid", "a 5", "a five", [(2, 3, "5", "n", None, "five", ["V", " ", "FIVE"])]), ("gold", "a 5", "x", [(2, 3, "5", "n", None, None, None)]), ("ambiguous", "a 3/4", None, [(2, 5, "3/4", "date", two, None, None)]), ("quarantine", "a", None, [])]
    df = spark.createDataFrame(rows, f"s string, t string, e string, u {unit}").select(lifecycle.derived_oracle(F.col("s"), F.col("t"), F.col("e"), F.col("u"), F.lit("en")).alias("o"))
    got = [r.o for r in df.collect()]
    assert [o and (o.canonical_output, list(o.accepted_outputs)) for o in got] == [("same", ["same"]), ("a five", ["a five"]), ("a five", ["a FIVE", "a V", "a five"]), ("x", ["a 5", "x"]), (None, []), None]
    assert [(i.label, list(i.accepted_outputs)) for i in got[4].interpretations] == [("interpretation_1", ["April 3, 2020"]), ("interpretation_2", ["March 4, 2020"])] and got[1].interpretations is None


def test_spoken_dates(spark):
    df = spark.createDataFrame([("en",), ("de",), ("es",), ("fr",)], "l string").select(lifecycle.spoken_date(F.col("l"), F.lit(2023), F.lit(3), F.lit(5)).alias("d"), lifecycle.spoken_date(F.col("l"), F.lit(2023), F.lit(13), F.lit(5)).alias("odd"))
    rows = df.collect()
    assert [r.d for r in rows] == ["March 5, 2023", "Tag 5, Monat 3, Jahr 2023", "día 5, mes 3, año 2023", "March 5, 2023"] and rows[0].odd == "month 13 5, 2023"


def test_overlays_round_trip(spark):
    df = spark.createDataFrame([("a", "text", "out", ["x"], "n", "keep"), ("b", None, None, None, None, None)], "id string, input string, expected_output string, negative_for array<string>, notes string, other string")
    over = lifecycle.overlay(df)
    assert over.where("input is not null").count() == 0 and "expected_output" not in over.columns
    back = lifecycle.hydrated(over, df).select(df.columns)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_profiles():
    profiles = {"a": {"kwargs": {"x": 1, "y": 1}, "kind": "k"}, "b": {"extends": "a", "kwargs": {"y": 2}}, "c": {"extends": "d"}, "d": {"extends": "c"}, "e": {"extends": "none"}}
    assert lifecycle.resolved_profile(profiles, "b") == {"kwargs": {"x": 1, "y": 2}, "kind": "k"}
    with pytest.raises(ValueError):
        lifecycle.resolved_profile(profiles, "c")
    assert [e[0] for e in lifecycle.registry_errors(profiles)] == ["c", "d", "e"]
    assert lifecycle.object_hash({"b": 1, "a": 2}) == lifecycle.object_hash({"a": 2, "b": 1})


def test_user_functions(spark):
    df = spark.createDataFrame([("a", "x", "en", "l"), ("b", None, "de", None)], "id string, input string, language string, locale string")
    assert {r.id: r.output for r in lifecycle.predicted(df, lambda t, lang, loc: f"{lang}:{t}").collect()} == {"a": "en:x", "b": None}
    assert {r.id: r.output for r in lifecycle.predicted(df, lambda t, lang, loc, p: t * p["n"], {"n": 2}).collect()} == {"a": "xx", "b": None}
    got = lifecycle.predicted_controls(df.where("input is not null"), lambda t, lang, loc, p: {"output": t, "owners": [p["r"]]} if p else t, {"p": {"r": "q"}, "e": {}}).first()
    assert {k: (v.output, list(v.rules)) for k, v in got.profiles.items()} == {"p": ("x", ["q"]), "e": ("x", [])}


def test_cut_and_selection(spark):
    cut = lifecycle.positional_cut(spark.range(11).selectExpr("id", "'x' AS source"), ["id"]).orderBy("id").collect()
    assert [r.source_split for r in cut] == ["upstream_train"] * 6 + ["upstream_test"] * 5
    df = spark.createDataFrame([("a", "train", "en", "l", "gold", [("date",)]), ("b", None, "en", "l", "gold", [])], "id string, split string, language string, locale string, status string, units array<struct<category string>>")
    assert [r.id for r in lifecycle.selected(df, language="en", category="date", ids=["a", "b"]).collect()] == ["a"]
    assert lifecycle.selected(df, status="gold").count() == 2


def test_control_rules(spark):
    df = spark.createDataFrame([("a", [("p", ["r"], ["r"]), ("p", [], [])]), ("b", []), ("c", [("z", None, None)])], "id string, expectations array<struct<profile_id string, required_rules array<string>, forbidden_rules array<string>>>")
    known = spark.createDataFrame([("p",)], "profile_id string")
    assert {(r.id, r.rule) for r in lifecycle.control_violations(df, known).collect()} == {("a", "profile_repeated"), ("a", "rule_required_and_forbidden"), ("b", "no_expectations"), ("c", "unknown_profile")}
