"""Oracles derived from records, external overlays, profiles with inheritance, user functions and positional cuts."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.spans import variants
from weftline.plans.runtime import stage

# Month names for dates that are read out.
MONTHS = "January February March April May June July August September October November December".split()
PROFILE = "sentence-exact-v1"
DATE = "struct<year:int,month:int,day:int>"


def spoken_date(language: Column, year: Column, month: Column, day: Column) -> Column:
    """A date as it is read out: its parts by name in German and Spanish, else the month's name, the day and the year."""
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    y, m, d = (c.cast("string") for c in (year, month, day))
    name = F.coalesce(F.get(F.array(*map(F.lit, MONTHS)), month - 1), text("month ", m))
    return F.when(language == "de", text("Tag ", d, ", Monat ", m, ", Jahr ", y)).when(language == "es", text("día ", d, ", mes ", m, ", año ", y)).otherwise(text(name, " ", d, ", ", y))


def interpretations(language: Column, units: Column) -> Column:
    """Readings of an ambiguous record: ``label, semantic, accepted_outputs`` of each candidate of its first unit."""
    semantic = F.get(units, F.lit(0))["semantic"]
    candidates = F.from_json(F.get_json_object(semantic, "$.candidates"), f"array<{DATE}>")
    read = F.transform(candidates, lambda c, i: F.struct(F.concat(F.lit("interpretation_"), i + 1).alias("label"), F.to_json(c).alias("semantic"), F.array(spoken_date(F.coalesce(language, F.lit("en")), c["year"], c["month"], c["day"])).alias("accepted_outputs")))
    return F.coalesce(read, F.array().cast("array<struct<label:string,semantic:string,accepted_outputs:array<string>>>"))


def derived_oracle(status: Column, text: Column, expected: Column, units: Column, language: Column | None = None) -> Column:
    """Explicit oracle of a record that has none: unchanged input, the sorted variants of its units, or its readings if ambiguous.

    Null for a record with no expected output that is neither unchanged nor ambiguous.
    """
    none = F.array().cast("array<string>")
    canonical = F.when(status == "no_change", text).when(status != "ambiguous", expected)
    listed = F.when(status == "no_change", F.array(text)).when(status == "ambiguous", none).otherwise(F.array_sort(variants(text, units, expected)))
    readings = interpretations(language if language is not None else F.lit("en"), units) if language is not None else F.array().cast("array<struct<label:string,semantic:string,accepted_outputs:array<string>>>")
    read = F.when(status == "ambiguous", readings)
    made = F.struct(canonical.alias("canonical_output"), listed.alias("accepted_outputs"), none.alias("rejected_outputs"), F.lit("explicit").alias("variant_mode"), F.lit(PROFILE).alias("comparison_profile"), read.alias("interpretations"))
    return F.when(status.isin("no_change", "ambiguous") | expected.isNotNull(), made)


PAYLOAD = ("expected_output", "units", "negative_for", "notes")


def overlay(records: DataFrame) -> DataFrame:
    """Records for sources whose text may not be passed on: the input is dropped, annotations move into one struct."""
    kept = [c for c in records.columns if c not in (*PAYLOAD, "input", "materialization", "annotation")]
    return records.select(*kept, F.lit("external_ref").alias("materialization"), F.lit(None).cast("string").alias("input"), F.struct(*[c for c in PAYLOAD if c in records.columns]).alias("annotation"))


def hydrated(overlays: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """Overlays with the text of their source joined back; those whose text is not there keep a null input."""
    kept = [c for c in overlays.columns if c not in ("input", "annotation")]
    return overlays.drop("input").join(texts.select(key, "input"), key, "left").select(*kept, "input", "annotation.*")


# --- evaluation profiles: small registries on the driver


def resolved_profile(profiles: dict[str, dict], name: str) -> dict:
    """A profile with what it extends, its own values last; unknown names and circles are errors."""
    chain: list[str] = []
    at: str | None = name
    while at is not None:
        if at in chain:
            raise ValueError(f"circle of profiles: {' > '.join([*chain, at])}")
        if at not in profiles:
            raise KeyError(at)
        chain.append(at)
        at = profiles[at].get("extends")
    out: dict = {"kwargs": {}}
    for p in reversed(chain):
        own = profiles[p]
        out |= {k: v for k, v in own.items() if k not in ("extends", "kwargs")} | {"kwargs": out["kwargs"] | own.get("kwargs", {})}
    return out


def object_hash(value: object) -> str:
    """Hash of the compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def registry_errors(profiles: dict[str, dict]) -> list[str]:
    out = []
    for name in sorted(profiles):
        try:
            resolved_profile(profiles, name)
        except (KeyError, ValueError) as e:
            out.append(f"{name}: {e}")
    return out


# --- user functions


def predicted(records: DataFrame, prepare: Callable, profile: dict | None = None) -> DataFrame:
    """``id, output`` from a user's ``prepare(text, language, locale[, profile])``, run on Arrow batches.

    A result of None is an empty output; whatever the function raises ends the query. Null inputs are passed on as null.
    """
    with_profile = len(inspect.signature(prepare).parameters) >= 4

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            extra = [profile or {}] if with_profile else []
            out = [None if pd.isna(t) else prepare(t, lang, loc, *extra) for t, lang, loc in zip(p["input"], p["language"], p["locale"], strict=True)]
            yield pd.DataFrame({"id": p["id"], "output": out})

    return records.select("id", "input", "language", "locale").mapInPandas(run, "id string, output string")


def predicted_controls(controls: DataFrame, prepare: Callable, profiles: dict[str, dict]) -> DataFrame:
    """``id, profiles`` of controls: a user's function per profile gives a text, or ``output`` and ``rules`` (or ``owners``)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for i, t, lang, loc in zip(p["id"], p["input"], p["language"], p["locale"], strict=True):
                of = {}
                for name, profile in profiles.items():
                    r = prepare(t, lang, loc, profile)
                    of[name] = {"output": r, "rules": []} if isinstance(r, str) else {"output": r["output"], "rules": list(r.get("rules", r.get("owners", [])))}
                rows.append((i, of))
            yield pd.DataFrame(rows, columns=["id", "profiles"])

    return controls.select("id", "input", "language", "locale").mapInPandas(run, "id string, profiles map<string,struct<output:string,rules:array<string>>>")


# --- scans, cuts, counts


def selected(records: DataFrame, split: str | None = None, language: str | None = None, locale: str | None = None, status: str | None = None, category: str | None = None, ids: list[str] | None = None) -> DataFrame:
    """Records by simple predicates, which reach the scan, and by a category of their units."""
    for column, value in (("split", split), ("language", language), ("locale", locale), ("status", status)):
        records = records.where(F.col(column) == value) if value is not None else records
    records = records.where(F.col("id").isin(ids)) if ids is not None else records
    return records.where(F.exists("units", lambda u: u["category"] == category)) if category is not None else records


def positional_cut(rows: DataFrame, order: list[str], share: float = 0.6) -> DataFrame:
    """``upstream_train`` for the first share of the rows in order, ``upstream_test`` for the others.

    Rows are counted range by range and numbered within each, so no task orders all of them. The ranges are a table of their
    own, as rows must not move between them when an executor is lost.
    """
    parts = stage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "cut-ranges")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    split = F.when(nth <= F.floor(F.col("_all") * share), "upstream_train").otherwise("upstream_test")
    return parts.join(F.broadcast(before), "_part").withColumn("source_split", split).drop("_part", "_before", "_all")


def control_violations(controls: DataFrame, profiles: DataFrame) -> DataFrame:
    """Controls without expectations, with a profile twice or unknown, or with a rule both required and forbidden."""
    each = controls.select("id", F.explode_outer("expectations").alias("e"))
    none = each.where("e is null").select("id", F.lit("no_expectations").alias("rule"))
    twice = each.where("e is not null").groupBy("id", "e.profile_id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("profile_repeated").alias("rule"))
    unknown = each.where("e is not null").select("id", F.col("e.profile_id").alias("profile_id")).join(profiles.select("profile_id").distinct(), "profile_id", "left_anti").select("id", F.lit("unknown_profile").alias("rule"))
    both = each.where(F.arrays_overlap("e.required_rules", "e.forbidden_rules")).select("id", F.lit("rule_required_and_forbidden").alias("rule"))
    return none.unionByName(twice).unionByName(unknown).unionByName(both).distinct()
