"""Spans of annotated texts: splicing, skeletons, variants, resolution and longest-match selection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.shapes import RECOGNIZERS, SPAN_PATTERNS
from weftline.functions.text import casefold, collapse


def _part(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def valid_units(text: Column, units: Column) -> Column:
    """Units whose span lies in the text, in order of start and end."""
    inside = F.filter(F.coalesce(units, F.array()), lambda u: u["start"].isNotNull() & u["end"].isNotNull() & (u["start"] >= 0) & (u["start"] <= u["end"]) & (u["end"] <= F.length(text)))
    return F.array_sort(inside, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"]))


def selects_surface(text: Column, unit: Column) -> Column:
    return _part(text, unit["start"], unit["end"]).eqNullSafe(unit["surface"])


def splice(text: Column, units: Column, replacement) -> Column:
    """The text with each span replaced; spans are taken in order, one that starts inside an earlier one is left out."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, u: Column) -> Column:
        taken = F.struct(F.concat(acc["out"], _part(text, acc["at"], u["start"]), replacement(u)).alias("out"), u["end"].cast("int").alias("at"))
        return F.when(u["start"] >= acc["at"], taken).otherwise(acc)

    return F.aggregate(valid_units(text, units), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def reconstruction(text: Column, units: Column) -> Column:
    """Canonical output that the units' canonical forms give; null if a unit has none or lies outside the text."""
    whole = F.size(valid_units(text, units)) == F.size(F.coalesce(units, F.array()))
    known = F.forall(F.coalesce(units, F.array()), lambda u: u["canonical"].isNotNull())
    return F.when(whole & known, splice(text, units, lambda u: u["canonical"]))


def skeleton(text: Column, units: Column) -> Column:
    """The text with each span as its category in angle brackets, whitespace collapsed, case folded."""
    return casefold(collapse(splice(F.coalesce(text, F.lit("")), units, lambda u: F.concat(F.lit("<"), F.coalesce(u["category"], F.lit("UNIT")), F.lit(">")))))


def options(unit: Column) -> Column:
    """Distinct outputs of a unit: the accepted ones, then the canonical one, one of each that compare as equal; its surface if it has none."""
    every = F.filter(F.concat(F.coalesce(unit["accepted"], F.array().cast("array<string>")), F.array(unit["canonical"])), lambda o: o.isNotNull() & (collapse(o) != ""))
    keep = lambda o, i: F.forall(F.slice(every, 1, i), lambda e: casefold(collapse(e)) != casefold(collapse(o)))
    return F.when(F.size(every) == 0, F.array(F.coalesce(unit["surface"], F.lit("")))).otherwise(F.filter(every, keep))


def variants(text: Column, units: Column, expected: Column | None = None) -> Column:
    """All outputs that one option of each unit gives, and ``expected``, which alone counts where there are no units.

    Grows as the product of the options, as the definition does. Units outside the text are left out.
    """
    begin = F.array(F.struct(F.lit("").alias("out"), F.lit(0).alias("at")))

    def step(acc: Column, u: Column) -> Column:
        return F.flatten(F.transform(acc, lambda p: F.transform(options(u), lambda o: F.struct(F.concat(p["out"], _part(text, p["at"], u["start"]), o).alias("out"), u["end"].cast("int").alias("at")))))

    spliced = F.aggregate(valid_units(text, units), begin, step, lambda acc: F.transform(acc, lambda p: F.concat(p["out"], F.substring(text, p["at"] + 1, F.length(text)))))
    if expected is None:
        return F.array_distinct(spliced)
    own = F.filter(F.array(expected), lambda e: e.isNotNull())
    return F.when(F.coalesce(F.size(units), F.lit(0)) < 1, own).otherwise(F.array_distinct(F.concat(spliced, own)))


def occurrences(text: Column, surface: Column) -> Column:
    """Number of occurrences, overlapping ones too."""
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.length(surface)) == surface)
    return F.when(F.length(surface) > 0, F.size(starts)).otherwise(0)


def unique_start(text: Column, surface: Column) -> Column:
    """Zero-based start of the only occurrence of the surface; null if there is none or more than one."""
    first = F.locate_col(surface, text) if hasattr(F, "locate_col") else F.call_function("locate", surface, text)
    second = F.call_function("locate", surface, text, first + 1)
    return F.when((F.length(surface) > 0) & (first > 0) & (second == 0), first - 1)


def token_start(text: Column, surface: Column) -> Column:
    """Start of the only occurrence that cuts no word in two: a letter or digit at its edge has none next to it outside."""
    alnum = lambda c: F.coalesce(c.rlike("^[\\p{L}\\p{N}]$"), F.lit(False))
    at = lambda i: F.substring(text, i, F.lit(1))
    n = F.length(surface)
    begins, ends = alnum(F.substring(surface, 1, 1)), alnum(F.substring(surface, -1, 1))
    fits = F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: (F.substring(text, i, n) == surface) & ~(begins & (i > 1) & alnum(at(i - 1))) & ~(ends & alnum(at(i + n))))
    return F.when((n > 0) & (F.size(fits) == 1), fits[0] - 1)


def _matches(text: Column, pattern: str) -> Column:
    """``start, end, surface`` of each match, in code points: the places follow from what lies between the matches."""
    regexp = F.lit(f"(?U){pattern}")
    surfaces, between = F.regexp_extract_all(text, regexp, F.lit(0)), F.split(text, f"(?U){pattern}", -1)
    start = lambda i: F.length(F.array_join(F.slice(between, F.lit(1), i + 1), "")) + F.length(F.array_join(F.slice(surfaces, F.lit(1), i), ""))
    return F.transform(surfaces, lambda s, i: F.struct(start(i).alias("start"), (start(i) + F.length(s)).alias("end"), s.alias("surface")))


def all_recognised(text: Column) -> Column:
    """Spans of all recognizers, overlapping ones too: ``start, end, surface, category, rule``."""
    of = lambda rule, category, pattern: F.transform(_matches(text, pattern), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["surface"].alias("surface"), F.lit(category).alias("category"), F.lit(rule).alias("rule")))
    return F.concat(*[of(k, c, p) for k, (c, p) in enumerate(RECOGNIZERS)])


def recognised(text: Column) -> Column:
    """Recognised spans that do not overlap: from left to right, of those that start together the longest, then the first rule's."""
    return longest_first(all_recognised(text))


def category_span(text: Column, category: Column) -> Column:
    """The only span ``start, end, surface`` that the patterns of a category find in the text; null if there is none or several."""
    out = None
    for name, patterns in SPAN_PATTERNS.items():
        found = F.array_distinct(F.concat(*[_matches(text, p) for p in patterns]))
        one = F.when(F.size(found) == 1, found[0])
        out = F.when(category == name, one) if out is None else out.when(category == name, one)
    return out


def longest_first(spans: Column) -> Column:
    """Spans ``(start, end, ...)`` that do not overlap: from left to right, of those that start together the longest."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise(a["rule"] - b["rule"]))
    empty = F.filter(spans, lambda s: F.lit(False))
    return F.aggregate(ordered, empty, lambda acc, s: F.when(F.exists(acc, lambda t: (s["end"] > t["start"]) & (s["start"] < t["end"])), acc).otherwise(F.concat(acc, F.array(s))))
