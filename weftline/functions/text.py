"""Normal forms of text as column expressions: fingerprint, exact comparison and conflict value."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Whitespace as the text model knows it: Unicode spaces and the four information separators.
SPACES = "(?U)[\\s\\x1c-\\x1f]+"
_EDGES = "(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$"


def _unlike_lower() -> dict[str, str]:
    """Characters whose full case folding differs from lowering them one by one, and the sigmas, which depend on place."""
    out = {chr(c): chr(c).casefold() for c in range(0x80, 0x1E944) if not 0xD800 <= c < 0xE000 and chr(c).casefold() != chr(c).lower()}
    return out | {"Σ": "σ", "ς": "σ"}


_FOLDS = _unlike_lower()


def _ranges(codes: list[int], gap: int) -> str:
    """A character class of few ranges around the codes: neighbours at most ``gap`` apart share one, single Latin ones do not."""
    out: list[list[int]] = []
    for c in sorted(codes):
        if out and c >= 0x250 and out[-1][0] >= 0x250 and c - out[-1][1] <= gap:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out) + "]"


#: Finds more than the characters themselves, but in a few comparisons; what it finds goes through the table one by one.
_FOLD_CLASS = _ranges([ord(c) for c in _FOLDS], 0x300)


def casefold(text: Column) -> Column:
    """Full case folding. ``lower`` unless the text has one of the characters in which the two differ."""
    table = F.create_map(*[F.lit(x) for pair in _FOLDS.items() for x in pair])
    each = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.coalesce(table[c], F.lower(c)))
    return F.when(text.rlike(_FOLD_CLASS), F.array_join(each, "")).otherwise(F.lower(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def collapse(text: Column) -> Column:
    """Runs of whitespace as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def fingerprint(text: Column) -> Column:
    """Whitespace collapsed, case folded; no compatibility normalization. Null counts as empty."""
    return casefold(collapse(F.coalesce(text, F.lit(""))))


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _nfkc_each(texts: pd.Series) -> pd.Series:
    return texts.map(lambda ts: None if ts is None else [t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in ts])


def exact_keys(texts: Column) -> Column:
    """``exact_key`` of each text of an array."""
    return F.transform(_nfkc_each(texts), lambda t: casefold(collapse(F.coalesce(t, F.lit("")))))


def exact_key(text: Column) -> Column:
    """Comparison form of sentences: NFKC, whitespace collapsed, case folded. Null counts as empty."""
    return casefold(collapse(_nfkc(F.coalesce(text, F.lit("")))))


def conflict_value(text: Column) -> Column:
    """Stripped and case folded, inner whitespace as it is. Null stays null."""
    return casefold(strip(text))
