"""Shapes of tokens and surfaces, as ordered tables of patterns: the first that matches names the shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.text import strip

# Outer punctuation of tokens.
TOKEN_EDGES = "()[]{}<>\"'“”‘’,;"

# Token shapes in order.
TOKEN_SHAPES = [
    ("url", r"(?i)https?://\S+"),
    ("email", r"[^@\s]+@[^@\s]+\.[^@\s]+"),
    ("ipv4", r"(?:\d{1,3}\.){3}\d{1,3}"),
    ("version_like", r"(?i)v?\d+(?:\.\d+){1,}(?:[-+][A-Za-z0-9.-]+)?"),
    ("time_like", r"(?i)\d{1,2}:\d{2}(?:\s?[AP]M)?"),
    ("date_like", r"\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}"),
    ("decimal_like", r"[+-]?(?:\d+\.\d*|\.\d+)"),
    ("slash_numeric", r"\d+/\d+"),
    ("percent", r"\d+(?:\.\d+)?%"),
    ("mixed_alnum", r"(?:[A-Za-z]+[-_/]?\d+[A-Za-z0-9._/-]*|\d+[A-Za-z][A-Za-z0-9._/-]*)"),
    ("uppercase_sequence", r"[A-Z]{2,}s?"),
    ("symbolic", r"(?s).*[\^_#@/\\:=+].*"),
]

# Shapes of excluded surfaces in order; the pattern is searched for.
SURFACE_SHAPES = [
    ("ipv4", r"^\d{1,3}(?:\.\d{1,3}){3}$"),
    ("date", r"^\d{1,4}[/-]\d{1,2}[/-]\d{1,4}$"),
    ("time", r"^\d{1,2}:\d{2}"),
    ("decimal", r"^-?\d[\d,]*\.\d+$"),
    ("fraction", r"^\d+/\d+$"),
    ("version", r"^v?\d+(?:\.\d+)+"),
    ("letters_digits", r"^[A-Za-z]+[A-Za-z0-9-]*\d[A-Za-z0-9-]*$"),
    ("digits", r"^\d+$"),
]

# Surface patterns by category, in order. "surface" and "context" say what is searched; None is the rest.
SURFACE_PATTERNS = {
    "decimal": [("leading_decimal", "surface", r"^-?\.\d+$"), ("grouped_decimal", "surface", ","), ("negative_decimal", "surface", "^-"), ("leading_zero", "surface", r"^0\d*\.\d+"), ("plain_decimal", "surface", None)],
    "date": [("iso_date", "surface", r"^\d{4}-\d{2}-\d{2}$"), ("month_name_date", "surface", "[A-Za-z]"), ("ambiguous_numeric_date", "surface", r"^(0?\d|1[0-2])/(0?\d|1[0-2])/\d{2,4}$"), ("slash_date", "surface", "/")],
    "time": [("midnight", "surface", r"^(00:00|00:00:00|12:00 AM|12:00:00 AM)$"), ("time_12h", "surface", "(?i)(?:AM|PM)$"), ("leading_zero_time", "surface", r"^0\d:"), ("time_24h", "surface", r"^\d{1,2}:\d{2}(?::\d{2})?$")],
    "identifier": [("letters_digits", "surface", r"^([A-Za-z]+\d+|\d+[A-Za-z]+)$"), ("mixed_identifier", "surface", "[-_:.]"), ("letters_digits", "surface", r"\d.*[A-Za-z]|[A-Za-z].*\d"), ("identifier_vs_word", "surface", "^[A-Za-z]+$"), ("mixed_identifier", "surface", None)],
    "score_or_range": [("countdown", "context", r"(?:\d+\s*-\s*){2}\d+"), ("numeric_range", "context", r"\b(range|from|between|through|to)\b"), ("score", "surface", None)],
    "math_expression": [("power", "surface", r"\^"), ("division", "surface", "/"), ("subscript", "surface", r"[A-Za-z]\d+|_"), ("subtraction", "surface", "-")],
    "version": [("prerelease_version", "surface", "-"), ("semantic_version", "surface", r"^[^.]*\.[^.]*\."), ("simple_version", "surface", None)],
    "ip_address": [("ipv4", "surface", r"^\d{1,3}(?:\.\d{1,3}){3}$")],
    "url_or_email": [("url", "surface", r"(?i)^https?://\S+$"), ("email", "surface", r"^[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}$")],
    "acronym": [("plural_acronym", "surface", "^[A-Z]{2,}s$"), ("initialism", "surface", "^[A-Z]{2,}$"), ("word_like_acronym", "surface", "^[A-Za-z]{2,}$")],
}
# Words of a sentence that speaks of a fraction.
FRACTION_WORDS = "fraction|numerator|denominator|quarter|half"

# Categories recognised in free text, in order, with their patterns.
RECOGNIZERS = [
    ("ip_address", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"),
    ("date", r"\b\d{4}-\d{2}-\d{2}\b"),
    ("date", r"\b\d{1,2}/\d{1,2}/\d{2,4}\b"),
    ("time", r"\b\d{1,2}:\d{2}(?:\s?[AP]M)?\b"),
    ("currency", r"(?:[$€£¥]\s?\d[\d,]*(?:\.\d+)?|\b\d[\d,]*(?:\.\d+)?\s?(?:USD|EUR|GBP|JPY)\b)"),
    ("fraction", r"\b\d+/\d+\b"),
    ("decimal", r"\b-?\d[\d,]*\.\d+\b"),
    ("phone", r"\b(?:\+\d{1,3}\s*)?(?:\d[\s-]?){6,}\d\b"),
    ("url_or_email", r"\bhttps?://\S+\b"),
    ("url_or_email", r"\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b"),
    ("version", r"\bv?\d+(?:\.\d+)+(?:-[A-Za-z0-9.]+)?\b"),
    ("math_expression", r"\b\d+\s*[-+/*^=]\s*\d+(?:\s*[-+/*^=]\s*\d+)*\b"),
    ("measurement_unit", r"\b\d+(?:\.\d+)?\s?(?:kg|g|mg|lb|km|m|cm|mm|L|mL|°C|°F|%)\b"),
    ("ordinal", r"\b\d+(?:st|nd|rd|th)\b"),
    ("identifier", r"\b[A-Za-z]+[A-Za-z0-9-]*\d+[A-Za-z0-9-]*\b"),
    ("cardinal", r"\b\d+\b"),
]

# Month names in running text, short and whole.
MONTH_NAMES = r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"

# Patterns that find the span of a category in a sentence.
SPAN_PATTERNS = {
    "abbreviation": [r"\b[A-Za-z]{1,6}\."],
    "acronym": [r"\b[A-Z]{2,}(?:s)?\b"],
    "address": [r"\b\d+\s+[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)*\b"],
    "biology": [r"\b[A-Z][a-z]+\s+[a-z]{2,}\b"],
    "cardinal": [r"\b\d+\b"],
    "chemical": [r"\b(?:[A-Z][a-z]?\d*)+\b"],
    "coordinates": [r"\b-?\d{1,3}\.\d+\s*,\s*-?\d{1,3}\.\d+\b", r"\b\d{1,3}°\s*\d{1,2}'?\s*\d{1,2}(?:\.\d+)?\"?\s*[NSEW]\b"],
    "currency": [r"(?:[$€£¥]\s?\d[\d,]*(?:\.\d+)?|\b\d[\d,]*(?:\.\d+)?\s?(?:USD|EUR|GBP|JPY)\b)"],
    "date": [r"\b\d{4}-\d{2}-\d{2}\b", r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", rf"\b{MONTH_NAMES}\s+\d{{1,2}},?\s+\d{{4}}\b"],
    "decimal": [r"\b-?\d[\d,]*\.\d+\b"],
    "fraction": [r"\b\d+/\d+\b"],
    "identifier": [r"\b[A-Za-z]+[A-Za-z0-9-]*\d+[A-Za-z0-9-]*\b"],
    "isbn": [r"\b97[89][-\d]{10,16}\b"],
    "legal_citation": [r"\b(?:§|Art\.?|Rule)\s*\d+[A-Za-z0-9.-]*\b"],
    "math_expression": [r"\b\d+\s*[-+/*^=]\s*\d+(?:\s*[-+/*^=]\s*\d+)*\b", r"\b[A-Za-z]\d+\b"],
    "measurement_unit": [r"\b\d+(?:\.\d+)?\s?(?:kg|g|mg|lb|km|m|cm|mm|L|mL|°C|°F|%)\b"],
    "music": [r"\b[A-G](?:#|b)?(?:maj|min|m|sus|dim|aug)?\b"],
    "ordinal": [r"\b\d+(?:st|nd|rd|th)\b"],
    "phone": [r"\b(?:\+\d{1,3}\s*)?(?:\d[\s-]?){7,}\d\b"],
    "product_code": [r"\b[A-Z0-9]+(?:-[A-Z0-9]+)+\b"],
    "roman_numeral": [r"\b[IVXLCDM]+\b"],
    "score_or_range": [r"\b\d+\s*-\s*\d+\b"],
    "serial_or_plate": [r"\b[A-Z0-9]{2,}(?:-[A-Z0-9]{2,})+\b"],
    "ticker": [r"\b[A-Z]{1,5}(?:\.[A-Z])?\b"],
    "time": [r"\b\d{1,2}:\d{2}(?:\s?[AP]M)?\b"],
    "url_or_email": [r"\bhttps?://\S+\b", r"\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b"],
    "version": [r"\bv?\d+(?:\.\d+)+(?:-[A-Za-z0-9.]+)?\b"],
}


def stripped_token(token: Column) -> Column:
    return F.trim(token, F.lit(TOKEN_EDGES))


def token_shape(token: Column) -> Column:
    """Shape of a token without its outer punctuation; null if it has none."""
    bare = stripped_token(token)
    out = None
    for name, pattern in TOKEN_SHAPES:
        test = bare.rlike(f"\\A(?:{pattern})\\z")
        out = F.when(test, name) if out is None else out.when(test, name)
    return F.when(bare != "", out)


def surface_shape(surface: Column) -> Column:
    """Shape of an excluded surface, ``unknown`` where it is null or blank."""
    text = strip(F.coalesce(surface, F.lit("")))
    out = F.when(text == "", "unknown")
    for name, pattern in SURFACE_SHAPES:
        out = out.when(text.rlike(pattern), name)
    return out.when((F.upper(text) == text) & (F.lower(text) != text), "uppercase").when(text.rlike("^\\p{L}+$"), "letters").otherwise("mixed")


def surface_pattern(category: Column, surface: Column, context: Column) -> Column:
    """Pattern of an annotated surface by its category; null where none is visible."""
    kind, value, around = F.lower(category), strip(surface), F.lower(F.coalesce(context, F.lit("")))
    out = F.when((kind == "fraction") & value.rlike("^\\d+/\\d+$"), F.when(around.rlike(FRACTION_WORDS), "numeric_fraction").otherwise("fraction_vs_slash"))
    for name, rules in SURFACE_PATTERNS.items():
        inner = None
        for pattern, where, regexp in rules:
            test = F.lit(True) if regexp is None else (value if where == "surface" else around).rlike(regexp)
            inner = F.when(test, pattern) if inner is None else inner.when(test, pattern)
        out = out.when(kind == name, inner)
    return F.when(surface.isNotNull(), out)
