"""Validity of a unit's semantic object by category; each function takes the JSON text of the object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of values.
DECIMAL = r"^[+-]?(?:\d+(?:\.\d+)?|\.\d+)$"
VERSION = r"^v?(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-[0-9A-Za-z.-]+)?(?:\+[0-9A-Za-z.-]+)?$"
IPV4 = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(?!$)|$)){4}$"


def _get(json: Column, key: str) -> Column:
    return F.get_json_object(json, f"$.{key}")


def _int(json: Column, key: str) -> Column:
    """The value if it is an integer in the JSON; a number in a string is not."""
    value = F.try_variant_get(F.try_parse_json(json), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "BIGINT", value.try_cast("bigint"))


def _date(y: Column, m: Column, d: Column) -> Column:
    known = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    return F.coalesce(known & F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd").isNotNull(), F.lit(False))


def valid_date(json: Column) -> Column:
    """A date of the calendar, or a list of candidates that all are."""
    several = F.from_json(_get(json, "candidates"), "array<struct<year bigint, month bigint, day bigint>>")
    listed = (F.size(several) > 0) & F.forall(several, lambda c: _date(c["year"], c["month"], c["day"]))
    return F.when(_get(json, "candidates").isNotNull(), F.coalesce(listed, F.lit(False))).otherwise(_date(*(_int(json, k) for k in ("year", "month", "day"))))


def valid_time(json: Column) -> Column:
    second = F.when(_get(json, "second").isNull(), F.lit(0)).otherwise(_int(json, "second"))
    return F.coalesce(_int(json, "hour").between(0, 23) & _int(json, "minute").between(0, 59) & second.between(0, 59), F.lit(False))


def valid_decimal(json: Column) -> Column:
    return F.coalesce(_get(json, "value").rlike(DECIMAL), F.lit(False))


def valid_fraction(json: Column) -> Column:
    return F.coalesce(_int(json, "numerator").isNotNull() & (_int(json, "denominator") != 0), F.lit(False))


def valid_currency(json: Column) -> Column:
    return F.coalesce(_get(json, "currency").rlike("^[A-Z]{3}$") & _int(json, "major").isNotNull() & _int(json, "minor").between(0, 99), F.lit(False))


def valid_ip(json: Column) -> Column:
    return F.coalesce(_get(json, "address").rlike(IPV4), F.lit(False))


def valid_version(json: Column) -> Column:
    parts = _int(json, "major").isNotNull() & _int(json, "minor").isNotNull() & _int(json, "patch").isNotNull()
    return F.coalesce(parts, F.lit(False)) | F.coalesce(_get(json, "value").rlike(VERSION), F.lit(False))


def valid_identifier(json: Column) -> Column:
    return F.coalesce(F.trim(F.coalesce(_get(json, "value"), _get(json, "text"))) != "", F.lit(False))


VALIDATORS = {"date": valid_date, "time": valid_time, "decimal": valid_decimal, "fraction": valid_fraction, "currency": valid_currency, "ip_address": valid_ip, "version": valid_version, "identifier": valid_identifier}


def valid_semantic(category: Column, json: Column) -> Column:
    """Null for categories without a rule, and for units without a semantic object."""
    out = None
    for name, rule in VALIDATORS.items():
        out = F.when(category == name, rule(json)) if out is None else out.when(category == name, rule(json))
    return F.when(json.isNotNull() & (json != "{}"), out)
