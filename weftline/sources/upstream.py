"""Upstream bundles as candidate records or exclusions: every row becomes exactly one of the two."""

from __future__ import annotations

import io
import pickle

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.hashing import joined_hash
from weftline.functions.shapes import surface_pattern, surface_shape
from weftline.functions.spans import token_start, unique_start

# Default locale of each supported language.
LOCALES = {"cs": "cs-CZ", "de": "de-DE", "en": "en-US", "es": "es-ES", "fr": "fr-FR", "it": "it-IT", "pt": "pt-PT"}
UNIT = "array<struct<text string, norm_category string, start int, `end` int>>"


def bundle_schema(rows: DataFrame, suite: str) -> Column | str:
    """Label of an async bundle's schema: version 2 if any row has the fields that came with it."""
    marks = ("categories", "row_index") if suite == "english" else ("language_code",)
    present = [c for c in marks if c in rows.columns]
    newer = bool(present) and not rows.where(" or ".join(f"{c} is not null" for c in present)).isEmpty()
    return f"async_tn_{suite}_v{2 if newer else 1}"


def async_english(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a single-language list: ``source_id, language, locale, input, upstream_expected, units``."""
    rows = spark.read.schema(f"row_id string, row_index string, language string, locale string, original_text string, normalized_text string, categories string, units {UNIT}").option("multiLine", True).json(path)
    return rows.select(F.coalesce("row_id", "row_index").alias("source_id"), F.coalesce("language", F.lit("en")).alias("language"), "locale", F.col("original_text").alias("input"), F.col("normalized_text").alias("upstream_expected"), "units", F.lit(bundle_schema(rows, "english")).alias("source_bundle_schema"))


def async_multilingual(spark: SparkSession, path: str) -> DataFrame:
    """One row per language of each row of a multilingual list."""
    inner = f"struct<language_code string, locale string, original_text string, normalized_text string, units {UNIT}>"
    rows = spark.read.schema(f"row_id string, sentence_id string, row_index string, languages map<string,{inner}>").option("multiLine", True).json(path)
    each = rows.select(F.coalesce("row_id", "sentence_id", "row_index", F.lit("unknown")).alias("base"), F.explode("languages").alias("key", "r")).select("base", "key", "r.*")
    return each.select(F.concat_ws(":", "base", "key").alias("source_id"), F.coalesce("language_code", "key").alias("language"), "locale", F.col("original_text").alias("input"), F.col("normalized_text").alias("upstream_expected"), "units", F.lit(bundle_schema(each, "multilingual")).alias("source_bundle_schema"))


def polynorm(spark: SparkSession, path: str, form: str = "projection") -> DataFrame:
    """Rows of a raw bundle, a projection or the official tree, whose locale is in the folder's or file's name."""
    flat = "source_id string, language string, locale string, source_split string, category string, input string, expected string, surface string, start int, `end` int, projection_notes string"
    if form == "raw":
        rows = spark.read.schema(f"locale string, records array<struct<{_colons(flat)}>>").option("multiLine", True).json(path).select(F.col("locale").alias("of_all"), F.inline("records"))
        rows = rows.withColumn("locale", F.coalesce("locale", "of_all", F.lit("en-US"))).drop("of_all")
    elif form == "projection":
        rows = spark.read.schema(flat).json(path).withColumn("locale", F.coalesce("locale", F.lit("en-US")))
    elif form == "official":
        rows = spark.read.schema("`index` string, category string, original_text string, normalized_text string").option("recursiveFileLookup", True).option("pathGlobFilter", "*_groundtruth.jsonl").json(path)
        file = F.col("_metadata.file_path")
        folder, stem = F.element_at(F.split(file, "/"), -2), F.element_at(F.split(file, "/"), -1)
        of = lambda c: F.nullif(F.regexp_extract(c, "([a-z]{2}-[A-Z]{2})", 1), F.lit(""))
        rows = rows.withColumn("locale", F.coalesce(of(folder), of(stem)))
        rows = rows.select(F.concat_ws(":", "locale", "index").alias("source_id"), F.substring("locale", 1, 2).alias("language"), "locale", F.lit(None).cast("string").alias("source_split"), "category", F.col("original_text").alias("input"), F.col("normalized_text").alias("expected"), *[F.lit(None).cast(t).alias(c) for c, t in (("surface", "string"), ("start", "int"), ("end", "int"), ("projection_notes", "string"))])
    else:
        raise ValueError("form must be raw, projection or official")
    return _single_unit(rows, form)


def proteno(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a cases bundle."""
    case = "case_id string, language string, locale string, source_split string, category string, input string, expected string, surface string, start int, `end` int, projection_notes string, identity_example boolean"
    rows = spark.read.schema(f"cases array<struct<{_colons(case)}>>").option("multiLine", True).json(path).select(F.inline("cases"))
    return _single_unit(rows.withColumnRenamed("case_id", "source_id"), "bundle")


def _colons(ddl: str) -> str:
    return ", ".join(":".join(part.strip().rsplit(" ", 1)) for part in ddl.split(","))


def _single_unit(rows: DataFrame, form: str) -> DataFrame:
    unit = F.struct(F.col("surface").alias("text"), F.col("category").alias("norm_category"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return rows.select("source_id", "language", "locale", "input", F.col("expected").alias("upstream_expected"), F.when(F.col("surface").isNotNull(), F.array(unit)).otherwise(F.array().cast(UNIT)).alias("units"), F.lit(form).alias("import_format"))


# --- official pickled pairs


class _Plain(pickle.Unpickler):
    """Reads built-in containers and texts only; any class or function in the bytes is refused."""

    def find_class(self, module: str, name: str):
        raise pickle.UnpicklingError(f"{module}.{name} is not allowed")


def plain_pickle(data: bytes):
    return _Plain(io.BytesIO(data)).load()


def pickled_pair(spark: SparkSession, inputs: bytes, outputs: bytes, language: str) -> DataFrame:
    """Two pickled lists of texts or token lists, paired by position; their lengths must agree."""
    text = lambda v: " ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    left, right = plain_pickle(inputs), plain_pickle(outputs)
    if len(left) != len(right):
        raise ValueError(f"{len(left)} inputs, {len(right)} outputs")
    rows = [(str(i), language, text(a), text(b), "upstream_train" if i < int(len(left) * 0.6) else "upstream_test") for i, (a, b) in enumerate(zip(left, right, strict=True))]
    return spark.createDataFrame(rows, "source_id string, language string, input string, upstream_expected string, source_split string")


ERROR_TAG = '<error\\s+what="([^"]+)">([^<]+)</error>'


def tagged_units(text: Column) -> Column:
    """Category and surface of inline tags."""
    names, surfaces = F.regexp_extract_all(text, F.lit(ERROR_TAG), F.lit(1)), F.regexp_extract_all(text, F.lit(ERROR_TAG), F.lit(2))
    return F.arrays_zip(names.alias("norm_category"), surfaces.alias("text"))


def untagged(text: Column) -> Column:
    return F.regexp_replace(text, ERROR_TAG, "$2")


# --- records or exclusions


#: Rules a mapping may have, as it becomes part of the plan.
MOST_RULES = 10_000


def mapped_category(mapping: DataFrame):
    """A function from a source category to its struct ``category, status``: an equal name first, else the first rule in
    order that differs in case only; null if there is none. ``mapping``: ``name, category, status, position``."""
    rules = mapping.where("name is not null").orderBy("position").limit(MOST_RULES + 1).collect()
    if len(rules) > MOST_RULES:
        raise ValueError(f"a mapping of more than {MOST_RULES} rules")
    exact, loose = {}, {}
    for r in rules:
        exact.setdefault(r.name, r)
        loose.setdefault(r.name.lower(), r)

    def table(entries: dict) -> Column:
        pairs = [x for k, r in entries.items() for x in (F.lit(k), F.struct(F.lit(r.category).alias("category"), F.lit(r.status).alias("status")))]
        return F.create_map(*pairs) if pairs else F.from_json(F.lit("{}"), "map<string,struct<category string, status string>>")

    tables = table(exact), table(loose)
    return lambda name: F.coalesce(tables[0][name], tables[1][F.lower(name)])


def imported(rows: DataFrame, benchmark: str, mapping: DataFrame, boundary: bool = False) -> tuple[DataFrame, DataFrame]:
    """Candidate records and exclusions of upstream rows; their counts add up to that of the rows.

    A row is excluded as a whole: for an unsupported language, a missing input, or its first unit whose category is not
    mapped or whose surface is not found exactly once. ``boundary`` asks that an occurrence cut no word in two. One
    projection without a shuffle makes both.
    """
    category = mapped_category(mapping)
    text = F.col("input")

    def unit(u: Column, nth: Column) -> Column:
        surface, rule = u["text"], category(u["norm_category"])
        given = u["start"].isNotNull() & u["end"].isNotNull()
        right = F.substring(text, u["start"] + 1, u["end"] - u["start"]) == surface
        start = F.when(given, F.when(right, u["start"])).otherwise((token_start if boundary else unique_start)(text, surface).cast("int"))
        failed = F.when(F.coalesce(surface, F.lit("")) == "", "malformed_unit").when(rule.isNull() | start.isNull(), "unmappable_or_unresolved_unit")
        return F.struct(
            nth.alias("nth"), surface.alias("surface"), start.alias("start"), (start + F.length(surface)).alias("end"), rule["category"].alias("category"), u["norm_category"].alias("source_category"), rule["status"].alias("mapping_status"),
            surface_pattern(rule["category"], surface, text).alias("surface_pattern"), F.when(given, "upstream").otherwise("resolved-exact").alias("span_origin"), failed.alias("failed"),
        )

    made = rows.withColumn("made", F.transform(F.coalesce("units", F.array().cast(UNIT)), unit))
    bad = F.get(F.filter("made", lambda u: u["failed"].isNotNull()), 0)
    reason = F.when(~F.coalesce(F.col("language").isin(list(LOCALES)), F.lit(False)), "unsupported_language").when(text.isNull(), "malformed_row").otherwise(bad["failed"])
    tagged = made.withColumn("bad", bad).withColumn("reason", reason)
    default = F.create_map(*[F.lit(x) for kv in LOCALES.items() for x in kv])
    extra = [c for c in ("source_bundle_schema", "import_format", "source_split") if c in rows.columns]
    records = tagged.where("reason is null").select(
        F.concat_ws("-", F.translate(F.lit(benchmark), "_", "-"), "language", F.translate("source_id", ":", "-")).alias("id"), "language", F.coalesce("locale", default[F.col("language")]).alias("locale"), F.lit("candidate").alias("split"), F.lit("quarantine").alias("status"),
        F.concat_ws("-", F.lit(benchmark), "source_id").alias("family_id"), "input", F.struct(F.lit(benchmark).alias("benchmark"), "source_id", "upstream_expected", joined_hash(F.col("language"), text, F.col("upstream_expected")).alias("source_hash"), *extra).alias("source"),
        F.transform("made", lambda u: u.dropFields("nth", "failed")).alias("units"),
    )
    lost = tagged.where("reason is not null").select(F.lit(benchmark).alias("source"), "source_id", "language", "reason", F.col("bad.source_category").alias("source_category"), F.col("bad.surface").alias("surface"), surface_shape(F.coalesce("bad.surface", "input")).alias("surface_shape"))
    return records, lost


def only_languages(records: DataFrame, languages: list[str]) -> tuple[DataFrame, DataFrame]:
    """Records of the languages; the others become exclusions, so that the accounting still holds."""
    wanted = F.coalesce(F.col("language").isin(languages), F.lit(False))
    lost = records.where(~wanted).select(F.col("source.benchmark").alias("source"), F.col("source.source_id").alias("source_id"), "language", F.lit("language_not_selected").alias("reason"), F.lit(None).cast("string").alias("source_category"), F.lit(None).cast("string").alias("surface"), F.lit("unknown").alias("surface_shape"))
    return records.where(wanted), lost
