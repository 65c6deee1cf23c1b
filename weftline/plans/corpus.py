"""Queries of the core operators over the record tables, each with the SQL that defines its result."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import hashing, semantics, shapes, spans
from weftline.operators import audit, census, constraints, counts, discovery, duplicates, lifecycle, ranking, scoring, snapshots, splitting
from weftline.plans.runtime import shared_dir, table
from weftline.sources import upstream
from weftline.streaming import events

POOL = ("async_tn", "polynorm", "proteno", "todo_regressions")
#: Whitespace of the text model as an RE2 class.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LANGUAGES = ["cs", "de", "en", "es", "fr", "it", "pt"]
#: Surface patterns that the coverage targets ask for.
REQUIRED_PATTERNS = {
    "decimal": ["plain_decimal", "leading_decimal", "leading_zero", "negative_decimal", "grouped_decimal"], "date": ["iso_date", "slash_date", "month_name_date", "ambiguous_numeric_date"], "time": ["time_12h", "time_24h", "midnight", "leading_zero_time"], "fraction": ["numeric_fraction", "fraction_vs_slash"], "identifier": ["letters_digits", "mixed_identifier", "identifier_vs_word"], "score_or_range": ["score", "numeric_range", "countdown"], "math_expression": ["subtraction", "division", "power", "subscript"], "version": ["simple_version", "semantic_version", "prerelease_version"], "ip_address": ["ipv4"], "url_or_email": ["url", "email"], "acronym": ["initialism", "word_like_acronym", "plural_acronym"],
}

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# columns of the record tables as the operators know them: name to (Spark expression, SQL)
_COLUMNS = {
    "benchmark": ("source.benchmark", "source.benchmark"),
    "source_id": ("source.source_id", "source.source_id"),
    "canonical": ("oracle.canonical_output", "oracle.canonical_output"),
    "accepted": ("oracle.accepted_outputs", "oracle.accepted_outputs"),
    "rejected": ("oracle.rejected_outputs.output", "list_transform(oracle.rejected_outputs, lambda r: r.output)"),
}


def _columns(spark: SparkSession, sf: str, name: str, columns: tuple[str, ...], whole: bool = True) -> DataFrame:
    df = table(spark, sf, name)
    out = []
    for c in columns:
        if c == "upstream_expected":
            out.append(F.lit(None).cast("string").alias(c) if name == "todo_regressions" else F.col("source.upstream_expected").alias(c))
        else:
            out.append(F.col(_COLUMNS.get(c, (c,))[0]).alias(c))
    rows = df.select(*out)
    return rows.distinct() if whole else rows  # a record delivered again differs in columns no operator reads


def pool(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [_columns(spark, sf, t, columns) for t in POOL])


def gold(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return _columns(spark, sf, "gold_sample", columns)


def _sql_columns(name: str, columns: tuple[str, ...]) -> str:
    out = []
    for c in columns:
        expression = ("NULL::VARCHAR" if name == "todo_regressions" else "source.upstream_expected") if c == "upstream_expected" else _COLUMNS.get(c, (c, c))[1]
        out.append(f"{expression} AS {c}")
    return f"SELECT DISTINCT {', '.join(out)} FROM {name}"


def sql_pool(*columns: str) -> str:
    return "(" + " UNION ALL ".join(_sql_columns(t, columns) for t in POOL) + ")"


def sql_gold(*columns: str) -> str:
    return f"({_sql_columns('gold_sample', columns)})"


def sql_fp(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g')))"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


# --- duplicates, overlap, conflicts

_DEDUPE = ("id", "benchmark", "input", "upstream_expected", "expected_output")
_FP = f"(SELECT id, coalesce(benchmark, '') AS benchmark, {sql_fp('input')} AS fp, {sql_fp("coalesce(nullif(upstream_expected, ''), expected_output, '')")} AS output FROM {sql_pool(*_DEDUPE)})"
_GROUPS = f"(SELECT fp, count(*) AS n, count(DISTINCT benchmark) AS n_sources, count(DISTINCT nullif(output, '')) AS n_outputs, min(id) AS min_id FROM {_FP} GROUP BY fp HAVING count(*) >= 2)"


def _raw(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The pool as it was delivered, for operators that make records distinct after they have narrowed them."""
    return reduce(DataFrame.unionByName, [_columns(spark, sf, t, columns, whole=False) for t in POOL])


@query(f"SELECT md5(fp) AS fp, n, n_sources, n_outputs, min_id FROM {_GROUPS}")
def dedupe_exact_groups(spark, sf):
    return duplicates.input_groups(_raw(spark, sf, *_DEDUPE))


@query(f"SELECT DISTINCT md5(fp) AS fp, id, benchmark FROM {_FP} WHERE fp IN (SELECT fp FROM {_GROUPS})")
def dedupe_members(spark, sf):
    return duplicates.input_members(_raw(spark, sf, *_DEDUPE))


@query(f"SELECT md5(fp) AS fp, md5(nullif(output, '')) AS output, count(*) AS n, min(id) AS min_id FROM {_FP} GROUP BY fp, output HAVING count(*) >= 2")
def dedupe_pair_groups(spark, sf):
    return duplicates.pair_groups(_raw(spark, sf, *_DEDUPE))


@query(f"SELECT md5(fp) AS fp, n, n_outputs FROM {_GROUPS} WHERE n_outputs > 1")
def dedupe_conflicting_outputs(spark, sf):
    return duplicates.conflicting_outputs(_raw(spark, sf, *_DEDUPE))


@query(f"SELECT DISTINCT md5(fp) AS fp, md5(output) AS output, id FROM {_FP} WHERE output <> '' AND fp IN (SELECT fp FROM {_GROUPS} WHERE n_outputs > 1)")
def dedupe_conflicting_members(spark, sf):
    return duplicates.conflicting_members(_raw(spark, sf, *_DEDUPE))


@query(f"WITH p AS (SELECT DISTINCT fp, benchmark FROM {_FP}) SELECT a.benchmark AS source_a, b.benchmark AS source_b, count(*) AS n_inputs FROM p a JOIN p b ON a.fp = b.fp AND a.benchmark < b.benchmark GROUP BY 1, 2")
def dedupe_source_overlap(spark, sf):
    return duplicates.source_overlap(_raw(spark, sf, *_DEDUPE))


@query(f"SELECT sum(n)::BIGINT AS records, count(*) AS unique_inputs, sum(p)::BIGINT AS unique_pairs, count(*) FILTER (n >= 2) AS duplicate_groups, count(*) FILTER (n >= 2 AND o > 1) AS conflict_groups FROM (SELECT fp, count(*) AS n, count(DISTINCT output) AS p, count(DISTINCT nullif(output, '')) AS o FROM {_FP} GROUP BY fp)")
def dedupe_summary(spark, sf):
    return duplicates.summary(_raw(spark, sf, *_DEDUPE))


_SAID = f"(SELECT id, coalesce(locale, '') AS locale, input, lower({sql_strip('expected_output')}) AS value FROM {sql_gold('id', 'locale', 'input', 'expected_output')})"
_FORMS = f"(SELECT id, locale, u.category AS category, u.surface AS surface, lower({sql_strip('u.canonical')}) AS value FROM (SELECT id, coalesce(locale, '') AS locale, unnest(units) AS u FROM {sql_gold('id', 'locale', 'units')}))"
#: Units of gold_sample and of the pool, where records of several sources may disagree.
_ALL_FORMS = f"(SELECT id, locale, u.category AS category, u.surface AS surface, lower({sql_strip('u.canonical')}) AS value FROM (SELECT id, coalesce(locale, '') AS locale, unnest(units) AS u FROM (SELECT id, locale, list_transform(units, lambda u: {{'category': u.category, 'surface': u.surface, 'canonical': u.canonical}}) AS units FROM {sql_gold('id', 'locale', 'units')} UNION ALL SELECT id, locale, list_transform(units, lambda u: {{'category': u.category, 'surface': u.surface, 'canonical': u.canonical}}) FROM {sql_pool('id', 'locale', 'units')})))"


@query(f"SELECT locale, input, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS first_value, max(value) AS last_value FROM {_SAID} GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT value) > 1")
def conflicts_record(spark, sf):
    return duplicates.record_conflicts(gold(spark, sf, "id", "locale", "input", "expected_output"))


@query(f"SELECT DISTINCT locale, input, value, id FROM {_SAID} JOIN (SELECT locale, input FROM {_SAID} GROUP BY 1, 2 HAVING count(DISTINCT value) > 1) USING (locale, input)")
def conflicts_record_items(spark, sf):
    return duplicates.record_conflict_items(gold(spark, sf, "id", "locale", "input", "expected_output"))


def _forms(spark, sf):
    """Units of all records, with the fields that conflicts are about."""
    narrow = lambda df: df.select("id", "locale", F.transform("units", lambda u: F.struct(u["category"].alias("category"), u["surface"].alias("surface"), u["canonical"].alias("canonical"))).alias("units"))
    return narrow(gold(spark, sf, "id", "locale", "units")).unionByName(narrow(pool(spark, sf, "id", "locale", "units")))


@query(f"SELECT locale, category, surface, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS first_value, max(value) AS last_value FROM {_ALL_FORMS} GROUP BY 1, 2, 3 HAVING count(*) >= 2 AND count(DISTINCT value) > 1")
def conflicts_unit(spark, sf):
    return duplicates.unit_conflicts(_forms(spark, sf))


@query(f"SELECT DISTINCT f.locale AS locale, f.category AS category, f.surface AS surface, value, id FROM {_ALL_FORMS} f JOIN (SELECT locale, category, surface FROM {_ALL_FORMS} GROUP BY 1, 2, 3 HAVING count(DISTINCT value) > 1) k ON f.locale = k.locale AND f.category IS NOT DISTINCT FROM k.category AND f.surface IS NOT DISTINCT FROM k.surface")
def conflicts_unit_items(spark, sf):
    return duplicates.unit_conflict_items(_forms(spark, sf))


_ASSERTED = ("id", "status", "locale", "input", "policy_version", "canonical", "accepted", "rejected")


@query()  # the comparison form needs NFKC, which the checking engine lacks; tested against a plain loop
def contradiction_pairs(spark, sf):
    return duplicates.contradictions(gold(spark, sf, *_ASSERTED))


@query()  # the same form; tested against a plain loop
def canonical_disagreements(spark, sf):
    return duplicates.canonical_disagreements(gold(spark, sf, *_ASSERTED))


# --- statistics and coverage

_STATS = ("id", "status", "language", "locale", "benchmark", "split", "family_id")


@query("UNION ALL".join(f" SELECT '{k}' AS section, coalesce({k}, 'null') AS key, count(*) AS records, count(DISTINCT nullif(family_id, '')) AS families FROM r GROUP BY {k} " for k in ("status", "language", "locale", "benchmark", "split")).join([f"WITH r AS {sql_gold(*_STATS)} ", f" UNION ALL SELECT 'all', '', count(*), count(DISTINCT nullif(family_id, '')) FROM r"]))
def corpus_stats(spark, sf):
    return counts.statistics(gold(spark, sf, *_STATS))


_COVER = ("id", "language", "status", "units", "negative_for")
_COVERAGE = f"""WITH r AS {sql_gold(*_COVER, "locale")}, u AS (SELECT * FROM (SELECT id, language, locale, status, u.category AS category, u.features->>'surface_pattern' AS pattern FROM (SELECT id, language, locale, status, unnest(units) AS u FROM r)) WHERE category <> ''),
    have AS (SELECT category, count(*) AS units, count(DISTINCT id) AS records, count(DISTINCT language) AS languages, count(*) FILTER (status = 'ambiguous') AS ambiguous FROM u GROUP BY category),
    neg AS (SELECT category, count(*) AS negatives FROM (SELECT unnest(negative_for) AS category FROM r) GROUP BY category),
    cover AS (SELECT category, units, records, languages, ambiguous, coalesce(negatives, 0) AS negatives FROM have LEFT JOIN neg USING (category))"""
_WANTED_PATTERNS = "(VALUES " + ", ".join(f"('{c}', '{p}')" for c, names in REQUIRED_PATTERNS.items() for p in names) + ") w(category, detail)"
_GAPS = f"""{_COVERAGE}, named AS (SELECT category, sum(min_records)::BIGINT AS m FROM category_targets GROUP BY category),
    row AS (SELECT category, coalesce(units, 0) AS units, coalesce(ambiguous, 0) AS ambiguous, coalesce(negatives, 0) AS negatives, coalesce(m, 20) AS min_units FROM cover FULL JOIN named USING (category)),
    seen AS (SELECT DISTINCT category, language AS detail FROM u), shown AS (SELECT DISTINCT category, pattern AS detail FROM u), gap AS (SELECT category, 'low_volume' AS gap, '' AS detail, units AS have, min_units AS need FROM row WHERE units < min_units
    UNION ALL SELECT category, 'ambiguous', '', ambiguous, 2 FROM row WHERE ambiguous < 2
    UNION ALL SELECT category, 'negative_controls', '', negatives, 2 FROM row WHERE negatives < 2
    UNION ALL SELECT category, 'surface_pattern', detail, 0, 1 FROM (SELECT w.category, w.detail FROM {_WANTED_PATTERNS} SEMI JOIN row USING (category)) ANTI JOIN shown USING (category, detail)
    UNION ALL SELECT category, 'language', detail, 0, 1 FROM (SELECT category, unnest([{', '.join(f"'{x}'" for x in LANGUAGES)}]) AS detail FROM row) w ANTI JOIN seen USING (category, detail))"""


@query(f"{_COVERAGE} SELECT * FROM cover")
def coverage(spark, sf):
    return counts.coverage(gold(spark, sf, *_COVER))


@query(f"{_COVERAGE} SELECT category, section, key, count(*) AS units FROM (" + " UNION ALL ".join(f"SELECT category, '{k}' AS section, {k} AS key FROM u" for k in ("language", "locale", "status", "pattern")) + ") WHERE key <> '' GROUP BY ALL")
def coverage_histograms(spark, sf):
    return counts.coverage_histograms(gold(spark, sf, *_COVER, "locale"))


@query(f"{_GAPS} SELECT * FROM gap")
def coverage_gaps(spark, sf):
    return counts.coverage_gaps(gold(spark, sf, *_COVER), _least(spark, sf), LANGUAGES, _required(spark))


def _required(spark):
    return spark.createDataFrame([(c, p) for c, names in REQUIRED_PATTERNS.items() for p in names], "category string, pattern string")


@query(f"SELECT section, key, count(*) AS records, count(DISTINCT coalesce('=' || family_id, 'null')) AS families FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS section, coalesce({c}, 'null') AS key, family_id FROM {sql_gold(*_STATS)}" for k, c in [*((k, k) for k in ("language", "locale", "status", "benchmark")), ("all", "''")]) + ") GROUP BY ALL")
def release_counts(spark, sf):
    return counts.release_counts(gold(spark, sf, *_STATS))


def _least(spark, sf):
    named = table(spark, sf, "category_targets").groupBy("category").agg(F.sum("min_records").alias("min_units")).withColumn("min_ambiguous", F.lit(2)).withColumn("min_negatives", F.lit(2))
    default = spark.range(1).select(F.lit(None).cast("string").alias("category"), F.lit(20).cast("bigint").alias("min_units"), F.lit(2).alias("min_ambiguous"), F.lit(2).alias("min_negatives"))
    return named.unionByName(default)


_EXCLUDED = ("id", "benchmark", "source_id", "language", "input", "units")


def _sql_case(table_of, value: str, whole: bool) -> str:
    quote = lambda p: p.replace("'", "''")
    return " ".join(f"WHEN regexp_matches({value}, '{'^(?s:' if whole else ''}{quote(p)}{')$' if whole else ''}') THEN '{n}'" for n, p in table_of)


_SHAPE = f"CASE WHEN s = '' THEN 'unknown' {_sql_case(shapes.SURFACE_SHAPES, 's', False)} WHEN upper(s) = s AND lower(s) <> s THEN 'uppercase' WHEN regexp_matches(s, '^\\p{{L}}+$') THEN 'letters' ELSE 'mixed' END"


@query(f"""WITH r AS (SELECT * FROM (SELECT DISTINCT id, source.benchmark AS benchmark, source.source_id AS source_id, language, input, list_transform(units, lambda u: {{'surface': u.surface, 'start': u.start, 'c': coalesce(u.source_category, u.category)}}) AS units FROM async_tn
        UNION ALL SELECT DISTINCT id, source.benchmark, source.source_id, language, input, list_transform(units, lambda u: {{'surface': u.surface, 'start': u.start, 'c': coalesce(u.source_category, u.category)}}) FROM polynorm
        UNION ALL SELECT DISTINCT id, source.benchmark, source.source_id, language, input, list_transform(units, lambda u: {{'surface': u.surface, 'start': u.start, 'c': coalesce(u.source_category, u.category)}}) FROM proteno
        UNION ALL SELECT DISTINCT id, source.benchmark, source.source_id, language, input, list_transform(units, lambda u: {{'surface': u.surface, 'start': u.start, 'c': coalesce(u.source_category, u.category)}}) FROM todo_regressions)),
    e AS (SELECT benchmark AS source, 'malformed_row' AS reason, 'unknown' AS source_category, language, '' AS s FROM r WHERE input IS NULL
        UNION ALL SELECT benchmark, 'unresolved_span', u.c, language, coalesce({sql_strip('u.surface')}, '') FROM (SELECT benchmark, language, unnest(units) AS u FROM r WHERE input IS NOT NULL) WHERE u.start IS NULL)
    SELECT source, reason, source_category, language, {_SHAPE} AS surface_shape, count(*) AS n FROM e GROUP BY ALL""")
def surface_shape_exclusions(spark, sf):
    return counts.exclusion_analysis(counts.excluded_units(pool(spark, sf, *_EXCLUDED)))


_LOST = f"""(SELECT benchmark AS source, 'malformed_row' AS reason FROM {sql_pool('id', 'benchmark', 'source_id', 'input')} WHERE input IS NULL UNION ALL SELECT benchmark, 'unresolved_span' FROM (SELECT benchmark, unnest(starts) AS start FROM (
    {' UNION ALL '.join(f"SELECT DISTINCT id, source.benchmark AS benchmark, input, units, list_transform(units, lambda u: u.start) AS starts FROM {t}".replace(", units,", ", units::VARCHAR AS units,") for t in POOL)}) WHERE input IS NOT NULL) WHERE start IS NULL)"""


@query(" UNION ALL ".join(f"SELECT '{k}' AS section, {c} AS key, count(*) AS n FROM {_LOST} GROUP BY 1, 2" for k, c in (("source", "coalesce(source, 'unknown')"), ("reason", "reason"), ("all", "''"))))
def exclusion_totals(spark, sf):
    return counts.exclusion_totals(counts.excluded_units(pool(spark, sf, *_EXCLUDED)))


_POOLED = ("id", "benchmark", "source_id", "input", "units")


@query(f"""SELECT benchmark, count(*) AS records, count(DISTINCT {sql_fp('input')}) AS unique_inputs, count(*) FILTER (len(units) > 1) AS multi_unit, round(coalesce(count(*) / any_value(source_rows), 0), 6) AS yield
    FROM {sql_pool(*_POOLED)} LEFT JOIN (SELECT benchmark, sum(n_rows) AS source_rows FROM upstream_files GROUP BY benchmark) USING (benchmark) GROUP BY benchmark""")
def pool_summary(spark, sf):
    observed = table(spark, sf, "upstream_files").groupBy("benchmark").agg(F.sum("n_rows").alias("source_rows"))
    return counts.pool_summary(pool(spark, sf, *_POOLED), observed)


_UNITS_OF_POOL = " UNION ALL ".join(f"SELECT DISTINCT id, source.benchmark AS benchmark, language, locale, input, list_transform(units, lambda u: {{'category': u.category, 'pattern': u.features->>'surface_pattern', 'mapping': u.mapping_status, 'start': u.start}}) AS units FROM {t}" for t in POOL)


def _sql_sections(table_of: str, prefix: str, sections) -> str:
    return " UNION ALL ".join(f"SELECT {prefix}'{k}' AS section, {c} AS key FROM {table_of}" for k, c in sections)


_PARTS = f"(SELECT benchmark, u.category AS category, u.pattern AS pattern, u.mapping AS mapping FROM (SELECT benchmark, unnest(units) AS u FROM r))"
_UNIT_SECTIONS = (("surface_pattern", "coalesce(pattern, 'unresolved')"), ("mapping_status", "coalesce(mapping, 'unmapped')"))


@query(f"""WITH r AS ({_UNITS_OF_POOL}) SELECT section, key, count(*) AS n FROM ({_sql_sections('r', '', (('source', "coalesce(benchmark, 'unknown')"), ('language', "coalesce(language, 'unknown')"), ('units', "CASE WHEN coalesce(len(units), 0) < 1 THEN 'metadata_only' WHEN len(units) > 1 THEN 'multi_unit' ELSE 'one_unit' END")))}
    UNION ALL {_sql_sections(_PARTS, '', (('category', "coalesce(category, 'unknown')"), *_UNIT_SECTIONS))}) GROUP BY ALL""")
def pool_histograms(spark, sf):
    return counts.pool_histograms(pool(spark, sf, "id", "benchmark", "language", "units"))


def _delivered(spark, sf):
    return table(spark, sf, "upstream_files").groupBy("benchmark").agg(F.sum("n_rows").alias("source_rows"))


@query(f"""WITH r AS ({_UNITS_OF_POOL}), made AS (SELECT benchmark, count(*) AS created, count(*) FILTER (coalesce(len(units), 0) > 0) AS with_units, count(*) FILTER (coalesce(len(units), 0) < 1) AS metadata_only, count(*) FILTER (len(units) > 1) AS multi_unit, sum(coalesce(len(units), 0))::BIGINT AS units FROM r WHERE input IS NOT NULL GROUP BY benchmark),
    lost AS (SELECT benchmark, count(*) AS excluded FROM r WHERE input IS NULL GROUP BY benchmark), seen AS (SELECT benchmark, sum(n_rows)::BIGINT AS source_rows FROM upstream_files GROUP BY benchmark)
    SELECT *, source_rows = created + excluded AS row_accounting_ok FROM (SELECT benchmark, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('source_rows', 'created', 'with_units', 'metadata_only', 'multi_unit', 'units', 'excluded'))}, 0 AS span_failures, 0 AS category_failures FROM seen FULL JOIN made USING (benchmark) FULL JOIN lost USING (benchmark))""")
def import_diagnostics(spark, sf):
    """Rows observed are those that the upstream files say they hold; files and records are deliveries of their own here, so the account seldom balances."""
    rows = pool(spark, sf, *_EXCLUDED)
    lost = rows.where("input is null").select(F.col("benchmark").alias("source"), F.lit("malformed_row").alias("reason"))
    return counts.import_diagnostics(rows.where("input is not null"), lost, _delivered(spark, sf))


@query(f"""WITH r AS ({_UNITS_OF_POOL}) SELECT benchmark, section, key, count(*) AS n FROM ({_sql_sections('(SELECT * FROM r WHERE input IS NOT NULL)', 'benchmark, ', (('language', "coalesce(language, '')"), ('locale', "coalesce(locale, '')"), ('source_split', "'unspecified'")))}
    UNION ALL {_sql_sections(_PARTS.replace('FROM r)', 'FROM r WHERE input IS NOT NULL)'), 'benchmark, ', (('category', "coalesce(category, '')"), *_UNIT_SECTIONS))}
    UNION ALL SELECT benchmark, 'exclusion_reason', 'malformed_row' FROM r WHERE input IS NULL) GROUP BY ALL""")
def import_histograms(spark, sf):
    rows = pool(spark, sf, *_EXCLUDED, "locale")
    lost = rows.where("input is null").select(F.col("benchmark").alias("source"), F.lit("malformed_row").alias("reason"))
    return counts.import_histograms(rows.where("input is not null"), lost)


# What a stable release needs of the corpus itself, beside the categories and patterns of the targets.
_STABLE = {"records": 60, "languages": 7, "negative_controls": 12, "families": 60}


@query(f"""{_GAPS}, g AS (SELECT id, language, status, family_id FROM {sql_gold('id', 'language', 'status', 'family_id')}), wanted AS (SELECT DISTINCT category FROM category_targets)
    SELECT gate, have, need FROM (SELECT 'records' AS gate, count(*) AS have, 60 AS need FROM g UNION ALL SELECT 'languages', count(DISTINCT nullif(language, '')), 7 FROM g
    UNION ALL SELECT 'negative_controls', count(*) FILTER (status = 'no_change'), 12 FROM g UNION ALL SELECT 'families', count(DISTINCT family_id), 60 FROM g
    UNION ALL SELECT 'required_categories', (SELECT count(*) FROM wanted SEMI JOIN u USING (category)), (SELECT count(*) FROM wanted)
    UNION ALL SELECT 'required_patterns', (SELECT count(*) FROM (SELECT category, detail FROM {_WANTED_PATTERNS}) SEMI JOIN shown USING (category, detail)), (SELECT count(*) FROM {_WANTED_PATTERNS})) WHERE have < need
    UNION ALL SELECT 'coverage_gaps', count(*), 0 FROM gap HAVING count(*) > 0""")
def maturity_gate(spark, sf):
    categories = [r.category for r in table(spark, sf, "category_targets").select("category").distinct().orderBy("category").collect()]
    return counts.maturity_gaps(gold(spark, sf, *_COVER, "family_id"), _STABLE, categories, _required(spark), coverage_gaps(spark, sf))


# --- shapes and discovery

NOT_WS = "[^" + WS[1:]
#: Where the token after ``place.n`` others starts: the length of all up to its end less its own.
_START = f"length(array_to_string(list_slice(regexp_extract_all(text, '{WS}*{NOT_WS}+'), 1, place.n + 1), '')) - length(token)"
_TOKENS = f"""(SELECT doc_id, nth - 1 AS nth, token, CASE WHEN t = '' THEN NULL {_sql_case(shapes.TOKEN_SHAPES, 't', True)} END AS shape FROM
    (SELECT *, trim(token, '{shapes.TOKEN_EDGES.replace("'", "''")}') AS t FROM (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS nth FROM
    (SELECT doc_id, regexp_extract_all(text, '{NOT_WS}+') AS tokens FROM documents))))"""


@query(f"SELECT shape, count(*) AS tokens, count(DISTINCT doc_id) AS texts FROM {_TOKENS} WHERE shape IS NOT NULL GROUP BY shape")
def shape_tokens(spark, sf):
    return discovery.shape_counts(table(spark, sf, "documents"), "doc_id")


@query(f"""WITH t AS (SELECT * FROM {_TOKENS} WHERE shape IS NOT NULL), s AS (SELECT trim(unnest(units).surface, '{shapes.TOKEN_EDGES.replace("'", "''")}') AS t FROM {sql_gold('id', 'units')}),
    c AS (SELECT shape, count(*) AS annotated FROM (SELECT CASE WHEN t = '' THEN NULL {_sql_case(shapes.TOKEN_SHAPES, 't', True)} END AS shape FROM s) WHERE shape IS NOT NULL GROUP BY shape),
    f AS (SELECT shape, token, count(*) AS n, min({{'k': doc_id, 'n': nth}}) AS place FROM t GROUP BY 1, 2)
    SELECT shape, token, n, coalesce(annotated, 0) AS annotated, place.k AS first_key, place.n AS first_nth, {_START} AS start, {_START} + length(token) AS "end", CASE WHEN coalesce(annotated, 0) = 0 THEN 'unseen_shape' ELSE 'rare_shape' END AS reason FROM f LEFT JOIN c USING (shape) JOIN documents ON documents.doc_id = place.k WHERE coalesce(annotated, 0) < 3""")
def discover_rare(spark, sf):
    return discovery.rare_tokens(table(spark, sf, "documents"), gold(spark, sf, "id", "units"), "doc_id")


def _sql_patterns() -> str:
    out = [f"WHEN kind = 'fraction' THEN CASE WHEN regexp_matches(v, '^\\d+/\\d+$') THEN CASE WHEN regexp_matches(c, '{shapes.FRACTION_WORDS}') THEN 'numeric_fraction' ELSE 'fraction_vs_slash' END END"]
    for name, rules in shapes.SURFACE_PATTERNS.items():
        inner = " ".join(f"WHEN {'TRUE' if p is None else f'''regexp_matches({'v' if where == 'surface' else 'c'}, '{p}')'''} THEN '{pattern}'" for pattern, where, p in rules)
        out.append(f"WHEN kind = '{name}' THEN CASE {inner} END")
    return f"CASE {' '.join(out)} END"


@query(f"""SELECT category, coalesce(CASE WHEN v IS NOT NULL THEN {_sql_patterns()} END, 'none') AS pattern, count(*) AS n FROM
    (SELECT u.category AS category, lower(u.category) AS kind, {sql_strip('u.surface')} AS v, lower(coalesce(input, '')) AS c FROM (SELECT input, unnest(units) AS u FROM {sql_gold('id', 'input', 'units')})) GROUP BY 1, 2""")
def surface_patterns(spark, sf):
    units = counts.units_of(gold(spark, sf, "id", "input", "units"), "input")
    pattern = shapes.surface_pattern(F.col("category"), F.col("surface"), F.col("input"))
    return units.groupBy("category", F.coalesce(pattern, F.lit("none")).alias("pattern")).agg(F.count("*").alias("n"))


@query()  # overlapping regular expressions with look-around of word boundaries: tested on a fixture
def recognised_spans(spark, sf):
    """Recognised spans of all candidates' inputs, without overlaps."""
    rows = pool(spark, sf, "id", "input").where("input is not null").select("id", F.explode(spans.recognised(F.col("input"))).alias("s"))
    return rows.groupBy("s.category").agg(F.count("*").alias("spans"), F.countDistinct("id").alias("records"))


# --- spans

@query(f"""SELECT category, count(*) AS units, count(*) FILTER (start IS NULL) AS unresolved, count(*) FILTER (start IS NOT NULL AND substring(input, start + 1, "end" - start) <> surface) AS wrong,
    count(*) FILTER (start IS NULL AND n = 1) AS findable FROM (SELECT input, u.category AS category, u.surface AS surface, u.start AS start, u."end" AS "end", CASE WHEN len(u.surface) > 0 AND contains(input, u.surface) THEN CASE WHEN contains(substring(input, instr(input, u.surface) + 1), u.surface) THEN 2 ELSE 1 END ELSE 0 END AS n
    FROM (SELECT input, unnest(units) AS u FROM {sql_pool('id', 'input').replace('input AS input', 'input AS input, list_transform(units, lambda u: {' + "'category': u.category, 'surface': u.surface, 'start': u.start, 'end': u." + '"end"' + "}) AS units")}) WHERE input IS NOT NULL) GROUP BY category""")
def span_resolution(spark, sf):
    units = counts.units_of(pool(spark, sf, "id", "input", "units").where("input is not null"), "input")
    start = F.col("unit.start")
    wrong = start.isNotNull() & ~spans.selects_surface(F.col("input"), F.col("unit"))
    findable = start.isNull() & spans.unique_start(F.col("input"), F.col("surface")).isNotNull()
    return units.groupBy("category").agg(F.count("*").alias("units"), F.count_if(start.isNull()).alias("unresolved"), F.count_if(wrong).alias("wrong"), F.count_if(findable).alias("findable"))


@query()  # splices spans in order; tested against a plain loop
def unit_reconstruction(spark, sf):
    rows = gold(spark, sf, "id", "input", "units", "canonical", "status").where("input is not null")
    made = spans.reconstruction(F.col("input"), F.col("units"))
    return rows.groupBy("status").agg(F.count("*").alias("records"), F.count_if(made.isNotNull()).alias("reconstructed"), F.count_if(made == F.col("canonical")).alias("equal"))


@query()  # product of options along spans; tested against itertools
def variants_cartesian(spark, sf):
    rows = gold(spark, sf, "id", "input", "units", "expected_output").where("input is not null")
    made = spans.variants(F.col("input"), F.col("units"), F.col("expected_output"))
    return rows.select("id", F.size(made).alias("variants"), F.md5(F.array_join(F.array_sort(made), chr(31))).alias("outputs"))


# --- lineage, clusters, families

_LEDGER = ("id", "benchmark", "source_id", "language", "input")
_MADE, _GONE = (f"(SELECT * FROM {sql_pool(*_LEDGER)} WHERE input IS {x}NULL)" for x in ("NOT ", ""))


def _accounted(spark, sf, *columns):
    """Rows that became records, and those that were left out as they have no input."""
    rows = pool(spark, sf, *_LEDGER, *columns)
    return rows.where("input is not null"), rows.where("input is null").select(F.col("benchmark").alias("source"), "source_id", "language", F.lit("malformed_row").alias("reason"))


@query(f"SELECT benchmark, state, count(*) AS n FROM (SELECT benchmark, 'candidate' AS state FROM {_MADE} UNION ALL SELECT benchmark, 'explicit_exclusion' FROM {_GONE}) GROUP BY 1, 2")
def census_accounting(spark, sf):
    return census.ledger_summary(*_accounted(spark, sf))


@query(f"""SELECT *, rows_observed = rows_parsed + rows_excluded AS row_accounting_ok FROM (SELECT (SELECT sum(n_rows)::BIGINT FROM upstream_files) AS rows_observed, (SELECT count(*) FROM {_MADE}) AS rows_parsed, (SELECT count(*) FROM {_MADE}) AS rows_candidate, 0 AS rows_metadata_only, (SELECT count(*) FROM {_GONE}) AS rows_excluded, 0 AS rows_failed, 0 AS rows_reviewed, 0 AS rows_adjudicated, 0 AS rows_gold_eligible,
    (SELECT count(*) FROM (SELECT DISTINCT coalesce(language, ''), coalesce(locale, ''), {sql_fp('input')} FROM {sql_pool('id', 'language', 'locale', 'input')} WHERE input IS NOT NULL)) AS sentence_clusters)""")
def census_summary(spark, sf):
    return census.summary(*_accounted(spark, sf, "locale"), _delivered(spark, sf))


@query(f"SELECT 'sha256:' || sha256(concat_ws('|', coalesce(benchmark, ''), coalesce(source_id, ''), '', sha256({sql_fp('input')}))) AS census_id, benchmark, source_id, 'candidate' AS state FROM {_MADE} UNION ALL SELECT 'sha256:' || sha256(concat_ws('|', coalesce(benchmark, ''), coalesce(source_id, ''), 'malformed_row')), benchmark, source_id, 'explicit_exclusion' FROM {_GONE}")
def census_rows(spark, sf):
    return census.ledger(*_accounted(spark, sf)).select("census_id", "benchmark", "source_id", "state")


_CLUSTER = ("id", "language", "locale", "input", "benchmark", "source_id", "upstream_expected")
_CLUSTERED = f"(SELECT *, sha256(concat_ws('|', language, locale, sentence)) AS cluster_id FROM (SELECT id, coalesce(language, '') AS language, coalesce(locale, '') AS locale, {sql_fp('input')} AS sentence, input, benchmark, source_id, CASE WHEN benchmark IS NOT NULL OR source_id IS NOT NULL THEN {{'b': benchmark, 's': source_id}} END AS ref, upstream_expected FROM {sql_pool(*_CLUSTER)}))"


@query(f"SELECT cluster_id, language, locale, count(DISTINCT id) AS records, count(DISTINCT ref) AS refs, count(DISTINCT upstream_expected) AS outputs, min(id) AS min_id, max(id) AS max_id FROM {_CLUSTERED} GROUP BY cluster_id, language, locale")
def census_clusters(spark, sf):
    return census.clusters(_raw(spark, sf, *_CLUSTER))


@query(f"SELECT DISTINCT cluster_id, id, benchmark, source_id, upstream_expected FROM {_CLUSTERED}")
def census_members(spark, sf):
    return census.cluster_members(_raw(spark, sf, *_CLUSTER))


@query(f"SELECT cluster_id, language, locale, min(id) AS id, min_by(input, id) AS input, count(DISTINCT ref) AS refs FROM {_CLUSTERED} GROUP BY cluster_id, language, locale")
def blind_batch(spark, sf):
    return census.blind_batch(_raw(spark, sf, *_CLUSTER))


@query(f"SELECT DISTINCT cluster_id, benchmark, source_id FROM {_CLUSTERED}")
def blind_refs(spark, sf):
    return census.blind_refs(_raw(spark, sf, *_CLUSTER))


@query()  # skeletons splice spans; tested against a plain loop
def family_suggestions(spark, sf):
    groups = census.families(pool(spark, sf, "id", "language", "locale", "benchmark", "source_id", "input", "units"))
    return census.numbered(groups).select("number", F.md5("family_key").alias("family_key"), "n", "min_id")


@query()  # as above
def family_members(spark, sf):
    members = census.family_members(pool(spark, sf, "id", "language", "locale", "benchmark", "source_id", "input", "units"))
    return members.select(F.md5("family_key").alias("family_key"), "id")


# --- splits

_SPLIT = ("id", "family_id", "split")
_SHARE = f"('0x' || left(sha256('{splitting.SEED}:' || family_id), 16))::UBIGINT::DOUBLE / 18446744073709551616.0"
_ASSIGNED = f"""SELECT family_id, coalesce(CASE WHEN lo = hi THEN lo END, CASE WHEN s < 0.7 THEN 'train' WHEN s < 0.85 THEN 'dev' ELSE 'test' END) AS split, CASE WHEN lo = hi THEN 'records' ELSE 'hash' END AS origin
    FROM (SELECT family_id, {_SHARE} AS s, min(own) AS lo, max(own) AS hi FROM (SELECT family_id, CASE WHEN split IN ('train', 'dev', 'test') THEN split END AS own FROM {sql_gold(*_SPLIT)} WHERE family_id IS NOT NULL) GROUP BY family_id)"""


@query(_ASSIGNED)
def split_assignment(spark, sf):
    return splitting.assignments(gold(spark, sf, *_SPLIT))


@query(f"SELECT split, origin, count(*) AS families FROM ({_ASSIGNED}) GROUP BY 1, 2")
def split_counts(spark, sf):
    return splitting.assignments(gold(spark, sf, *_SPLIT)).groupBy("split", "origin").agg(F.count("*").alias("families"))


@query(f"SELECT family_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS records FROM {sql_gold(*_SPLIT)} WHERE family_id IS NOT NULL AND split IS NOT NULL AND split NOT IN ('candidate', 'judge_gold') GROUP BY family_id HAVING count(DISTINCT split) > 1")
def family_leakage(spark, sf):
    return splitting.leakage(gold(spark, sf, *_SPLIT))


@query(f"SELECT family_id, 'several_splits' AS rule, string_agg(DISTINCT split, ',' ORDER BY split) AS detail FROM {sql_gold(*_SPLIT)} WHERE family_id IS NOT NULL AND split IN ('train', 'dev', 'test') GROUP BY family_id HAVING count(DISTINCT split) > 1")
def split_violations(spark, sf):
    return splitting.violations(gold(spark, sf, *_SPLIT))


# --- scores

_SCORED = ("id", "language", "locale", "status", "split", "input", "canonical", "accepted", "units", "expected_output", "upstream_expected", "oracle")


def _evaluated(spark, sf):
    rows = gold(spark, sf, *_SCORED)
    predictions = rows.where("upstream_expected is not null").select("id", F.col("upstream_expected").alias("output"))
    records = rows.select(*_SCORED[:10], F.col("oracle").isNotNull().alias("has_oracle"), F.size("units").alias("n_units"), F.col("units.category").alias("categories"))
    return scoring.evaluated(records, predictions)


@query()  # exact comparison needs NFKC; tested against a plain loop
def score_breakdown(spark, sf):
    return scoring.score(_evaluated(spark, sf))


@query()
def score_categories(spark, sf):
    return scoring.score_categories(_evaluated(spark, sf))


_JUDGED = ("id", "language", "status", "units", "expected_output", "upstream_expected")
_JUDGE = f"""(SELECT language, coalesce(units[1].category, 'none') AS category, coalesce(units[1].features->>'ambiguity_family', 'none') AS ambiguity_family, CASE WHEN status = 'gold' THEN 1 ELSE 0 END AS h, CASE WHEN upstream_expected = expected_output THEN 1 ELSE 0 END AS j FROM {sql_gold(*_JUDGED)} WHERE upstream_expected IS NOT NULL AND expected_output IS NOT NULL)"""


def _sql_confusion(section: str, key: str, group: str) -> str:
    ta, fa, tr, fr = "sum(h * j)", "sum((1 - h) * j)", "sum((1 - h) * (1 - j))", "sum(h * (1 - j))"
    rate = lambda a, b: f"round(coalesce(({a}) / nullif({b}, 0), 0), 6)"
    return f"""SELECT '{section}' AS section, {key} AS key, {ta}::BIGINT AS true_accept, {fa}::BIGINT AS false_accept, {tr}::BIGINT AS true_reject, {fr}::BIGINT AS false_reject, {rate(f'{ta} + {tr}', 'count(*)')} AS accuracy,
    {rate(ta, f'{ta} + {fa}')} AS "precision", {rate(ta, f'{ta} + {fr}')} AS recall, {rate(fa, f'{tr} + {fa}')} AS false_accept_rate, {rate(fr, f'{ta} + {fr}')} AS false_reject_rate FROM {_JUDGE} {group}"""


@query(" UNION ALL ".join([_sql_confusion("language", "coalesce(language, 'null')", "GROUP BY language"), _sql_confusion("category", "category", "GROUP BY category"), _sql_confusion("ambiguity_family", "ambiguity_family", "GROUP BY ambiguity_family"), _sql_confusion("all", "''", "")]))
def judge_calibration(spark, sf):
    rows = gold(spark, sf, *_JUDGED).where("upstream_expected is not null and expected_output is not null")
    category = F.coalesce(F.get(F.col("units.category"), 0), F.lit("none"))
    family = F.get_json_object(F.get("units", F.lit(0))["features"], "$.ambiguity_family")
    records = rows.select("id", "language", category.alias("category"), family.alias("ambiguity_family"), F.when(F.col("status") == "gold", "accept").otherwise("reject").alias("human_label"))
    predictions = rows.select("id", F.when(F.col("upstream_expected") == F.col("expected_output"), "accept").otherwise("reject").alias("label"))
    return scoring.calibration(records, predictions)


_CONTROLS = ("id", "language", "units", "canonical", "upstream_expected")
_RESULTS = f"""(SELECT language, control, upstream_expected IS NOT NULL AND canonical IS NOT NULL AND upstream_expected = canonical AS m, upstream_expected IS NOT NULL OR len(accepted) = 0 AS r,
    upstream_expected IS NOT NULL AND len(list_intersect(accepted, rejected)) > 0 AS f FROM (SELECT language, canonical, upstream_expected, u.category AS control, coalesce(u.accepted, []) AS accepted, coalesce(u.rejected, []) AS rejected FROM (SELECT *, units[1] AS u FROM {sql_gold(*_CONTROLS)} WHERE len(units) > 0)))"""


def _sql_controls(section: str, key: str, group: str) -> str:
    share = lambda c: f"round(count(*) FILTER ({c}) / count(*), 6)"
    return f"SELECT '{section}' AS section, {key} AS key, count(*) AS expectations, {share('m')} AS output_accuracy, {share('r')} AS required_accuracy, count(*) FILTER (f) AS forbidden_violations, {share('m AND r AND NOT f')} AS full_accuracy FROM {_RESULTS} {group}"


def _controls(spark, sf):
    rows = gold(spark, sf, *_CONTROLS).where("size(units) > 0").withColumn("u", F.get("units", 0))
    expectation = F.struct(F.lit("default").alias("profile_id"), F.col("canonical").alias("expected_output"), F.col("u.accepted").alias("required_rules"), F.col("u.rejected").alias("forbidden_rules"))
    controls = rows.select("id", F.col("u.category").alias("control"), "language", F.array(expectation).alias("expectations"))
    predictions = rows.where("upstream_expected is not null").select("id", F.create_map(F.lit("default"), F.struct(F.col("upstream_expected").alias("output"), F.col("u.accepted").alias("rules"))).alias("profiles"))
    return controls, predictions


@query(" UNION ALL ".join([_sql_controls("control", "control", "GROUP BY control"), _sql_controls("language", "coalesce(language, 'null')", "GROUP BY language"), _sql_controls("all", "''", "")]))
def control_scoring(spark, sf):
    return scoring.score_controls(scoring.control_results(*_controls(spark, sf)))


@query(f"""SELECT control, count(*) AS records, count(*) AS expectations, count(*) FILTER (len(u.accepted) > 0 OR len(u.rejected) > 0) AS rule_expectations, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, 'default' AS profiles FROM
    (SELECT language, units[1] AS u, units[1].category AS control FROM {sql_gold(*_CONTROLS)} WHERE len(units) > 0) WHERE control <> '' GROUP BY control""")
def control_counts(spark, sf):
    return scoring.control_counts(_controls(spark, sf)[0])


@query(f"""WITH c AS (SELECT control, count(DISTINCT id) AS records, list(DISTINCT language) AS seen FROM (SELECT id, language, units[1].category AS control FROM {sql_gold(*_CONTROLS)} WHERE len(units) > 0) GROUP BY control)
    SELECT * FROM (SELECT control, records, array_to_string(list_filter([{', '.join(f"'{x}'" for x in LANGUAGES)}], lambda x: NOT list_contains(seen, x)), ',') AS missing_languages FROM c) WHERE records < 20 OR missing_languages <> ''""")
def control_coverage(spark, sf):
    return scoring.control_coverage(_controls(spark, sf)[0], 20, LANGUAGES)


# --- ranking

_RANKED = ("id", "language", "family_id", "benchmark", "status", "input", "units", "upstream_expected", "expected_output", "locale")


def _ranked(spark, sf):
    return ranking.prioritised(ranking.candidate_flags(pool(spark, sf, *_RANKED), gold(spark, sf, "id", "language", "units"), _least(spark, sf), _required(spark)), ranking.REASONS)


_FLAGS = {
    "category_missing": "cm", "category_below_minimum": "cb", "required_pattern_missing": "rp", "new_language_for_category": "nl", "source_disagreement": "coalesce(disputed, FALSE) OR coalesce(conflicting, FALSE)", "multi_unit": "n_units > 1", "ambiguity_family": "af", "rare_surface_pattern": "rs",
    "cross_source_duplicate": "crossed", "metadata_only": "coalesce(n_units, 0) < 1", "broad_or_ambiguous_mapping": "bm", "duplicate_exact_input_output": "coalesce(paired, FALSE) OR (coalesce(repeated, FALSE) AND NOT coalesce(crossed, FALSE))",
}
_RANK_SQL = f"""WITH r AS (SELECT * FROM ({' UNION ALL '.join(f"SELECT DISTINCT id, language, locale, family_id, list_transform(units, lambda u: {{'category': u.category, 'surface': u.surface, 'canonical': u.canonical, 'pattern': nullif(u.features->>'surface_pattern', ''), 'family': nullif(u.features->>'ambiguity_family', ''), 'mapping': u.mapping_status}}) AS units FROM {t}" for t in POOL)})),
    u AS MATERIALIZED (SELECT id, language, coalesce(locale, '') AS locale, u.category AS category, u.surface AS surface, lower({sql_strip('u.canonical')}) AS value, u.pattern AS pattern FROM (SELECT id, language, locale, unnest(units) AS u FROM r)),
    g AS (SELECT language, u.category AS category, u.features->>'surface_pattern' AS pattern FROM (SELECT language, unnest(units) AS u FROM {sql_gold('id', 'language', 'units')}) WHERE u.category IS NOT NULL),
    have AS (SELECT category, count(*) AS have FROM g GROUP BY 1), spoken AS (SELECT DISTINCT category, language, TRUE AS spoken FROM g WHERE language <> ''), named AS (SELECT category, sum(min_records) AS least FROM category_targets GROUP BY 1),
    wanting AS (SELECT DISTINCT w.category AS category, w.detail AS pattern, TRUE AS wanting FROM {_WANTED_PATTERNS} ANTI JOIN g ON g.category = w.category AND g.pattern = w.detail),
    once AS (SELECT pattern, TRUE AS once FROM u WHERE pattern IS NOT NULL GROUP BY pattern HAVING count(*) = 1),
    by_units AS (SELECT id, bool_or(have IS NULL) AS cm, bool_or(have < coalesce(least, 20)) AS cb, bool_or(wanting IS NOT NULL) AS rp, bool_or(spoken IS NULL) AS nl, bool_or(once IS NOT NULL) AS rs FROM u LEFT JOIN have USING (category) LEFT JOIN spoken USING (category, language) LEFT JOIN named USING (category) LEFT JOIN wanting USING (category, pattern) LEFT JOIN once USING (pattern) WHERE category IS NOT NULL GROUP BY id),
    clash AS (SELECT locale, category, surface FROM u GROUP BY 1, 2, 3 HAVING count(DISTINCT value) > 1), disputed AS (SELECT DISTINCT id, TRUE AS disputed FROM u JOIN clash c ON u.locale = c.locale AND u.category IS NOT DISTINCT FROM c.category AND u.surface IS NOT DISTINCT FROM c.surface),
    f AS MATERIALIZED {_FP}, i AS (SELECT fp, count(*) AS n, count(DISTINCT benchmark) AS ns, count(DISTINCT nullif(output, '')) AS no FROM f GROUP BY fp), p AS (SELECT fp, output, count(*) AS np FROM f GROUP BY fp, output),
    shared AS (SELECT id, bool_or(ns > 1) AS crossed, bool_or(np >= 2) AS paired, bool_or(n >= 2) AS repeated, bool_or(no > 1 AND output <> '') AS conflicting FROM f JOIN i USING (fp) JOIN p USING (fp, output) GROUP BY id),
    w AS (SELECT r.id AS id, language, len(units) AS n_units, len(list_filter(units, lambda x: x.family IS NOT NULL)) > 0 AS af, len(list_filter(units, lambda x: coalesce(x.mapping IN ('broader', 'ambiguous'), FALSE))) > 0 AS bm, by_units.* EXCLUDE (id), disputed, shared.* EXCLUDE (id) FROM r LEFT JOIN by_units USING (id) LEFT JOIN disputed USING (id) LEFT JOIN shared USING (id)),
    ranked AS (SELECT id, language, ({' + '.join(f"CASE WHEN {_FLAGS[k]} THEN {w} ELSE 0 END" for k, w in ranking.REASONS.items())})::INTEGER AS priority, concat_ws(',', {', '.join(f"CASE WHEN {_FLAGS[k]} THEN '{k}' END" for k in sorted(_FLAGS))}) AS reasons FROM w)"""


@query(f"{_RANK_SQL} SELECT id, priority, reasons FROM ranked")
def rank_candidates(spark, sf):
    return _ranked(spark, sf).select("id", "priority", "reasons")


@query(f"{_RANK_SQL} SELECT id, language, priority FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY priority DESC, id) AS k FROM ranked) WHERE k <= 5 ORDER BY priority DESC, id LIMIT 25")
def review_batch_capped(spark, sf):
    return ranking.capped(_ranked(spark, sf), "language", 5, 25).select("id", "language", "priority")


@query()  # a sequential rule; tested against a plain loop
def review_batch_greedy(spark, sf):
    return ranking.greedy_batch(_ranked(spark, sf), 50, 4, 2)


# --- merge, difference, review comparison

@query(f"SELECT benchmark, language, locale, source_id, id FROM {sql_pool('id', 'benchmark', 'language', 'locale', 'source_id')} UNION ALL SELECT benchmark, language, locale, source_id, id FROM {sql_gold('id', 'benchmark', 'language', 'locale', 'source_id')}")
def merge_union(spark, sf):
    columns = ("id", "benchmark", "language", "locale", "source_id")
    return snapshots.merged(pool(spark, sf, *columns), gold(spark, sf, *columns)).select(*snapshots.MERGE_ORDER)


@query(f"SELECT {', '.join(snapshots.MERGE_ORDER)}, row_number() OVER (ORDER BY {', '.join(f'coalesce({c}, {chr(39) * 2})' for c in snapshots.MERGE_ORDER)}) AS place FROM {sql_pool('id', 'benchmark', 'language', 'locale', 'source_id')}")
def merge_ordered(spark, sf):
    """The merged pool with each record's place in the total order."""
    columns = ("id", "benchmark", "language", "locale", "source_id")
    keyed = pool(spark, sf, *columns).withColumn("key", F.struct(*[F.coalesce(c, F.lit("")) for c in snapshots.MERGE_ORDER]))
    return census.numbered(keyed, "key").select(*snapshots.MERGE_ORDER, F.col("number").alias("place"))


@query("SELECT id, count(*) AS n FROM (SELECT id FROM async_tn UNION ALL SELECT id FROM polynorm UNION ALL SELECT id FROM proteno UNION ALL SELECT id FROM todo_regressions) GROUP BY id HAVING count(*) > 1")
def merge_duplicate_ids(spark, sf):
    return snapshots.duplicate_ids(snapshots.merged(*[table(spark, sf, t).select("id") for t in POOL]))


# candidates of the pool against the records that were taken over from them, by the upstream item of both
_ITEM = ("id", "benchmark", "source_id", "upstream_expected", "canonical", "accepted", "rejected", "units", "status", "locale")


def _items(spark, sf):
    """Both sides, one record per upstream item (the smallest id): candidates with the upstream output, records with their oracle."""
    unit = lambda u: F.struct(*[u[c].alias(c) for c in ("surface", "start", "end", "category", "semantic", "policy", "canonical", "accepted", "rejected")])
    key = F.concat_ws(":", F.lower(F.trim("benchmark")), "source_id")
    none = F.array().cast("array<string>")
    own = lambda t, extra: _columns(spark, sf, t, ("id", "benchmark", "source_id", "status", "locale", "units", *extra), whole=False).where("benchmark is not null and source_id is not null").withColumn("item", key).withColumn("units", F.transform("units", unit))
    first = lambda df: df.groupBy("item").agg(F.min_by(F.struct("canonical", "accepted", "rejected", "units", "status", "locale"), "id").alias("r")).select(F.col("item").alias("id"), "r.*")
    candidates = [own(t, ("upstream_expected",)).select("item", "id", F.col("upstream_expected").alias("canonical"), F.when(F.col("upstream_expected").isNotNull(), F.array("upstream_expected")).otherwise(none).alias("accepted"), none.alias("rejected"), "units", "status", "locale") for t in POOL]
    records = own("gold_sample", ("canonical", "accepted", "rejected")).select("item", "id", "canonical", F.coalesce("accepted", none).alias("accepted"), F.coalesce("rejected", none).alias("rejected"), "units", "status", "locale")
    return first(reduce(DataFrame.unionByName, candidates)), first(records)


_SQL_UNITS = "list_transform(units, lambda u: {'surface': u.surface, 'start': u.start, 'end': u.\"end\", 'category': u.category, 'semantic': u.semantic, 'policy': u.policy, 'canonical': u.canonical, 'accepted': u.accepted, 'rejected': u.rejected})"
_SQL_ITEM = "lower(trim(source.benchmark)) || ':' || source.source_id AS item, id"
_SQL_SIDES = f"""WITH c AS ({' UNION ALL '.join(f"SELECT {_SQL_ITEM}, {'NULL::VARCHAR' if t == 'todo_regressions' else 'source.upstream_expected'} AS canonical, {_SQL_UNITS} AS units, status, locale FROM {t}" for t in POOL)}),
    g AS (SELECT {_SQL_ITEM}, oracle.canonical_output AS canonical, coalesce(oracle.accepted_outputs, []) AS accepted, coalesce(list_transform(oracle.rejected_outputs, lambda x: x.output), []) AS rejected, {_SQL_UNITS} AS units, status, locale FROM gold_sample),
    a AS (SELECT DISTINCT ON (item) item, canonical, CASE WHEN canonical IS NULL THEN [] ELSE [canonical] END AS accepted, []::VARCHAR[] AS rejected, units, status, locale FROM c WHERE item IS NOT NULL ORDER BY item, id),
    b AS (SELECT DISTINCT ON (item) item, canonical, accepted, rejected, units, status, locale FROM g WHERE item IS NOT NULL ORDER BY item, id)"""


@query(f"""{_SQL_SIDES} SELECT * FROM (SELECT coalesce(a.item, b.item) AS id, CASE WHEN a.item IS NULL THEN 'added' WHEN b.item IS NULL THEN 'removed' WHEN a.canonical IS DISTINCT FROM b.canonical THEN 'canonical_change'
    WHEN a.accepted IS DISTINCT FROM b.accepted THEN CASE WHEN len(b.accepted) > len(a.accepted) THEN 'accepted_addition' ELSE 'accepted_removal' END WHEN list_transform(a.units, lambda u: u.surface) IS DISTINCT FROM list_transform(b.units, lambda u: u.surface) THEN 'unit_change'
    WHEN a.status IS DISTINCT FROM b.status THEN 'status_change' WHEN a.locale IS DISTINCT FROM b.locale THEN 'metadata_change' END AS change, a.canonical AS old_canonical, array_to_string(a.accepted, '|') AS old_accepted, a.status AS old_status, b.canonical AS new_canonical, array_to_string(b.accepted, '|') AS new_accepted, b.status AS new_status FROM a FULL JOIN b ON a.item = b.item) WHERE change IS NOT NULL""")
def oracle_diff(spark, sf):
    side = lambda df: df.select("id", "canonical", "accepted", F.to_json("units.surface").alias("units"), "status", F.col("locale").alias("meta"))
    old, new = _items(spark, sf)
    changes = snapshots.difference(side(old), side(new))
    return changes.withColumns({c: F.array_join(c, "|") for c in ("old_accepted", "new_accepted")})


def _sql_dimensions() -> str:
    of = lambda f: f"list_transform(a.units, lambda u: {f}) IS DISTINCT FROM list_transform(b.units, lambda u: {f})"
    rules = {"span": "a.units IS DISTINCT FROM b.units", "category": of("u.category"), "semantic": of("u.semantic"), "ambiguity": "coalesce(a.status = 'ambiguous', FALSE) OR coalesce(b.status = 'ambiguous', FALSE)", "policy": of("u.policy"), "unit_canonical": of("u.canonical"), "unit_accepted": of("u.accepted"),
        "sentence_canonical": "a.canonical IS DISTINCT FROM b.canonical", "sentence_accepted": "a.accepted IS DISTINCT FROM b.accepted", "rejected_variants": "a.rejected IS DISTINCT FROM b.rejected"}
    return ", ".join(f"{c} AS {k}_differs" for k, c in rules.items()) + f", {' OR '.join(f'({c})' for c in rules.values())} AS disagreement"


@query(f"{_SQL_SIDES} SELECT a.item AS id, 'both' AS side, {_sql_dimensions()} FROM a JOIN b ON a.item = b.item")
def review_compare(spark, sf):
    """The ten dimensions of every item that both sides have."""
    return snapshots.compared_annotations(*_items(spark, sf)).where("side = 'both'")


@query(f"{_SQL_SIDES} SELECT coalesce(a.item, b.item) AS id, CASE WHEN a.item IS NULL THEN 'second_only' ELSE 'first_only' END AS side FROM a FULL JOIN b ON a.item = b.item WHERE a.item IS NULL OR b.item IS NULL")
def review_missing(spark, sf):
    """Items that only one side has."""
    one, other = (d.select("id", "status") for d in _items(spark, sf))
    return snapshots.compared_reviews(one, other, ["status"]).where("side <> 'both'").select("id", "side")


# --- constraints

_RULED = ("id", "schema_version", "taxonomy_version", "policy_version", "family_id", "status", "split", "expected_output", "units", "negative_for", "oracle", "input")
_AUDITED = (*_RULED, "language", "locale", "oracle_hash", "review")


@query()  # semantics, spans and exact forms of every unit; each rule is tested on its own
def violations(spark, sf):
    return constraints.violations(gold(spark, sf, *_RULED)).groupBy("rule").agg(F.count("*").alias("n"))


@query()  # exact forms need NFKC; tested against a plain loop
def unit_violations(spark, sf):
    """Rules of the units of all candidates, which need a source category and a mapping."""
    rows = pool(spark, sf, "id", "benchmark", "status", "input", "units")
    return constraints.unit_violations(rows).groupBy("rule").agg(F.count("*").alias("n"))


@query()  # as violations, with hashes and reviews
def gold_audit(spark, sf):
    return audit.audit(gold(spark, sf, *_AUDITED)).groupBy("rule").agg(F.count("*").alias("n"))


@query()
def gold_audit_strict(spark, sf):
    return audit.audit(gold(spark, sf, *_AUDITED), strict=True).groupBy("rule").agg(F.count("*").alias("n"))


@query()  # canonical JSON of nested objects; tested against json.dumps
def oracle_hashes(spark, sf):
    return audit.with_hash(gold(spark, sf, *_AUDITED)).select("id", "assertion_hash")


@query(f"SELECT id AS record_id, unnest(list_filter([CASE WHEN status IN ('ambiguous', 'quarantine') THEN 'forbidden_status' END, CASE WHEN split IN ('candidate', 'judge_gold') THEN 'forbidden_split' END], lambda x: x IS NOT NULL)) AS rule FROM {sql_gold('id', 'status', 'split')}")
def not_for_release(spark, sf):
    return audit.not_for_release(gold(spark, sf, "id", "status", "split")).select("record_id", "rule")


@query(f"""WITH m AS (SELECT b AS benchmark, CASE WHEN l IS NULL THEN 'review_required' WHEN l LIKE 'CC-BY%' THEN 'embedded_public' ELSE 'external_ref_only' END AS policy FROM (SELECT source.benchmark AS b, min(source.license) AS l FROM polynorm GROUP BY 1))
    SELECT id AS record_id, 'embeds_against_policy' AS rule, policy AS detail FROM (SELECT DISTINCT id, source.benchmark AS benchmark FROM gold_sample) JOIN m USING (benchmark) WHERE policy <> 'embedded_public'""")
def materialization_violations(spark, sf):
    """Records against the policies of their sources; a source with an open licence may be embedded."""
    licence = F.min("source.license")
    manifest = table(spark, sf, "polynorm").groupBy(F.col("source.benchmark").alias("benchmark")).agg(F.when(licence.isNull(), None).when(licence.like("CC-BY%"), "allowed").otherwise("metadata_only").alias("redistribution_status")).withColumn("materialization_policy", F.lit(None).cast("string"))
    return audit.materialization_violations(gold(spark, sf, "id", "source"), manifest)


@query(f"""WITH g AS (SELECT family_id, min(split) AS frozen FROM {sql_gold('id', 'family_id', 'split')} WHERE family_id IS NOT NULL AND split IS NOT NULL GROUP BY 1)
    SELECT id AS record_id, unnest(list_filter([CASE WHEN frozen IS NULL THEN 'family_not_registered' END, CASE WHEN frozen NOT IN ('train', 'dev', 'test') THEN 'registered_split_unknown' END, CASE WHEN frozen IS NOT NULL AND split IS DISTINCT FROM frozen THEN 'split_differs_from_registry' END], lambda x: x IS NOT NULL)) AS rule FROM {sql_gold('id', 'family_id', 'split')} LEFT JOIN g USING (family_id)""")
def registry_violations(spark, sf):
    rows = gold(spark, sf, "id", "family_id", "split")
    registry = rows.where("family_id is not null and split is not null").groupBy("family_id").agg(F.min("split").alias("split"))
    return audit.registry_violations(rows, registry).select("record_id", "rule")


_RULES_SQL = {
    "missing_schema_version": "coalesce(trim(schema_version), '') = ''", "missing_taxonomy_version": "coalesce(trim(taxonomy_version), '') = ''", "missing_policy_version": "coalesce(trim(policy_version), '') = ''", "missing_family_id": "coalesce(trim(family_id), '') = ''",
    "unknown_status": "NOT coalesce(status IN ('gold', 'multi_valid', 'policy_choice', 'ambiguous', 'quarantine', 'no_change'), FALSE)", "unknown_split": "NOT coalesce(split IN ('train', 'dev', 'test', 'challenge', 'judge_gold', 'candidate'), FALSE)",
    "output_missing": "status IN ('gold', 'multi_valid', 'policy_choice', 'no_change') AND expected_output IS NULL", "output_not_allowed": "status IN ('ambiguous', 'quarantine') AND expected_output IS NOT NULL",
    "negative_control_with_units": "status = 'no_change' AND len(units) > 0", "negative_control_of_nothing": "status = 'no_change' AND coalesce(len(negative_for), 0) < 1", "unchanged_output_differs": "status = 'no_change' AND input IS NOT NULL AND expected_output IS DISTINCT FROM input",
}
_SHAPED = tuple(c for c in _RULED if c != "oracle")


@query(f"WITH g AS {sql_gold(*_SHAPED)} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) AS n FROM g WHERE {c}" for k, c in _RULES_SQL.items()) + ") WHERE n > 0")
def record_violations(spark, sf):
    return constraints.record_violations(gold(spark, sf, *_SHAPED)).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT g.id AS record_id, 'unknown_category' AS rule, g.c AS detail FROM (SELECT id, unnest(units).category AS c FROM gold_sample) g WHERE c IS NOT NULL AND c NOT IN (SELECT category FROM category_targets)")
def unknown_categories(spark, sf):
    rows = gold(spark, sf, "id", "units").select("id", F.explode("units.category").alias("category"))
    return constraints.unknown_names(rows, "category", table(spark, sf, "category_targets"), "category", "unknown_category").distinct()


_MANIFEST = "(SELECT source.benchmark AS benchmark, min(source.source_version) AS source_version, min(source.license) AS license, min(source.source_url) AS source_url FROM polynorm GROUP BY 1)"


@query(f"""WITH j AS (SELECT g.id, g.source.benchmark AS b, g.source.source_version AS v, g.source.license AS l, g.source.source_url AS u, g.source.source_hash AS h, m.source_version AS mv, m.license AS ml, m.source_url AS mu, m.benchmark AS mb FROM (SELECT DISTINCT id, source FROM gold_sample) g LEFT JOIN {_MANIFEST} m ON g.source.benchmark = m.benchmark)
    SELECT rule, count(*) AS n FROM (SELECT 'unknown_benchmark' AS rule FROM j WHERE mb IS NULL UNION ALL SELECT 'url_differs' FROM j WHERE mu IS NOT NULL AND u IS DISTINCT FROM mu UNION ALL SELECT 'hash_malformed' FROM j WHERE h NOT LIKE 'sha256:%' UNION ALL SELECT 'version_differs' FROM j WHERE v <> mv UNION ALL SELECT 'license_differs' FROM j WHERE l <> ml UNION ALL SELECT 'license_missing' FROM j WHERE l IS NULL AND ml IS NOT NULL) GROUP BY rule""")
def source_mismatches(spark, sf):
    manifest = table(spark, sf, "polynorm").groupBy(F.col("source.benchmark").alias("benchmark")).agg(F.min("source.source_version").alias("source_version"), F.min("source.license").alias("license"), F.min("source.source_url").alias("source_url"))
    return constraints.source_mismatches(gold(spark, sf, "id", "source"), manifest).groupBy("rule").agg(F.count("*").alias("n"))


# --- hashes and semantics

@query("SELECT id, 'sha256:' || sha256(concat_ws(chr(10), coalesce(source.benchmark, ''), coalesce(source.source_id, ''), coalesce(language, ''), coalesce(input, ''))) AS source_hash FROM (SELECT DISTINCT id, source, language, input FROM proteno)")
def source_hashes(spark, sf):
    rows = _columns(spark, sf, "proteno", ("id", "benchmark", "source_id", "language", "input"))
    return rows.select("id", hashing.joined_hash(*map(F.col, ("benchmark", "source_id", "language", "input"))).alias("source_hash"))


@query("SELECT event_id, sha256(json(props)::VARCHAR) AS props_hash FROM events")
def canonical_hash(spark, sf):
    return table(spark, sf, "events").select("event_id", F.sha2(hashing.canonical_json(F.col("props")), 256).alias("props_hash"))


@query("""WITH u AS (SELECT u.category AS category, u.semantic AS s FROM (SELECT unnest(units) AS u FROM (SELECT DISTINCT id, units FROM gold_sample))), v AS (SELECT category, CASE category
    WHEN 'date' THEN try_cast(printf('%04d-%02d-%02d', (s->>'year')::BIGINT, (s->>'month')::BIGINT, (s->>'day')::BIGINT) AS DATE) IS NOT NULL
    WHEN 'time' THEN (s->>'hour')::BIGINT BETWEEN 0 AND 23 AND (s->>'minute')::BIGINT BETWEEN 0 AND 59 AND coalesce((s->>'second')::BIGINT, 0) BETWEEN 0 AND 59
    WHEN 'decimal' THEN regexp_full_match(s->>'value', '[+-]?(?:\\d+(?:\\.\\d+)?|\\.\\d+)') WHEN 'fraction' THEN (s->>'numerator') IS NOT NULL AND (s->>'denominator')::BIGINT <> 0
    WHEN 'currency' THEN regexp_full_match(s->>'currency', '[A-Z]{3}') AND (s->>'major') IS NOT NULL AND (s->>'minor')::BIGINT BETWEEN 0 AND 99
    WHEN 'version' THEN regexp_full_match(s->>'value', 'v?(0|[1-9]\\d*)\\.(0|[1-9]\\d*)\\.(0|[1-9]\\d*)(?:-[0-9A-Za-z.-]+)?(?:\\+[0-9A-Za-z.-]+)?') WHEN 'identifier' THEN trim(s->>'value') <> '' END AS ok FROM u WHERE s IS NOT NULL AND s <> '{}')
    SELECT category, count(*) AS units, count(*) FILTER (ok) AS valid FROM v WHERE category IN ('date', 'time', 'decimal', 'fraction', 'currency', 'version', 'identifier') GROUP BY category""")
def semantic_validity(spark, sf):
    units = counts.units_of(gold(spark, sf, "id", "units"), "id")
    ok = semantics.valid_semantic(F.col("category"), F.col("unit.semantic"))
    return units.select("category", ok.alias("ok")).where("ok is not null").groupBy("category").agg(F.count("*").alias("units"), F.count_if("ok").alias("valid"))


# --- oracles, overlays, cuts, scans

@query()  # variants splice spans; tested against a plain loop
def oracle_migration(spark, sf):
    """The oracle that each record would get if it had none."""
    rows = gold(spark, sf, "id", "language", "status", "input", "expected_output", "units")
    made = lifecycle.derived_oracle(F.col("status"), F.col("input"), F.col("expected_output"), F.col("units"), F.col("language"))
    return rows.select("id", made.alias("o")).where("o is not null").select("id", "o.canonical_output", F.array_join("o.accepted_outputs", "|").alias("accepted_outputs"), F.coalesce(F.size("o.interpretations"), F.lit(-1)).alias("interpretations"))


_MONTHS = "[" + ", ".join(f"'{m}'" for m in lifecycle.MONTHS) + "]"
_SPOKEN = f"CASE language WHEN 'de' THEN 'Tag ' || d || ', Monat ' || m || ', Jahr ' || y WHEN 'es' THEN 'día ' || d || ', mes ' || m || ', año ' || y ELSE coalesce({_MONTHS}[m], 'month ' || m) || ' ' || d || ', ' || y END"


@query(f"""SELECT language, count(*) AS dates, min(t) AS first_text, max(t) AS last_text FROM (SELECT language, {_SPOKEN} AS t FROM (SELECT language, (s->>'year')::BIGINT AS y, (s->>'month')::BIGINT AS m, (s->>'day')::BIGINT AS d FROM
    (SELECT language, u.semantic AS s FROM (SELECT language, unnest(units) AS u FROM {sql_gold('id', 'language', 'units')}) WHERE u.category = 'date' AND json_extract(u.semantic, '$.year') IS NOT NULL))) GROUP BY language""")
def spoken_dates(spark, sf):
    units = counts.units_of(gold(spark, sf, "id", "language", "units"), "language").where("category = 'date' and get_json_object(unit.semantic, '$.year') is not null")
    number = lambda k: F.get_json_object("unit.semantic", f"$.{k}").cast("int")
    spoken = units.select("language", lifecycle.spoken_date(F.col("language"), number("year"), number("month"), number("day")).alias("t"))
    return spoken.groupBy("language").agg(F.count("*").alias("dates"), F.min("t").alias("first_text"), F.max("t").alias("last_text"))


@query(f"""SELECT id, i AS reading, CASE language WHEN 'de' THEN 'Tag ' || d || ', Monat ' || m || ', Jahr ' || y WHEN 'es' THEN 'día ' || d || ', mes ' || m || ', año ' || y ELSE coalesce({_MONTHS}[m], 'month ' || m) || ' ' || d || ', ' || y END AS output FROM
    (SELECT id, language, i, (c->>'year')::BIGINT AS y, (c->>'month')::BIGINT AS m, (c->>'day')::BIGINT AS d FROM (SELECT id, coalesce(language, 'en') AS language, unnest(json_extract(s, '$.candidates[*]')) AS c, generate_subscripts(json_extract(s, '$.candidates[*]'), 1) AS i FROM (SELECT id, language, units[1].semantic AS s FROM {sql_gold('id', 'language', 'status', 'units')} WHERE status = 'ambiguous')))""")
def ambiguous_readings(spark, sf):
    rows = gold(spark, sf, "id", "language", "status", "units").where("status = 'ambiguous'")
    read = rows.select("id", F.posexplode(lifecycle.interpretations(F.col("language"), F.col("units"))).alias("i", "r"))
    return read.select("id", (F.col("i") + 1).alias("reading"), F.get("r.accepted_outputs", F.lit(0)).alias("output"))


@query("SELECT DISTINCT id, input, expected_output, notes FROM gold_sample")
def external_overlay(spark, sf):
    rows = table(spark, sf, "gold_sample").select("id", "input", "expected_output", "notes").distinct()
    return lifecycle.hydrated(lifecycle.overlay(rows.withColumn("key", F.xxhash64("*"))), rows.withColumn("key", F.xxhash64("*")).select("key", "input"), "key").select("id", "input", "expected_output", "notes")


@query("SELECT id, locale FROM (SELECT DISTINCT id, locale, units FROM gold_sample WHERE split = 'test' AND language = 'en' AND status = 'gold') WHERE list_contains(list_transform(units, lambda u: u.category), 'date')")
def release_scan(spark, sf):
    rows = gold(spark, sf, "id", "split", "language", "locale", "status", "units")
    return lifecycle.selected(rows, split="test", language="en", status="gold", category="date").select("id", "locale")


@query("""WITH r AS (SELECT DISTINCT id, source.source_id AS source_id FROM proteno), n AS (SELECT *, row_number() OVER (ORDER BY id, source_id) AS k, count(*) OVER () AS n FROM r)
    SELECT id, CASE WHEN k <= floor(n * 0.6) THEN 'upstream_train' ELSE 'upstream_test' END AS source_split FROM n""")
def upstream_cut(spark, sf):
    rows = _columns(spark, sf, "proteno", ("id", "source_id"))
    return lifecycle.positional_cut(rows, ["id", "source_id"]).select("id", "source_split")


@query(f"""WITH m AS (SELECT category AS name, category, row_number() OVER (ORDER BY category) AS position FROM (SELECT DISTINCT category FROM category_targets)), u AS (SELECT u.source_category AS c FROM (SELECT unnest(units) AS u FROM (SELECT DISTINCT id, units FROM polynorm)))
    SELECT u.c AS source_category, coalesce(e.category, l.category, 'none') AS category, count(*) AS n FROM u LEFT JOIN m e ON u.c = e.name LEFT JOIN m l ON lower(u.c) = lower(l.name) GROUP BY 1, 2""")
def mapping_lookup(spark, sf):
    names = table(spark, sf, "category_targets").select("category").distinct()
    mapping = names.select(F.col("category").alias("name"), "category", F.lit("exact").alias("status"), F.col("category").alias("position"))
    rule = upstream.mapped_category(mapping)
    units = _columns(spark, sf, "polynorm", ("id", "units")).select(F.explode("units.source_category").alias("source_category"))
    return units.groupBy("source_category", F.coalesce(rule(F.col("source_category"))["category"], F.lit("none")).alias("category")).agg(F.count("*").alias("n"))


_QUEUE = {"production_regression": 50, "source_disagreement": 40, "semantic_risk": 10, "quarantine_review": 5}


@query(f"""{_GAPS.replace('WITH r AS', 'WITH gr AS', 1).replace('FROM r)', 'FROM gr)')}, short AS (SELECT DISTINCT category FROM gap), q AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(f"SELECT DISTINCT id, source.benchmark AS benchmark, locale, status, list_transform(units, lambda u: {{'category': u.category, 'surface': u.surface}}) AS units FROM {t}" for t in POOL)})),
    qu AS MATERIALIZED (SELECT id, coalesce(locale, '') AS locale, u.category AS category, u.surface AS surface FROM (SELECT id, locale, unnest(units) AS u FROM q)), c AS (SELECT locale, category, surface FROM {_FORMS} GROUP BY 1, 2, 3 HAVING count(*) >= 2 AND count(DISTINCT value) > 1),
    k AS (SELECT DISTINCT id, TRUE AS hit FROM qu JOIN c ON qu.locale = c.locale AND qu.category IS NOT DISTINCT FROM c.category AND qu.surface IS NOT DISTINCT FROM c.surface), m AS (SELECT id, count(DISTINCT category) AS n_gaps, list_sort(list(DISTINCT 'coverage_gap:' || category)) AS said FROM qu SEMI JOIN short USING (category) GROUP BY id),
    t AS (SELECT DISTINCT source.benchmark AS benchmark, TRUE AS failed FROM todo_regressions),
    f AS (SELECT q.id AS id, coalesce(failed, FALSE) AS production_regression, coalesce(hit, FALSE) AS source_disagreement, coalesce(list_has_any(list_transform(units, lambda x: x.category), {list(ranking.RISKY)}), FALSE) AS semantic_risk, coalesce(status = 'quarantine', FALSE) AS quarantine_review, coalesce(n_gaps, 0) AS n_gaps, said FROM q LEFT JOIN k USING (id) LEFT JOIN m USING (id) LEFT JOIN t USING (benchmark))
    SELECT id, ({' + '.join(f"CASE WHEN {k} THEN {w} ELSE 0 END" for k, w in _QUEUE.items())} + 15 * n_gaps)::INTEGER AS priority, array_to_string(list_concat(coalesce(said, []), list_filter([{', '.join(f"CASE WHEN {k} THEN '{k}' END" for k in sorted(_QUEUE))}], lambda x: x IS NOT NULL)), ',') AS reasons FROM f""")
def adjudication_queue(spark, sf):
    """Candidates; those of the benchmarks of todo_regressions come from production."""
    rows = pool(spark, sf, "id", "benchmark", "locale", "status", "units")
    regressions = table(spark, sf, "todo_regressions").select(F.col("source.benchmark").alias("benchmark"))
    return ranking.adjudication(rows, duplicates.unit_conflicts(gold(spark, sf, "id", "locale", "units")), coverage_gaps(spark, sf), regressions)


# --- the events stream, run to the end of what is there

@query("SELECT start, event_type, n FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE start + INTERVAL 3 DAY <= (SELECT max(ts) FROM events)")
def stream_windows(spark, sf):
    """Windows that the watermark has closed when the stream has read everything, as a batch query over them would count."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events.run_once(events.windowed(events.read(spark, sf)), f"{base}/out", f"{base}/state")
    return spark.read.schema("start timestamp, event_type string, n bigint").parquet(f"{base}/out")
