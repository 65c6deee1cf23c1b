"""SQL that defines the results of the training-data queries where plain SQL can; each runs over the whole tables."""

from __future__ import annotations

from weftline.llm.formatting import HYPHENS, MARKS
from weftline.llm.sampling import KEYS
from weftline.llm.splits import UNKNOWN_IDS
from weftline.llm.textform import FOLD

_KEPT = {c: t for c, t in FOLD.items() if t is not None and c > 127}
_GONE = "".join(chr(c) for c, t in FOLD.items() if t is None)
_FROM, _TO = ("".join(x).replace("'", "''") for x in ([*map(chr, _KEPT), _GONE], _KEPT.values()))


def _fold(x: str) -> str:
    return f"nfc_normalize(translate({x}, '{_FROM}', '{_TO}'))"


def _words(x: str) -> str:
    return f"regexp_extract_all(lower({_fold(x)}), '[\\p{{L}}\\p{{N}}]+')"


def _plain(x: str, sign: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), '^\\s+|\\s+$', '', 'g'), '[\\s_\\-]+', '{sign}', 'g')"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


P1 = f"""WITH r AS (SELECT DISTINCT id, lower(trim(split)) AS split, {_words('input')} AS w FROM (SELECT id, split, input FROM gold_sample UNION ALL SELECT id, split, input FROM polynorm) WHERE input IS NOT NULL AND id IS NOT NULL),
    d AS (SELECT *, regexp_replace(array_to_string(w, ''), '[^0-9]', '', 'g') AS digits FROM r WHERE split IN ('train', 'dev', 'test', 'challenge', 'judge_gold')),
    p AS (SELECT a.id AS i, b.id AS j, a.w AS v, b.w AS w, list_distinct(list_concat(a.w, b.w)) AS k FROM d a JOIN d b ON a.digits = b.digits AND a.id <> b.id WHERE a.split = 'train' AND b.split <> 'train' AND abs(len(a.w) - len(b.w)) <= 3)
    SELECT DISTINCT least(i, j) AS id_1, greatest(i, j) AS id_2 FROM p WHERE levenshtein(array_to_string(list_transform(v, lambda x: chr(33 + list_position(k, x)::INTEGER)), ''), array_to_string(list_transform(w, lambda x: chr(33 + list_position(k, x)::INTEGER)), '')) <= 3"""

_ORIGINS = f"""(SELECT DISTINCT id, lower(trim(split)) AS split, lower(trim(origin)) AS origin, {_words('input')} AS w FROM (SELECT id, split, source.benchmark AS origin, input FROM gold_sample UNION ALL SELECT id, split, source.benchmark, input FROM polynorm) WHERE input IS NOT NULL AND id IS NOT NULL)"""
P1_REPORT = f"""WITH r AS {_ORIGINS}, d AS (SELECT *, regexp_replace(array_to_string(w, ''), '[^0-9]', '', 'g') AS digits FROM r WHERE split IN ('train', 'dev', 'test', 'challenge', 'judge_gold')),
    p AS (SELECT a.id AS i, b.id AS j, b.split AS split, b.origin AS source, a.w AS v, b.w AS w, list_distinct(list_concat(a.w, b.w)) AS k FROM d a JOIN d b ON a.digits = b.digits AND a.id <> b.id WHERE a.split = 'train' AND b.split <> 'train' AND abs(len(a.w) - len(b.w)) <= 3),
    o AS (SELECT DISTINCT i, j, split, source FROM p WHERE levenshtein(array_to_string(list_transform(v, lambda x: chr(33 + list_position(k, x)::INTEGER)), ''), array_to_string(list_transform(w, lambda x: chr(33 + list_position(k, x)::INTEGER)), '')) <= 3)
    SELECT split, source, count(DISTINCT j) AS eval_records, count(DISTINCT i) AS train_records, count(*) AS pairs FROM o GROUP BY split, source"""

P2 = f"""WITH r AS (SELECT id, min(u.category) AS category, min(language) AS language, min(status) AS status FROM (SELECT id, language, status, units[1] AS u FROM (SELECT id, language, status, list_sort(list_transform(units, lambda x: {{'start': x.start, 'category': x.category}})) AS units FROM todo_regressions)) GROUP BY id),
    c AS (SELECT {', '.join(f"{_plain(k, '_')} AS {k}" for k in KEYS)}, count(*) AS have FROM r GROUP BY ALL)
    SELECT {', '.join(f't.{k} AS {k}' for k in KEYS)} FROM category_targets t LEFT JOIN c ON {' AND '.join(f"{_plain('t.' + k, '_')} = c.{k}" for k in KEYS)}
    WHERE coalesce(have, 0) < greatest(min_records, (target_permille * (SELECT count(*) // 5 FROM r) + 999) // 1000)"""

_FIELDS = (("async_tn", "input"), ("gold_sample", "expected_output"), ("polynorm", "source.upstream_expected"))
P4 = f"""WITH t AS ({' UNION '.join(f"SELECT '{t}.{c}' AS field_name, id, {c} AS text FROM {t} WHERE {c} IS NOT NULL" for t, c in _FIELDS)}), f AS (SELECT *, {_fold('text')} AS form FROM t)
    SELECT DISTINCT a.field_name AS field_name, a.id AS id_1, b.id AS id_2 FROM f a JOIN f b ON a.field_name = b.field_name AND a.form = b.form AND a.text <> b.text AND a.id < b.id"""

_TEXTS = " UNION ALL ".join(f"SELECT '{t}.{c}' AS field_name, id, {c} AS text FROM {t}" for t, c in _FIELDS)
P4_CANONICAL = f"SELECT DISTINCT field_name, id, canonical, changed FROM (SELECT field_name, id, text, {_fold('text')} AS canonical, text IS DISTINCT FROM {_fold('text')} AS changed FROM (SELECT DISTINCT * FROM ({_TEXTS})))"

_MARK, _HYPHEN = (f"regexp_matches(ch, '[{x}]')" for x in (MARKS.replace("'", "''"), HYPHENS))
P5 = f"""WITH r AS (SELECT DISTINCT id, coalesce(language, '') AS language, string_split(lower({_fold('input')}), '') AS c FROM (SELECT id, language, input FROM async_tn UNION ALL SELECT id, language, input FROM proteno UNION ALL SELECT id, language, input FROM polynorm) WHERE input IS NOT NULL AND id IS NOT NULL),
    k AS (SELECT id, language, array_to_string(list_filter(c, lambda ch, i: NOT regexp_matches(ch, '\\s') AND (NOT {_MARK} OR (i > 1 AND regexp_matches(c[i - 1], '\\d') AND coalesce(regexp_matches(c[i + 1], '\\d'), FALSE))
        OR ({_HYPHEN} AND (i = 1 OR regexp_matches(c[i - 1], '\\s')) AND coalesce(regexp_matches(c[i + 1], '\\d'), FALSE)))), '') AS key FROM r)
    SELECT DISTINCT kept_id, id AS copy_id FROM (SELECT id, min(id) OVER (PARTITION BY language, key) AS kept_id FROM k) WHERE id <> kept_id"""

P5_COLLAPSED = P5.replace("SELECT DISTINCT kept_id, id AS copy_id FROM", "SELECT kept_id AS id, count(DISTINCT id) AS copies FROM").replace(" WHERE id <> kept_id", " GROUP BY kept_id")

P6 = f"""WITH RECURSIVE r AS (SELECT DISTINCT {_plain('family_id', '-')} AS f, lower(trim(source.benchmark)) AS b, source.source_id AS s FROM (SELECT family_id, source.benchmark AS bench, source FROM gold_sample UNION ALL SELECT family_id, source.benchmark, {{'benchmark': source.benchmark, 'source_id': source.source_id, 'source_version': source.source_version, 'source_url': source.source_url, 'license': source.license, 'source_hash': source.source_hash, 'upstream_expected': source.upstream_expected}} FROM polynorm)
        WHERE family_id IS NOT NULL AND source.benchmark IS NOT NULL AND source.source_id IS NOT NULL AND lower(trim(source.source_id)) NOT IN ({_quoted(UNKNOWN_IDS)})),
    e AS (SELECT DISTINCT a.f AS a, b.f AS b FROM r a JOIN r b ON a.b = b.b AND a.s = b.s AND a.f <> b.f),
    reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
    SELECT a AS family_id, least(a, min(b)) AS group_family FROM reach GROUP BY a"""

def _runs(key: str, table: str) -> str:
    """Every run of twelve words; null where the text ends sooner."""
    run = " || ' ' || ".join(f"lead(w, {i}) OVER p" for i in range(12))
    return f"SELECT {key}, {run} AS s FROM (SELECT {key}, unnest(w) AS w, generate_subscripts(w, 1) AS k FROM (SELECT {key}, {_words('text')} AS w FROM {table} WHERE text IS NOT NULL)) WINDOW p AS (PARTITION BY {key} ORDER BY k)"


P7 = f"SELECT DISTINCT item_id, doc_id FROM ({_runs('item_id', 'eval_items')}) JOIN ({_runs('doc_id', 'documents')}) USING (s)"

def _placed(key: str, table: str) -> str:
    return _runs(key, table).replace(f"SELECT {key}, ", f"SELECT {key}, k, ", 1)


# consecutive hits on one diagonal are one run of words
P7_ITEMS = f"""WITH h AS (SELECT DISTINCT i.item_id AS item_id, d.doc_id AS doc_id, d.k AS k, d.k - i.k AS shift FROM ({_placed('item_id', 'eval_items')}) i JOIN ({_placed('doc_id', 'documents')}) d USING (s)),
    r AS (SELECT item_id, doc_id, count(*) + 11 AS n FROM (SELECT *, k - row_number() OVER (PARTITION BY item_id, doc_id, shift ORDER BY k) AS run FROM h) GROUP BY item_id, doc_id, shift, run),
    t AS (SELECT item_id, count(DISTINCT doc_id) AS documents, max(n) AS longest_run FROM r GROUP BY item_id)
    SELECT item_id, split, lang, coalesce(documents, 0) AS documents, coalesce(longest_run, 0) AS longest_run FROM eval_items LEFT JOIN t USING (item_id)"""

SQL = {"p1_found": P1, "p1_report": P1_REPORT, "p2_found": P2, "p4_found": P4, "p4_canonical": P4_CANONICAL, "p5_found": P5, "p5_collapsed": P5_COLLAPSED, "p6_found": P6, "p7_found": P7, "p7_items": P7_ITEMS}
