from pathlib import Path

import duckdb
import pytest

from weftline.llm import queries
from weftline.llm.textform import words

DATA = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


@here
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as con:
        for p in Path(DATA).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        want = con.sql(queries.oracle_sql()[name])
        names = want.columns
        rows = want.fetchall()
    got = queries.queries()[name](spark, DATA)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(names).collect()) == sorted(rows)


@here
def test_assignment_keeps_groups_and_shares(spark):
    split = {r.id: r.split for r in queries.p6_assigned(spark, DATA).collect()}
    families = {(r.family_id, r.group_family) for r in queries.p6_found(spark, DATA).collect()}
    group, of = dict(families), {}
    for r in queries._split_records(spark, DATA).select("id", "family").distinct().collect():
        if r.family is not None:
            of.setdefault(group.get(r.family, r.family), set()).add(split[r.id])
    assert all(len(s) == 1 for s in of.values())
    for name, share in (("train", 0.7), ("dev", 0.15), ("test", 0.15)):
        assert abs(sum(s == name for s in split.values()) - share * len(split)) <= 3
    report = queries.p6_report(spark, DATA).collect()
    assert sum(r.records for r in report) == len(split)


@here
def test_sample_keeps_floors_and_size(spark):
    report = queries.p2_report(spark, DATA).collect()
    sample = queries.p2_sample(spark, DATA).collect()
    drawn = {}
    for r in sample:
        drawn[r.category, r.language, r.status] = drawn.get((r.category, r.language, r.status), 0) + 1
    assert len({r.id for r in sample}) == len(sample)
    for r in report:
        assert drawn.get((r.category, r.language, r.status), 0) == r.drawn >= min(r.available, r.min_records) and (r.missing > 0) == (r.available < r.needed)


@here
def test_mixture_keeps_caps_membership_and_shares(spark):
    chosen, report = queries.p8_mixture(spark, DATA).collect(), {r.source: r for r in queries.p8_report(spark, DATA).collect()}
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").collect()}
    assert len({r.doc_id for r in chosen}) == len(chosen) and all(source[r.doc_id] == r.source and 1 <= r.repeats <= report[r.source].max_repeats for r in chosen)
    for s, r in report.items():
        assert sum(c.repeats * c.tokens for c in chosen if c.source == s) == r.tokens <= r.quota_tokens


@here
def test_spans_and_pieces_of_the_driver_s_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{DATA}/eval_items.parquet").collect()}
    for r in queries.p7_spans(spark, DATA).collect():
        assert r.n_words >= 12 and words(texts[r.doc_id][r.start : r.end]) == items[r.item_id][r.item_word : r.item_word + r.n_words]
    limits = {r.plan: r for r in spark.read.parquet(f"{DATA}/chunk_limits.parquet").collect()}
    last = {}
    for r in queries.p9_pieces(spark, DATA).orderBy("plan", "doc_id", "piece_no").collect():
        limit = limits[r.plan]
        assert r.text == texts[r.doc_id][r.start : r.end] and r.tokens <= limit.max_tokens
        before = last.get((r.plan, r.doc_id), 0)
        assert (r.start == 0) if r.piece_no == 0 else (r.start <= before and r.shared_tokens >= limit.overlap_tokens)
        last[r.plan, r.doc_id] = r.end
    assert all(end == len(texts[doc]) for (_, doc), end in last.items()) and last
