"""Every query of the registry against its SQL, where the driver's tables are at hand."""

import math
import unicodedata
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from weftline.plans import registry

DATA = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


def _rows(frame):
    names = sorted(frame.columns)
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return names, sorted((tuple(map(plain, r)) for r in frame[names].itertuples(index=False)), key=repr)


def test_names_and_sql_belong_together():
    assert set(registry.oracle_sql()) <= set(registry.queries()) and registry.FLAGSHIP in registry.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@here
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as con:
        for p in Path(DATA).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        want = con.sql(registry.oracle_sql()[name]).df()
    assert _rows(registry.queries()[name](spark, DATA).toPandas()) == _rows(want)


@here
@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    df = registry.queries()[name](spark, DATA)
    assert len(df.columns) == len(set(df.columns)) and df.count() >= 0


@here
def test_scores_of_the_driver_s_records_match_a_loop(spark):
    plain = lambda t: " ".join(unicodedata.normalize("NFKC", t or "").split()).casefold()
    rows = {r.id: r for r in spark.read.parquet(f"{DATA}/gold_sample.parquet").collect()}
    n = canonical = accepted = missing = weight = right = 0
    for r in rows.values():
        if r.status not in ("gold", "multi_valid", "policy_choice", "no_change") or r.split == "candidate":
            continue
        said = plain(r.source.upstream_expected)
        match = said == plain(r.oracle.canonical_output)
        size = max(len(r.units), r.status == "no_change")
        n, canonical, accepted = n + 1, canonical + match, accepted + (match or said in set(map(plain, r.oracle.accepted_outputs)))
        missing, weight, right = missing + (r.source.upstream_expected is None), weight + size, right + match * size
    total = {r.section: r for r in registry.queries()["score_breakdown"](spark, DATA).collect()}["all"]
    assert (total.records, total.missing) == (n, missing) and n > 100
    assert (total.canonical_accuracy, total.accepted_accuracy, total.unit_accuracy) == (round(canonical / n, 6), round(accepted / n, 6), round(right / weight, 6))
