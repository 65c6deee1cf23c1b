import json
import pickle

import pytest
from pyspark.sql import functions as F

from weftline.sources import jsonl, sinks, upstream


def _mapping(spark):
    return spark.createDataFrame([("date", "date", "exact", 0), ("Version", "version", "exact", 1), ("VERSION", "other", "broader", 2)], "name string, category string, status string, position int")


def test_paths_of_files_folders_and_patterns(tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.jsonl", "a/y.txt", "z.jsonl"):
        (tmp_path / name).write_text("{}\n")
    found = jsonl.expand_paths([tmp_path, tmp_path / "z.jsonl", f"{tmp_path}/a/*.jsonl", tmp_path / "none.jsonl"])
    assert [f.rsplit("/", 1)[1] for f in found] == ["x.jsonl", "z.jsonl"]


def test_lines_and_broken_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a", "output": "1"}\n\n[1]\n{"id": "a", "output": "2"}\nnot json\n')
    lines = jsonl.read_lines(spark, [str(tmp_path)])
    assert sorted(r._line for r in lines.collect()) == [1, 3, 4, 5]
    assert sorted(r._line for r in jsonl.broken_lines(lines).collect()) == [3, 5]
    assert [tuple(r) for r in jsonl.predictions(lines).collect()] == [("a", "2")]
    rows = jsonl.read_jsonl(spark, [str(tmp_path)], "id string, output string")
    assert rows.where("_broken is null").count() == 2


def test_async_rows_become_records_or_exclusions(spark, tmp_path):
    rows = [
        {"row_id": "1", "language": "en", "original_text": "On 2020-01-02 use v1.2 now", "normalized_text": "x", "units": [{"text": "2020-01-02", "norm_category": "date"}, {"text": "v1.2", "norm_category": "version"}]},
        {"row_id": "2", "language": "en", "original_text": "12 and 12", "units": [{"text": "12", "norm_category": "date"}]},
        {"row_id": "3", "language": "xx", "original_text": "a", "units": []},
        {"row_id": "4", "language": "de", "original_text": None, "units": None},
        {"row_id": "5", "language": "de", "original_text": "frei", "units": None},
        {"row_id": "6", "language": "en", "original_text": "a 112 b", "units": [{"text": "12", "norm_category": "date"}]},
    ]
    path = tmp_path / "e.json"
    path.write_text(json.dumps(rows))
    records, lost = upstream.imported(upstream.async_english(spark, str(path)), "async_tn", _mapping(spark), boundary=True)
    got = {r.id: r for r in records.collect()}
    assert sorted(got) == ["async-tn-de-5", "async-tn-en-1"]
    assert [(u.surface, u.start, u.end, u.category, u.mapping_status, u.surface_pattern) for u in got["async-tn-en-1"].units] == [("2020-01-02", 3, 13, "date", "exact", "iso_date"), ("v1.2", 18, 22, "version", "exact", "simple_version")]
    assert got["async-tn-de-5"].locale == "de-DE"
    assert {r.source_id: r.reason for r in lost.collect()} == {"2": "unmappable_or_unresolved_unit", "3": "unsupported_language", "4": "malformed_row", "6": "unmappable_or_unresolved_unit"}
    kept, other = upstream.only_languages(records, ["de"])
    assert kept.count() == 1 and [r.reason for r in other.collect()] == ["language_not_selected"]


def test_async_languages_are_flattened(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps([{"row_id": "9", "languages": {"de": {"original_text": "a", "units": []}, "fr": {"language_code": "fr", "original_text": "b", "units": []}}}]))
    rows = upstream.async_multilingual(spark, str(path)).orderBy("source_id").collect()
    assert [(r.source_id, r.language, r.source_bundle_schema) for r in rows] == [("9:de", "de", "async_tn_multilingual_v2"), ("9:fr", "fr", "async_tn_multilingual_v2")]


def test_polynorm_forms(spark, tmp_path):
    row = {"source_id": "p1", "language": "en", "locale": "en-GB", "category": "date", "input": "on 1/2/2020", "expected": "x", "surface": "1/2/2020"}
    (tmp_path / "p.jsonl").write_text(json.dumps(row) + "\n")
    (tmp_path / "r.json").write_text(json.dumps({"format": "raw", "records": [row]}))
    tree = tmp_path / "official" / "de-DE"
    tree.mkdir(parents=True)
    (tree / "x_groundtruth.jsonl").write_text(json.dumps({"index": "3", "category": "date", "original_text": "a", "normalized_text": "b"}) + "\n")
    for path, form in (("p.jsonl", "projection"), ("r.json", "raw")):
        records, lost = upstream.imported(upstream.polynorm(spark, str(tmp_path / path), form), "polynorm", _mapping(spark))
        assert [(r.locale, r.units[0].start, r.units[0].surface_pattern) for r in records.collect()] == [("en-GB", 3, "ambiguous_numeric_date")] and lost.count() == 0
    assert [(r.locale, r.language, r.source_id) for r in upstream.polynorm(spark, str(tmp_path / "official"), "official").collect()] == [("de-DE", "de", "de-DE:3")]


def test_proteno_cases_pairs_and_tags(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"cases": [{"case_id": "c", "language": "es", "input": "el 3/4", "expected": "y", "category": "date", "surface": "3/4", "start": 3, "end": 6}]}))
    records, _ = upstream.imported(upstream.proteno(spark, str(tmp_path / "c.json")), "proteno", _mapping(spark))
    assert records.first().units[0].span_origin == "upstream"
    pair = upstream.pickled_pair(spark, pickle.dumps(["a", ["b", "c"]]), pickle.dumps(["x", "y"]), "en")
    assert [(r.input, r.source_split) for r in pair.orderBy("source_id").collect()] == [("a", "upstream_train"), ("b c", "upstream_test")]
    with pytest.raises(ValueError):
        upstream.pickled_pair(spark, pickle.dumps(["a"]), pickle.dumps([]), "en")
    with pytest.raises(pickle.UnpicklingError):
        upstream.plain_pickle(pickle.dumps(json.dumps))
    text = spark.createDataFrame([('on <error what="DATE">1 May</error> x',)], "t string")
    row = text.select(upstream.tagged_units(F.col("t")).alias("u"), upstream.untagged(F.col("t")).alias("p")).first()
    assert row.p == "on 1 May x" and (row.u[0].norm_category, row.u[0].text) == ("DATE", "1 May")


def test_sinks_are_stable_and_guarded(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1, "x"), ("a", 2, "é")], "id string, n int, _line string")
    sinks.write_jsonl(rows, str(tmp_path / "o"), ["id"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "o").glob("part-*")))
    assert text == '{"id":"a","n":2}\n{"id":"b","n":1}\n'
    sinks.write_report(rows.orderBy("id"), str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())[0] == {"id": "a", "n": 2}
    hashes = sinks.file_hashes(spark, str(tmp_path / "o")).where("path like '%part-%'")
    assert sinks.manifest_violations(hashes, hashes).count() == 0
    assert {r.rule for r in sinks.manifest_violations(hashes, hashes.withColumn("sha256", F.lit("0"))).collect()} == {"differs"}
    with pytest.raises(ValueError):
        sinks.guard_output(str(tmp_path / "o" / "in"), [str(tmp_path / "o")])
    with pytest.raises(FileExistsError):
        sinks.guard_output(str(tmp_path / "o"), [])
