import json
import random
from datetime import datetime, timedelta

import pytest

from weftline.operators import schema_drift as sd


def _drift(spark, files, rows):
    f = spark.createDataFrame([(feed, i, datetime(2025, 1, 1) + timedelta(days=d)) for feed, i, d in files], "feed string, file_id bigint, exported_at timestamp")
    r = spark.createDataFrame([(n, i, p if p is None or isinstance(p, str) else json.dumps(p)) for n, (i, p) in enumerate(rows)], "row_no bigint, file_id bigint, payload string")
    return sd.Drift(f, r)


def test_each_change_under_its_first_file(spark):
    rows = [
        (1, {"row_id": "a", "text": "x", "n": 1, "old": "only", "units": [{"cat": "d", "s": 1}]}), (1, {"row_id": "b", "text": "y", "n": 2, "gone": None, "units": []}), (1, "{broken"), (1, None), (1, "[1]"),
        (2, {"row_id": "b", "sentence": "y", "n": "2", "fresh": "z", "units": [{"kind": "d", "s": 1}]}), (2, {"row_id": "a", "sentence": "x", "n": "1", "units": [{"kind": "d", "s": 1}]}), (2, {"row_id": "a", "sentence": "x", "n": "1", "units": [{"kind": "d", "s": 1}]}),
        (3, {"row_id": "c", "sentence": "q", "n": {"value": 1}, "fresh": None, "units": [{"kind": "d"}]}), (9, {"row_id": "c"}),
    ]
    drift = _drift(spark, [("f", 2, 5), ("f", 1, 0), ("f", 3, 9), ("g", 7, 0), ("g", 8, 1), (None, 4, 0)], rows)
    got = {tuple(r) for r in drift.changes.collect()}
    assert got == {
        ("f", 2, "renamed", "text", "sentence"), ("f", 2, "renamed", "units.cat", "units.kind"), ("f", 2, "retyped", "n", "n"), ("f", 2, "removed", "old", ""), ("f", 2, "added", "", "fresh"),
        ("f", 3, "retyped", "n", "n"), ("f", 3, "removed", "fresh", ""), ("f", 3, "removed", "units.s", ""),
    }
    table = {(r.file_id, r.row_key): r for r in drift.united().collect()}
    assert len(table) == 5 and table[(2, "b")].text == "y" and table[(3, "c")].text == "q"
    assert json.loads(table[(2, "a")].units) == [{"cat": "d", "s": 1}]
    assert "sentence" not in drift.united().columns


def test_alike_names_without_equal_values_are_no_rename(spark):
    rows = [(1, {"row_id": "a", "start": 1, "label": "u"}), (2, {"row_id": "a", "offset_start": 7, "label_code": "u-x"})]
    assert {(r.change, r.old_name, r.new_name) for r in _drift(spark, [("f", 1, 0), ("f", 2, 1)], rows).changes.collect()} == {("removed", "start", ""), ("removed", "label", ""), ("added", "", "offset_start"), ("added", "", "label_code")}


def test_flooding_prefers_the_like_field_among_equal_values():
    before = {"row_id": "string", "start": "number", "finish": "number"}
    after = {"row_id": "string", "offset_start": "number", "offset_finish": "number"}
    equal = {(a, b) for a in ("start", "finish") for b in ("offset_start", "offset_finish")}
    assert sorted(sd.correspondences(before, after, equal)) == [("finish", "offset_finish"), ("start", "offset_start")]
    assert sd.correspondences(before, before, set()) == [] and sd.flood({}, {}) == {}


def test_nested_fields_and_kinds():
    record = {"a": None, "b": True, "c": [{"x": 1, "y": None}, {"x": "2"}, 3], "d": {"e": 1}}
    assert dict(sd.fields_of(record)) == {"b": [True], "c": [record["c"]], "c.x": [1, "2"], "d": [{"e": 1}]}
    assert [sd._kind(v) for v in (True, 1, 1.5, "s", [], {})] == ["boolean", "number", "number", "string", "array", "object"]
    assert sd.parse("") is None and sd.parse("[" * 100_000) is None and sd.parse('{"a": 1}') == {"a": 1}


def test_united_keeps_different_rows_of_one_key_and_a_reused_name(spark):
    rows = [(1, {"row_id": "a", "t": "x", "n": 1}), (1, {"row_id": "a", "t": "y", "n": 1}), (1, {"n": 1, "t": "y", "row_id": "a"}), (2, {"row_id": "a", "u": "y", "n": 1}), (3, {"row_id": "a", "u": "y", "t": "new", "n": 1}), (4, {"row_id": "b", "t": "more", "n": 2})]
    drift = _drift(spark, [("f", i, i) for i in range(1, 5)], rows)
    assert ("f", 2, "renamed", "t", "u") in {tuple(r) for r in drift.changes.collect()}
    assert sorted((r.file_id, r.t or "", r.t_2 or "") for r in drift.united().collect()) == [(1, "x", ""), (1, "y", ""), (2, "y", ""), (3, "y", "new"), (4, "", "more")]


def test_empty_tables(spark):
    drift = _drift(spark, [("f", 1, 0)], [(1, {"row_id": "a"})])
    assert drift.changes.count() == 0
    nothing = sd.Drift(drift.order.limit(0).select("feed", "file_id", "exported_at"), drift.rows.limit(0))
    assert nothing.changes.count() == 0 and nothing.united().count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_previous_file_across_tasks(spark, seed):
    draw = random.Random(seed)
    files = [(draw.choice("ab") if i % 3 else "hot", i, draw.randrange(40)) for i in range(80)]
    df = spark.createDataFrame([(f, i, datetime(2025, 1, 1) + timedelta(days=d)) for f, i, d in files], "feed string, file_id bigint, exported_at timestamp")
    want, last = {}, {}
    for f, d, i in sorted((f, d, i) for f, i, d in files):
        want[i] = last.get(f)
        last[f] = i
    assert {r.file_id: r.previous for r in sd.file_order(df.repartition(7)).collect()} == want
