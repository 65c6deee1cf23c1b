import json

import pytest

from weftline import cli


def _record(i, text="Say 3/4 now", canonical="three quarters", **more):
    unit = {"surface": "3/4", "start": 4, "end": 7, "category": "fraction", "semantic": {"numerator": 3, "denominator": 4}, "policy": "p", "canonical": canonical, "accepted": [canonical], "rejected": [], "features": {"surface_pattern": "x"}}
    out = f"Say {canonical} now"
    return {"schema_version": "1", "taxonomy_version": "1", "policy_version": "1", "id": i, "language": "en", "locale": "en-US", "split": "train", "family_id": f"f{i}", "status": "gold", "input": text, "expected_output": out, "negative_for": [], "source": {"benchmark": "b", "source_id": i}, "units": [unit], "oracle": {"canonical_output": out, "accepted_outputs": [out], "variant_mode": "explicit"}} | more


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in").mkdir()
    rows = [_record("a"), _record("b", canonical="three over four"), _record("c", text="Say 3/4  NOW", split="test", family_id="fa")]
    (tmp_path / "in" / "r.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return tmp_path


def _lines(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]


@pytest.mark.parametrize("command", [*cli.SIMPLE, "merge", "migrate-oracle", "rank-candidates", "adjudicate-queue", "pool-stats", "census", "review-batch"])
def test_every_command_runs(spark, files, capsys, command):
    assert cli.main([command, str(files / "in")], spark) in (0, 1)


def test_results_and_exit_codes(spark, files, capsys):
    assert cli.main(["conflicts", str(files / "in"), "--fail-on-conflict"], spark) == 2
    assert [(r["surface"], r["n_values"]) for r in _lines(capsys)] == [("3/4", 2)]
    assert cli.main(["validate", str(files / "in"), "--curated", "b"], spark) == 1
    assert [(r["record_id"], r["rule"]) for r in _lines(capsys)] == [("c", "reconstruction_differs"), ("fa", "family_in_several_splits")]
    assert cli.main(["merge", str(files / "in")], spark) == 0
    merged = _lines(capsys)
    assert [r["id"] for r in merged] == ["a", "b", "c"] and merged[0]["units"][0]["surface"] == "3/4" and merged[0]["source"]["benchmark"] == "b"
    (files / "twice.jsonl").write_text(json.dumps(_record("a")) + "\n")
    assert cli.main(["merge", str(files / "in"), str(files / "twice.jsonl")], spark) == 1
    assert cli.main(["rank-candidates", str(files / "in"), "--reviewed", str(files / "in")], spark) == 0
    assert {r["id"]: r["reasons"] for r in _lines(capsys)}["a"] == "duplicate_exact_input_output,source_disagreement"
    (files / "p.jsonl").write_text('{"id": "a", "output": "say three quarters NOW"}\n')
    assert cli.main(["score", str(files / "in"), "--predictions", str(files / "p.jsonl")], spark) == 0
    assert {r["section"]: r["missing"] for r in _lines(capsys)}["all"] == 2
    assert cli.main(["oracle-diff", str(files / "in"), "--new", str(files / "in")], spark) == 0 and _lines(capsys) == []
    (files / "in" / "bad.jsonl").write_text("{nope\n")
    assert cli.main(["stats", str(files / "in")], spark) == 1
    assert "bad.jsonl:1:" in capsys.readouterr().err


def test_output_folder_and_discovery(spark, files, capsys):
    assert cli.main(["dedupe", str(files / "in"), "--out", str(files / "out")], spark) == 0
    assert [json.loads(x)["n"] for p in sorted((files / "out").glob("part-*")) for x in p.read_text().splitlines()] == [3]
    with pytest.raises(ValueError):
        cli.main(["dedupe", str(files / "in"), "--out", str(files / "in" / "x")], spark)
    (files / "c.txt").write_text("Order QK-417/3D.\n")
    assert cli.main(["discover", str(files / "in"), "--corpus", str(files / "c.txt")], spark) == 0
    assert [r["token"] for r in _lines(capsys)] == ["QK-417/3D."]


def test_imports(spark, files, capsys):
    (files / "m.json").write_text(json.dumps([{"name": "date", "category": "date", "status": "exact", "position": 0}]))
    (files / "e.json").write_text(json.dumps([{"row_id": "1", "language": "en", "original_text": "on 2020-01-02", "units": [{"text": "2020-01-02", "norm_category": "DATE"}]}]))
    assert cli.main(["import-async", str(files / "e.json"), "--form", "english", "--mapping", str(files / "m.json")], spark) == 0
    assert _lines(capsys)[0]["units"][0]["category"] == "date"
