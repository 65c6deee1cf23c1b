import random

import pytest

from weftline.llm import formatting, lookalike
from weftline.llm.textform import fold

FORMS = ["cafe", "café", "café", "ｃafe", "cаfe", "ca​fe", "CAFE", "ca fe", "ca fe", "ca  fe", "cafe.", "ca-fe", "ca–fe", "", "​", None, "ca\tfe", "ΑΒ", "AB", "ÁB", "ΆB", "x" * 70_000, "x" * 70_000 + "⁠"]


def test_look_alike_pairs_match_folding(spark):
    rows = [(f, f"{f}{i:02}", t) for f in "pq" for i, t in enumerate(FORMS * 2)] + [("p", "p00", FORMS[0]), ("p", None, "cafe")]
    df = spark.createDataFrame(rows, "field_name string, id string, text string").selectExpr("*", "1 AS form", "2 AS canonical")
    got = [tuple(r) for r in lookalike.look_alike_pairs(df).collect()]
    known = sorted({r for r in rows if r[1] and r[2] is not None})
    want = {(a[0], a[1], b[1]) for a in known for b in known if a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and fold(a[2]) == fold(b[2])}
    assert len(got) == len(set(got)) and set(got) == want
    canonical = {(r.field_name, r.id): r.canonical for r in lookalike.canonical_texts(df).collect()}
    by_fold = {}
    for f, i, t in known:
        by_fold.setdefault((f, fold(t)), set()).add(canonical[f, i])
    assert all(len(v) == 1 for v in by_fold.values()) and canonical["p", "p15"] is None
    assert len({next(iter(v)) for (f, _), v in by_fold.items() if f == "p"}) == len([k for k in by_fold if k[0] == "p"])
    assert lookalike.look_alike_pairs(df.limit(0)).count() == 0


def test_one_form_over_all_fields(spark):
    rows = [("p", "1", "cafe\u0301"), ("q", "2", "caf\u00e9"), ("q", "3", "ne\u0301"), ("p", "4", "a\x01b"), ("p", "5", "ab"), ("p", "6", "\u212b"), ("q", "7", None)]
    df = spark.createDataFrame(rows, "field_name string, id string, text string")
    canonical = {r.id: (r.canonical, r.changed) for r in lookalike.canonical_texts(df).collect()}
    assert canonical == {"1": ("caf\u00e9", True), "2": ("caf\u00e9", False), "3": ("n\u00e9", True), "4": ("a\x01b", False), "5": ("ab", False), "6": ("\u00c5", True), "7": (None, False)}
    assert lookalike.look_alike_pairs(df).count() == 0


def test_canonical_form_of_punctuation():
    cases = {"-13 a-b 3,4 x, y 1-2 'q' (5)": "-13ab3,4xy1-2q5", "a -3": "a-3", "- 3": "3", "3 , 4": "34", "133–140": "133–140", "3.": "3", "x-3": "x3", "“A” b C!": "abc", "": "", " . ": "", "５，６": "5,6"}
    for t, want in cases.items():
        assert formatting.canonical(t) == want


SCHEMA = "id string, language string, input string"


@pytest.mark.parametrize("bucket_rows", [2, 20, 100_000])
def test_copies_for_any_bucket_size(spark, bucket_rows):
    draw = random.Random(7)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(40))) for _ in range(30)] + ["shared prefix " * 4 + c for c in "abcde"]
    rows = [(f"r{i:03}", draw.choice(["en", "de"]), draw.choice(texts).replace("a", draw.choice(["a", "A", " a", "ａ"]))) for i in range(250)]
    rows += [(f"h{i:03}", "en", "hot text") for i in range(150)] + [("n", "en", None), (None, "en", "x"), ("m", None, "x"), rows[0], ("e1", "en", ""), ("e2", "en", " .")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS key", "'clash' AS bucket")
    got = [tuple(r) for r in formatting.copies(df, bucket_rows).collect()]
    groups = {}
    for i, lang, t in rows:
        if i and t is not None:
            groups.setdefault((lang or "", formatting.canonical(t)), set()).add(i)
    assert len(got) == len(set(got)) and set(got) == {(min(g), i) for g in groups.values() for i in g if i != min(g)}
    counts = {r.id: r.copies for r in formatting.collapsed(df, bucket_rows).collect()}
    assert counts == {min(g): len(g) for g in groups.values()}


def test_radix_plan_splits_until_buckets_fit(spark):
    rows = spark.createDataFrame([(f"i{k}", bytearray(f"en\0same start of all keys {k:04}".encode())) for k in range(300)] + [(f"z{k}", bytearray(b"hot")) for k in range(50)], "id string, key binary")
    plan = formatting.radix_plan(rows, 20, first=4)
    assert plan.hot == {b"hot": "z0"} and len(plan.levels) > 2
    sizes = {}
    for r in rows.collect():
        if bytes(r.key) not in plan.hot:
            b = formatting.bucket_of(bytes(r.key), plan)
            sizes[b] = sizes.get(b, 0) + 1
    assert max(sizes.values()) <= 20


def test_empty_table(spark):
    assert formatting.copies(spark.createDataFrame([], SCHEMA)).count() == 0
