import itertools
import json
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing, order, sampling, splits
from weftline.llm.tokens import counter

TARGETS = "category string, language string, status string, target_permille int, min_records int"


def test_swaps_reach_the_lowest_deviation():
    draw = random.Random(1)
    for _ in range(60):
        k = draw.randrange(2, 5)
        have = [draw.randrange(0, 7) for _ in range(k)]
        floors = [draw.randrange(0, 3) for _ in range(k)]
        size = draw.randrange(0, 9)
        goal = [draw.randrange(0, 6) for _ in range(k)]
        low = [min(f, h) for f, h in zip(floors, have, strict=True)]
        got = sampling.swap_repair(have, floors, goal, size, seed=draw.randrange(99))
        assert sum(got) == min(size, sum(have)) and all(0 <= g <= h for g, h in zip(got, have, strict=True))
        if sum(low) <= size:
            cost = lambda c: sum((x - g) ** 2 / max(1, g) for x, g in zip(c, goal, strict=True))
            every = [c for c in itertools.product(*(range(a, b + 1) for a, b in zip(low, have, strict=True))) if sum(c) == sum(got)]
            assert cost(got) <= min(map(cost, every)) + 1e-6


def test_stratified_sample(spark):
    rows = [(f"r{i:03}", c, l, s) for i, (c, l, s) in enumerate([(" Date", "EN", "gold")] * 60 + [("score percent", "de ", "no-change")] * 10 + [("music", "xx", "gold")] * 30 + [(None, "en", "gold")] * 5 + [("date", None, None)] * 5)]
    rows += rows[:7] + [(None, "date", "en", "gold")]
    targets = spark.createDataFrame([("date", "en", "gold", 500, 1), ("score_percent", "de", "no_change", 300, 2), ("isbn", "fr", "gold", 200, 3)], TARGETS)
    df = spark.createDataFrame(rows, "id string, category string, language string, status string").withColumn("rank", F.lit(1))
    s = sampling.Stratified(df, targets)
    assert s.size == 22 and {tuple(r) for r in s.shortfalls().collect()} == {("isbn", "fr", "gold")}
    report = {r.category: (r.needed, r.available, r.drawn, r.missing) for r in s.report().collect()}
    assert report["isbn"] == (5, 0, 0, 5) and sum(r[2] for r in report.values()) == 22 and report["score_percent"][2] >= 6
    sample = s.sample().collect()
    assert len(sample) == len({r.id for r in sample}) == 22 and sorted(r.id for r in sample) == sorted(r.id for r in sampling.Stratified(df.repartition(5), targets).sample().collect())
    nothing = sampling.Stratified(df.limit(0), targets)
    assert nothing.size == 0 and nothing.shortfalls().count() == 3 and nothing.sample().count() == 0
    assert sampling.Stratified(df, targets.limit(0), Fraction(1, 2)).sample().count() == 55


def test_leading_category(spark):
    df = spark.createDataFrame([([(5, "b"), (1, "a")],), ([(None, "z"), (9, "y")],), ([(3, "c"), (3, "b")],), ([],), (None,)], "u array<struct<start int, category string>>")
    assert [r.c for r in df.select(sampling.leading_category(F.col("u")).alias("c")).collect()] == ["a", "y", "b", None, None]


def test_running_sums_over_one_large_group(spark):
    rows = spark.range(3000).select(F.lit(None).cast("string").alias("k"), F.col("id"), (F.col("id") % 5).alias("w"), order.seeded(3, "id").alias("draw"))
    got = sorted((r.draw % 2**64, r.w, r.before) for r in order.running(rows, ["k"], "draw", ["id"], F.col("w"), "before").collect())
    total = 0
    for _, w, before in got:
        assert before == total
        total += w


REC = "id string, label string, family string, origin string, source_id string"


def _union_find(rows):
    up = {}
    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    items = {}
    for _, _, f, o, s in rows:
        if f is None or o is None or s is None or s.strip().lower() in splits.UNKNOWN_IDS:
            continue
        a, b = find(f), find(items.setdefault((o.lower(), s), f))
        up[max(a, b)] = min(a, b)
    return find


def test_families_that_belong_together(spark):
    draw = random.Random(8)
    rows = [(f"r{i}", draw.choice(["en", "de"]), draw.choice([f"f{i % 90:02}", None]), draw.choice(["S", "s", "t"]), draw.choice([f"u{draw.randrange(150)}", "n/a", "TBD", None, ""])) for i in range(400)]
    rows += [(f"c{i}", "en", f"chain{i // 2:03}", "s", f"link{(i + 1) // 2}") for i in range(120)] + rows[:9]
    df = spark.createDataFrame(rows, REC).withColumn("root", F.lit("clash"))
    find = _union_find(rows)
    groups = {}
    for r in rows:
        if r[2] is not None:
            groups.setdefault(find(r[2]), set()).add(r[2])
    want = {(f, min(g)) for g in groups.values() if len(g) > 1 for f in g}
    got = [tuple(r) for r in splits.family_groups(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    targets = spark.createDataFrame([("train", 700), ("dev", 150), ("test", 150)], "split_name string, target_permille int")
    assert {tuple(r) for r in splits.kept_together(df, targets).collect()} == want
    assigned = {r.id: r.split for r in splits.assigned_records(df, targets).collect()}
    assert set(assigned) == {r[0] for r in rows}
    by = {}
    for r in rows:
        by.setdefault(find(r[2]) if r[2] else r[0], set()).add(assigned[r[0]])
    assert all(len(s) == 1 for s in by.values())
    share = sum(s == "train" for s in assigned.values()) / len(assigned)
    assert abs(share - 0.7) < 0.03
    assert splits.family_groups(df.limit(0)).count() == 0 and splits.assigned_records(df.limit(0), targets).count() == 0
    assert {r.split for r in splits.assigned_records(df, targets.limit(0)).collect()} == {None}


@pytest.mark.parametrize("seed", range(5))
def test_allocation_places_every_component(seed):
    draw = random.Random(seed)
    bundles = [(s, label, draw.randrange(1, 40)) for s in (1, 2, 3, 7, 50) for label in "ab"] + [(draw.randrange(100, 900), "a", 1)]
    shares = {"dev": 0.15, "test": 0.15, "train": 0.7}
    out = splits.allocate(bundles, shares)
    assert {k: sum(v.values()) for k, v in out.items()} == {(s, label): n for s, label, n in bundles}
    total = sum(s * n for s, _, n in bundles)
    if max(s for s, _, _ in bundles) < 0.7 * total:
        for name, share in shares.items():
            assert abs(sum(k[0] * v[name] for k, v in out.items()) / total - share) < 0.02


@pytest.mark.parametrize("large", [[], [900], [500, 400, 30], [2600]])
def test_shares_hold_beside_large_components(large):
    draw = random.Random(len(large))
    bundles = [(n, draw.choice("abc"), 1) for n in large] + [(size, label, draw.randrange(1, 60)) for size in (1, 2, 3, 5, 8, 13) for label in "abc"]
    merged = {}
    for size, label, n in bundles:
        merged[size, label] = merged.get((size, label), 0) + n
    bundles = [(*k, n) for k, n in merged.items()]
    shares = {"dev": 0.15, "test": 0.15, "train": 0.7}
    out = splits.allocate(bundles, shares)
    total = sum(s * n for s, _, n in bundles)
    for name, share in shares.items():
        got = sum(k[0] * v[name] for k, v in out.items())
        assert abs(got - share * total) <= 2, (large, name)
    if not large:
        for label in "abc":
            mass = sum(s * n for s, at, n in bundles if at == label)
            for name, share in shares.items():
                assert abs(sum(k[0] * v[name] for k, v in out.items() if k[1] == label) - share * mass) <= 8


def test_flow_is_of_lowest_cost():
    flow = splits.Flow()
    edges = [flow.add(a, b, r, c) for a, b, r, c in (("s", "x", 4, 1), ("s", "y", 3, 2), ("x", "t", 2, 1), ("x", "y", 3, 1), ("y", "t", 5, 1))]
    flow.run("s", "t")
    assert [flow.through(e) for e in edges] == [4, 3, 2, 2, 5]


def test_mixture_keeps_caps_and_shares(spark):
    draw = random.Random(5)
    text = lambda: " ".join(draw.choice(["alpha", "beta", "gamma"]) for _ in range(draw.randrange(5, 30)))
    docs = [(i, text(), draw.choice(["a", "a", "a", "b", "c", "zz", None])) for i in range(400)]
    docs += [(1000 + i, t, "b") for i, (_, t, s) in enumerate(docs[:60]) if s == "a"] + [docs[0], (2000, None, "a"), (2001, "", "a"), (None, "x", "a")]
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.2, 3), ("c", 0.2, 1), ("none", 0.1, 4), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("tokens", F.lit(0)).withColumn("pattern", F.lit("clash"))
    chosen, report = mixing.mixture(df, targets)
    rows = chosen.collect()
    caps, known = {"a": 2, "b": 3, "c": 1}, {d: (t, s) for d, t, s in docs}
    count = counter().count
    assert all(1 <= r.repeats <= caps[r.source] and known[r.doc_id][1] == r.source and r.tokens == count(known[r.doc_id][0]) for r in rows)
    assert len({(r.source, r.doc_id) for r in rows}) == len(rows)
    by = {r.source: r for r in report.collect()}
    assert by["none"].tokens == 0 and set(by) == {"a", "b", "c", "none"}
    for s in caps:
        assert abs(by[s].tokens - by[s].quota_tokens) <= 60
    assert abs(sum(r.actual_share for r in by.values()) - 1) < 1e-9
    again = mixing.mixture(df.repartition(3), targets)[0].collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    for d, t in ((df.limit(0), targets), (df, targets.limit(0))):
        empty = mixing.mixture(d, t)
        assert empty[0].count() == 0 and all(r.tokens == 0 for r in empty[1].collect())


def test_repeats_are_used_last():
    targets = {"a": (0.5, 3), "b": (0.5, 3)}
    flows = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 10}, targets, 200)
    assert flows[("a",), "a"] == 100 and flows.get((("a", "b"), "b"), 0) + flows.get((("b",), "b"), 0) == 100
    assert flows.get((("b",), "b"), 0) <= 10 and flows.get((("a", "b"), "b"), 0) <= 100
    assert json.dumps(mixing.reachable_total({("a",): 10}, {"a": (0.5, 2), "b": (0.5, 9)})) == "40"


def test_best_fill():
    draw = random.Random(2)
    for _ in range(50):
        sizes = [draw.randrange(1, 30) for _ in range(draw.randrange(0, 9))]
        room = draw.randrange(0, 90)
        got = mixing.best_fill(sizes, room)
        best = max(t for k in range(len(sizes) + 1) for c in itertools.combinations(sizes, k) if (t := sum(c)) <= room)
        assert len(set(got)) == len(got) and sum(sizes[i] for i in got) == best


def test_long_texts_do_not_make_a_source_miss_its_share(spark):
    draw = random.Random(4)
    docs = [(i, " ".join(draw.choice(["alpha", "beta", "gamma"]) for _ in range(draw.choice([3, 20, 60, 3000]))), "a") for i in range(200)]
    docs += [(500 + i, f"{i} " + "delta " * 30, "b") for i in range(20)]
    docs += [(700 + i, "one text that a third of all rows have", "c") for i in range(110)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.3, 1), ("c", 0.4, 2)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mixture(df, targets)
    by = {r.source: r for r in report.collect()}
    for s in "abc":
        assert 0.98 * by[s].quota_tokens <= by[s].tokens <= by[s].quota_tokens, by
    assert by["c"].available_tokens == 110 * counter().count(docs[-1][1])
    rows = chosen.collect()
    assert all(r.repeats <= {"a": 1, "b": 1, "c": 2}[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
