import random

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import overlap


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def _texts(seed, n):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        base = draw.choice(out).split() if out and draw.random() < 0.5 else [draw.choice("abcdefgh") for _ in range(draw.randrange(0, 14))]
        for _ in range(draw.randrange(4)):
            k = draw.randrange(len(base) + 1)
            base = [base[:k] + ["z"] + base[k:], base[:k] + base[k + 1 :], base[:k] + ["y"] + base[k + 1 :]][draw.randrange(3)]
        out.append(" ".join(base))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_shard_finds_all_pairs_within_the_bound(seed):
    texts = _texts(seed, 120)
    cell = np.array([hash(t) % 2 for t in range(120)])
    is_eval = np.array([random.Random(seed + i).random() < 0.5 for i in range(120)])
    t, e = overlap.search_shard(cell, is_eval, pa.array(texts))
    want = {(i, j) for i in range(120) for j in range(120) if not is_eval[i] and is_eval[j] and cell[i] == cell[j] and _edits(texts[i].split(), texts[j].split()) <= 3}
    assert set(zip(t.tolist(), e.tolist(), strict=True)) == want


@pytest.mark.parametrize("most", [1, 3, 50])
def test_cuts_between_located_seeds_lose_no_pair(monkeypatch, most):
    monkeypatch.setattr(overlap, "_slices", lambda size, _, cut=overlap._slices: cut(size, most))
    texts = _texts(5, 100) + ["a b c d e f g", "a b c x e f g"]
    is_eval = np.array([i % 2 == 1 for i in range(102)])
    t, e = overlap.search_shard(np.zeros(102, np.int64), is_eval, pa.array(texts))
    want = {(i, j) for i in range(0, 102, 2) for j in range(1, 102, 2) if _edits(texts[i].split(), texts[j].split()) <= 3}
    assert set(zip(t.tolist(), e.tolist(), strict=True)) == want and (100, 101) in want


def test_index_counts_and_locates():
    draw = np.random.default_rng(1)
    symbols = np.where(draw.random(400) < 0.1, 0, draw.integers(1, 5, 400))
    symbols[-1] = 0
    index = overlap.FmIndex(symbols)
    for pattern in ([1], [2, 3], [1, 1, 2], [4, 4, 4, 4]):
        low, high = np.array([0]), np.array([400])
        for s in reversed(pattern):
            low, high = index.step(np.array([s]), low, high)
        want = [i for i in range(400 - len(pattern)) if symbols[i : i + len(pattern)].tolist() == pattern]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_within_edits_agrees_with_the_full_table():
    draw = random.Random(2)
    for _ in range(500):
        a, b = ([draw.choice("abc") for _ in range(draw.randrange(8))] for _ in "ab")
        assert overlap.within_edits(a, b) == (_edits(a, b) <= 3)


SCHEMA = "id string, split string, origin string, input string"


def test_pairs_over_crowded_digits_ties_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(overlap, "CELL_TEXTS", 5)
    monkeypatch.setattr(overlap, "BLOCK_TEXTS", 7)
    texts = _texts(11, 90)
    draw = random.Random(4)
    rows = [(f"r{i:02}", draw.choice(["train", " Train", "DEV ", "test", "candidate", None]), "s", t + draw.choice(["", "!", " 7", "  ７"])) for i, t in enumerate(texts)]
    rows += [("n1", "train", "s", None), ("n2", "dev", "s", ""), ("n3", "train", "s", "..."), (None, "train", "s", "x"), rows[0], rows[1]]
    got = [tuple(r) for r in overlap.overlap_ids(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tid", "2 AS cell")).collect()]
    known = {r[0]: ((r[1] or "").strip().lower(), overlap.words(r[3])) for r in rows if r[0] and r[3] is not None}
    digits = {k: overlap.digits_of("".join(v[1])) for k, v in known.items()}
    want = {tuple(sorted((a, b))) for a in known for b in known if known[a][0] == "train" and known[b][0] in overlap.EVALUATION_SPLITS and digits[a] == digits[b] and _edits(known[a][1], known[b][1]) <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_very_long_texts_and_empty_tables(spark):
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    rows = [("a", "train", "s", long), ("b", "dev", "s", long.replace("w5 ", "v ", 2)), ("c", "test", "s", long + " x y z q")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in overlap.overlap_ids(df).collect()] == []  # v has no digit
    assert overlap.overlap_ids(spark.createDataFrame([rows[0], ("b", "dev", "s", long.upper() + " x y z")], SCHEMA)).count() == 1
    assert overlap.overlap_ids(df.limit(0)).count() == 0 and overlap.overlap_report(df.limit(0)).count() == 0
