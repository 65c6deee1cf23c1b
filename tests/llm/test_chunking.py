import random

import numpy as np
import pytest

from weftline.llm import chunking
from weftline.llm.tokens import _FAST, _ODD, _SLOW, counter

LIMITS = "plan string, max_tokens int, overlap_tokens int"


def _texts(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeéž漢😀") for _ in range(draw.randrange(1, 9)))
    out = [" ".join(word() + draw.choice(["", "", "", ".", "!\n", "\n\n", ",", "  "]) for _ in range(draw.randrange(300))) for _ in range(25)]
    return out + ["x" * 5000, "漢" * 900, "", None, "short", "\n" * 700, "a. " * 600, "²½" * 200 + "\x1c"]


@pytest.mark.parametrize(("limit", "overlap"), [(32, 0), (32, 8), (50, 20), (5, 1), (4, 3), (1, 0)])
def test_pieces_cover_the_text_within_the_limit(spark, limit, overlap):
    texts = _texts(limit)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'clash' AS plan")
    plans = spark.createDataFrame([("p", limit, overlap), ("off", 0, 0), (None, None, None)], LIMITS)
    c = counter()
    size = lambda t: len(c.encoding.encode_ordinary(t))
    by = {}
    for r in chunking.split_texts(df, plans).collect():
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {i for i, t in enumerate(texts) if t and c.count(t) > limit}
    for i, rows in by.items():
        rows.sort(key=lambda r: r.piece_no)
        assert [r.piece_no for r in rows] == list(range(len(rows))) and rows[0].start == 0 and rows[-1].end == len(texts[i])
        for r in rows:
            assert r.text == texts[i][r.start : r.end] and r.text
            assert size(r.text) <= max(limit, 4) and r.tokens <= max(limit, 4)
        for a, b in zip(rows, rows[1:], strict=False):
            assert a.start < b.start <= a.end < b.end, (a, b)


def test_overlap_is_at_least_the_one_asked_for(spark):
    text = " ".join(f"word{i}." if i % 9 == 0 else "plain" for i in range(900))
    rows = chunking.split_texts(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), spark.createDataFrame([("p", 64, 16)], LIMITS)).orderBy("piece_no").collect()
    assert len(rows) > 5 and all(16 <= r.shared_tokens <= 19 for r in rows[1:])
    assert all(r.text.rstrip().endswith(".") for r in rows[:-1])


def test_cuts_equal_a_greedy_loop():
    draw = np.random.default_rng(3)
    for _ in range(40):
        counts = [int(n) for n in draw.integers(1, 60, 3)]
        begin = np.concatenate([[0], np.cumsum(counts)])
        tokens = draw.integers(1, 4, begin[-1])
        natural = draw.random(begin[-1] + 3) < 0.2
        start, end = chunking.cuts(tokens, natural, begin, 12, 4)
        want = []
        for i, n in enumerate(counts):
            base, own = begin[i] + i, tokens[begin[i] : begin[i + 1]]
            total = np.concatenate([[0], np.cumsum(own)])
            at = 0
            while True:
                far = lambda b: max(k for k in range(n + 1) if total[k] <= total[b] + 12)
                reach = far(at)
                back = lambda e: max(k for k in range(e + 1) if total[k] <= max(0, total[e] - 4))
                done = max(k for k in range(n + 1) if total[k] < total[at + 1] + 4)
                stops = [k for k in range(done + 1, reach + 1) if natural[base + k]]
                stop = reach if reach == n else stops[-1] if stops and back(stops[-1]) > at else reach
                want.append((base + at, base + stop))
                if stop == n:
                    break
                at = back(stop) if back(stop) > at and far(back(stop)) > stop else stop
        assert list(zip(start.tolist(), end.tolist(), strict=True)) == want


def test_whole_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    plans = spark.createDataFrame([("p", 50, 5)], LIMITS)
    assert chunking.split_texts(df, plans).count() == 0
    assert [r.text for r in chunking.split_texts(df, plans, include_short=True).collect()] == ["a b c"]
    assert chunking.split_texts(df.limit(0), plans).count() == 0 and chunking.split_texts(df, plans.limit(0)).count() == 0


def test_counts_are_the_tokenizer_s():
    draw = random.Random(6)
    c = counter()
    for _ in range(3000):
        t = "".join(draw.choice("ab1 .,\n'sé½٣_ 　²漢é́😀\x1c‍") for _ in range(12))
        assert c.count(t) == len(c.encoding.encode_ordinary(t))
        assert _ODD.search(t) or _FAST.findall(t) == _SLOW.findall(t)


def test_large_overlaps_are_kept_or_refused(spark):
    text = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(1, text), (2, "漢" * 300)], "doc_id bigint, text string")
    rows = chunking.split_texts(df, spark.createDataFrame([("p", 16, 14)], LIMITS)).orderBy("doc_id", "piece_no").collect()
    plain = [r for r in rows if r.doc_id == 1]
    assert len(plain) > 50 and all(r.shared_tokens >= 14 for r in plain[1:]) and all(r.tokens <= 16 for r in plain)
    assert all(r.shared_tokens >= 11 for r in rows if r.piece_no)  # a character of three tokens takes the rest
    with pytest.raises(ValueError):
        chunking.split_texts(df, spark.createDataFrame([("p", 16, 16)], LIMITS))
