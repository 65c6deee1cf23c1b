import random

import pytest

from weftline.llm import leakage
from weftline.llm.textform import words


def _data(seed):
    draw = random.Random(seed)
    items = [(i, " ".join(draw.choice("abcdefghij") + draw.choice("xyz") for _ in range(draw.randrange(5, 40)))) for i in range(12)] + [(99, None), (98, "")]
    docs = []
    for d in range(60):
        parts = [draw.choice("pqr") for _ in range(draw.randrange(10))]
        i, t = draw.choice(items[:12])
        w = t.split()
        at = draw.randrange(len(w))
        parts += [x.upper() if draw.random() < 0.3 else x + draw.choice(["", ",", "​", " -"]) for x in w[at : at + draw.randrange(4, 30)]]
        docs.append((d, " ".join(parts + ["end"])))
    return docs + [(100, None), (101, ""), docs[0], (102, " ".join(items[0][1].split() * 3))], items


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_spans_match_brute_force(spark, block):
    docs, items = _data(3)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' AS item_id")
    e = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS doc_id")
    spans = leakage.leaked_spans(d, e, block_chars=block, held_bytes=500).collect()
    texts, want, runs = dict(docs), set(), set()
    for doc, t in set(docs):
        w = words(t or "")
        for item, u in items:
            v = words(u or "")
            for a in range(len(w)):
                for b in range(len(v)):
                    if a and b and w[a - 1] == v[b - 1]:
                        continue
                    n = 0
                    while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                        n += 1
                    if n >= 12:
                        want.add((item, doc))
                        runs.add((item, doc, a, n, b))
    assert {(s.item_id, s.doc_id) for s in spans} == want and want
    assert {(s.item_id, s.doc_id, s.first_word, s.n_words, s.item_word) for s in spans} == runs and len(spans) == len(runs)
    for s in spans:
        assert words(texts[s.doc_id][s.start : s.end]) == words(texts[s.doc_id])[s.first_word : s.first_word + s.n_words]


def test_nothing_to_find(spark):
    docs, items = _data(4)
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert leakage.leaks(d, e.limit(0)).count() == 0 and leakage.leaks(d.limit(0), e).count() == 0
    assert leakage.leaks(d, e.where("item_id >= 98")).count() == 0


def test_a_later_query_has_its_own_automaton(spark):
    """Blocks of equal place and size in one worker after another: the automaton belongs to its broadcast."""
    for i in range(4):
        text = " ".join(f"w{i}x{k}" for k in range(14))
        d = spark.createDataFrame([(i, text)], "doc_id bigint, text string")
        e = spark.createDataFrame([(7, text)], "item_id bigint, text string")
        assert [tuple(r) for r in leakage.leaks(d, e).collect()] == [(7, i)]
