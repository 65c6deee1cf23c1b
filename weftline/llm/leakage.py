"""Evaluation passages inside training documents (problem 7).

Every run of ``MIN_WORDS`` consecutive words of the evaluation items is a pattern of one Aho-Corasick automaton. Words of
the items are its letters, each coded as two characters of two small alphabets, as the automaton's nodes look through
their children one by one. A document's words are looked up once; the automaton reads what is left of it in runs of
known words that are long enough. Hits are joined into spans of words and mapped back to offsets of the original text.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from weftline.llm.textform import words, words_with_offsets

MIN_WORDS = 12
#: Characters of items in one automaton. More items make further blocks, each with a broadcast and an automaton of this bound.
BLOCK_CHARS = 4_000_000
#: Arrow bytes of documents that a task holds while it goes from automaton to automaton.
HELD_BYTES = 64_000_000
_OTHER = "\x01\x01"


class Passages:
    """The automaton and its vocabulary. Built where it is used, as it is larger than the items it is built from."""

    def __init__(self, items: list[tuple[int, str]], least: int = MIN_WORDS) -> None:
        self.least = least
        tokens = [(item, words(text)) for item, text in items]
        vocabulary = sorted({w for _, t in tokens for w in t})
        base = math.isqrt(len(vocabulary)) + 1
        self.letters = {w: chr(2 + i // base) + chr(2 + base + i % base) for i, w in enumerate(vocabulary)}
        self.known = re.compile(f"[^\x01]{{{2 * least},}}")
        where: dict[str, list[tuple[int, int]]] = {}
        for item, t in tokens:
            coded = "".join(self.letters[w] for w in t)
            for at in range(len(t) - least + 1):
                where.setdefault(coded[2 * at : 2 * (at + least)], []).append((item, at))
        self.automaton = ahocorasick.Automaton()
        for pattern, owners in where.items():
            self.automaton.add_word(pattern, owners)
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item, first word, words, place in the item)`` of the maximal common runs of the text with each item."""
        if self.empty or not text:
            return []
        get = self.letters.get
        coded = "".join([get(w, _OTHER) for w in words(text)])
        runs: dict[tuple[int, int], list[int]] = {}
        out = []
        for known in self.known.finditer(coded):
            for end, owners in self.automaton.iter(coded, known.start(), known.end()):
                start = end // 2 - self.least + 1
                for item, place in owners:
                    run = runs.get((item, start - place))
                    if run and start <= run[0] + run[1] - self.least + 1:
                        run[1] = start + self.least - run[0]
                    else:
                        run = runs[item, start - place] = [start, self.least, place]
                        out.append((item, run))
        return sorted((item, *run) for item, run in out)


#: The automaton a worker built last, by the name its block got when it was broadcast.
_LAST: dict[str, Passages] = {}


def _passages(name: str, items: Broadcast, least: int) -> Passages:
    if name not in _LAST:
        _LAST.clear()  # one at a time: it is larger than its block
        _LAST[name] = Passages(items.value, least)
    return _LAST[name]


def _found(passages: Passages, b: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
        found = passages.spans(text)
        if not found:
            continue
        offsets = words_with_offsets(text)
        rows += [(item, doc, start, n, place, offsets[start][1], offsets[start + n - 1][2]) for item, start, n, place in found]
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.int32()] * 5, strict=True)], names=["item_id", "doc_id", "first_word", "n_words", "item_word", "start", "end"])


def _scan(blocks: list[tuple[str, Broadcast]], least: int, held_bytes: int = HELD_BYTES):
    """One pass over the documents. With several blocks a stretch of documents is held and read by one automaton after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        forward = True

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal forward
            for name, items in blocks if forward else blocks[::-1]:  # the automaton at hand is used again
                passages = _passages(name, items, least)
                for b in held:
                    yield _found(passages, b)
            forward = not forward

        for b in batches:
            held.append(b)
            size += b.nbytes
            if len(blocks) == 1 or size >= held_bytes:
                yield from emit()
                held, size = [], 0
        if held:
            yield from emit()

    return run


SPANS = "item_id bigint, doc_id bigint, first_word int, n_words int, item_word int, start int, `end` int"


def _blocks(items: DataFrame, block_chars: int) -> list[tuple[str, Broadcast]]:
    """The items in broadcasts of bounded size. They stream through the driver, which holds one block at a time."""
    context = items.sparkSession.sparkContext
    out: list[tuple[str, Broadcast]] = []
    block: list[tuple[int, str]] = []
    size = 0

    def close() -> None:
        out.append((uuid.uuid4().hex, context.broadcast(block)))

    for item, text in items.select("item_id", "text").where("text is not null and item_id is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        if size + len(text) > block_chars and block:
            close()
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    close()
    return out


def leaked_spans(documents: DataFrame, items: DataFrame, least: int = MIN_WORDS, block_chars: int = BLOCK_CHARS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Maximal runs of at least ``least`` words that a document shares with an item, with their offsets in ``text``.

    Null and empty texts and items of fewer words hold no run; repeated rows of a document give the same rows once.
    Letter case, punctuation, spacing and look-alike differences do not matter. Documents are read once, however many
    blocks the items fill. An empty table gives no rows.
    """
    rows = documents.select("doc_id", "text").where("text is not null and doc_id is not null")
    return rows.mapInArrow(_scan(_blocks(items, block_chars), least, held_bytes), SPANS).distinct()


def leaks(documents: DataFrame, items: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Each document and item that share such a run, once."""
    return leaked_spans(documents, items, least).select("item_id", "doc_id").distinct()
