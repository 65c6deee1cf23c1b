"""Splitting oversized texts at natural boundaries (problem 9).

Boundaries lie between the tokenizer's pieces. Each boundary is joined to its farthest legal successor: the start of the
next piece if one began here, that is the farthest sentence or line end within the limit (else the farthest word end) less
the overlap. The successor table is squared again and again, each time doubling the cuts known, for all texts of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.tokens import BEGINS_SPACE, ENDS_SENTENCE, HAS_NEWLINE, VOCABULARY, Counter, counter

#: Pieces of text worked on at once, over all texts of a batch; a longer text is on its own.
BATCH_PIECES = 2_000_000


def atoms(pieces: list[str], codes: list[int], most: int, count: Counter) -> tuple[list[str], list[int]]:
    """Pieces of over ``most`` tokens cut into runs of characters of at most that many bytes, hence tokens."""
    out, out_codes = [], []
    for piece, code in zip(pieces, codes, strict=True):
        if code >> 3 <= most:
            out.append(piece)
            out_codes.append(code)
            continue
        run, size = [], 0
        cut = []
        for c in piece:
            width = len(c.encode("utf-8", "surrogatepass"))
            if run and size + width > most:
                cut.append("".join(run))
                run, size = [], 0
            run.append(c)
            size += width
        cut.append("".join(run))
        flags = [0] * (len(cut) - 1) + [code & 7]
        out += cut
        out_codes += [(n >> 3 << 3) | f for n, f in zip(count.codes(cut), flags, strict=True)]
    return out, out_codes


def cuts(tokens: np.ndarray, natural: np.ndarray, begin: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all texts, as boundary numbers.

    Text i has the atoms begin[i] to begin[i + 1]; boundary k lies before atom k, the end of a text being its own boundary
    begin[i + 1] + i. ``natural[k]`` says whether a piece had best end at boundary k.
    """
    n_texts = len(begin) - 1
    ends = begin[1:] + np.arange(n_texts)  # boundaries: one more than atoms in each text
    firsts = np.concatenate([[0], ends[:-1] + 1])
    size = int(ends[-1]) + 1
    step = np.zeros(size, np.int64)
    inner = np.ones(size, bool)
    inner[ends] = False
    step[inner] = tokens
    place = np.cumsum(step) - step  # tokens before a boundary, over all texts
    last = np.repeat(ends, ends - firsts + 1)
    here = np.arange(size)
    reach = np.minimum(np.searchsorted(place, place + limit, "right") - 1, last)
    reach = np.maximum(reach, np.minimum(here + 1, last))
    stop = np.maximum.accumulate(np.where(natural, here, -1))[reach]
    back = lambda e: np.searchsorted(place, place[e] - overlap, "right") - 1
    first = np.repeat(firsts, ends - firsts + 1)
    resume = np.maximum(back(np.maximum(stop, 0)), first)
    # a piece that begins here may follow one that ended as far as this, and has to get beyond it
    done = np.searchsorted(place, place[np.minimum(here + 1, last)] + overlap, "left") - 1
    end = np.where((stop > done) & (resume > here), stop, reach)
    end = np.where(reach == last, last, end)  # what is left fits in one piece
    resume = np.maximum(back(end), first)
    # the next piece has to get beyond ``end``: where the overlap leaves no room for a wide character it shares what it can
    resume = np.maximum(np.maximum(resume, here + 1), np.searchsorted(reach, end + 1))
    succ = np.where(end == last, last, resume)
    known = firsts[firsts < ends]
    table = succ
    while True:  # squaring: known holds the first 2^k starts of each text
        more = table[known]
        more = more[more < last[more]]
        both = np.unique(np.concatenate([known, more]))
        if len(both) == len(known):
            return known, end[known]
        known, table = both, table[table]


def _pieces(batch: list[tuple[int, str]], plans: list[tuple[str, int, int]], vocabulary: str, include_short: bool) -> Iterator[pa.RecordBatch]:
    count = counter(vocabulary)
    found = [(doc, text, count.pieces(text)) for doc, text in batch]
    coded = [count.codes(p) for _, _, p in found]
    sums = [sum(c >> 3 for c in codes) for codes in coded]
    for plan, limit, overlap in plans:
        most = max(1, (limit - overlap - 1) // 2)
        docs, parts, codes = [], [], []
        for (doc, text, pieces), own, n in zip(found, coded, sums, strict=True):
            if n > limit or include_short:
                p, c = atoms(pieces, own, most, count) if max(own, default=0) >> 3 > most else (pieces, own)
                docs.append((doc, text))
                parts.append(p)
                codes.append(c)
        if not docs:
            continue
        begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        code = np.concatenate([np.asarray(c, np.int64) for c in codes])
        width = np.concatenate([np.fromiter(map(len, p), np.int64, len(p)) for p in parts])
        shift = np.repeat(np.arange(len(docs)), np.diff(begin))  # a text's boundaries are one more than its atoms
        natural = np.zeros(len(code) + len(docs), bool)
        newline = (code & HAS_NEWLINE) > 0
        sentence = (code & ENDS_SENTENCE) > 0
        spaced = np.zeros(len(code), bool)
        spaced[:-1] = (code[1:] & BEGINS_SPACE) > 0
        spaced[begin[1:][begin[1:] > 0] - 1] = True
        natural[np.arange(len(code)) + shift + 1] = newline | (sentence & spaced)
        start, end = cuts(code >> 3, natural, begin, limit, overlap)
        ends = begin[1:] + np.arange(len(docs))
        text_of = np.searchsorted(ends, start)
        step = np.zeros(len(natural), np.int64)
        inner = np.ones(len(natural), bool)
        inner[ends] = False
        step[inner] = code >> 3
        tokens_at = np.cumsum(step) - step
        step[inner] = width
        chars_at = np.cumsum(step) - step
        firsts = np.concatenate([[0], ends[:-1] + 1])
        low, high = chars_at[start] - chars_at[firsts[text_of]], chars_at[end] - chars_at[firsts[text_of]]
        number = np.arange(len(start)) - np.searchsorted(text_of, text_of)
        shared = np.where(number > 0, tokens_at[np.concatenate([[0], end[:-1]])] - tokens_at[start], 0)
        columns = [
            pa.array([plan] * len(start), pa.string()), pa.array([docs[t][0] for t in text_of.tolist()], pa.int64()), pa.array(number, pa.int32()), pa.array(low, pa.int32()), pa.array(high, pa.int32()),
            pa.array(tokens_at[end] - tokens_at[start], pa.int32()), pa.array(shared, pa.int32()), pa.array([docs[t][1][a:b] for t, a, b in zip(text_of.tolist(), low.tolist(), high.tolist(), strict=True)], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["plan", "doc_id", "piece_no", "start", "end", "tokens", "shared_tokens", "text"])


SCHEMA = "plan string, doc_id bigint, piece_no int, start int, `end` int, tokens int, shared_tokens int, text string"


def split_texts(documents: DataFrame, limits: DataFrame, vocabulary: str = VOCABULARY, include_short: bool = False) -> DataFrame:
    """Pieces of each document longer than a plan's ``max_tokens``: place in the text, tokens, tokens shared with the one before.

    A piece begins at the last boundary that leaves at least ``overlap_tokens`` to the end of the piece before it. A word of
    more than half of ``max_tokens - overlap_tokens`` tokens has boundaries inside, between characters. Null and empty texts
    have no pieces; ``include_short`` gives texts within the limit as one piece. ``limits`` is a few rows; those with a null
    limit are left out, a null or negative overlap is none. An overlap is kept between all pieces: a plan whose limit does not
    exceed it by ``LEAST_ROOM`` is an error.
    """
    plans = [(r.plan, r.max_tokens, max(r.overlap_tokens or 0, 0)) for r in limits.where("max_tokens > 0").select("plan", "max_tokens", "overlap_tokens").distinct().orderBy("plan", "max_tokens", "overlap_tokens").collect()]
    for plan, limit, overlap in plans:
        if overlap >= limit:
            raise ValueError(f"plan {plan}: an overlap of {overlap} tokens in pieces of at most {limit}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                held.append((doc, text))
                size += len(text)
                if size > BATCH_PIECES or len(held) >= 1000:
                    yield from _pieces(held, plans, vocabulary, include_short)
                    held, size = [], 0
        if held:
            yield from _pieces(held, plans, vocabulary, include_short)

    return documents.where("text is not null and text <> ''").select("doc_id", "text").mapInArrow(run, SCHEMA)
