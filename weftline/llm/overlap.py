"""Same or nearly same inputs across splits (problem 1).

Evaluation texts are indexed in shards by a compressed full-text index over word symbols; training texts are streamed
through backward search. Every seed occurrence is located, seeds on one diagonal are merged into maximal matches, their
covered words are counted, and pairs that can still be within the edit bound are verified exactly.

Sharding. Only texts with equal digit strings can match, so the digit string is the shard key. A digit string with many
texts is split by its texts' rarest-looking words instead: texts within ``edits`` word edits share one of their first
``edits + 1`` words in any fixed order of words. Cells that are still large are cut into blocks on both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.textform import digits_of, words
from weftline.plans.runtime import stage

EDITS = 3
EVALUATION_SPLITS = ("dev", "test", "challenge", "judge_gold")
#: Texts of one digit string up to which it is one cell, and texts of one side in a block of a larger cell.
CELL_TEXTS = 1_000
BLOCK_TEXTS = 4_000
#: Word symbols gathered before an index shard is built.
SHARD_SYMBOLS = 400_000
#: Seed occurrences located at once.
HITS = 2_000_000
SAMPLE = 8


def _key(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def shard_keys(digits: str, tokens: list[str], edits: int = EDITS) -> list[int]:
    """Keys of the cells of a text whose digit string is crowded: long words first, as they are the rarer ones."""
    seen: dict[str, int] = {}
    numbered = []
    for w in tokens:
        seen[w] = seen.get(w, 0) + 1
        numbered.append((-len(w), w, seen[w]))
    keys = [_key(digits, w, str(i)) for _, w, i in sorted(numbered)[: edits + 1]]
    return [*keys, _key(digits, "")] if len(tokens) <= edits else keys


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {"tid": [], "norm": [], "n": [], "base": [], "keys": []}
        for text in b.column("input").to_pylist():
            tokens = words(text)
            norm = " ".join(tokens)
            digits = digits_of(norm)
            out["tid"].append(hashlib.blake2b(norm.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            out["norm"].append(norm)
            out["n"].append(len(tokens))
            out["base"].append(_key(digits))
            out["keys"].append(shard_keys(digits, tokens))
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in ("id", "split", "origin")]
            + [pa.array(out["tid"], pa.binary()), pa.array(out["norm"], pa.string()), pa.array(out["n"], pa.int32()), pa.array(out["base"], pa.int64()), pa.array(out["keys"], pa.list_(pa.int64()))],
            names=["id", "split", "origin", "tid", "norm", "n", "base", "keys"],
        )


class FmIndex:
    """Full-text index of symbol sequences: ranks by position lists of the Burrows-Wheeler transform, sampled suffix array.

    Each of the texts ends in the separator 0, which no query holds. ``order`` packs (symbol, position in the transform),
    so that a search for (c, i) in it gives C[c] + occ(c, i) at once, for any number of queries.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        suffixes = _suffix_array(symbols)
        transform = symbols[suffixes - 1]
        self.size = np.int64(n + 1)
        self.transform = transform.astype(np.int32)
        self.order = np.sort(transform.astype(np.int64) * self.size + np.arange(n))
        kept = (suffixes % SAMPLE == 0) | (transform == 0)  # also each text's first symbol, so no walk crosses a separator
        self.marked = kept
        self.rank = np.cumsum(kept, dtype=np.int64) - kept
        self.samples = suffixes[kept].astype(np.int32)
        self.n = n

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Extend each match [low, high) by one symbol to the left."""
        base = symbol * self.size
        return np.searchsorted(self.order, base + low), np.searchsorted(self.order, base + high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array, by walking left to the next sample."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            done = self.marked[at[todo]]
            hit = todo[done]
            out[hit] = (self.samples[self.rank[at[hit]]] + steps[hit]) % self.n
            todo = todo[~done]
            here = at[todo]
            at[todo] = np.searchsorted(self.order, self.transform[here].astype(np.int64) * self.size + here)
            steps[todo] += 1
        return out


def _suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling. Separators are told apart by their place, so no comparison runs on into the next text."""
    n = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    width = 1
    while True:
        second = np.concatenate([rank[width:], rank[: min(width, n)]])[:n] if width < n else np.zeros(n, np.int64)
        packed = rank * (rank.max() + 2) + second
        order = np.argsort(packed, kind="stable")
        ordered = packed[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if fresh[order[-1]] == n - 1:
            return order
        if width >= n:
            return order
        rank, width = fresh, width * 2


def within_edits(a: list, b: list, most: int = EDITS) -> bool:
    """Whether at most ``most`` words are added, dropped or replaced between a and b."""
    low, high_a, high_b = 0, len(a), len(b)
    if abs(high_a - high_b) > most:
        return False
    while low < high_a and low < high_b and a[low] == b[low]:
        low += 1
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
    a, b = a[low:high_a], b[low:high_b]
    if not a or not b or max(len(a), len(b)) <= most:
        return max(len(a), len(b)) <= most
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
        if min(row) > most:
            return False
    return row[-1] <= most


def _flat(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts on end, and the number of words of each; an empty text has none."""
    lists = pc.split_pattern(texts, " ")
    flat = pc.list_flatten(lists)
    counts = np.asarray(pc.list_value_length(lists), np.int64)
    empty = np.asarray(pc.equal(texts, ""), bool)
    if empty.any():
        flat = flat.filter(pc.not_equal(flat, ""))
        counts[empty] = 0
    return flat, counts


def search_shard(cell: np.ndarray, is_eval: np.ndarray, norm: pa.Array, edits: int = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (train, evaluation) of the pairs of one cell each that are within the edit bound."""
    flat, counts = _flat(norm)
    codes = np.asarray(flat.dictionary_encode().indices, np.int64) if len(flat) else np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.cumsum(counts)])
    cells = np.unique(cell, return_inverse=True)[1]
    of_word = np.repeat(np.arange(len(cell)), counts)
    tagged = cells[of_word] * (int(codes.max(initial=0)) + 1) + codes  # a word counts within its cell only
    evals, trains = np.flatnonzero(is_eval), np.flatnonzero(~is_eval)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    e_count = counts[evals]
    e_begin = np.concatenate([[0], np.cumsum(e_count + 1)])
    in_eval = is_eval[of_word]
    alphabet = np.unique(tagged[in_eval])
    if len(alphabet):
        symbols = np.zeros(int(e_begin[-1]), np.int64)
        local = np.cumsum(is_eval) - 1  # place among the evaluation rows
        word_at = np.arange(len(tagged)) - begin[of_word]
        symbols[e_begin[local[of_word[in_eval]]] + word_at[in_eval]] = np.searchsorted(alphabet, tagged[in_eval]) + 1
        index = FmIndex(symbols)
        e_of = np.repeat(np.arange(len(evals)), e_count + 1)

        # every word of every training text as right end of a seed, searched in step with all others
        t_word = np.flatnonzero(~in_eval)
        place = np.minimum(np.searchsorted(alphabet, tagged), len(alphabet) - 1)
        known = alphabet[place] == tagged
        symbol = place + 1
        seed = np.maximum(1, -(-(counts - edits) // (edits + 1)))  # longest run that the edits leave is at least this
        ends = t_word[word_at[t_word] + 1 >= seed[of_word[t_word]]]
        low, high, depth = np.zeros(len(ends), np.int64), np.full(len(ends), index.n, np.int64), 0
        hits = []
        while len(ends):
            at = ends - depth
            ok = known[at]
            ends, low, high, at = ends[ok], low[ok], high[ok], at[ok]
            low, high = index.step(symbol[at], low, high)
            depth += 1
            ok = high > low
            ends, low, high = ends[ok], low[ok], high[ok]
            full = seed[of_word[ends]] == depth
            hits.append((ends[full] - depth + 1, low[full], high[full]))
            ends, low, high = ends[~full], low[~full], high[~full]
        start = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
        low, high = (np.concatenate([h[i] for h in hits]) if hits else np.zeros(0, np.int64) for i in (1, 2))
        for part in _whole_texts(of_word[start], high - low, HITS):
            found.append(_merged(start[part], low[part], high[part], index, e_of, e_begin, e_count, evals, of_word, word_at, counts, seed, edits))
    # texts of so few words that they need not share any
    short_e, short_t = evals[counts[evals] <= edits], trains[counts[trains] <= edits]
    if len(short_e) and len(short_t):
        order = short_e[np.argsort(cells[short_e], kind="stable")]
        left, right = np.searchsorted(cells[order], cells[short_t], "left"), np.searchsorted(cells[order], cells[short_t], "right")
        t = np.repeat(short_t, right - left)
        found.append((t, order[_ranges(left, right)]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t, e = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    pair = np.unique(t * np.int64(len(cell)) + e)
    t, e = pair // len(cell), pair % len(cell)
    keep = np.abs(counts[t] - counts[e]) <= edits
    t, e = t[keep], e[keep]
    token = codes.tolist()
    lists = {}
    for r in np.unique(np.concatenate([t, e])).tolist():
        lists[r] = token[begin[r] : begin[r + 1]]
    right = np.fromiter((within_edits(lists[x], lists[y], edits) for x, y in zip(t.tolist(), e.tolist(), strict=True)), bool, len(t))
    return t[right], e[right]


def _ranges(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All numbers of all half-open ranges, on end."""
    size = right - left
    return np.repeat(left - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))


def _slices(size: np.ndarray, most: int) -> Iterator[slice]:
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield slice(at, to)
        at = to


def _near(start, low, high, index, e_of, e_begin, of_word, word_at, edits):
    """Located seeds (evaluation text, train text, shift, first word) whose places differ by no more than the edit bound."""
    where = index.locate(_ranges(low, high))
    first = np.repeat(start, high - low)
    e = e_of[where]
    t = of_word[first]
    shift = (where - e_begin[e]) - word_at[first]
    near = np.abs(shift) <= edits  # no more words than the bound can have come or gone before a kept run
    return e[near], t[near], shift[near], word_at[first[near]]


def _whole_texts(text: np.ndarray, size: np.ndarray, most: int) -> Iterator[slice]:
    """Slices with all hits of their texts, as covers are summed over a text's hits. Those have one depth, so they stand together."""
    if not len(text):
        return
    at = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    ends = np.append(at[1:], len(text))
    for part in _slices(np.add.reduceat(size, at), most):
        yield slice(at[part.start], ends[part.stop - 1])


def _merged(start, low, high, index, e_of, e_begin, e_count, evals, of_word, word_at, counts, seed, edits):
    """Candidate pairs whose located seeds, merged along diagonals into maximal matches, cover enough words."""
    near = [_near(start[part], low[part], high[part], index, e_of, e_begin, of_word, word_at, edits) for part in _slices(high - low, HITS)]  # one slice, unless a single text has more
    e, t, shift, first = (np.concatenate([x[i] for x in near]) for i in range(4))
    order = np.lexsort((first, shift, e, t))
    e, t, shift, first = e[order], t[order], shift[order], first[order]
    if not len(t):
        return t, e
    width = seed[t]
    fresh = np.ones(len(t), bool)  # a seed that does not overlap the one before it on its diagonal begins a match
    fresh[1:] = (t[1:] != t[:-1]) | (e[1:] != e[:-1]) | (shift[1:] != shift[:-1])
    gain = width.copy()
    gain[1:] = np.where(fresh[1:], width[1:], np.minimum(width[1:], first[1:] - first[:-1]))
    pair = np.ones(len(t), bool)
    pair[1:] = (t[1:] != t[:-1]) | (e[1:] != e[:-1])
    at = np.flatnonzero(pair)
    covered = np.add.reduceat(gain, at)
    t, e = t[at], e[at]
    need = np.maximum(seed[t], np.maximum(counts[t], e_count[e]) - edits - edits * (seed[t] - 1))
    keep = covered >= need
    return t[keep], evals[e[keep]]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell; whole cells are gathered until a shard is full."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        while b.num_rows:
            cells = b.column("cell")
            if size >= SHARD_SYMBOLS and held:
                last = held[-1].column("cell")[-1]
                same = int(pc.sum(pc.equal(cells, last)).as_py() or 0)  # sorted: the rest of the cell comes first
                held.append(b.slice(0, same))
                b = b.slice(same)
                if b.num_rows:
                    yield from _search(held)
                    held, size = [], 0
                continue
            take = min(b.num_rows, 2_000)
            held.append(b.slice(0, take))
            size += int(pc.sum(held[-1].column("n")).as_py())
            b = b.slice(take)
    if held:
        yield from _search(held)


def _search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(held).combine_chunks()
    if not t.num_rows:
        return
    norm = t.column("norm").chunk(0)
    train, evaluation = search_shard(np.asarray(t.column("cell")), np.asarray(t.column("is_eval")), norm)
    tid = t.column("tid").chunk(0)
    yield pa.RecordBatch.from_arrays([tid.take(pa.array(train)), tid.take(pa.array(evaluation))], names=["train_tid", "eval_tid"])


def normalised_records(records: DataFrame) -> DataFrame:
    """One row per (id, split, origin) with its normalised words; rows without an input or a relevant split are left out."""
    split = F.lower(F.trim("split"))
    rows = records.select("id", split.alias("split"), "origin", "input").where(F.col("input").isNotNull() & F.col("id").isNotNull() & split.isin("train", *EVALUATION_SPLITS))
    schema = "id string, split string, origin string, tid binary, norm string, n int, base bigint, keys array<bigint>"
    return stage(rows.mapInArrow(_normalise, schema), "overlap-records")


def similar_texts(records: DataFrame) -> DataFrame:
    """Pairs (train_tid, eval_tid) of distinct texts with equal digits and at most ``EDITS`` word edits, each once."""
    texts = records.groupBy("tid").agg(F.first("norm").alias("norm"), F.first("n").alias("n"), F.first("base").alias("base"), F.first("keys").alias("keys"), F.max(F.col("split") == "train").alias("train"), F.max(F.col("split") != "train").alias("eval"))
    digits = texts.groupBy("base").agg(F.sum(F.col("train").cast("int")).alias("n_train"), F.sum(F.col("eval").cast("int")).alias("n_eval")).where("n_train > 0 and n_eval > 0")
    both = texts.join(digits, "base")
    crowded = F.col("n_train") + F.col("n_eval") > CELL_TEXTS
    sides = F.expr("explode(filter(array(if(train, false, null), if(eval, true, null)), x -> x is not null))")
    keyed = stage(both.select("tid", "norm", "n", "train", "eval", F.explode(F.when(crowded, F.col("keys")).otherwise(F.array("base"))).alias("key")).select("tid", "norm", "n", "key", sides.alias("is_eval")), "overlap-keyed")
    sizes = keyed.groupBy("key").agg(F.count_if(~F.col("is_eval")).alias("t"), F.count_if("is_eval").alias("e")).where("t > 0 and e > 0")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_TEXTS).cast("int")
    placed = keyed.join(sizes.select("key", blocks("t").alias("bt"), blocks("e").alias("be")), "key")
    own = lambda n: F.pmod(F.xxhash64("tid"), F.col(n)).cast("int")
    across = F.when(F.col("is_eval"), F.sequence(F.lit(0), F.col("bt") - 1)).otherwise(F.sequence(F.lit(0), F.col("be") - 1))
    celled = placed.withColumn("other", F.explode(across)).withColumn("cell", F.when((F.col("bt") == 1) & (F.col("be") == 1), F.col("key")).otherwise(F.xxhash64("key", F.when(F.col("is_eval"), F.col("other")).otherwise(own("bt")), F.when(F.col("is_eval"), own("be")).otherwise(F.col("other")))))
    sharded = celled.select("cell", "is_eval", "tid", "norm", "n").repartition("cell").sortWithinPartitions("cell")
    return sharded.mapInArrow(_stream, "train_tid binary, eval_tid binary").distinct()


def overlaps(records: DataFrame) -> DataFrame:
    """Overlapping records, one row per (train id, evaluation id) with both splits and origins.

    Input columns ``id, split, origin, input``. Null inputs, ids and splits take no part; an empty input has no digits and
    no words, so it overlaps with other inputs of at most ``EDITS`` words without digits. Repeated rows count once.
    """
    rows = normalised_records(records)
    people = rows.select("id", "split", "origin", "tid").distinct()
    train = people.where("split = 'train'").select(F.col("tid").alias("train_tid"), F.col("id").alias("train_id"), F.col("origin").alias("train_origin"))
    evaluation = people.where("split <> 'train'").select(F.col("tid").alias("eval_tid"), F.col("id").alias("eval_id"), F.col("origin").alias("eval_origin"), F.col("split").alias("eval_split"))
    return similar_texts(rows).join(train, "train_tid").join(evaluation, "eval_tid").where("train_id <> eval_id").drop("train_tid", "eval_tid")


def overlap_ids(records: DataFrame) -> DataFrame:
    pairs = overlaps(records)
    return pairs.select(F.least("train_id", "eval_id").alias("id_1"), F.greatest("train_id", "eval_id").alias("id_2")).distinct()


def overlap_report(records: DataFrame) -> DataFrame:
    """Per evaluation split and source: evaluation and train records in an overlap, and the number of pairs."""
    pairs = overlaps(records).select("train_id", "eval_id", "eval_split", "eval_origin").distinct()
    return pairs.groupBy(F.col("eval_split").alias("split"), F.col("eval_origin").alias("source")).agg(F.countDistinct("eval_id").alias("eval_records"), F.countDistinct("train_id").alias("train_records"), F.count("*").alias("pairs"))
