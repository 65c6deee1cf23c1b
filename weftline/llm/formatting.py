"""Duplicates hidden by formatting differences (problem 5).

Rows are partitioned by the leading bytes of their canonical form; a bucket that holds too many rows is split by further
bytes, until each fits or all its rows are one and the same key. Each bucket is then counted in a trie whose terminal
nodes hold the number of copies and the smallest id. A key that fills buckets by itself is known from the splitting, with
its smallest id, and its rows are spread over all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.textform import fold
from weftline.plans.runtime import stage

#: Rows a bucket may hold, and buckets over that size that one level may list: together they bound what is broadcast.
BUCKET_ROWS = 20_000
LISTED_BUCKETS = 50_000
FIRST_BYTES = 16
EDGE = 8  # bytes on an edge of a trie

MARKS = re.escape(".,;:!?\"'`´“”„‟‘’‚‛«»‹›()[]{}<>⟨⟩-‐‑‒–—―−")
HYPHENS = re.escape("-‐‑−")
# a mark stays between two digits, and a hyphen does at the start or after spacing and before a digit
_DROP = re.compile(rf"(?<!\d)(?!(?:(?<=\s)|(?<![\s\S]))[{HYPHENS}]\d)[{MARKS}]|(?<=\d)[{MARKS}](?!\d)|\s+")


def canonical(text: str) -> str:
    """Folded, case-folded, without spacing and without punctuation other than in numbers."""
    return _DROP.sub("", fold(text).casefold())


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = [f"{lang}\x00{canonical(text)}".encode("utf-8", "surrogatepass") for lang, text in zip(b.column("language").to_pylist(), b.column("input").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(keys, pa.binary())], names=["id", "key"])


def canonical_rows(records: DataFrame) -> DataFrame:
    """``id, key`` of each record with an input; a null language counts as the empty one. Whole repeated rows go."""
    rows = records.where("input is not null and id is not null").select("id", F.coalesce("language", F.lit("")).alias("language"), "input")
    return stage(rows.mapInArrow(_keys, "id string, key binary"), "formatting-keys")


class Plan:
    """Buckets of the radix partitioning: ``levels`` has (bytes, prefixes split further), ``hot`` the keys that cannot be split."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, set[bytes]]] = []
        self.hot: dict[bytes, str] = {}


def radix_plan(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, first: int = FIRST_BYTES) -> Plan:
    """Level by level counts the rows under each prefix, of the buckets still too large only.

    What reaches the driver are prefixes with over ``bucket_rows`` rows: at most rows / bucket_rows a level. The limit
    grows with the input such that these are no more than ``LISTED_BUCKETS``.
    """
    plan, width, rest = Plan(), first, rows
    bucket_rows = max(bucket_rows, rows.count() // LISTED_BUCKETS)
    while True:
        large = rest.groupBy(F.substring("key", 1, width).alias("prefix")).agg(F.count("*").alias("n"), F.max(F.length("key")).alias("longest"), F.min("key").alias("low"), F.max("key").alias("high"), F.min("id").alias("first_id")).where(F.col("n") > bucket_rows)
        found = large.collect()
        for r in found:
            if r.low == r.high:
                plan.hot[bytes(r.low)] = r.first_id
        split = {bytes(r.prefix) for r in found if r.low != r.high}
        plan.levels.append((width, split))
        if not split:
            return plan
        rest = rest.where(F.substring("key", 1, width).isin([bytearray(p) for p in split])) if len(split) <= 200 else rest.join(F.broadcast(rows.sparkSession.createDataFrame([(bytearray(p),) for p in split], "prefix binary")), F.substring("key", 1, width) == F.col("prefix"), "left_semi")
        width *= 2


def bucket_of(key: bytes, plan: Plan) -> bytes:
    """The shortest prefix that was not split further."""
    for width, split in plan.levels:
        if key[:width] not in split:
            return key[:width]
    return key


def _buckets(plan_bytes) -> callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = plan_bytes.value
        for b in batches:
            keys = b.column("key").to_pylist()
            kept = [plan.hot.get(k) for k in keys]
            buckets = [bucket_of(k, plan) if h is None else None for k, h in zip(keys, kept, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(buckets, pa.binary()), pa.array(kept, pa.string())], names=["id", "key", "bucket", "kept_id"])

    return assign


class Trie:
    """Keys by edges of ``EDGE`` bytes; a terminal counter has the number of copies and the smallest id."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, key: bytes, record: str) -> list:
        node = self.root
        for at in range(0, len(key), EDGE):
            part = key[at : at + EDGE]
            node = node.get(part) or node.setdefault(part, {})
        terminal = node.get(None)
        if terminal is None:
            terminal = node[None] = [0, record]
        terminal[0] += 1
        if record < terminal[1]:
            terminal[1] = record
        return terminal


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket; a bucket's trie is dropped once the bucket ends. Emits each record with its terminal's smallest id."""
    now, trie, held = None, Trie(), []

    def emit() -> Iterator[pa.RecordBatch]:
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([t[1] for _, t in held], pa.string()), pa.array([r for r, _ in held], pa.string())], names=["kept_id", "copy_id"])

    for b in batches:
        for bucket, key, record in zip(b.column("bucket").to_pylist(), b.column("key").to_pylist(), b.column("id").to_pylist(), strict=True):
            if bucket != now:
                if len(held) >= 10_000:
                    yield from emit()
                    held = []
                now, trie = bucket, Trie()
            held.append((record, trie.add(key, record)))
    yield from emit()


def members(records: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``kept_id, copy_id`` of every record, the kept ones too (both ids equal). Null inputs take no part.

    An empty text, or one of marks and spacing only, has the empty key and is a copy of others with it.
    """
    rows = canonical_rows(records)
    plan = radix_plan(rows, bucket_rows)
    shared = rows.sparkSession.sparkContext.broadcast(plan)
    placed = rows.mapInArrow(_buckets(shared), "id string, key binary, bucket binary, kept_id string")
    hot = placed.where("bucket is null").select("kept_id", F.col("id").alias("copy_id"))
    rest = placed.where("bucket is not null").select("id", "key", "bucket").repartition("bucket").sortWithinPartitions("bucket")
    counted = rest.mapInArrow(_count, "kept_id string, copy_id string")
    return (counted.unionByName(hot) if plan.hot else counted)


def copies(records: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row for each record that repeats the one kept: ``kept_id, copy_id``. A record delivered again is one record."""
    return members(records, bucket_rows).where("kept_id <> copy_id").distinct()


def collapsed(records: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per group: the kept id and how many records it stands for, itself included."""
    return members(records, bucket_rows).distinct().groupBy(F.col("kept_id").alias("id")).agg(F.count("*").alias("copies"))
