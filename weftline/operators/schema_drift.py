"""Schemas that drift between the files of a feed (problem 3).

Each file's schema is the graph of its fields, their types and their nesting. Neighbouring files whose schemas differ are
matched by similarity flooding: scores start from names and spread over pairs of nodes whose neighbours match, until they
settle. Consistent correspondences are taken from the highest score down, between fields of one name, or of two names with
equal values in the rows that both files deliver. They say what was renamed or changed type; what has none came or went.
Renames then carry every field back to the name it first had, and all rows are cast and united into one table.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.plans.runtime import stage

#: The fields that name a row within its feed.
ROW_KEYS = ("row_id", "case_id", "source_id")
#: Distinct columns the united table may have; more fields are kept in its ``rest`` column.
MOST_COLUMNS = 1_000


def _kind(value: object) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def fields_of(record: dict) -> Iterator[tuple[str, list]]:
    """Each field with its non-null values: top-level keys, and ``outer.inner`` for keys of objects in an array."""
    for key, value in record.items():
        if value is None:
            continue
        yield key, [value]
        if isinstance(value, list):
            inner: dict[str, list] = {}
            for item in value:
                if isinstance(item, dict):
                    for k, v in item.items():
                        if v is not None:
                            inner.setdefault(k, []).append(v)
            for k, v in inner.items():
                yield f"{key}.{k}", v


def _plain(value: object) -> str:
    """Text of a value for comparison; a number and the same number as text compare as equal."""
    return value if isinstance(value, str) else json.dumps(value, sort_keys=True, ensure_ascii=False)


def parse(text: str | None) -> dict | None:
    """The object in a payload; None for anything broken or not an object."""
    try:
        record = json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None
    return record if isinstance(record, dict) else None


def row_key(record: dict, number: int | None) -> str:
    for key in ROW_KEYS:
        if record.get(key) is not None:
            return _plain(record[key])
    return f"row {number}"


def _count_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many values of which type each field of each file has in a batch."""
    for b in batches:
        seen: dict[tuple[int, str, str], int] = {}
        for file_id, payload in zip(b.column("file_id").to_pylist(), b.column("payload").to_pylist(), strict=True):
            record = parse(payload)
            if record is None:
                continue
            for name, values in fields_of(record):
                for v in values:
                    at = file_id, name, _kind(v)
                    seen[at] = seen.get(at, 0) + 1
        columns = list(zip(*seen, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:]), pa.array(seen.values(), pa.int64())], names=["file_id", "field", "kind", "n"])


def field_kinds(rows: DataFrame) -> DataFrame:
    """``file_id, field, kind, n`` of every field in every payload that can be read."""
    seen = rows.select("file_id", "payload").where("file_id is not null").mapInArrow(_count_kinds, "file_id bigint, field string, kind string, n bigint")
    return seen.groupBy("file_id", "field", "kind").agg(F.sum("n").alias("n"))


def _hash_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        files, keys, names, hashes = [], [], [], []
        for number, file_id, payload, wanted in zip(*(b.column(c).to_pylist() for c in ("row_no", "file_id", "payload", "fields")), strict=True):
            record = parse(payload)
            if record is None:
                continue
            key = row_key(record, number)
            for name, values in fields_of(record):
                if name in wanted:
                    files.append(file_id)
                    keys.append(key)
                    names.append(name)
                    hashes.append(int.from_bytes(hashlib.blake2b("\x00".join(map(_plain, values)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.int64()), pa.array(keys, pa.string()), pa.array(names, pa.string()), pa.array(hashes, pa.int64())], names=["file_id", "row_key", "field", "value"])


def field_values(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``file_id, row_key, field, value`` (a hash) of the fields that ``wanted`` (``file_id, fields``) names for a file."""
    return rows.select("row_no", "file_id", "payload").join(wanted, "file_id").mapInArrow(_hash_values, "file_id bigint, row_key string, field string, value bigint").distinct()


def file_order(files: DataFrame) -> DataFrame:
    """``feed, file_id, exported_at, previous``: each file with the one exported before it, null for a feed's first.

    Equal times go by file id. Files are sorted over all tasks; only each task's first and last file of a feed are then
    compared, so no task holds a whole feed.
    """
    order = ["feed", "exported_at", "file_id"]
    listed = files.select(*order).where("feed is not null and file_id is not null and exported_at is not null").dropDuplicates(["file_id"])
    placed = stage(listed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "drift-files")
    near = Window.partitionBy("feed", "part").orderBy("exported_at", "file_id")
    own = placed.withColumn("before", F.lag("file_id").over(near))
    last = placed.groupBy(F.col("feed").alias("of_feed"), F.col("part").alias("of_part")).agg(F.max_by("file_id", F.struct("exported_at", "file_id")).alias("last"))
    heads = own.where("before is null").select("feed", "part").join(last, (F.col("feed") == F.col("of_feed")) & (F.col("of_part") < F.col("part")))
    linked = heads.groupBy(F.col("feed").alias("of_feed"), F.col("part").alias("of_part")).agg(F.max_by("last", "of_part").alias("linked"))
    return own.join(linked, own["before"].isNull() & (F.col("feed") == F.col("of_feed")) & (F.col("part") == F.col("of_part")), "left").select("feed", "file_id", "exported_at", F.coalesce("before", "linked").alias("previous"))


# --- similarity flooding


def _grams(name: str) -> set[str]:
    padded = f"  {name.lower()} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


def name_similarity(a: str, b: str) -> float:
    """Of the last parts of two field names: shared three-letter runs, and at least half if they share a word."""
    a, b = a.rpartition(".")[2], b.rpartition(".")[2]
    if a == b:
        return 1.0
    x, y = _grams(a), _grams(b)
    dice = 2 * len(x & y) / (len(x) + len(y))
    return max(dice, 0.5 * bool(set(a.lower().split("_")) & set(b.lower().split("_"))))


def flood(before: dict[str, str], after: dict[str, str], rounds: int = 100, settled: float = 1e-4) -> dict[tuple[str, str], float]:
    """Scores of all pairs of fields of two schemas (field to type), after flooding.

    Nodes are the schema itself, its fields and its types; edges lead from the schema, or the field a nested one lies in, to
    each field and from it to its type. A pair of nodes passes its score on to the pairs that edges of one kind lead to,
    shared out evenly among them, and back.
    """
    kinds = ["array", "boolean", "number", "object", "string"]

    def graph(schema: dict[str, str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names = sorted(schema)
        nodes = ["", *names]
        inside, typed = np.zeros((len(nodes),) * 2), np.zeros((len(nodes), len(kinds)))
        at = {n: i for i, n in enumerate(nodes)}
        for n in names:
            outer = n.rpartition(".")[0]
            inside[at.get(outer, 0), at[n]] = 1
            typed[at[n], kinds.index(schema[n])] = 1
        return nodes, inside, typed

    left, inside_a, typed_a = graph(before)
    right, inside_b, typed_b = graph(after)
    start = np.array([[1.0 if not a and not b else name_similarity(a, b) if a and b else 0.0 for b in right] for a in left])
    start_kinds = np.eye(len(kinds))
    share = lambda a, b: np.divide(1.0, c := np.outer(a.sum(1), b.sum(1)), out=np.zeros_like(c), where=c > 0)
    down, up = share(inside_a, inside_b), share(inside_a.T, inside_b.T)
    to_kind, from_kind = share(typed_a, typed_b), share(typed_a.T, typed_b.T)
    score, score_kinds = start.copy(), start_kinds.copy()
    for _ in range(rounds):
        basis, basis_kinds = start + score, start_kinds + score_kinds
        gained = inside_a.T @ (basis * down) @ inside_b + inside_a @ (basis * up) @ inside_b.T + typed_a @ (basis_kinds * from_kind) @ typed_b.T
        new, new_kinds = basis + gained, basis_kinds + typed_a.T @ (basis * to_kind) @ typed_b
        top = max(new.max(), new_kinds.max())
        new, new_kinds = new / top, new_kinds / top
        moved = max(np.abs(new - score).max(), np.abs(new_kinds - score_kinds).max())
        score, score_kinds = new, new_kinds
        if moved < settled:
            break
    return {(a, b): float(score[i, j]) for i, a in enumerate(left) for j, b in enumerate(right) if a and b}


def matches(before: dict[str, str], after: dict[str, str], equal: set[tuple[str, str]]) -> list[tuple[str, str]]:
    """One-to-one pairs of fields from the highest score down: of one name, or one that goes and one that comes with equal values."""
    gone, come = before.keys() - after.keys(), after.keys() - before.keys()
    ranked = sorted((-n, a, b) for (a, b), n in flood(before, after).items() if a == b or (a in gone and b in come and (a, b) in equal))
    out: dict[str, str] = {}
    for _, a, b in ranked:
        if a not in out and b not in out.values():
            out[a] = b
    return sorted(out.items())


def correspondences(before: dict[str, str], after: dict[str, str], equal: set[tuple[str, str]]) -> list[tuple[str, str]]:
    """The matches that are renames."""
    return [(a, b) for a, b in matches(before, after, equal) if a != b]


def step_changes(before: dict[str, str], after: dict[str, str], equal: set[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """``change, old_name, new_name`` between two schemas, as their correspondences tell."""
    pairs = matches(before, after, equal)
    out = [("renamed", a, b) for a, b in pairs if a != b] + [("retyped", a, b) for a, b in pairs if a == b and before[a] != after[b]]
    out += [("removed", a, "") for a in sorted(before.keys() - {a for a, _ in pairs})]
    return out + [("added", "", b) for b in sorted(after.keys() - {b for _, b in pairs})]


def _match(group: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for r in group.itertuples():
        equal = {(e["old"], e["new"]) for e in r.equal} if r.equal is not None else set()
        rows += [(r.feed, r.file_id, *c) for c in step_changes({f["field"]: f["kind"] for f in r.before}, {f["field"]: f["kind"] for f in r.after}, equal)]
    return pd.DataFrame(rows, columns=["feed", "file_id", "change", "old_name", "new_name"])


class Drift:
    """Schemas, changes and the united table of feeds of files.

    ``files`` has ``feed, file_id, exported_at``; ``rows`` has ``row_no, file_id, payload``. Rows of unlisted files, files
    without a feed or time, and payloads that are broken, empty or no object count for nothing. A file whose payloads all
    count for nothing has no fields.
    """

    def __init__(self, files: DataFrame, rows: DataFrame) -> None:
        self.rows = rows
        self.order = stage(file_order(files), "drift-order")
        self.kinds = stage(field_kinds(rows), "drift-kinds")
        self.schemas = self.kinds.groupBy("file_id", "field").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"))
        self.changes = stage(self._changes(), "drift-changes")
        self.renames = self.changes.where("change = 'renamed'").select("file_id", "old_name", "new_name")

    def _changes(self) -> DataFrame:
        whole = self.schemas.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("field", "kind"))).alias("schema"))
        none = F.array().cast("array<struct<field:string,kind:string>>")
        steps = self.order.where("previous is not null").select("feed", "file_id", "previous")
        paired = steps.join(whole.withColumnRenamed("schema", "after"), "file_id", "left").join(whole.select(F.col("file_id").alias("previous"), F.col("schema").alias("before")), "previous", "left")
        paired = paired.withColumns({"before": F.coalesce("before", none), "after": F.coalesce("after", none)}).where(F.col("before") != F.col("after"))
        changed = stage(paired.withColumns({"gone": F.array_except("before.field", "after.field"), "come": F.array_except("after.field", "before.field")}), "drift-steps")
        return changed.join(self._equal(changed.where(F.size("gone") * F.size("come") > 0)), "file_id", "left").select("feed", "file_id", "before", "after", "equal").mapInPandas(lambda parts: map(_match, parts), "feed string, file_id bigint, change string, old_name string, new_name string")

    def _equal(self, busy: DataFrame) -> DataFrame:
        """``file_id, equal``: pairs of a field that goes and one that comes whose values agree in most rows both files deliver.

        Only rows of the files of such steps are read again, and only those fields of them.
        """
        asked = busy.select(F.col("previous").alias("file_id"), F.col("gone").alias("fields")).unionByName(busy.select("file_id", F.col("come").alias("fields")))
        wanted = asked.groupBy("file_id").agg(F.array_distinct(F.flatten(F.collect_list("fields"))).alias("fields"))
        values = stage(field_values(self.rows, wanted), "drift-values")
        of = lambda file, fields, name, value: values.join(busy.select(F.col(file).alias("of_file"), F.col("file_id").alias("step"), fields), F.col("file_id") == F.col("of_file")).where(F.array_contains(fields, F.col("field"))).select("step", "row_key", F.col("field").alias(name), F.col("value").alias(value))
        shared = of("previous", "gone", "old", "old_value").join(of("file_id", "come", "new", "new_value"), ["step", "row_key"]).groupBy("step", "row_key", "old", "new").agg(F.max(F.col("old_value") == F.col("new_value")).alias("same"))
        # a stray value of another type may differ; a field that merely resembles another differs throughout
        equal = shared.groupBy("step", "old", "new").agg(F.count_if("same").alias("n_same"), F.count("*").alias("n")).where("2 * n_same > n")
        return equal.groupBy(F.col("step").alias("file_id")).agg(F.collect_list(F.struct("old", "new")).alias("equal"))

    def names(self) -> DataFrame:
        """``feed, file_id, field, column``: the name each file's field has in the united table, the first it had in its feed.

        A new field whose name another field had before gets a column of its own, ``name_2``.

        Files are streamed in the order of export, with the current names of one feed at a time at hand.
        """
        marks = self.order.select("feed", "exported_at", "file_id")
        renamed = self.renames.groupBy("file_id").agg(F.collect_list(F.struct("old_name", "new_name")).alias("renames"))
        fields = self.schemas.groupBy("file_id").agg(F.collect_list("field").alias("fields"))
        rows = marks.join(renamed, "file_id", "left").join(fields, "file_id", "left").repartition("feed").sortWithinPartitions("feed", "exported_at", "file_id")

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            feed, first, used = None, {}, set()
            for part in parts:
                out = []
                for r in part.itertuples():
                    if r.feed != feed:
                        feed, first, used = r.feed, {}, set()
                    moved = {e["new_name"]: first.get(e["old_name"], e["old_name"]) for e in (r.renames if r.renames is not None else ())}
                    fields = sorted(r.fields) if r.fields is not None else []
                    first = {k: v for k, v in first.items() if k not in {e["old_name"] for e in (r.renames if r.renames is not None else ())}} | moved
                    held = set(first.values())
                    for f in fields:
                        if f not in first and f in held:  # the column of another field, which had this name before
                            first[f] = next(n for n in (f"{f}_{k}" for k in itertools.count(2)) if n not in used and n not in fields)
                            held.add(first[f])
                        used.add(first.get(f, f))
                        out.append((r.feed, r.file_id, f, first.get(f, f)))
                yield pd.DataFrame(out, columns=["feed", "file_id", "field", "column"])

        return rows.select("feed", "file_id", "renames", "fields").mapInPandas(run, "feed string, file_id bigint, field string, column string")

    def united(self) -> DataFrame:
        """One row per distinct row of a file: ``feed, file_id, row_key``, a typed column per field, ``rest`` for any beyond.

        A column has the type that most values have under its name; values that do not cast to it are null there and kept
        as text in ``rest``. Arrays and objects are JSON text. Nested fields stay in their arrays, under their first names.
        """
        names = stage(self.names(), "drift-names")
        counted = self.kinds.where(~F.contains("field", F.lit("."))).join(names, ["file_id", "field"])
        columns = counted.groupBy("column", "kind").agg(F.sum("n").alias("n")).groupBy("column").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"), F.sum("n").alias("n"))
        chosen = sorted((r.column, r.kind) for r in columns.orderBy(F.desc("n"), "column").limit(MOST_COLUMNS).collect())
        per_file = names.groupBy("file_id").agg(F.first("feed").alias("feed"), F.map_from_entries(F.collect_list(F.struct("field", "column"))).alias("names"))
        rows = self.rows.where("file_id is not null").select("row_no", "file_id", "payload").join(per_file, "file_id")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for number, file_id, feed, payload, entries in zip(*(b.column(c).to_pylist() for c in ("row_no", "file_id", "feed", "payload", "names")), strict=True):
                    record = parse(payload)
                    if record is not None:
                        out.append((feed, file_id, row_key(record, number), sorted(renamed(record, dict(entries)).items())))
                columns = list(zip(*out, strict=True)) or [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["feed", "file_id", "row_key", "fields"])

        flat = rows.mapInArrow(run, "feed string, file_id bigint, row_key string, fields map<string,string>").select("feed", "file_id", "row_key", F.to_json("fields").alias("fields")).distinct().withColumn("fields", F.from_json("fields", "map<string,string>"))
        taken = ("feed", "file_id", "row_key", "rest")
        target = lambda name: name if name.lower() not in taken else f"{name}_field"
        cast = {name: _cast(F.col("fields")[name], kind) for name, kind in chosen}
        kept = F.map_filter("fields", lambda k, _: ~k.isin([n for n, _ in chosen]))
        lost = F.map_filter("fields", lambda k, v: F.coalesce(_any(k, v, chosen), F.lit(False)))
        return flat.select("feed", "file_id", "row_key", *[cast[n].alias(target(n)) for n, _ in chosen], F.map_concat(kept, lost).alias("rest"))


def renamed(record: dict, names: dict[str, str]) -> dict[str, str]:
    """Non-null values as text under their columns' names; nested keys are renamed inside their arrays."""
    out = {}
    for key, value in record.items():
        if value is None:
            continue
        if isinstance(value, list):
            value = [{names.get(f"{key}.{k}", f"{key}.{k}").rpartition(".")[2]: v for k, v in item.items()} if isinstance(item, dict) else item for item in value]
        out[names.get(key, key)] = _plain(value)
    return out


def _cast(text: Column, kind: str) -> Column:
    return text.try_cast({"number": "double", "boolean": "boolean"}.get(kind, "string"))


def _any(key: Column, value: Column, chosen: list[tuple[str, str]]) -> Column:
    """Whether a value does not cast to the type of its column."""
    numbers, flags = ([n for n, k in chosen if k == kind] for kind in ("number", "boolean"))
    return (key.isin(numbers) & value.try_cast("double").isNull()) | (key.isin(flags) & value.try_cast("boolean").isNull())
