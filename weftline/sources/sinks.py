"""Sinks: stable JSON lines, one-row reports, partitioned shards, hash manifests and guarded outputs."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stable_json(rows: DataFrame) -> DataFrame:
    """One text column: each row as JSON with sorted keys, without columns that begin with an underscore."""
    kept = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(F.to_json(F.parse_json(F.to_json(F.struct(*kept)))).alias("value"))


def write_jsonl(rows: DataFrame, path: str, by: list[str]) -> None:
    """Sorted by ranges of the keys, so that the files on end are in order, whatever their number."""
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    stable_json(ordered).write.mode("errorifexists").text(path)


def write_shards(records: DataFrame, path: str, by: tuple[str, ...] = ("split", "language")) -> None:
    records.write.mode("errorifexists").partitionBy(*by).parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    """A report of a bounded number of rows as one JSON document, written beside and moved into place."""
    content = [json.loads(r.value) for r in stable_json(rows).collect()]
    beside = f"{path}.part"
    with open(beside, "w", encoding="utf-8") as f:
        json.dump(content, f, ensure_ascii=False, indent=2, sort_keys=True)
    os.replace(beside, path)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 and size of every file under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_violations(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are missing, not listed, or differ from the manifest (``path, sha256``)."""
    both = hashes.select("path", F.col("sha256").alias("found")).join(manifest.select("path", F.col("sha256").alias("listed")), "path", "full")
    rule = F.when(F.col("found").isNull(), "missing").when(F.col("listed").isNull(), "not_listed").when(F.col("found") != F.col("listed"), "differs")
    return both.select("path", rule.alias("rule")).where("rule is not null")


def guard_output(output: str, inputs: list[str]) -> None:
    """Refuses an output folder that is not empty or lies in or around an input."""
    out = Path(output).resolve()
    for i in map(lambda p: Path(p).resolve(), inputs):
        if out == i or out in i.parents or i in out.parents:
            raise ValueError(f"{output} overlaps {i}")
    if out.exists() and any(out.iterdir()):
        raise FileExistsError(output)
