"""Records from JSON lines, in the columns that the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources import jsonl

#: ``semantic`` and ``features`` hold any object; they are read as JSON text.
UNIT = "surface string, start int, `end` int, category string, semantic string, policy string, canonical string, accepted array<string>, rejected array<string>, features string, source_category string, mapping_status string"
SOURCE = "benchmark string, source_id string, source_version string, source_url string, license string, source_hash string, source_file string, upstream_expected string"
ORACLE = "canonical_output string, accepted_outputs array<string>, rejected_outputs array<struct<output:string,reason:string>>, variant_mode string, comparison_profile string, interpretations array<struct<label:string,semantic:string,accepted_outputs:array<string>>>"
SCHEMA = ", ".join(f"{c} string" for c in ("schema_version", "taxonomy_version", "policy_version", "id", "language", "locale", "split", "family_id", "status", "input", "expected_output", "notes")) + f", negative_for array<string>, source struct<{SOURCE}>, units array<struct<{UNIT}>>, oracle struct<{ORACLE}>, oracle_hash string, review struct<protocol_version:string,status:string,decision:string,reviewers:array<string>,adjudicator:string>"


class BrokenLines(ValueError):
    pass


def read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of all files; a line that is no object is an error that names its file and line."""
    files = jsonl.expand_paths(paths, spark)
    if not files:
        return flat(spark.createDataFrame([], SCHEMA))
    rows = jsonl.read_jsonl(spark, files, SCHEMA)
    if broken := rows.where("_broken is not null").select("_file").take(1):  # only then are the lines of that file counted
        first = jsonl.broken_lines(jsonl.read_lines(spark, [broken[0]._file])).orderBy("_line").first()
        raise BrokenLines(f"{first._file}:{first._line}: {first.value[:200]}")
    return flat(rows.drop("_broken", "_file"))


def flat(records: DataFrame) -> DataFrame:
    """Records with the parts of source and oracle that operators read as columns of their own. Missing lists are empty."""
    return records.withColumns({
        "benchmark": F.col("source.benchmark"), "source_id": F.col("source.source_id"), "upstream_expected": F.col("source.upstream_expected"), "canonical": F.col("oracle.canonical_output"),
        "accepted": F.coalesce("oracle.accepted_outputs", F.array().cast("array<string>")), "rejected": F.coalesce(F.col("oracle.rejected_outputs")["output"], F.array().cast("array<string>")),
        "units": F.coalesce("units", F.array().cast(records.schema["units"].dataType)), "negative_for": F.coalesce("negative_for", F.array().cast("array<string>")),
    })
