"""JSON lines and whole JSON documents as tables, with the file and line each row came from."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def expand_paths(paths: Iterable[str], spark: SparkSession | None = None) -> list[str]:
    """JSONL files of files, folders and patterns, each once, sorted, on any filesystem that Hadoop knows.

    What does not exist is left out, as is a file with another ending. Names are whole addresses.
    """
    spark = spark or SparkSession.getActiveSession()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    for p in map(str, paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for at in fs.globStatus(fs.makeQualified(path)) or []:
            if at.isDirectory():
                files = fs.listFiles(at.getPath(), True)
                while files.hasNext():
                    found.add(files.next().getPath().toString())
            else:
                found.add(at.getPath().toString())
    return sorted(f for f in found if f.endswith(".jsonl"))


def read_jsonl(spark: SparkSession, paths: list[str], schema: StructType | str) -> DataFrame:
    """Rows with ``_file`` and ``_broken``, the text of a line that is no object of the schema; blank lines are skipped."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")
    broken = F.when(_no_object(F.col("value")), F.col("value"))
    parsed = lines.select("_file", broken.alias("_broken"), F.from_json(F.when(broken.isNull(), F.col("value")), schema).alias("r"))
    return parsed.select("r.*", "_broken", "_file")


def _no_object(text: Column) -> Column:
    return F.coalesce(~F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(True))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``_file, _line, value`` of every line that is not blank, numbered from 1. One file is read by one task."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("_file"), F.posexplode(F.split("value", "\r?\n")).alias("_line", "value"))
    return whole.where(F.trim("value") != "").withColumn("_line", F.col("_line") + 1)


def broken_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON object, with the place of each."""
    return lines.where(_no_object(F.col("value")))


def registry(spark: SparkSession, path: str, key: str | None = None, schema: str | None = None) -> DataFrame:
    """A JSON document as a table: the list in it, or the list under ``key``. It is small and passes through the driver."""
    content = json.loads(spark.read.text(path, wholetext=True).first().value)
    rows = content[key] if key else content
    if isinstance(rows, dict):
        rows = [{"name": k, "value": json.dumps(v, sort_keys=True)} for k, v in sorted(rows.items())]
    return spark.createDataFrame(rows, schema) if schema else spark.createDataFrame(rows)


def predictions(lines: DataFrame, value: str = "output") -> DataFrame:
    """``id`` and value of prediction lines; of several lines for an id the last one of the last file counts."""
    parsed = lines.select("_file", "_line", F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", f"$.{value}").alias(value))
    return parsed.where("id is not null").groupBy("id").agg(F.max_by(value, F.struct("_file", "_line")).alias(value))


def control_predictions(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, profiles`` of control predictions, and ids that occur twice, which is an error in this form."""
    schema = "struct<id string, profiles map<string,struct<output string, rules array<string>>>>"
    parsed = lines.select(F.from_json("value", schema).alias("r")).select("r.*").where("id is not null")
    return parsed, parsed.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def exclusions(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Exclusion lists; a missing source is named after the file."""
    schema = "source string, source_id string, reason string, detail string, source_category string, language string, surface string, surface_shape string"
    rows = spark.read.schema(schema).option("multiLine", True).json(paths)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)[_.]?(exclusions)?\.json$", 1)
    return rows.withColumn("source", F.coalesce("source", stem))


CONTROL = "struct<id string, control string, language string, locale string, input string, expectations array<struct<profile_id string, expected_output string, required_rules array<string>, forbidden_rules array<string>>>>"


def controls(lines: DataFrame) -> DataFrame:
    """Control records: ``id, control, language, locale, input, expectations``."""
    return lines.select(F.from_json("value", CONTROL).alias("r")).select("r.*").where("id is not null")
