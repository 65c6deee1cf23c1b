"""Queries of the schema drift operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.operators.schema_drift import Drift
from weftline.plans.runtime import table


def _drift(spark: SparkSession, sf: str) -> Drift:
    return Drift(table(spark, sf, "upstream_files"), table(spark, sf, "upstream_rows"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _drift(spark, sf).changes


def p3_united(spark: SparkSession, sf: str) -> DataFrame:
    return _drift(spark, sf).united()
