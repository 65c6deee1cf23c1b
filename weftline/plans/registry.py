"""All queries of the core operators and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.plans import corpus, drift

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "dedupe_exact_groups"


def queries() -> dict[str, Query]:
    return corpus.QUERIES | {"p3_found": drift.p3_found, "p3_united": drift.p3_united}


def oracle_sql() -> dict[str, str]:
    return dict(corpus.SQL)
