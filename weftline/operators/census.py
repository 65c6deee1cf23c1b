"""Lineage ledger, sentence clusters, blind batches and families of parallel or like sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.hashing import sha256
from weftline.functions.spans import skeleton
from weftline.functions.text import fingerprint
from weftline.plans.runtime import stage


def ledger(records: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Every upstream row once, with its state: candidate or explicit exclusion, metadata only for a record mapped as unsupported.

    The latter is a field of the record (``mapping_status``), which few have, not of its units. ``census_id`` is a hash of
    where the row came from and of its input's fingerprint, or of the reason it was left out for.
    """
    state = F.when(F.col("mapping_status") == "unsupported", "metadata_only").otherwise("candidate") if "mapping_status" in records.columns else F.lit("candidate")
    version = F.col("source_version") if "source_version" in records.columns else F.lit(None).cast("string")
    text = lambda c: F.coalesce(c, F.lit(""))
    mark = F.when(F.col("input").isNotNull(), F.sha2(fingerprint(F.col("input")), 256))
    kept = records.select("benchmark", "source_id", "language", state.alias("state"), F.lit("").alias("reason"), sha256(F.concat_ws("|", *map(text, (F.col("benchmark"), F.col("source_id"), version, mark)))).alias("census_id"))
    lost = exclusions.select(F.col("source").alias("benchmark"), "source_id", "language", F.lit("explicit_exclusion").alias("state"), "reason", sha256(F.concat_ws("|", *map(text, (F.col("source"), F.col("source_id"), F.col("reason"))))).alias("census_id"))
    return kept.unionByName(lost)


def ledger_summary(records: DataFrame, exclusions: DataFrame) -> DataFrame:
    return ledger(records, exclusions).groupBy("benchmark", "state").agg(F.count("*").alias("n"))


def summary(records: DataFrame, exclusions: DataFrame, observed: DataFrame | None = None) -> DataFrame:
    """The whole census as one row. ``observed`` has ``source_rows``; without any, the rows accounted for count as observed."""
    rows = ledger(records, exclusions)
    of = lambda *states: F.count_if(F.col("state").isin(*states))
    counted = rows.agg(
        F.count_if(F.col("state") != "explicit_exclusion").alias("rows_parsed"), of("candidate").alias("rows_candidate"), of("metadata_only").alias("rows_metadata_only"), of("explicit_exclusion").alias("rows_excluded"),
        F.count_if((F.col("state") == "explicit_exclusion") & F.col("reason").isin("parse_error", "failed")).alias("rows_failed"), of("reviewed", "adjudicated", "release_ready").alias("rows_reviewed"), of("adjudicated", "release_ready").alias("rows_adjudicated"), of("release_ready").alias("rows_gold_eligible"),
    )
    sentences = _keyed(records).select("language", "locale", "sentence").distinct().agg(F.count("*").alias("sentence_clusters"))
    seen = (observed if observed is not None else records.sparkSession.createDataFrame([], "source_rows bigint")).agg(F.coalesce(F.sum("source_rows"), F.lit(0)).alias("_seen"))
    accounted = F.col("rows_parsed") + F.col("rows_excluded")
    whole = counted.join(sentences).join(seen).withColumn("rows_observed", F.when(F.col("_seen") == 0, accounted).otherwise(F.col("_seen")))
    return whole.withColumn("row_accounting_ok", F.col("rows_observed") == accounted).drop("_seen")


def _keyed(records: DataFrame) -> DataFrame:
    """Records by their sentence, the fingerprint of the input as a hash; a null input is the empty sentence."""
    text = lambda c: F.coalesce(c, F.lit(""))
    sentence = fingerprint(F.col("input"))
    cluster = F.sha2(F.concat_ws("|", text("language"), text("locale"), sentence), 256)
    ref = F.when(F.col("benchmark").isNotNull() | F.col("source_id").isNotNull(), F.to_json(F.struct("benchmark", "source_id"))) if {"benchmark", "source_id"} <= set(records.columns) else F.lit(None).cast("string")
    return records.select("*", text("language").alias("_language"), text("locale").alias("_locale"), F.unhex(F.md5(sentence)).alias("sentence"), cluster.alias("cluster_id"), ref.alias("_ref")).drop("language", "locale").withColumnsRenamed({"_language": "language", "_locale": "locale"})


def clusters(records: DataFrame) -> DataFrame:
    """Sentences by language, locale and fingerprint: records, distinct source references and upstream outputs, first and last id."""
    rows = _keyed(records).select("cluster_id", "language", "locale", "id", "_ref", F.unhex(F.md5("upstream_expected")).alias("output"))
    several = rows.groupBy("cluster_id", "language", "locale", "_ref", "output").agg(F.countDistinct("id").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    grouped = several.groupBy("cluster_id", "language", "locale").agg(F.sum("n").alias("records"), F.countDistinct("_ref").alias("refs"), F.countDistinct("output").alias("outputs"), F.min("low").alias("min_id"), F.max("high").alias("max_id"))
    return grouped.select("cluster_id", "language", "locale", "records", "refs", "outputs", "min_id", "max_id")


def cluster_members(records: DataFrame) -> DataFrame:
    """``cluster_id, id, benchmark, source_id, upstream_expected`` of every record."""
    return _keyed(records).select("cluster_id", "id", "benchmark", "source_id", "upstream_expected").distinct()


def blind_batch(records: DataFrame) -> DataFrame:
    """One record per cluster, that of the smallest id, without any upstream answer; its references are those of ``blind_refs``."""
    rows = _keyed(records).select("cluster_id", "language", "locale", "id", "input", "_ref")
    best = rows.groupBy("cluster_id", "language", "locale").agg(F.min(F.struct("id", "input")).alias("r"), F.countDistinct("_ref").alias("refs"))
    return best.select("cluster_id", "language", "locale", F.col("r.id").alias("id"), F.col("r.input").alias("input"), "refs")


def blind_refs(records: DataFrame) -> DataFrame:
    """``cluster_id, benchmark, source_id`` of every upstream row that a cluster came from."""
    return _keyed(records).select("cluster_id", "benchmark", "source_id").distinct()


def families(records: DataFrame) -> DataFrame:
    """Suggested families of any size: records of one upstream item in several languages, else of one skeleton with its categories.

    Numbers follow the order of the keys; only the table of groups is numbered, in one pass over its sorted ranges.
    """
    return family_members(records).groupBy("family_key").agg(F.count("*").alias("n"), F.min("id").alias("min_id"))


def family_members(records: DataFrame) -> DataFrame:
    """``family_key, id`` of every record."""
    parallel = F.col("source_id").contains(":")
    by_item = F.concat_ws("|", F.lit("parallel"), "benchmark", F.regexp_replace("source_id", ":[^:]*$", ""))
    patterns = F.array_join(F.transform("units", lambda u: F.concat_ws("/", u["category"], F.coalesce(F.get_json_object(u["features"], "$.surface_pattern"), F.lit("")))), ",")
    by_form = F.concat_ws("|", F.lit("skeleton"), F.coalesce("language", F.lit("")), F.coalesce("locale", F.lit("")), patterns, skeleton(F.col("input"), F.col("units")))
    return records.select(F.when(parallel, by_item).otherwise(by_form).alias("family_key"), "id").distinct()


def numbered(groups: DataFrame, key: str = "family_key") -> DataFrame:
    """Groups numbered from 1 in the order of their key, without a window over one partition."""
    parts = stage(groups.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return parts.withColumn("_nth", within).join(F.broadcast(earlier.select("_part", "_before")), "_part").withColumn("number", F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_before")
