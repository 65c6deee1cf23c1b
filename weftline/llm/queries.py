"""Queries of the training-data operators over the driver's tables, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import chunking, formatting, leakage, lookalike, mixing, oracles, overlap, sampling, splits
from weftline.plans.runtime import table

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    parts = [table(spark, sf, n).select("id", "language", "split", "family_id", "input", F.lower(F.trim("source.benchmark")).alias("origin"), F.col("source.source_id").alias("source_id")) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.overlap_ids(_inputs(spark, sf, "gold_sample", "polynorm"))


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.overlap_report(_inputs(spark, sf, "gold_sample", "polynorm"))


def _stratified(spark: SparkSession, sf: str) -> sampling.Stratified:
    rows = table(spark, sf, "todo_regressions").select("id", sampling.leading_category(F.col("units")).alias("category"), "language", "status")
    return sampling.Stratified(rows, table(spark, sf, "category_targets"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _stratified(spark, sf).shortfalls()


def p2_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _stratified(spark, sf).sample()


def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    return _stratified(spark, sf).report()


def _look_alike_fields(spark: SparkSession, sf: str) -> DataFrame:
    fields = (("async_tn", "input"), ("gold_sample", "expected_output"), ("polynorm", "source.upstream_expected"))
    parts = [table(spark, sf, t).select(F.lit(f"{t}.{c}").alias("field_name"), "id", F.col(c).alias("text")) for t, c in fields]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.look_alike_pairs(_look_alike_fields(spark, sf))


def p4_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.canonical_texts(_look_alike_fields(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return formatting.copies(_inputs(spark, sf, "async_tn", "proteno", "polynorm"))


def p5_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return formatting.collapsed(_inputs(spark, sf, "async_tn", "proteno", "polynorm"))


def _split_records(spark: SparkSession, sf: str) -> DataFrame:
    rows = _inputs(spark, sf, "gold_sample", "polynorm")
    return rows.select("id", F.col("language").alias("label"), splits.joined_name(F.col("family_id")).alias("family"), "origin", "source_id")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.kept_together(_split_records(spark, sf), table(spark, sf, "split_targets"))


def p6_assigned(spark: SparkSession, sf: str) -> DataFrame:
    return splits.assigned_records(_split_records(spark, sf), table(spark, sf, "split_targets"))


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Records, components and share of each split and language beside the target."""
    targets = table(spark, sf, "split_targets")
    families = splits.assigned_families(_split_records(spark, sf), targets)
    whole = families.select("root", "size", "label", "split").distinct()
    sums = whole.groupBy("split", "label").agg(F.sum("size").alias("records"), F.count("*").alias("components"))
    of_label = sums.groupBy("label").agg(F.sum("records").alias("of_label"))
    out = sums.join(of_label, "label").join(targets.select(F.col("split_name").alias("split"), "target_permille"), "split", "left")
    return out.select("split", F.col("label").alias("language"), "records", "components", F.round(F.col("records") * 1000 / F.col("of_label"), 1).alias("permille"), "target_permille")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_spans(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every evaluation item with the number of documents it leaked into and its longest run there."""
    spans = leakage.leaked_spans(table(spark, sf, "documents"), table(spark, sf, "eval_items"))
    hits = spans.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("n_words").alias("longest_run"))
    items = table(spark, sf, "eval_items").select("item_id", "split", "lang")
    return items.join(hits, "item_id", "left").select("item_id", "split", "lang", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("longest_run", F.lit(0)).alias("longest_run"))


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[0]


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))[1]


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.split_texts(table(spark, sf, "documents"), table(spark, sf, "chunk_limits"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
