"""Token shapes of free text that an annotated corpus covers rarely or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.shapes import token_shape

#: Whitespace of the text model, as a list of ranges that is searched faster than a Unicode class.
SPACE = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: What a token needs for any shape at all; most words of a text have none of it.
_HINT = r"[0-9^_#@/\\:=+]|[A-Z]{2}|[\p{Nd}&&[^0-9]]"


def tokens(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Tokens between whitespace with their place: ``key, nth, token, shape``; those without a shape are left out."""
    found = texts.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), F.lit(0))).alias("nth", "token"))
    return found.where(F.col("token").rlike(_HINT)).withColumn("shape", token_shape(F.col("token"))).where("shape is not null")


def placed_tokens(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``tokens`` with ``start`` and ``end`` of each in the text, in code points; only tokens that may have a shape are measured."""
    pieces = texts.select(key, F.regexp_extract_all(text, F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0)).alias("pieces"))
    bare = lambda p: F.regexp_replace(p, f"^[{SPACE}]+", "")
    hinted = F.filter(F.transform("pieces", lambda p, i: F.struct(i.alias("nth"), p.alias("piece"))), lambda p: p["piece"].rlike(_HINT))
    placed = F.transform(hinted, lambda p: F.struct(p["nth"].alias("nth"), bare(p["piece"]).alias("token"), (F.length(F.array_join(F.slice("pieces", F.lit(1), p["nth"] + 1), "")) - F.length(bare(p["piece"]))).alias("start")))
    found = pieces.select(key, F.inline(placed)).withColumn("shape", token_shape(F.col("token"))).where("shape is not null")
    return found.withColumn("end", F.col("start") + F.length("token"))


def shape_counts(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    return tokens(texts, key, text).groupBy("shape").agg(F.count("*").alias("tokens"), F.countDistinct(key).alias("texts"))


def covered(records: DataFrame) -> DataFrame:
    """How often each shape is annotated."""
    surfaces = records.select(F.explode("units.surface").alias("surface"))
    return surfaces.select(token_shape(F.col("surface")).alias("shape")).where("shape is not null").groupBy("shape").agg(F.count("*").alias("annotated"))


def rare_tokens(texts: DataFrame, records: DataFrame, key: str, rare_below: int = 3) -> DataFrame:
    """Each token of a shape annotated less than ``rare_below`` times, once, at its first place."""
    first = placed_tokens(texts, key).groupBy("shape", "token").agg(F.min(F.struct(F.col(key), F.col("nth"), F.col("start"), F.col("end"))).alias("at"), F.count("*").alias("n"))
    joined = first.join(F.broadcast(covered(records)), "shape", "left").withColumn("annotated", F.coalesce("annotated", F.lit(0))).where(F.col("annotated") < rare_below)
    reason = F.when(F.col("annotated") == 0, "unseen_shape").otherwise("rare_shape")
    return joined.select("shape", "token", "n", "annotated", F.col(f"at.{key}").alias("first_key"), F.col("at.nth").alias("first_nth"), F.col("at.start").alias("start"), F.col("at.end").alias("end"), reason.alias("reason"))
