"""Texts that look the same but differ in their characters (problem 4).

Look-alike characters are mapped inside the JVM and the mapped values grouped under an accent-sensitive Unicode
collation in SQL, under which composed and combining accents are equal while letter case, accents and marks stay
distinct. The canonical member of a class is its shortest mapped value (composed accents are shorter), the smallest in
code point order among those, with its accents composed, joined back to every record. Classes span all fields, so equal
looking texts of different fields have one form too.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.textform import mapped
from weftline.plans.runtime import stage

# Control characters that the collation ignores, and the private ones that stand for them in its keys.
CONTROLS = "".join(map(chr, [*range(0x01, 0x09), *range(0x0E, 0x20), *range(0x7F, 0x85), *range(0x86, 0xA0)]))
STAND_INS = "".join(chr(0xE000 + i) for i in range(len(CONTROLS)))
_CONTROL_CLASS = "[\\x01-\\x08\\x0e-\\x1f\\x7f-\\x84\\x86-\\x9f]"

#: Equal under it: canonically equivalent strings. Distinct: case, accents, punctuation, width.
COLLATION = "UNICODE"


def collated(form: Column) -> Column:
    """``form`` with its control characters, which are visible in no font but part of the text, as ones that the collation tells apart."""
    return F.when(form.rlike(_CONTROL_CLASS), F.translate(form, CONTROLS, STAND_INS)).otherwise(form)


def classes(texts: DataFrame) -> DataFrame:
    """Distinct texts of ``(field_name, id, text)`` with the canonical member of their class: ``text, canonical, several``.

    ``several`` says whether the class has more than one text. Null texts belong to no class; the empty text is in a class
    with texts of invisible characters only.
    """
    spark = texts.sparkSession
    distinct = stage(texts.where("text is not null").select("text").distinct().withColumn("form", mapped(F.col("text"))), "lookalike-texts").withColumn("key", collated(F.col("form")))
    groups = """
        SELECT key COLLATE {c} AS class_key, min_by(form, struct(length(form), form)) AS canonical, min(text) < max(text) AS several
        FROM {t} GROUP BY key COLLATE {c}
    """
    grouped = spark.sql(groups.replace("{c}", COLLATION), t=distinct)
    joined = """
        SELECT t.text, g.canonical, g.several FROM {t} t JOIN {g} g ON t.key COLLATE {c} = g.class_key
    """
    return spark.sql(joined.replace("{c}", COLLATION), t=distinct, g=grouped)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("canonical"), pa.array([unicodedata.normalize("NFC", t) for t in b.column("canonical").to_pylist()], pa.string())], names=["canonical", "composed"])


def canonical_texts(texts: DataFrame) -> DataFrame:
    """One row per distinct (field_name, id, text): the text in the one form its class shares; a null text stays null.

    The form is composed (NFC). Only canonical members with characters that composing may change go through Python.
    """
    rows = texts.select("field_name", "id", "text").distinct()
    found = stage(classes(texts).drop("several"), "lookalike-canonical")
    # beyond Latin letters with their accents: marks, and the few characters that are equivalent to others
    composed = found.where(F.col("canonical").rlike("[^\\x00-\u02ff]")).select("canonical").distinct().mapInArrow(_compose, "canonical string, composed string").where("canonical <> composed")
    whole = found.join(composed, "canonical", "left").select("text", F.coalesce("composed", "canonical").alias("canonical"))
    return rows.join(whole, "text", "left").select("field_name", "id", "canonical", (~F.col("text").eqNullSafe(F.col("canonical"))).alias("changed"))


def look_alike_pairs(texts: DataFrame) -> DataFrame:
    """Pairs of ids of one field whose texts look the same but are not the same string, ``id_1 < id_2``.

    Distinct texts of a class are paired first and their records joined on afterwards, so copies of one string meet
    only the records they are to be reported with.
    """
    alike = classes(texts).where("several").select("text", "canonical")
    members = stage(texts.select("field_name", "id", "text").where("text is not null and id is not null").join(alike, "text").select("field_name", "id", "text", "canonical").distinct(), "lookalike-members")
    # one row per text of a field, under the 128 bits of its class: the texts are read once more where they are compared
    texts_of = stage(members.select("field_name", F.md5("canonical").alias("class"), "text").distinct(), "lookalike-classes")
    one, other = texts_of.alias("a"), texts_of.alias("b")
    pairs = one.join(other, (F.col("a.field_name") == F.col("b.field_name")) & (F.col("a.class") == F.col("b.class")) & (F.col("a.text") < F.col("b.text")))
    pairs = pairs.select(F.col("a.field_name").alias("field_name"), F.col("a.text").alias("text_a"), F.col("b.text").alias("text_b"))
    a = members.select("field_name", F.col("text").alias("text_a"), F.col("id").alias("id_a"))
    b = members.select("field_name", F.col("text").alias("text_b"), F.col("id").alias("id_b"))
    found = pairs.join(a, ["field_name", "text_a"]).join(b, ["field_name", "text_b"]).where("id_a <> id_b")
    return found.select("field_name", F.least("id_a", "id_b").alias("id_1"), F.greatest("id_a", "id_b").alias("id_2")).distinct()
