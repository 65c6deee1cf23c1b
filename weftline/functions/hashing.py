"""Hashes that stand for texts, objects and split assignments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def joined_hash(*parts: Column) -> Column:
    """Hash of the parts, one a line; a null part is an empty line."""
    return sha256(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]))


def canonical_json(json: Column) -> Column:
    """JSON text with sorted keys and no spaces. Numbers are rewritten to their shortest form."""
    return F.to_json(F.parse_json(json))


def hash_share(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on seed and key only: the first 64 bits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("double") / F.lit(2.0**64)


def hash_split(seed: int, key: Column, ratios: dict[str, float]) -> Column:
    """The split whose span of cumulated ratios the key's number falls into."""
    share, total, at, out = hash_share(seed, key), sum(ratios.values()), 0.0, None
    for name, ratio in ratios.items():
        at += ratio / total
        out = F.when(share < at, name) if out is None else out.when(share < at, name)
    return out.otherwise(list(ratios)[-1])
