"""A sample that matches target category proportions (problem 2).

Records are grouped by signature: the stratum their leading unit's category, language and status name. From a random
sample that keeps every floor, counts are swapped between signatures as long as that lowers the deviation from the
targets; the records of each signature are then drawn in seeded order.
"""

from __future__ import annotations

import math
import random
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.order import running, seeded
from weftline.plans.runtime import stage

SEED = 20260818
SAMPLE_SHARE = Fraction(1, 5)
KEYS = ["category", "language", "status"]


def plain_name(column: Column) -> Column:
    """Spelling aside: lower case, outer spaces off, words joined by one sign."""
    return F.regexp_replace(F.regexp_replace(F.lower(column), "^\\s+|\\s+$", ""), "[\\s_\\-]+", "_")


def leading_category(units: Column) -> Column:
    """Category of the unit that starts first; units without a start come after the others, ties go by name."""
    far = 2**31 - 1
    order = F.array_min(F.transform(units, lambda u: F.struct(F.coalesce(u["start"], F.lit(far)).alias("start"), u["category"].alias("category"))))
    return order["category"]


def signatures(records: DataFrame, targets: DataFrame) -> DataFrame:
    """``id`` and the stratum of each record, spelled as in the targets; null where it belongs to none of them.

    Input columns ``id, category, language, status``. A record delivered again counts once, with its smallest stratum.
    """
    strata = targets.select(*KEYS, *[plain_name(F.col(k)).alias(f"_{k}") for k in KEYS]).dropDuplicates([f"_{k}" for k in KEYS])
    plain = records.where("id is not null").select("id", *[plain_name(F.col(k)).alias(f"_{k}") for k in KEYS])
    joined = plain.join(F.broadcast(strata), [f"_{k}" for k in KEYS], "left")
    whole = joined.groupBy("id").agg(F.min(F.when(F.col("category").isNotNull(), F.struct(*KEYS))).alias("s"))
    return whole.select("id", *[F.col(f"s.{k}").alias(k) for k in KEYS])


def needs(targets: list, size: int) -> list[int]:
    return [max(t.min_records or 0, math.ceil(Fraction(t.target_permille or 0, 1000) * size)) for t in targets]


def swap_repair(available: list[int], floors: list[int], goal: list[float], size: int, seed: int = SEED) -> list[int]:
    """Counts of each signature that add up to ``size`` (or all there is) and deviate least from ``goal``.

    The deviation is the sum of squared differences relative to the goal; being convex and separable, it is at its lowest
    when no swap of one record between two signatures lowers it. Swaps are tried in bulk first.
    """
    size = min(size, sum(available))
    counts = [min(a, f) for a, f in zip(available, floors, strict=True)]
    draw = random.Random(seed)
    while (over := sum(counts) - size) > 0:  # the floors alone are too many
        k = max(range(len(counts)), key=lambda i: (counts[i], i))
        counts[k] -= min(over, max(1, counts[k] // 2))
    held = list(counts)
    left = size - sum(counts)
    room = [a - c for a, c in zip(available, counts, strict=True)]
    total = sum(room)
    if total:  # random places among all records that are not in yet
        for i in draw.sample(range(len(room)), len(room)):
            n = min(room[i], left, round(left * room[i] / total * draw.uniform(0.8, 1.2)))
            counts[i], room[i], left = counts[i] + n, room[i] - n, left - n
        for i in range(len(room)):
            n = min(room[i], left)
            counts[i], left = counts[i] + n, left - n
    weight = [1 / max(1.0, g) for g in goal]
    step = max(1, size)
    while step:
        gain = lambda i, n: weight[i] * ((counts[i] + n - goal[i]) ** 2 - (counts[i] - goal[i]) ** 2)
        giving = [i for i in range(len(counts)) if counts[i] - step >= held[i]]
        taking = [i for i in range(len(counts)) if counts[i] + step <= available[i]]
        give = min(giving, key=lambda i: (gain(i, -step), i), default=None)
        take = min(taking, key=lambda i: (gain(i, step), i), default=None)
        if give is None or take is None or give == take or gain(give, -step) + gain(take, step) >= -1e-9:
            step //= 2
            continue
        counts[give] -= step
        counts[take] += step
    return counts


class Stratified:
    """The counted strata and the repaired sample; see ``shortfalls``, ``report`` and ``sample``.

    ``targets`` has one row per stratum and is small; what is collected is one count per stratum, and one of all records.
    A null or empty targets table has no strata, so nothing falls short and the sample is drawn from all records.
    """

    def __init__(self, records: DataFrame, targets: DataFrame, share: Fraction = SAMPLE_SHARE, seed: int = SEED) -> None:
        self.spark, self.seed = records.sparkSession, seed
        self.of = stage(signatures(records, targets), "sample-signatures")
        counted = {(r.category, r.language, r.status): r.n for r in self.of.groupBy(*KEYS).agg(F.count("*").alias("n")).collect()}
        kept = targets.dropDuplicates(KEYS).orderBy(*KEYS).collect()
        self.strata = [t for t in kept if all(t[k] is not None for k in KEYS)]
        self.size = math.floor(sum(counted.values()) * share)
        self.need = needs(self.strata, self.size)
        self.have = [counted.get((t.category, t.language, t.status), 0) for t in self.strata]
        outside = counted.get((None, None, None), 0)  # drawn from only as far as the strata do not hold enough
        goal = [self.size * (t.target_permille or 0) / 1000 for t in self.strata]
        inside = min(self.size, sum(self.have))
        # a stratum that cannot reach what it needs gives all it has, the others at least their minimum; minimums come before the size
        floors = [h if h < n else min(h, t.min_records or 0) for t, n, h in zip(self.strata, self.need, self.have, strict=True)]
        drawn = swap_repair(self.have, floors, goal, max(inside, sum(floors)), seed)
        self.drawn = [*drawn, min(outside, max(0, self.size - sum(drawn)))]

    def report(self) -> DataFrame:
        """Each stratum with its repaired count. It misses what it needs where the repair drew all there is and that is less."""
        rows = [(t.category, t.language, t.status, int(t.target_permille or 0), int(t.min_records or 0), need, have, drawn, max(0, need - drawn) if drawn == have else 0) for t, need, have, drawn in zip(self.strata, self.need, self.have, self.drawn, strict=False)]
        schema = "category string, language string, status string, target_permille int, min_records int, needed bigint, available bigint, drawn bigint, missing bigint"
        return self.spark.createDataFrame(rows, schema)

    def shortfalls(self) -> DataFrame:
        """Strata that the repaired sample leaves below what they need though it drew all their records."""
        return self.report().where("missing > 0").select(*KEYS)

    def sample(self) -> DataFrame:
        """``id`` and stratum of the records drawn."""
        quota = [(t.category, t.language, t.status, n) for t, n in zip(self.strata, self.drawn, strict=False)] + [(None, None, None, self.drawn[-1])]
        quota_df = self.spark.createDataFrame(quota, "category string, language string, status string, quota bigint")
        ranked = running(self.of.withColumn("draw", seeded(self.seed, "id")), KEYS, "draw", ["id"], F.lit(1), "rank")
        same = None
        for k in KEYS:
            c = ranked[k].eqNullSafe(quota_df[k])
            same = c if same is None else same & c
        return ranked.join(F.broadcast(quota_df), same).where("rank < quota").select("id", *[ranked[k] for k in KEYS])
