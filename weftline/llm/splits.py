"""Splits that keep related records together (problem 6).

Families are joined into components over the upstream items they share. Components of one size and label profile are
interchangeable and form a bundle. A min-cost flow carries the records of the bundles to the splits at the lowest deviation
from the quotas, the flow of each bundle is rounded to whole components, from the largest sizes down with what rounding
shifted carried into the next flow, and a bundle's members are assigned in the order of a seeded hash.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.order import running, seeded
from weftline.plans.runtime import stage

# Source ids that only say that none is known, in lower case.
UNKNOWN_IDS = ["", "-", "--", "?", "n/a", "na", "nan", "nil", "none", "null", "tbd", "tba", "unk", "unknown", "not available", "unspecified"]
SEED = 20260818
#: Cost of a record over the quota of its split, over that of its label in the split, and over the split's share of its bundle.
SPLIT_COST, LABEL_COST, BUNDLE_COST = 100, 10, 1


def joined_name(column: Column) -> Column:
    """Lower case, outer spaces off, words joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(column), "^[\\s]+|[\\s]+$", ""), "[\\s_\\-]+", "-")


def _links(records: DataFrame) -> DataFrame:
    """Edges between each family and the smallest one that shares an upstream item with it."""
    known = records.where("family is not null and origin is not null and source_id is not null").where(~F.lower(F.trim("source_id")).isin(UNKNOWN_IDS))
    pairs = known.select(F.lower("origin").alias("origin"), "source_id", "family").distinct()
    least = pairs.groupBy("origin", "source_id").agg(F.min("family").alias("low"))
    return pairs.join(least, ["origin", "source_id"]).where("family <> low").select(F.col("family").alias("a"), F.col("low").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; the root is the smallest node of its component.

    Large-star and small-star steps in turn until no edge changes. Each step is written to the shared folder.
    """
    edges = stage(links.select("a", "b"), "component-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stage(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "component-edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    # at the fixed point every edge leads to a root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def family_groups(records: DataFrame) -> DataFrame:
    """``family_id, group_family`` of every family that must stay with another one.

    Input columns ``family, origin, source_id``. Null families, benchmarks and ids link nothing, nor do ids that only say
    that none is known.
    """
    return components(_links(records)).select(F.col("node").alias("family_id"), F.col("root").alias("group_family"))


class Flow:
    """Min-cost flow by shortest augmenting paths, for graphs of some hundred nodes."""

    def __init__(self) -> None:
        self.out: dict = {}
        self.edges: list[list] = []

    def add(self, a, b, room: int, cost: float) -> int:
        for u, v, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out.setdefault(u, []).append(len(self.edges))
            self.out.setdefault(v, [])
            self.edges.append([v, r, c])
        return len(self.edges) - 2

    def run(self, source, sink) -> None:
        while True:
            distance, through, queue, queued = {source: 0.0}, {}, deque([source]), {source}
            while queue:
                u = queue.popleft()
                queued.discard(u)
                for k in self.out.get(u, ()):
                    v, room, cost = self.edges[k]
                    if room > 0 and distance[u] + cost < distance.get(v, float("inf")) - 1e-12:
                        distance[v], through[v] = distance[u] + cost, k
                        if v not in queued:
                            queued.add(v)
                            queue.append(v)
            if sink not in distance:
                return
            path, v = [], sink
            while v != source:
                path.append(through[v])
                v = self.edges[through[v] ^ 1][0]
            push = min(self.edges[k][1] for k in path)
            for k in path:
                self.edges[k][1] -= push
                self.edges[k ^ 1][1] += push

    def through(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]


def bundle_flow(bundles: list[tuple[int, str, int]], later: dict[str, int], shares: dict[str, float], placed: dict[tuple[str, str], int]) -> dict[tuple[int, str, str], int]:
    """Records that each bundle ``(size, label, count)`` sends to each split in the flow of lowest cost.

    ``later``: records of each label in bundles whose turn comes afterwards, which take part as one node a label;
    ``placed``: records of each label that a split has already. Quotas are the shares of all of these.
    """
    of_label = dict(later)
    for size, label, count in bundles:
        of_label[label] = of_label.get(label, 0) + size * count
    for (label, _), n in placed.items():
        of_label[label] = of_label.get(label, 0) + n
    total = sum(of_label.values())
    flow, edges = Flow(), {}
    for label, n in later.items():
        flow.add("source", ("later", label), n, 0)
        for s in shares:
            flow.add(("later", label), ("label", label, s), n, 0)
    for size, label, count in bundles:
        mass = size * count
        flow.add("source", ("bundle", size, label), mass, 0)
        for s, share in shares.items():
            own = flow.add(("bundle", size, label), ("label", label, s), math.ceil(mass * share), 0)
            edges[size, label, s] = own, flow.add(("bundle", size, label), ("label", label, s), mass, BUNDLE_COST)
    for s, share in shares.items():
        for label, n in of_label.items():
            flow.add(("label", label, s), ("split", s), max(0, round(n * share) - placed.get((label, s), 0)), 0)
            flow.add(("label", label, s), ("split", s), total, LABEL_COST)
        flow.add(("split", s), "sink", max(0, round(total * share) - sum(n for (_, at), n in placed.items() if at == s)), 0)
        flow.add(("split", s), "sink", total, SPLIT_COST)
    flow.run("source", "sink")
    return {k: flow.through(own) + flow.through(over) for k, (own, over) in edges.items()}


def allocate(bundles: list[tuple[int, str, int]], shares: dict[str, float]) -> dict[tuple[int, str], dict[str, int]]:
    """Whole components of each bundle ``(size, label, count)`` for each split.

    Bundles take their turn by powers of two of their size, the largest first: a flow over them and all that come later, then
    each bundle's flow is rounded down to components; those left over go where the flow of the split, then that of the label,
    is still owed most, and what a label is owed is added to the flow of its next bundle. The next turn's flow starts from
    what has been placed, so a component larger than a quota is made up for by all that follow.
    """
    out = {(size, label): dict.fromkeys(shares, 0) for size, label, _ in bundles}
    placed: dict[tuple[str, str], int] = {}
    for level in sorted({size.bit_length() for size, _, _ in bundles}, reverse=True):
        here = sorted((b for b in bundles if b[0].bit_length() == level), key=lambda b: (-b[0], b[1]))
        later: dict[str, int] = {}
        for size, label, count in bundles:
            if size.bit_length() < level:
                later[label] = later.get(label, 0) + size * count
        flow = bundle_flow(here, later, shares, placed)
        owed_label: dict[tuple[str, str], int] = {}
        owed_split = dict.fromkeys(shares, 0)
        for size, label, count in here:
            want = {s: flow[size, label, s] + owed_label.get((label, s), 0) for s in shares}
            left = count
            for s in shares:
                owed_split[s] += flow[size, label, s]

            def place(s: str, n: int) -> None:
                nonlocal left
                out[size, label][s] += n
                want[s] -= n * size
                owed_split[s] -= n * size
                placed[label, s] = placed.get((label, s), 0) + n * size
                left -= n

            for s in sorted(shares, key=lambda s: (-want[s], s)):
                place(s, max(0, min(left, want[s] // size)))
            while left:
                place(max(shares, key=lambda s: (SPLIT_COST * owed_split[s] + LABEL_COST * want[s], s)), 1)
            owed_label.update({(label, s): n for s, n in want.items()})
    return out


def assigned_families(records: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``family, root, linked, size, label, split`` of every family; records without a family are families of their own id.

    ``linked`` says whether the family belongs with another one; the label of a component is the one most of its records have.
    (Whole profiles of labels would make nearly every component a bundle of its own, too many to send to the driver.)

    Input columns ``id, label, family, origin, source_id``; targets ``split_name, target_permille``, a few rows. Distinct
    (size, label) pairs are at most about sqrt(2 x records x labels), as their sizes add up to no more than all records.
    Without targets or with none above zero there is nothing to assign to, and the split is null.
    """
    people = stage(records.select("id", F.coalesce("label", F.lit("")).alias("label"), F.coalesce("family", F.concat(F.lit("record:"), F.col("id"))).alias("family"), F.col("family").alias("named"), "origin", "source_id"), "split-records")
    groups = stage(components(_links(people.select(F.col("named").alias("family"), "origin", "source_id"))), "split-groups")
    sizes = people.groupBy("family", "label").agg(F.countDistinct("id").alias("n"))
    rooted = stage(sizes.join(groups, sizes["family"] == groups["node"], "left").select("family", "label", "n", F.coalesce("root", "family").alias("root"), F.col("root").isNotNull().alias("linked")), "split-families")
    by_label = rooted.groupBy("root", "label").agg(F.sum("n").alias("n"))
    whole = stage(by_label.groupBy("root").agg(F.sum("n").alias("size"), F.max_by("label", F.struct("n", "label")).alias("label")).withColumn("draw", seeded(seed, "root")), "split-components")
    shares = {r.split_name: r.target_permille for r in targets.where("target_permille > 0 and split_name is not null").groupBy("split_name").agg(F.max("target_permille").alias("target_permille")).orderBy("split_name").collect()}
    bundles = [(r.size, r.label, r.n) for r in whole.groupBy("size", "label").agg(F.count("*").alias("n")).orderBy("size", "label").collect()]
    counts = allocate(bundles, {s: n / sum(shares.values()) for s, n in shares.items()}) if shares else {}
    spans = []
    for (size, label), by_split in counts.items():
        at = 0
        for s, n in by_split.items():
            if n:
                spans.append((size, label, s, at, at + n))
                at += n
    spans_df = records.sparkSession.createDataFrame(spans, "size bigint, label string, split string, low bigint, high bigint")
    ranked = running(whole, ["size", "label"], "draw", ["root"], F.lit(1), "rank")
    chosen = ranked.join(spans_df, ["size", "label"], "left").where("split is null or (rank >= low and rank < high)").select("root", "size", "label", "split")
    return rooted.select("family", "root", "linked").distinct().join(chosen, "root").select("family", "root", "linked", "size", "label", "split")


def kept_together(records: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``family_id, group_family`` of every family that the assignment kept with at least one other."""
    return assigned_families(records, targets, seed).where("linked").select(F.col("family").alias("family_id"), F.col("root").alias("group_family"))


def assigned_records(records: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``id, split``: one row per record id. A record delivered again has one split, that of its smallest family."""
    families = assigned_families(records, targets, seed).select("family", "split")
    people = records.select("id", F.coalesce("family", F.concat(F.lit("record:"), F.col("id"))).alias("family")).where("id is not null").distinct()
    return people.join(families, "family").groupBy("id").agg(F.min_by("split", "family").alias("split"))
