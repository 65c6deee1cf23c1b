"""Mixing sources to target weights (problem 8).

Texts that occur in several sources have a membership pattern, the set of those sources. Tokens are summed per pattern
and routed to the sources' quotas by a min-cost flow, in which using a pattern's texts once more costs more each time. The
seeded order of a pattern's texts, laid end to end for every pass, then says which texts a source's flow covers. A text on
the border of two flows is left out; what a source lacks by that is filled with further documents of it that fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.order import running, seeded
from weftline.llm.splits import Flow
from weftline.llm.tokens import VOCABULARY, with_counts
from weftline.plans.runtime import stage

SEED = 20260818
#: Stands first in the pattern of the further copies of a text within a source, whose use repeats it from the start.
COPIES = "\x00copies"
#: Documents of a source and size class (a power of two) of which the last few tokens of a quota are made up.
LAST_CHOICES = 8


def sized_texts(documents: DataFrame, sources: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What can be used: ``text_id, tokens, pattern, names, members``, with the document of each source in ``members``.

    Each distinct text is a row with the smallest document of each source that has it. Every further document of the same
    text in one source is a row of its own. Null and empty texts, texts without tokens, and documents of other sources or
    none take no part. A document delivered again counts once.
    """
    wanted = documents.join(F.broadcast(sources.select("source").distinct()), "source").where("doc_id is not null and text is not null and text <> ''")
    # 128 bits stand for a text; the text itself is counted where it lies, in no shuffle
    counted = wanted.withColumn("text_id", F.md5("text")).select("source", "doc_id", "text_id", "text").mapInArrow(with_counts(vocabulary, keep=("source", "doc_id", "text_id")), "source string, doc_id bigint, text_id string, tokens bigint")
    sized = stage(counted.where("tokens > 0"), "mix-sized")
    each = sized.groupBy("text_id", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"), F.count("*").alias("n"))
    whole = each.groupBy("text_id").agg(F.max("tokens").alias("tokens"), F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("members"))
    firsts = whole.select("text_id", "tokens", F.col("members.source").alias("names"), "members")
    copied = each.where("n > 1").select("text_id", "source", F.col("doc_id").alias("first_id"))
    further = sized.join(copied, ["text_id", "source"]).where("doc_id <> first_id").select("text_id", "source", "doc_id", "tokens").distinct()
    copies = further.select(F.concat_ws(":", "text_id", "source", "doc_id").alias("text_id"), "tokens", F.array(F.lit(COPIES), F.col("source")).alias("names"), F.array(F.struct("source", "doc_id")).alias("members"))
    return stage(firsts.unionByName(copies).withColumn("pattern", F.to_json("names")), "mix-usable")


def route(capacity: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int) -> dict[tuple[tuple[str, ...], str], int]:
    """Tokens each source takes from each pattern. The n-th use of a pattern's tokens costs n - 1, a missed quota more than any use."""
    flow, edges = Flow(), {}
    for pattern, tokens in sorted(capacity.items()):
        sources = [s for s in pattern if s in targets]
        for use in range(sum(targets[s][1] for s in sources)):
            flow.add("in", pattern, tokens, use + (COPIES in pattern))
        for s in sources:
            edges[pattern, s] = flow.add(pattern, s, tokens * targets[s][1], 0)
    for s, (share, _) in targets.items():
        flow.add(s, "out", round(total * share), 0)
    flow.run("in", "out")
    return {k: n for k, e in edges.items() if (n := flow.through(e))}


def best_fill(sizes: Sequence[int], room: int) -> list[int]:
    """Places of the sizes whose sum comes closest to ``room`` without going over it; of equal sums the one that needs the earlier sizes."""
    mask, reached = (1 << (room + 1)) - 1, [1]
    for n in sizes:
        reached.append((reached[-1] | reached[-1] << n) & mask)
    left, out = reached[-1].bit_length() - 1, []
    for i in range(len(sizes) - 1, -1, -1):
        if not reached[i] >> left & 1:
            out.append(i)
            left -= sizes[i]
    return out[::-1]


def reachable_total(capacity: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]]) -> int:
    """The largest total at which each source that has texts at all can fill its quota, by bisection over flows."""
    present = {s: t for s, t in targets.items() if t[0] > 0 and any(s in p for p in capacity)}
    if not present:
        return 0
    low, high = 0, int(min(sum(n for p, n in capacity.items() if s in p) * reps / share for s, (share, reps) in present.items()))
    full = lambda t: sum(route(capacity, targets, t).values()) >= sum(round(t * share) for share, _ in present.values())
    if full(high):
        return high
    while high - low > max(1, high // 1000):
        middle = (low + high) // 2
        low, high = (middle, high) if full(middle) else (low, middle)
    return low


def _filled(texts: DataFrame, used: DataFrame, clean: DataFrame, quotas: dict[str, int], seed: int) -> DataFrame:
    """Changes of uses, ``source, doc_id, repeats, tokens``, that bring each source up to its quota as far as its documents fit.

    First the documents of a source in seeded order, those not used yet before the others, as long as they fit. Then a few
    uses and a few free documents of every size class are chosen anew, the ones that together come closest; a use that
    is given up is a row with -1 repeats. What is collected is that many rows per source.
    """
    spark = texts.sparkSession
    held = {r.source: r.n for r in used.groupBy("source").agg(F.sum(F.expr("repeats * tokens")).alias("n")).collect()}
    rooms = {s: n - held.get(s, 0) for s, n in quotas.items()}
    limits = spark.createDataFrame([(s, n, rooms[s]) for s, n in quotas.items() if rooms[s] > 0], "source string, quota bigint, room bigint")
    every = texts.select("tokens", F.explode("members").alias("m")).select("m.source", "m.doc_id", "tokens")
    spent = used.groupBy("source", "doc_id").agg(F.sum("repeats").alias("spent"))
    open_ = every.join(F.broadcast(limits), "source").where("tokens <= quota").join(spent, ["source", "doc_id"], "left").join(F.broadcast(clean.select("source", "max_repeats")), "source")
    draw = F.shiftrightunsigned(seeded(seed + 1, "source", "doc_id"), 1).bitwiseOR(F.when(F.col("spent").isNull(), F.lit(0)).otherwise(F.lit(-(2**63))))
    state = stage(open_.select("source", "doc_id", "tokens", "room", F.coalesce("spent", F.lit(0)).alias("spent"), (F.coalesce("spent", F.lit(0)) < F.col("max_repeats")).alias("free"), draw.alias("draw")), "mix-state")
    ranked = running(state.where("free and tokens <= room"), ["source"], "draw", ["doc_id"], F.col("tokens"), "before")
    fitting = stage(ranked.where("before + tokens <= room").select("source", "doc_id", F.lit(1).alias("repeats"), "tokens"), "mix-fitting")
    for r in fitting.groupBy("source").agg(F.sum("tokens").alias("n")).collect():
        rooms[r.source] -= r.n
    after = state.join(fitting.select("source", "doc_id", F.lit(True).alias("fits")), ["source", "doc_id"], "left").withColumn("fits", F.coalesce("fits", F.lit(False)))
    # whether a choice is a use of now, that may be given up, or one more
    kinds = F.filter(F.array(F.when(F.col("fits") | (F.col("spent") > 0), True), F.when(F.col("free") & ~F.col("fits"), False)), lambda k: k.isNotNull())
    nth = F.row_number().over(Window.partitionBy("source", "now", F.floor(F.log2("tokens"))).orderBy((F.col("draw") < 0).cast("int"), "draw", "doc_id"))
    choices: dict[str, list] = {}
    for r in after.select("source", "doc_id", "tokens", "draw", F.explode(kinds).alias("now")).withColumn("nth", nth).where(F.col("nth") <= LAST_CHOICES).orderBy("source", F.desc("now"), "nth", "doc_id").collect():
        choices.setdefault(r.source, []).append(r)
    last = []
    for s, rows in choices.items():
        taken = set(best_fill([r.tokens for r in rows], rooms[s] + sum(r.tokens for r in rows if r.now)))
        last += [(s, r.doc_id, (i in taken) - r.now, r.tokens) for i, r in enumerate(rows) if (i in taken) != r.now]
    return fitting.unionByName(spark.createDataFrame(last, "source string, doc_id bigint, repeats int, tokens bigint"))


def mixture(documents: DataFrame, mix_targets: DataFrame, total_tokens: int | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mixture, ``source, doc_id, repeats, tokens`` (of one use), and the report of each target source.

    ``total_tokens``: without it the largest total at which all sources that have documents reach their share. Patterns are
    sets of target sources, which are a few rows; what is collected is one sum per pattern that occurs. Sources with a null
    or negative share, or with no uses allowed, get no quota. A source comes within its quota as closely as its unused
    documents fit, and not over it. In the report ``actual_share`` is of the tokens that the mixture has, ``planned_share`` of
    those asked for; the two differ where a source has not enough documents.
    """
    spark = documents.sparkSession
    clean = mix_targets.where("source is not null").groupBy("source").agg(F.max(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"))
    targets = {r.source: (r.target_share, r.max_repeats) for r in clean.orderBy("source").collect()}
    texts = sized_texts(documents, clean, vocabulary)
    capacity = {tuple(r.names): r.tokens for r in texts.groupBy("names").agg(F.sum("tokens").alias("tokens")).collect()}
    total = reachable_total(capacity, targets) if total_tokens is None else total_tokens
    flows = route(capacity, targets, total)
    spans, at, quotas = [], {}, {}
    for (pattern, source), n in sorted(flows.items()):
        start = at.get(pattern, 0)
        spans.append((list(pattern), source, capacity[pattern], start, start + n))
        at[pattern] = start + n
        quotas[source] = quotas.get(source, 0) + n
    spans_df = spark.createDataFrame(spans, "names array<string>, source string, size bigint, low bigint, high bigint").withColumn("pattern", F.to_json("names")).drop("names")
    placed = running(texts.withColumn("draw", seeded(seed, "text_id")), ["pattern"], "draw", ["text_id"], F.col("tokens"), "before")
    # a text lies at before, before + size, before + 2 size, ...: how many of these places are whole within [low, high)
    floor = lambda x: f"(({x}) - pmod({x}, size)) div size"
    whole = F.expr(f"greatest(0, {floor('high - before - tokens')} - {floor('low - before + size - 1')} + 1)")
    covered = placed.join(F.broadcast(spans_df), "pattern").withColumn("repeats", whole.cast("int")).where("repeats > 0")
    used = stage(covered.select("source", F.expr("filter(members, m -> m.source = source)[0].doc_id").alias("doc_id"), "repeats", "tokens"), "mix-used")
    both = used.unionByName(_filled(texts, used, clean, quotas, seed))
    chosen = stage(both.groupBy("source", "doc_id", "tokens").agg(F.sum("repeats").cast("int").alias("repeats")).where("repeats > 0").select("source", "doc_id", "repeats", "tokens"), "mix-chosen")
    reached = chosen.groupBy("source").agg(F.sum(F.col("repeats") * F.col("tokens")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    there = texts.select(F.explode("members.source").alias("source"), "tokens").groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    sums = clean.join(reached, "source", "left").join(there, "source", "left")
    everything = reached.agg(F.sum("tokens").alias("all_tokens"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    share = lambda of: F.coalesce(F.try_divide("tokens", of), F.lit(0.0))
    report = sums.join(F.broadcast(everything)).select("source", "target_share", "max_repeats", zero("available_tokens"), F.rint(F.lit(total) * F.col("target_share")).cast("bigint").alias("quota_tokens"), zero("tokens"), zero("documents"), zero("most_repeats"), share(F.col("all_tokens")).alias("actual_share"), share(F.lit(total)).alias("planned_share"))
    return chosen, report
