"""Mixing sources to target weights by Pfair scheduling, in built-in functions only.

Every source's documents form blocks of ``block`` documents.  While a set of sources is
active with whole-number weights ``w`` that add up to ``W``, block ``i`` of a source
(from 1) is released at slot ``floor((i - 1) * W / w)`` and due by ``ceil(i * W / w)``;
each slot takes, of the released blocks, the one due first.  So at any slot each source
is less than one block from its exact share.  After ``W`` slots everybody is exactly
even and the pattern repeats, so one pattern of ``W`` slots is all that is computed one
slot after another.  When a source runs out, the others go on in a new phase among
themselves: nothing is dropped or repeated.

A document's slot then follows from its number within its source by arithmetic.  The
numbers come from counts per source and leading hexadecimal digits of the md5 of the
document's id, so a source with a third of all rows is numbered in many small groups.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import small_side

BLOCK = 8
PERIOD = 240
GROUP_ROWS = 4096


@dataclass(frozen=True)
class Phase:
    """A stretch of slots with the same active sources."""

    first_slot: int
    period: int
    weights: dict[str, int]
    pattern: dict[str, list[int]]
    taken: dict[str, int]  # blocks that each active source has had before


def default_weights(counts: dict[str, int], period: int = PERIOD) -> dict[str, int]:
    """Weights in proportion to the square root of the sizes, at least 1 of the period."""
    period = max(period, 2 * len(counts))
    spare, done, total = period - len(counts), 0, sum(map(math.isqrt, counts.values()))
    weights = {}
    for name in sorted(counts):
        share = math.isqrt(counts[name])
        weights[name] = 1 + spare * (done + share) // total - spare * done // total
        done += share
    return weights


def pattern_of(weights: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period: earliest deadline first."""
    period = sum(weights.values())
    waiting = [(0, -(-period // w), name, 1) for name, w in weights.items()]
    heapq.heapify(waiting)
    released: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {name: [] for name in weights}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, due, name, i = heapq.heappop(waiting)
            heapq.heappush(released, (due, name, i))
        _, name, i = heapq.heappop(released)
        slots[name].append(slot)
        w = weights[name]
        if i < w:
            heapq.heappush(
                waiting, (i * period // w, -(-(i + 1) * period // w), name, i + 1)
            )
    return slots


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[Phase]:
    """The schedule: a new phase each time that sources run out."""
    left = {name: n for name, n in blocks.items() if n}
    taken = dict.fromkeys(left, 0)
    made, first = [], 0
    while left:
        active = {name: weights[name] for name in left}
        period, pattern = sum(active.values()), pattern_of(active)
        ends = []
        for name, n in left.items():
            whole, rest = divmod(n - 1, active[name])
            ends.append(whole * period + pattern[name][rest] + 1)
        length = min(ends)
        made.append(Phase(first, period, active, pattern, {x: taken[x] for x in left}))
        whole, rest = divmod(length, period)
        for name in list(left):
            had = whole * active[name] + sum(s < rest for s in pattern[name])
            taken[name] += had
            left[name] -= had
            if not left[name]:
                del left[name]
        first += length
    return made


def _schedule(spark, plan: list[Phase]) -> DataFrame:
    """One row per source: its phases with what slots follow from."""
    rows = []
    for name in plan[0].weights if plan else ():
        own = [p for p in plan if name in p.weights]
        rows.append(
            {
                "mix_source": name,
                "phases": [
                    {
                        "taken": p.taken[name],
                        "first_slot": p.first_slot,
                        "period": p.period,
                        "weight": p.weights[name],
                        "pattern": p.pattern[name],
                    }
                    for p in own
                ],
            }
        )
    kind = (
        "array<struct<mix_source:string,phases:array<struct<taken:bigint,"
        "first_slot:bigint,period:bigint,weight:bigint,pattern:array<bigint>>>>>"
    )
    table = F.from_json(F.lit(json.dumps(rows)), kind)
    return spark.range(1).select(F.inline(table))


def _slot(block: Column) -> Column:
    """The slot of a source's block, counted from 0."""
    phase = F.element_at(
        F.filter("phases", lambda p: p["taken"] <= block), F.lit(-1)
    )
    done = block - phase["taken"]
    turn = F.floor(done / phase["weight"])
    inside = F.get(phase["pattern"], (done % phase["weight"]).cast("int"))
    return phase["first_slot"] + turn * phase["period"] + inside


def mixed(
    docs: DataFrame,
    weights: dict[str, int] | None = None,
    block: int = BLOCK,
    period: int = PERIOD,
) -> DataFrame:
    """``docs`` with ``mix_block`` (number within the source), ``mix_slot`` and
    ``mix_place`` (within the block): sorted by the last two, sources are mixed.

    ``docs`` needs ``doc_id`` and ``source`` and keeps all its columns, but for any named
    as the three new ones, which are replaced; a null source
    counts as the empty name.  ``weights`` are whole numbers of 1 or more for every
    source; by default they follow the square roots of the sizes.  The sources are
    listed on the driver: they are what weights are given for.  Documents with equal or
    no id stand side by side in any order.  An empty table stays empty.
    """
    spark = docs.sparkSession
    source = F.coalesce(F.col("source"), F.lit(""))
    sized = docs.select(source.alias("s")).groupBy("s").count().collect()
    counts = {row["s"]: row["count"] for row in sized}
    weights = weights or default_weights(counts, period)
    lacking = sorted(set(counts) - {name for name, w in weights.items() if w >= 1})
    if lacking:
        raise ValueError(f"no weight for sources {lacking}")
    plan = phases({name: -(-n // block) for name, n in counts.items()}, weights)

    largest = max(counts.values(), default=0)
    digits = max(1, math.ceil(math.log(max(1, largest / GROUP_ROWS), 16)))
    made = ("mix_block", "mix_slot", "mix_place")
    columns = [name for name in docs.columns if name not in made]
    marked = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("mix_row"),
        F.col("doc_id").cast("string").alias("mix_id"),
        source.alias("mix_source"),
    )
    marked = marked.withColumn(
        "mix_hash", F.md5(F.coalesce("mix_id", F.lit("")).cast("binary"))
    ).withColumn("mix_group", F.substring("mix_hash", 1, digits))
    sizes = marked.groupBy("mix_source", "mix_group").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("mix_source")
        .orderBy("mix_group")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "mix_source",
        "mix_group",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("mix_before"),
    )
    order = Window.partitionBy("mix_source", "mix_group").orderBy("mix_hash", "mix_id")
    number = F.col("mix_before") + F.col("mix_rank") - 1
    return (
        marked.withColumn("mix_rank", F.row_number().over(order))
        .join(small_side(offsets), ["mix_source", "mix_group"])
        .join(F.broadcast(_schedule(spark, plan)), "mix_source")
        .withColumn("mix_block", F.floor(number / block))
        .withColumn("mix_slot", _slot(F.col("mix_block")))
        .withColumn("mix_place", (number % block).cast("int"))
        .select(*[F.col("mix_row")[name].alias(name) for name in columns], *made)
    )
