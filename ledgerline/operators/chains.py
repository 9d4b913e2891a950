"""Linked lists held as rows: which nodes the start of their list leads to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir


def unreached(links: DataFrame, keys: list[str]) -> DataFrame:
    """Per list, the number of nodes that lie on a loop: ``keys`` and ``unreached``.

    ``links`` has a row per node: the columns ``keys`` of its list, ``node`` and
    ``before``, the node it follows (null for the first).  Nodes of a list differ and each
    is followed once at most, so a list is a chain and, perhaps, loops.

    Pointer doubling, twice a step: every node comes to point to what its pointer's
    pointer's pointer points to, and nodes that have come to the start are dropped, so after
    ``k`` steps only nodes ``4 ** k`` places or more behind it are left, and those on loops
    for ever.  Lists without nodes left are
    not returned.
    """
    ensure_checkpoint_dir(links.sparkSession)
    left = links.where(F.col("before").isNotNull()).checkpoint()
    reach, there = 1, True
    # The longest list bounds the steps; only its length passes through the driver.
    sizes = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max("n")).head()[0] or 0
    while there and reach <= most:
        step = left.select(
            *keys, F.col("node").alias("before"), F.col("before").alias("further")
        )
        for _ in range(3):
            left = left.join(step, [*keys, "before"]).select(
                *keys, "node", F.col("further").alias("before")
            )
        left = left.checkpoint()
        reach *= 4
        there = not left.isEmpty()
    return left.groupBy(*keys).agg(F.count(F.lit(1)).alias("unreached"))

