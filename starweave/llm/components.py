"""Connected components of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starweave.llm.scratch import Scratch, gathered

#: Links up to which a round is one task.
TASK_LINKS = 100_000


def connected(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` (the lowest node of its component) of all linked nodes.

    ``links`` has columns ``a`` and ``b``. In each round a node is hooked to the lowest of its
    neighbours (a minimum with partial sums, so a node with very many links sends one row
    per task), hooks are followed three times, and links are carried over to where their ends have
    come, each once: those inside a part are gone, so the next round has fewer. Rounds grow with
    the logarithm of the longest chain. Labels are stored tables, never collected.
    """
    ends = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    edge = scratch.keep(ends.dropDuplicates(), "edges-0", rows=links.count())
    label = edge.select(F.col("a").alias("node"), F.col("b").alias("root"))
    round_ = 0
    while size := edge.count():
        few = size <= TASK_LINKS
        (edge,) = gathered(edge, most=TASK_LINKS)
        both = edge.unionAll(edge.select(F.col("b"), F.col("a")))
        hook = scratch.keep(
            (both.coalesce(1) if few else both)
            .groupBy(F.col("a").alias("node"))
            .agg(F.least(F.min("b"), F.col("node")).alias("root")),
            f"hooks-{round_}",
            rows=2 * size,
        )
        hook = hook.coalesce(1) if few else hook
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        top = hook.select(F.col("node").alias("_up"), F.col("root").alias("_top"))
        step = scratch.keep(
            hook.join(up, "root").join(top, "_up").select("node", F.col("_top").alias("root"), F.col("_up").alias("_old")),
            f"steps-{round_}",
            rows=2 * size,
        )
        step = step.coalesce(1) if few else step
        # Where a chain of hooks goes on above, it is a link.
        chain = step.filter("root <> _old").select(F.col("node").alias("a"), F.col("root").alias("b"))
        carried = edge.unionAll(chain)
        for end in ("a", "b"):
            to = step.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
            carried = (carried.coalesce(1) if few else carried).join(to, end)
        carried = carried.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).filter("a < b")
        if round_:
            new = step.select(F.col("node").alias("root"), F.col("root").alias("_root"))
            label = label.join(new, "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
        else:
            label = step.select("node", "root")
        before, edge = f"edges-{round_}", scratch.keep(carried.dropDuplicates(), f"edges-{round_ + 1}", rows=size)
        scratch.drop(before)
        round_ += 1
    return scratch.keep(label, "labels") if round_ > 1 else label
