"""Exact duplicates by radix partitioning on successive bytes, without digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starweave.llm.scratch import Scratch

#: Bytes looked at in the first round; each later round looks at ``GROWTH`` times as many.
FIRST_BYTES = 256
GROWTH = 4
#: Longest value that Spark holds.
MAX_BYTES = 2**31 - 1


def radix_groups(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] = (),
    keep_text: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Rows with the group of equal texts that each belongs to.

    Most significant digit first: all rows start in one group, and each round splits
    every group by its next bytes (the digit). A group of one row is settled; so is a
    group whose texts have ended, as its members agree in every byte. The digits
    grow from round to round, so a text of n bytes takes about log(n) rounds, and
    only rows still undecided take part in them.

    A round counts the rows of each (group, digit) after a partial sum in each task
    and joins the larger groups back. That join's sides are a stored table and plain
    rows, so adaptive execution splits a group that holds much of the input.

    Null texts count as empty; empty texts are equal to each other. Repeated rows are
    rows of their own. Columns of any name may be carried. Returns ``row`` (unique
    number), ``group`` (null for a row alone), the ``carry`` columns as a struct
    ``_carry`` and, with ``keep_text``, the text as ``_text``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "radix")
    carried = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.struct(F.lit(0).alias("_"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    live = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.lit(0).cast("long").alias("group"),
        carried.alias("_carry"),
        body.alias("_text"),
    )
    settled, at, size, depth = [], 0, FIRST_BYTES, 0
    while True:
        done = at if keep_text else 0  # else what was looked at is gone
        digit = F.substring("_text", done + 1, size)
        ended = F.octet_length("_text") <= done + size
        rows = live.withColumns({"_digit": digit, "_ended": ended})
        label = F.monotonically_increasing_id().alias("_next")
        groups = scratch.keep(
            rows.groupBy("group", "_digit", "_ended")
            .agg(F.count("*").alias("_n"))
            .filter("_n > 1")
            .select("group", "_digit", "_ended", label),
            f"groups-{depth}",
        )
        more = F.col("_next").isNotNull() & ~F.col("_ended")
        rest = F.when(more, F.substring("_text", size + 1, MAX_BYTES))
        # The groups grow with the input: not a side to broadcast.
        split = rows.join(groups.hint("merge"), ["group", "_digit", "_ended"], "left").select(
            "row",
            F.col("_next").alias("group"),
            "_carry",
            (F.col("_text") if keep_text else rest).alias("_text"),
            F.when(more, 1).otherwise(0).alias("_live"),
        )
        split = scratch.keep(split, f"rows-{depth}", partition_by="_live")
        settled.append(split.filter("_live = 0").withColumn("_depth", F.lit(depth)).drop("_live"))
        live = split.filter("_live = 1").drop("_live")
        scratch.drop(f"groups-{depth}", *([f"rows-{depth - 1}/_live=1"] if depth else []))
        if live.isEmpty():
            break
        at, size, depth = at + size, size * GROWTH, depth + 1
    rows = settled[0]
    for other in settled[1:]:
        rows = rows.unionByName(other)
    # Numbers of groups start anew in every round: the round makes them unique.
    group = F.when(F.col("group").isNotNull(), F.struct("_depth", "group"))
    whole = F.col("_text").cast("string").alias("_text")
    out = rows.select("row", group.alias("group"), "_carry", whole)
    return out if keep_text else out.drop("_text")


def exact_duplicates(
    docs: DataFrame,
    order: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    keep_text: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``radix_groups`` with, for each row, the row of its group that stays.

    That is the row with the largest ``order`` (null is lowest); among equal ones the
    row with the largest number. Adds ``keep_id`` (its ``order``), ``group_size`` and
    ``kept``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact")
    columns = list(dict.fromkeys([order, *carry]))
    rows = radix_groups(docs, text, columns, keep_text, scratch)
    key = F.col(f"_carry.`{order}`")
    grouped = rows.filter("group IS NOT NULL")
    best = scratch.keep(
        grouped.groupBy("group").agg(
            F.max(F.struct(key.alias("id"), "row")).alias("_best"), F.count("*").alias("_size")
        ),
        "best",
    )
    found = grouped.join(best, "group").select(
        *rows.columns,
        F.col("_best.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("row") == F.col("_best.row")).alias("kept"),
    )
    alone = rows.filter("group IS NULL").select(
        *rows.columns,
        key.alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return alone.unionAll(found)
