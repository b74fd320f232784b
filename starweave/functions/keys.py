"""Composite text keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def prefix_key(
    head: str, *rest: str, prefix_len: int | None = None, sep: str | None = None
) -> Column:
    """Leading characters of ``head`` joined with the other columns.

    Without ``sep`` the key is null when any part is null. With ``sep`` null
    parts are skipped. ``prefix_len=None`` keeps all of ``head``; a prefix can make
    different keys equal, and so can parts that are joined without their lengths.
    """
    first = F.col(head).cast("string")
    if prefix_len is not None:
        first = F.substring(first, 1, prefix_len)
    parts = [first, *(F.col(c).cast("string") for c in rest)]
    return F.concat(*parts) if sep is None else F.concat_ws(sep, *parts)


def whole_key(*columns: str) -> Column:
    """All columns as text, each with its length before it, or a mark for null.

    No two different natural keys give the same text.
    """
    if not columns:
        raise ValueError("a key needs the columns of the natural key")
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat(
        *(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts)
    )


def digest_key(*columns: str) -> Column:
    """128-bit digest of a natural key as hex text, equal in every run.

    64 bits would be too few: at 10^12 rows collisions become certain.
    """
    return F.md5(whole_key(*columns).cast("binary"))
