"""Secret scans with linking of the parts of a credential, in built-in expressions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from starweave.llm.scratch import Scratch

# The patterns of the base rules. Letters of the key names in either case.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
#: Shortest group 2 of an assignment and shortest access identifier.
ASSIGNED, ACCESS_CHARS = 8, 16
BASE = ("assign", "access", "hex")

#: Weak parts: far too common alone. A run of 32 key characters or more with both cases
#: and a digit may be a secret; a service address may be an endpoint; identifiers of other
#: kinds than the base rule's (temporary and role keys, storage keys, account and client
#: ids) may name whom a secret belongs to.
WEAK = {
    "weak_secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Z0-9+/_-]*+[a-z])(?=[a-z0-9+/_-]*+[A-Z])"
    r"(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])",
    "endpoint": r"(?<![A-Za-z0-9])(?:https?|s3|ftp|postgres(?:ql)?|mysql|mongodb)://[A-Za-z0-9.-]+(?::[0-9]{1,5})?"
    r"(?:/[A-Za-z0-9._~/-]*)?",
    "access_id": r"(?<![A-Za-z0-9_-])(?:(?:ASIA|AROA|AIDA|ABIA|ACCA)[A-Z0-9]{16}|GOOG1[A-Z0-9]{10,}+|AC[0-9a-f]{32}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})(?![A-Za-z0-9_-])",
}
#: Parts that make up a credential belong together when at most so many characters lie
#: between them.
SCOPE = 400
#: What each weak part needs in its scope: one of these kinds.
NEEDS = {
    "weak_secret": ("access", "endpoint", "access_id"),
    "endpoint": ("access", "assign", "hex"),
    "access_id": ("weak_secret", "assign", "hex"),
}


def pieces_of(body: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Matches of a pattern, leftmost and non-overlapping, as (kind, before, length, ok).

    Splitting by the pattern gives the text between the matches, extracting the matches
    themselves; ``before`` is the length of the text since the match before, in code points. ``ok``
    tells whether ``group`` is ``least`` characters long: matches that are not use up text all the same.
    """
    between = F.transform(F.split(body, pattern, -1), F.length)
    inside = F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), F.length)
    ok = F.transform(F.regexp_extract_all(body, F.lit(pattern), F.lit(group)), lambda v: F.length(v) >= least)
    zipped = F.arrays_zip(between.alias("b"), inside.alias("n"), ok.alias("ok"))
    named = F.transform(
        F.filter(zipped, lambda x: x["n"].isNotNull()),
        lambda x: F.struct(
            F.lit(kind).alias("kind"), x["b"].alias("before"), x["n"].alias("length"), x["ok"].alias("ok")
        ),
    )
    none = F.array().cast("array<struct<kind:string,before:int,length:int,ok:boolean>>")
    # Most texts have no match; one search tells.
    return F.when(body.rlike(pattern), named).otherwise(none)


def candidate_pieces(body: Column) -> Column:
    """Matches of the base rules and weak candidates of a text.

    A run of hexadecimal digits is matched as a whole, so its least length can be part of the
    pattern. The other base kinds drop short matches afterwards.
    """
    return F.concat(
        pieces_of(body, ASSIGN, "assign", 1, ASSIGNED),
        pieces_of(body, ACCESS, "access", 0, ACCESS_CHARS),
        pieces_of(body, HEX, "hex"),
        *(pieces_of(body, p, k) for k, p in WEAK.items()),
    )


def spans_of(found: DataFrame) -> DataFrame:
    """Spans (``row``, ``kind``, ``start``, ``end``) from rows with their ``pieces``.

    Places are running sums over the matches of a text and kind, so the work is that of
    sorting them: a text with very many matches costs no more for each.
    """
    each = found.filter(F.size("pieces") > 0).select("row", F.posexplode("pieces").alias("at", "_p"))
    before = Window.partitionBy("row", "_p.kind").orderBy("at")
    placed = each.withColumn("end", F.sum(F.col("_p.before") + F.col("_p.length")).over(before).cast("int"))
    return placed.filter("_p.ok").select("row", "_p.kind", (F.col("end") - F.col("_p.length")).alias("start"), "end")


def linked(spans: DataFrame, needs: Mapping[str, tuple[str, ...]] = NEEDS, scope: int = SCOPE) -> DataFrame:
    """Weak spans with a complementary part in their scope, from rows (row, kind, start, end).

    An interval join: two spans meet if they do not overlap and at most ``scope``
    characters lie between them. Text is cut into bins of ``scope`` characters. A part that
    ends in the bin just before a span is near if it ends soon enough, else in the bin
    before that one; likewise for parts that start after it. So the lowest and highest ends
    and starts of each bin and kind are all that the join needs: a weak span meets at most
    four rows for each kind, however many parts a text has.
    """
    ends = spans.select("row", "kind", F.lit("end").alias("side"), F.col("end").alias("at"), (F.col("end") - 1).alias("in"))
    starts = spans.select(
        "row", "kind", F.lit("start").alias("side"), F.col("start").alias("at"), F.col("start").alias("in")
    )
    parts = (
        ends.unionAll(starts)
        .groupBy("row", "kind", "side", F.floor(F.col("in") / scope).alias("bin"))
        .agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
        .select(*(F.col(c).alias(f"_{c}") for c in ("row", "kind", "side", "bin")), "lo", "hi")
    )
    wanted = F.lit(None).cast("array<string>")
    for kind, others in needs.items():
        wanted = F.when(F.col("kind") == kind, F.array(*(F.lit(o) for o in others))).otherwise(wanted)
    before, after = F.floor((F.col("start") - 1) / scope), F.floor(F.col("end") / scope)
    places = F.array(
        F.struct(F.lit("end").alias("side"), before.alias("bin"), F.lit(True).alias("own")),
        F.struct(F.lit("end").alias("side"), (before - 1).alias("bin"), F.lit(False).alias("own")),
        F.struct(F.lit("start").alias("side"), after.alias("bin"), F.lit(True).alias("own")),
        F.struct(F.lit("start").alias("side"), (after + 1).alias("bin"), F.lit(False).alias("own")),
    )
    weak = (
        spans.filter(F.col("kind").isin(*needs))
        .withColumn("part", F.explode(wanted))
        .select("*", F.inline(places))
    )
    earlier = F.when(F.col("own"), F.col("lo") <= F.col("start")).otherwise(F.col("hi") >= F.col("start") - scope)
    later = F.when(F.col("own"), F.col("hi") >= F.col("end")).otherwise(F.col("lo") <= F.col("end") + scope)
    found = weak.join(
        parts,
        (F.col("row") == F.col("_row"))
        & (F.col("part") == F.col("_kind"))
        & (F.col("side") == F.col("_side"))
        & (F.col("bin") == F.col("_bin"))
        & F.when(F.col("side") == "end", earlier).otherwise(later),
    )
    return found.groupBy("row", "kind", "start", "end").agg(
        F.array_sort(F.collect_set("part")).alias("parts")
    )


def find_secrets(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """All rows as ``_row`` with ``base`` (spans of the base rules) and ``spans`` (those
    and the weak parts that are linked), both in order of start, then kind as listed.

    Whole texts are searched; a null text counts as empty. Repeated rows are rows of
    their own, an empty table gives none, further columns go along in ``_row``. The texts
    are read once; only spans are stored, joined and shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession, "secrets")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(0).alias("_")]
    found = scratch.keep(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*rest).alias("_row"),
            candidate_pieces(body).alias("pieces"),
        ),
        "pieces",
    )
    each = scratch.keep(spans_of(found.select("row", "pieces")), "spans")
    weak = linked(each).select("row", "kind", "start", "end")
    wanted = each.filter(F.col("kind").isin(*BASE)).unionAll(weak)
    listed = wanted.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("all"))
    order = F.create_map(*(F.lit(x) for i, k in enumerate((*BASE, *WEAK)) for x in (k, i)))
    sort = lambda spans: F.transform(
        F.array_sort(
            F.transform(
                spans,
                lambda x: F.struct(
                    x["start"].alias("start"), order[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")
                ),
            )
        ),
        lambda x: F.struct(x["kind"], x["start"], x["end"]),
    )
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    every = found.select("row", "_row").join(listed, "row", "left")
    every = every.select("_row", F.coalesce("all", none).alias("all"))
    return every.select(
        "_row",
        sort(F.filter("all", lambda x: x["kind"].isin(*BASE))).alias("base"),
        sort(F.col("all")).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def span_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
