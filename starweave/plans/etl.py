"""From raw CSV files to checked warehouse tables."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starweave.functions import trunc_int
from starweave.operators.clean import complete, distinct_rows
from starweave.operators.dedup import SEVERAL, alone_and_several, repeated_digests, zero_floats
from starweave.operators.quality import (
    Measured,
    check_join_size,
    gate,
    gate_measured,
)
from starweave.operators.star import Star, broadcast_if_small
from starweave.plans import match_star as ms
from starweave.session import (
    bucket_number,
    concurrently,
    delete_folder,
    drop_together,
    even_buckets,
    few_files,
    folder_bytes,
    materialize,
    scratch_dir,
    settings,
    short_tasks,
    stored_together,
)
from starweave.sinks.publish import (
    Edition,
    adopt,
    create_part,
    drop_parts,
    new_part,
    part_spec,
    part_table,
    publish,
    published,
    read_published,
)
from starweave.sinks.stage import stage_all
from starweave.sinks.warehouse import (
    TableSpec,
    analyze,
    create_tables,
    load,
    load_staged,
    merge_day,
)
from starweave.sources.csv import REJECT, read_csv, schema_by_name
from starweave.sources.staged import read_stage, stage_path


@dataclass(frozen=True)
class EtlConfig:
    """Where the job reads and writes, and how it builds keys and ids.

    The known columns of the stats file have the types of the warehouse and
    further columns stay text; ``infer_stats`` infers the types instead, at the
    price of one more pass over the file. ``header=False`` is for kill files
    without a header line, ``stats_columns`` names the columns of stats files without
    one. ``load_days`` is ``run`` for the day of the run, ``latest``, ``all``, a day, or
    ``incremental``: the day of the run is merged into what is loaded, without reading the days
    before again. ``newest`` keeps what the last day says of each key, as ``incremental``
    always does. ``mode`` is ``replace`` or ``append``.

    ``keys`` is ``whole`` (no two kills or players share a key) or ``plain`` (parts joined as
    they are: match, second and killer, match and player); ``prefix_len`` cuts the match ids of
    plain keys, which can merge matches, and implies them. ``strict_keys`` makes merged
    keys an error. ``buckets`` is the number of buckets that facts and kill details are
    hashed into by their common key; without it the staged bytes tell, 0 sorts the tables instead.
    ``most_facts`` bounds the rows of the fact, which is checked before it is joined.
    """

    input_root: str
    stage_root: str
    database: str
    database_location: str | None = None
    prefix_len: int | None = None
    keys: str | None = None
    ids: str = "monotonic"
    infer_stats: bool = False
    header: bool = True
    stats_columns: tuple[str, ...] = ()
    header_check: bool = True
    named_days: bool = True
    load_days: str = "run"
    newest: bool = False
    mode: str = "replace"
    strict_keys: bool = False
    max_records_per_file: int = 0
    buckets: int | None = None
    most_facts: int | None = None

    def __post_init__(self) -> None:
        if self.keys not in (None, "whole", "plain") or self.keys == "whole" and self.prefix_len:
            raise ValueError(f"keys {self.keys} with a prefix of {self.prefix_len}")
        if self.mode not in ("replace", "append"):
            raise ValueError(f"unknown load mode: {self.mode}")

    @property
    def whole(self) -> bool:
        return self.keys == "whole" or self.keys is None and self.prefix_len is None


@dataclass(frozen=True)
class EtlReport:
    """What a run found.

    ``rejected``: rows of the raw files that could not be read. ``merged_keys``: keys that
    stand for several natural keys, a kill's being match, second, killer and victim. ``merged_rows``:
    rows that share the key of another one, whose columns their dimension has.
    ``missing``: shares of nulls of the checked columns, as staged.
    """

    rejected: Mapping[str, int]
    merged_keys: Mapping[str, int]
    merged_rows: Mapping[str, int] = field(default_factory=dict)
    missing: Mapping[str, Mapping[str, float | None]] = field(default_factory=dict)


REJECTS = "rejects"
_BAD = "_bad"
#: Staged bytes of facts and kill details for each bucket: zstd leaves about 10 bytes of a row with short ids.
BUCKET_BYTES = 16 << 20
#: Raw bytes, as a rule compressed, of the larger file for each bucket of clean rows.
RAW_BUCKET_BYTES = 32 << 20
#: Raw and staged bytes that a task reads at most and sorts on the way to its buckets, some two million rows.
RAW_TASK_BYTES, TASK_BYTES = 64 << 20, 32 << 20
MATCH = ("match_id",)
EVERY_KEY = "spark.sql.requireAllClusterKeysForCoPartition"
#: Tables that are bucketed by the key that joins them.
BUCKETED = ("locations", "details")
#: Those that are bucketed by match if their keys tell it, with the key.
BY_MATCH = {"locations": ("detail_id", "performance_id"), "details": ("detail_id",), "matches": (), "performances": ("performance_id",)}


def today() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d")


def read_stats(spark: SparkSession, config: EtlConfig, rejects: bool = False) -> DataFrame:
    """Stats rows; text columns, the date among them, are never inferred.

    Whole numbers are read with or without a fraction, which is cut off.
    """
    path = f"{config.input_root.rstrip('/')}/{ms.STATS_PATH}"
    check, header = config.header_check, not config.stats_columns
    types = {n: "double" if n in ms.STATS_NUMBERS else t for n, t in ms.STATS_TYPES.items()}
    if config.infer_stats:
        texts = {n: t for n, t in ms.STATS_TYPES.items() if t == "string"}
        return read_csv(spark, path, types=texts, header=header, header_check=check, rejects=rejects)
    if header:
        schema = schema_by_name(spark, path, types)
    else:
        schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in config.stats_columns)
    stats = read_csv(spark, path, schema, header=header, header_check=check, rejects=rejects)
    return stats.withColumns({n: trunc_int(n) for n in ms.STATS_NUMBERS})


def read_kills(spark: SparkSession, config: EtlConfig, rejects: bool = False) -> DataFrame:
    path = f"{config.input_root.rstrip('/')}/{ms.KILLS_PATH}"
    return read_csv(
        spark,
        path,
        ms.KILLS_SCHEMA,
        header=config.header,
        header_check=config.header_check,
        rejects=rejects,
    )


def _rows_once(
    raw: DataFrame,
    columns: Sequence[str],
    unreadable: Column,
    folder: str,
    name: str,
    buckets: int,
    shuffle: bool,
) -> tuple[DataFrame, DataFrame, bool]:
    """Clean rows bucketed by match, and the rejects as often as they were there, from one parse and one write.

    A reject is malformed and so incomplete, or has an unreadable date. Others with a null
    are dropped. Equal rows become one; their digests meet in the bucket, see
    ``distinct_rows_late``. If rows repeat, the distinct ones are stored again. The last value is
    False if the matches of a bucket are too many rows, see ``stored_together``.
    """
    missing = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in columns])
    bad = F.coalesce((F.col(REJECT).isNotNull() & missing) | unreadable, F.lit(False))
    whole = F.expr(complete(raw, [c for c in raw.columns if c != REJECT]))
    flagged = zero_floats(raw).withColumn(_BAD, bad).filter(F.col(_BAD) | whole)
    stored, together = stored_together(flagged, MATCH, buckets, name, folder, _BAD, shuffle)
    good = stored.filter(~F.col(_BAD)).drop(_BAD, REJECT)
    rejects = stored.filter(_BAD).drop(_BAD)
    repeated = repeated_digests(good, good.columns, folder, MATCH if together else ())
    if repeated is not None and repeated.isEmpty():
        return good, rejects, together
    if together:
        once, together = stored_together(distinct_rows(good), MATCH, buckets, f"{name}-once", folder)
        return once, rejects, together
    if repeated is None:
        return materialize(distinct_rows(good), f"{name}-once", folder), rejects, False
    alone, several = alone_and_several(good, good.columns, repeated)
    once = materialize(several.dropDuplicates(), f"{name}-once", folder)
    return alone.unionAll(once), rejects, False


def transform(spark: SparkSession, config: EtlConfig, run_date: str) -> EtlReport:
    """Clean both raw tables, build the five tables and stage them, all of them or none.

    Each raw file is parsed once, and rows are written once before they are staged: the
    clean ones, each once, and the rejects. The clean ones feed four and three outputs, each
    of which reads only its own columns. Nulls of the key columns, and keys that stand for several
    natural keys, are counted while the tables are staged. What was stored in between is deleted at the end.

    The clean rows lie in buckets by match, which all that is made of them but the start times is
    grouped or joined by. So only keys that occur in several matches are shuffled, found by digests.
    """
    folder = scratch_dir(spark)
    # Rows that lie together by match need no shuffle to be joined by match and player.
    with settings(spark, {EVERY_KEY: "false", **short_tasks(spark, RAW_TASK_BYTES)}):
        try:
            return _transform(spark, config, run_date, folder)
        finally:
            drop_together(spark, folder)
            delete_folder(spark, folder)


def _transform(spark: SparkSession, config: EtlConfig, run_date: str, folder: str) -> EtlReport:
    raw_stats, raw_kills = read_stats(spark, config, True), read_kills(spark, config, True)
    unreadable = F.col("date").isNotNull() & ms.game_time(raw_stats).isNull()
    raw = {
        "stats": (raw_stats, list(ms.STATS_TYPES), unreadable),
        "kills": (raw_kills, [c for c in raw_kills.columns if c != REJECT], F.lit(False)),
    }
    root = config.input_root.rstrip("/")
    size = max(folder_bytes(spark, f"{root}/{p}") for p in (ms.STATS_PATH, ms.KILLS_PATH))
    buckets = bucket_number(spark, size, RAW_BUCKET_BYTES)
    shuffle = not few_files(spark, size, buckets)
    read = dict(zip(raw, concurrently(partial(_rows_once, *r, folder, n, buckets, shuffle) for n, r in raw.items())))
    together = all(t for _, _, t in read.values())
    # Whole keys tell their match, so they need not be looked for in other buckets.
    within, rare = MATCH if together else (), folder if config.whole != together else None
    stats, kills = read["stats"][0].select(*ms.STATS_TYPES), read["kills"][0]
    if config.most_facts is not None:
        check_join_size(kills, stats, ms.KILLER_IS_PLAYER, config.most_facts)
    star = ms.match_star(kills, stats, config.prefix_len, whole=config.whole, rare=rare, several=not config.whole, within=within, ids=config.ids)
    tables = {star.name: star.fact, **star.dims}
    # Whole keys are their natural keys: there is nothing to look for.
    merging = () if config.whole else ("performances", "details")
    measured = {
        s.name: Measured(tuple(ms.NULL_CHECKS[s.name]), (SEVERAL,) if s.name in merging else ())
        for s in ms.TABLES
    }
    staged = {s.source: measured[s.name].on(tables[s.name]).drop(SEVERAL) for s in ms.TABLES}
    staged |= {f"{REJECTS}/{n}": bad for n, (_, bad, _) in read.items()}
    stage_all(staged, config.stage_root, run_date, config.named_days, config.max_records_per_file)
    days = {
        n: read_stage(spark, config.stage_root, n, run_date, config.named_days)
        for n in (*(f"{REJECTS}/{r}" for r in raw), "performance", "detail")
    }
    counts = {n: partial(d.count) for n, d in days.items()}  # from the files' footers
    counts |= {"stats": partial(stats.count), "kills": partial(kills.count)}
    found = dict(zip(counts, concurrently(counts.values())))
    return EtlReport(
        {n: found[f"{REJECTS}/{n}"] for n in raw},
        {n: measured[n].told(SEVERAL) if n in merging else 0 for n in ("performances", "details")},
        {
            "performances": found["stats"] - found["performance"],
            "details": found["kills"] - found["detail"],
        },
        {n: m.missing() for n, m in measured.items()},
    )


def check_staged(spark: SparkSession, config: EtlConfig, run_date: str) -> None:
    """Raise when a key column of the staged day has nulls or no rows."""
    tables = {
        s.name: read_stage(spark, config.stage_root, s.source, run_date, config.named_days)
        for s in ms.TABLES
    }
    gate(tables, ms.NULL_CHECKS)


def layouts(spark: SparkSession, config: EtlConfig, day: str | None) -> tuple[TableSpec, ...]:
    """The tables with the two that meet on the kill's key hashed into buckets by it, or all but the dates by match.

    The latter if keys are whole, as staged, so that equal keys are of equal matches, no match is hot, and the number
    of buckets is not given. That number comes from the bytes of the staged day, or of all days, and is at least
    that of the cores; so the joins need no shuffle. Nor does the load, unless that makes too many files.
    What is staged lies by match already, so a load by match makes few.
    """
    buckets, size = config.buckets, 0
    for s in ms.TABLES:
        if s.name in BUCKETED:
            folder = f"{config.stage_root.rstrip('/')}/{s.source}"
            size += folder_bytes(
                spark, stage_path(config.stage_root, s.source, day, config.named_days) if day else folder
            )
    if buckets is None:
        buckets = bucket_number(spark, size, BUCKET_BYTES)
        if config.whole and _lie_by_match(spark, config, day, buckets):
            return tuple(
                replace(s, bucket_by=MATCH, buckets=buckets, direct=True) if s.name in BY_MATCH else s
                for s in ms.TABLES
            )
    if not buckets:
        return ms.TABLES
    direct = few_files(spark, size, buckets)
    return tuple(
        replace(s, bucket_by=("detail_id",), buckets=buckets, direct=direct) if s.name in BUCKETED else s
        for s in ms.TABLES
    )


def _lie_by_match(spark: SparkSession, config: EtlConfig, day: str | None, buckets: int) -> bool:
    """Whether all staged keys begin with the match of their row, and the matches of no bucket are too many rows."""

    def fits(spec: TableSpec) -> bool:
        rows = read_stage(spark, config.stage_root, spec.source, day or "all", config.named_days)
        if not even_buckets(rows, MATCH, buckets):
            return False
        told = [F.coalesce(ms.whole_match(k), F.lit(False)) for k in BY_MATCH[spec.name]]
        return not told or rows.filter(~reduce(Column.__and__, told)).isEmpty()

    return all(concurrently(partial(fits, s) for s in ms.TABLES if s.name in BY_MATCH))


def load_warehouse(spark: SparkSession, config: EtlConfig, run_date: str) -> Edition:
    """Load all five tables and publish them together, or none.

    The rows go to new tables aside, nulls of the key columns are counted on the way, and only
    when all are there and pass the gate does the published star change, by one
    statement. A load that fails leaves the old star whole.
    """
    with settings(spark, short_tasks(spark, TASK_BYTES)):
        return _load_warehouse(spark, config, run_date)


def _load_warehouse(spark: SparkSession, config: EtlConfig, run_date: str) -> Edition:
    create_tables(spark, (), config.database, config.database_location)
    before = adopt(spark, ms.TABLES, config.database)
    day = run_date if config.load_days in ("run", "incremental") else config.load_days
    # An earlier or repeated day cannot take back what it said before: all days are read.
    merge = config.load_days == "incremental" and before.parts and (before.last_day or "9") < run_date
    every = config.load_days == "incremental" and before.parts and not merge
    part = new_part(run_date)
    specs = layouts(spark, config, day if day.isdigit() and not merge and not every else None)

    def load_one(spec: TableSpec) -> Measured:
        table, checks = part_table(spec.name, part), ms.NULL_CHECKS[spec.name]
        if merge:
            rows = merge_day(
                read_published(spark, config.database, spec.name, before),
                read_stage(spark, config.stage_root, spec.source, run_date, config.named_days),
                spec.key,
            )
            done = load(rows, part_spec(spec, part), config.database, measure=checks)
        else:
            done = load_staged(
                spark,
                spec,
                config.database,
                config.stage_root,
                "all" if every else day,
                named=config.named_days,
                newest=config.newest or bool(every),
                measure=checks,
                table=table,
            )
        analyze(spark, config.database, table)
        return done

    try:
        create_part(spark, specs, config.database, part)
        measured = concurrently(partial(load_one, s) for s in specs)
        gate_measured({s.name: m.missing() for s, m in zip(specs, measured)})
        parts = [*before.parts, part] if config.mode == "append" else [part]
        last = max(run_date, before.last_day or "") if every or config.mode == "append" else run_date
        return publish(spark, specs, config.database, parts, before, last)
    except BaseException:
        drop_parts(spark, specs, config.database, [part], published(spark, config.database))
        raise


def check_warehouse(spark: SparkSession, database: str) -> None:
    """Raise when a key column of a loaded table has nulls or no rows."""
    tables = {t: spark.table(f"{database}.{t}") for t in ms.NULL_CHECKS}
    gate(tables, ms.NULL_CHECKS)


def open_star(spark: SparkSession, database: str) -> Star:
    """The loaded tables as a star, all of one edition even while the next is being published.

    Not assumed complete: loads of several days repeat keys. Small dimensions
    marked so are broadcast, all small ones are joined last; those bucketed like the fact are joined first.
    Where all are bucketed by match, the session is set to join them by match and key where they are.
    """
    edition = published(spark, database)
    stored = {s.name: read_published(spark, database, s.name, edition) for s in ms.TABLES}
    alone = len(edition.parts) == 1
    by = {n: _bucketed_by(spark, f"{database}.{part_table(n, edition.parts[0])}") for n in stored} if alone else {}
    beside = MATCH if by.get(ms.FACT) == MATCH else ()
    lying = tuple(n for n in by if by[n] == MATCH) if beside else BUCKETED
    if beside:
        spark.conf.set(EVERY_KEY, "false")
    measured = {n: broadcast_if_small(t) for n, t in stored.items() if n not in BUCKETED}
    small = tuple(n for n, t in measured.items() if t is not stored[n])
    tables = {s.name: measured[s.name] if s.replicate else stored[s.name] for s in ms.TABLES}
    fact = tables.pop(ms.FACT)
    together = tuple(n for n in lying if n != ms.FACT) if alone else ()
    return Star(ms.FACT, fact, tables, ms.LINKS, colocated=together, small=small, beside=beside)


def _bucketed_by(spark: SparkSession, table: str) -> tuple[str, ...]:
    return tuple(c.name for c in spark.catalog.listColumns(table) if c.isBucket)


def verified(star: Star) -> Star:
    """Mark a star complete after checking it, else raise."""
    bad = star.integrity().filter("repeated_keys > 0 OR orphan_rows > 0").collect()
    if bad:
        raise ValueError("star is not complete: " + "; ".join(str(r.asDict()) for r in bad))
    return replace(star, complete=True)


def run(spark: SparkSession, config: EtlConfig, run_date: str | None = None) -> EtlReport:
    """Transform and stage, check what was staged, load and publish.

    A day that fails a check, and a load that fails, leave the published tables as they
    were. Both checks use what was counted during the writes.
    """
    run_date = run_date or today()
    report = transform(spark, config, run_date)
    merged = {t: n for t, n in report.merged_keys.items() if n}
    if merged and config.strict_keys:
        raise ValueError(f"keys that stand for several natural keys: {merged}")
    for problem, found in (("rows that cannot be read", report.rejected), ("merged keys", merged)):
        if any(found.values()):
            warnings.warn(f"{problem}: {dict(found)}", stacklevel=2)
    gate_measured(report.missing)
    load_warehouse(spark, config, run_date)
    return report
