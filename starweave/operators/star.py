"""Dimensions, facts and star joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from starweave.operators.dedup import one_per_key
from starweave.session import BROADCAST_BYTES, concurrently, materialize


def build_dimension(
    df: DataFrame,
    key: str,
    columns: Mapping[str, Column],
    repeats: bool = False,
    among: DataFrame | None = None,
    rare: str | None = None,
    natural: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """Project to the named columns and keep one row per key, see ``one_per_key``."""
    rows = df.select(*(c.alias(n) for n, c in columns.items()))
    return one_per_key(rows, key, repeats=repeats, among=among, rare=rare, natural=natural, within=within)


def build_fact(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Inner join on pairs of columns, then a choice of qualified columns.

    ``columns`` maps each output name to ``("left" | "right", column)``. Only
    the needed columns go through the shuffle. Adaptive execution splits hot
    join keys, as nothing above the join relies on its partitioning.
    """
    sides = {"left": left.alias("left"), "right": right.alias("right")}
    condition = [F.col(f"left.{a}") == F.col(f"right.{b}") for a, b in on]
    joined = sides["left"].join(sides["right"], condition, "inner")
    return joined.selectExpr(*(f"{s}.{c} AS {n}" for n, (s, c) in columns.items()))


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark a stored table for broadcast after measuring its size.

    The bound is a session setting unless it is given. Larger tables are returned as they are and joined by shuffle. The rows are
    counted first, from the file footers; only if they can fit is text measured.
    """
    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get(BROADCAST_BYTES, str(64 << 20)))
    width = 8 * len(df.columns)
    rows = df.count()
    if rows * width > max_bytes:
        return df
    texts = [f"coalesce(octet_length(`{n}`), 0)" for n, t in df.dtypes if t == "string"]
    text_bytes = 0
    if texts:
        total = F.sum(F.expr(" + ".join(texts)).cast("long")).alias("bytes")
        text_bytes = df.agg(total).first()["bytes"] or 0
    return F.broadcast(df) if rows * width + text_bytes <= max_bytes else df


@dataclass(frozen=True)
class Link:
    """Fact column that refers to the key of a dimension."""

    dim: str
    fact_key: str
    dim_key: str

    def used(self, fact: DataFrame) -> DataFrame:
        """Dimension keys that the fact refers to, each once."""
        return fact.select(F.col(self.fact_key).alias(self.dim_key)).dropDuplicates()


@dataclass(frozen=True)
class Star:
    """A fact table and its dimensions.

    ``complete`` states that each fact row has exactly one row in every
    dimension: true by construction when all tables are cut from the same
    input, else to be shown by ``integrity``. ``colocated`` names dimensions that are stored
    in the same buckets as the fact, ``small`` those that a broadcast has room for. ``beside`` names columns that the
    buckets are hashed by, of the fact and of the colocated dimensions, if that is not the key that joins them:
    equal keys come with equal values of these.
    """

    name: str
    fact: DataFrame
    dims: Mapping[str, DataFrame]
    links: tuple[Link, ...]
    complete: bool = False
    colocated: tuple[str, ...] = ()
    small: tuple[str, ...] = ()
    beside: tuple[str, ...] = ()

    def filtered(self, fact: Column | None = None, **dims: Column) -> Star:
        """Star with predicates on the fact and on dimensions, by name."""
        return replace(
            self,
            fact=self.fact if fact is None else self.fact.filter(fact),
            dims={n: d.filter(dims[n]) if n in dims else d for n, d in self.dims.items()},
        )

    def narrowed(self, **columns: Sequence[str]) -> Star:
        """Star with only the named columns of the named tables."""
        tables = {self.name: self.fact, **self.dims}
        tables.update({n: tables[n].select(*c) for n, c in columns.items()})
        return replace(self, fact=tables.pop(self.name), dims=tables)

    def stored(self, *names: str) -> Star:
        """Star with the named tables (default all) written to the shared folder.

        A table used more than once is then computed once. Joins with a stored
        dimension shuffle both sides on their own, or neither, so that adaptive
        execution can split a hot fact key; it cannot where the dimension comes
        straight out of an aggregate on the join key.
        """
        names = names or (self.name, *self.dims)
        tables = {self.name: self.fact, **self.dims}
        written = concurrently([partial(materialize, tables[n], n) for n in names])
        tables.update(zip(names, written))
        return replace(self, fact=tables.pop(self.name), dims=tables)

    def register(self, prefix: str = "") -> None:
        """Make all tables visible to SQL."""
        for name, df in {self.name: self.fact, **self.dims}.items():
            df.createOrReplaceTempView(prefix + name)

    def unregister(self, prefix: str = "") -> None:
        """Take the names away again."""
        for name in (self.name, *self.dims):
            self.fact.sparkSession.catalog.dropTempView(prefix + name)

    def join(self, dims: Sequence[str] | None = None) -> DataFrame:
        """Inner star join; every column is named ``<table>_<column>``.

        ``dims`` are joined in the given order, those that cut the rows belong
        first. Without it all are: colocated ones, whose join needs no shuffle while the
        fact lies in its buckets, then narrow ones first, as each shuffle join moves
        the row gathered so far, and at the end small ones, which move nothing. Spark picks
        broadcast or shuffle joins by size.
        """
        links = {k.dim: k for k in self.links}
        joined = _prefixed(self.name, self.fact)
        order = sorted(links, key=lambda n: (n not in self.colocated, n in self.small, len(self.dims[n].columns)))
        for name in dims or order:
            joined = self._lookup(joined, links[name], self.dims[name])
        tables = {n: self.dims[n] for n in dims or links}
        names = [f"{t}_{c}" for t, df in tables.items() for c in df.columns]
        return joined.select(*(f"{self.name}_{c}" for c in self.fact.columns), *names)

    def top(
        self,
        order: Sequence[str],
        n: int,
        first: Sequence[str] = (),
        dims: Sequence[str] = (),
        bound: bool = False,
        stored: bool = False,
    ) -> DataFrame:
        """The ``n`` lowest rows of the star join by fact columns ``order``.

        Dimensions in ``first`` restrict the rows (they carry predicates), those
        in ``dims`` only add columns. On a complete star the rows are chosen before
        the second kind is joined, and these dimensions are cut to the chosen keys by a
        semi join. Spark moves that below a dimension's aggregate where the keys
        are few. ``stored`` chooses the rows at once and stores them, so that they are found
        once and not for each dimension; else nothing runs before the result is read.
        ``bound`` finds the ``n``-th value first, see ``bounded``.
        """
        links = {k.dim: k for k in self.links}
        rank = [f"{self.name}_{c}" for c in order]
        rank += [f"{self.name}_{c}" for c in self.fact.columns if c not in order]
        if not self.complete:
            every = [*first, *dims]
            star = self.bounded(order[0], n, every) if bound else self
            return star.join(every).orderBy(*rank).limit(n)
        star = self.bounded(order[0], n, first) if bound else self
        rows = star.join(first) if first else _prefixed(self.name, star.fact)
        rows = rows.orderBy(*rank).limit(n)
        chosen = rows = materialize(rows, "top") if stored else rows
        for name in dims:
            link = links[name]
            keys = chosen.select(F.col(f"{self.name}_{link.fact_key}").alias(link.dim_key))
            wanted = self.dims[name].join(keys, link.dim_key, "left_semi")
            rows = self._lookup(rows, link, wanted)
        return rows.orderBy(*rank).limit(n)

    def bounded(self, column: str, n: int, dims: Sequence[str] = ()) -> Star:
        """Star without facts that cannot be among the ``n`` lowest by ``column``.

        A pass over that column and the keys of ``dims``, which restrict the rows, gives the
        ``n``-th value: one number comes to the driver. As a bound on the fact it reaches the scan of all
        other columns. Nulls are lowest, rows that tie with the bound stay.
        """
        links = {k.dim: k for k in self.links}
        keys = {d: [links[d].dim_key] for d in dims}
        narrow = self.narrowed(**{self.name: [column, *(links[d].fact_key for d in dims)]}, **keys)
        rows = narrow.join(dims) if dims else _prefixed(self.name, narrow.fact)
        value = f"{self.name}_{column}"
        last = rows.select(value).orderBy(value).limit(n).agg(F.max(value).alias("last"), F.count("*").alias("n")).first()
        if last["n"] < n:
            return self
        low = F.col(column).isNull()
        return self.filtered(low if last["last"] is None else low | (F.col(column) <= F.lit(last["last"])))

    def pruned(self, dim: str, fact_part: str, dim_part: str) -> Star:
        """Star whose fact, stored in a folder for each value of ``fact_part``, is read only in
        those that the rows of a (filtered) dimension have as ``dim_part``.

        The values are few, as they are folders, so they are broadcast, and Spark's
        dynamic pruning takes them for a filter of the scan.
        """
        parts = self.dims[dim].select(F.col(dim_part).alias(fact_part)).distinct()
        return replace(self, fact=self.fact.join(F.broadcast(parts), fact_part, "left_semi"))

    def integrity(self) -> DataFrame:
        """Per dimension: rows, repeated keys, fact rows and orphan fact rows."""
        reports = []
        for link in self.links:
            dim = self.dims[link.dim]
            keys = dim.groupBy(F.col(link.dim_key).alias("key")).agg(F.count("*").alias("rows"))
            used = self.fact.groupBy(F.col(link.fact_key).alias("key")).agg(
                F.count("*").alias("uses")
            )
            both = keys.join(used, "key", "full")
            reports.append(
                both.agg(
                    F.lit(link.dim).alias("dim"),
                    F.coalesce(F.sum("rows"), F.lit(0)).alias("dim_rows"),
                    F.count_if(F.col("rows") > 1).alias("repeated_keys"),
                    F.coalesce(F.sum("uses"), F.lit(0)).alias("fact_rows"),
                    F.coalesce(F.sum(F.when(F.col("rows").isNull(), F.col("uses"))), F.lit(0)).alias(
                        "orphan_rows"
                    ),
                    F.coalesce(F.sum(F.col("rows") * F.col("uses")), F.lit(0)).alias("joined_rows"),
                )
            )
        report = reports[0]
        for other in reports[1:]:
            report = report.unionAll(other)
        return report

    def _lookup(self, rows: DataFrame, link: Link, dim: DataFrame) -> DataFrame:
        keys = [(link.fact_key, link.dim_key)]
        if link.dim in self.colocated:
            # Not of tables that were narrowed to other columns.
            met = {*self.fact.columns} & {*dim.columns}
            keys += [(c, c) for c in self.beside if c in met and (c, c) not in keys]
        dim = _prefixed(link.dim, dim)
        alike = [F.col(f"{self.name}_{a}") == F.col(f"{link.dim}_{b}") for a, b in keys]
        return rows.join(dim, alike, "inner")


def _prefixed(table: str, df: DataFrame) -> DataFrame:
    return df.toDF(*(f"{table}_{c}" for c in df.columns))
