"""Numbers, ranks and running aggregates over a whole table, without the single task of a window that has no partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.tables import free, materialised

#: Functions whose partial results combine by the function given.
COMBINES = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}


def in_order(df: DataFrame, order: Sequence[str | Column]) -> tuple[DataFrame, str, str]:
    """The rows sorted by range and written, with the names of two new columns: the part of the range and the row's number in it, from 0.

    Parts come from a sample of the order, so they are near equal whatever its
    distribution, but for rows that tie on all of it, which share a part; the
    callers break ties where a key may be hot. The table is written, so the
    numbers stay what they are if an executor is lost.
    """
    part, nth = free(df, "_part"), free(df, "_nth")
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.shiftright(at, 33).alias(part), at.bitwiseAND((1 << 33) - 1).alias(nth))
    return materialised(rows, "ordered"), part, nth


def with_offsets(rows: DataFrame, part: str, partials: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """rows with, for each name, the combination of its partial over all parts before; the driver sees a row for each part."""
    names = list(partials)
    per = rows.groupBy(part).agg(*[e.alias(n) for n, (_, e) in partials.items()])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # over the parts, of which there are as many as tasks
    offsets = per.select(part, *[getattr(F, how)(n).over(before).alias(n) for n, (how, _) in partials.items()])
    return rows.join(F.broadcast(offsets), part).select(*rows.columns, *names)


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """row_number over the whole table, from 1: place in the own part plus the rows of the parts before. One shuffle, by range."""
    rows, part, nth = in_order(df, order)
    base = free(rows, "_base")
    out = with_offsets(rows, part, {base: ("sum", F.count(F.lit(1)))})
    return out.select(*df.columns, (F.coalesce(base, F.lit(0)) + F.col(nth) + 1).alias(name))


def ntile(df: DataFrame, order: Sequence[str | Column], n: int, name: str = "nt") -> DataFrame:
    """ntile(n) over the whole table: the first rows % n tiles hold one row more."""
    if n < 1:
        raise ValueError("ntile needs at least one tile")
    at = free(df, "_at")
    rows = row_numbers(df, order, at)
    total = df.count()
    small, more = divmod(total, n)
    k = F.col(at) - 1
    wide = more * (small + 1)
    tile = F.when(k < wide, F.floor(k / F.lit(small + 1))).otherwise(F.lit(more) + F.floor((k - wide) / F.lit(max(small, 1))))
    return rows.select(*df.columns, (tile + 1).cast("long").alias(name))


def running(df: DataFrame, order: Sequence[str | Column], totals: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    """Running aggregates over the whole table up to each row, nulls passed over.

    totals: name -> (sum, count, min or max, column). order should end in a
    unique column: rows that tie come in any order. Each part runs its own
    window and gets what the parts before add up to, so the largest task is a
    part; sums are exact for whole numbers and decimals.
    """
    for how, _ in totals.values():
        if how not in COMBINES:
            raise ValueError(f"cannot carry {how!r} over parts; known: {', '.join(COMBINES)}")
    rows, part, nth = in_order(df, order)
    own = Window.partitionBy(part).orderBy(nth).rowsBetween(Window.unboundedPreceding, 0)
    bases, taken = {}, rows
    for name in totals:
        bases[name] = free(taken, f"_base_{name}")
        taken = taken.withColumn(bases[name], F.lit(None))
    out = with_offsets(rows, part, {bases[name]: (COMBINES[how], getattr(F, how)(c)) for name, (how, c) in totals.items()})
    columns = []
    for name, (how, c) in totals.items():
        mine, base = getattr(F, how)(c).over(own), F.col(bases[name])
        if how in ("min", "max"):
            value = (F.least if how == "min" else F.greatest)(mine, base)  # both pass over nulls
        elif how == "count":
            value = mine + F.coalesce(base, F.lit(0))
        else:
            value = F.coalesce(mine + base, mine, base)
        columns.append(value.alias(name))
    return out.select(*df.columns, *columns)


def ranks(df: DataFrame, order: Sequence[str], names: Mapping[str, str], descending: bool = False) -> DataFrame:
    """rank, dense_rank, percent_rank and cume_dist over the whole table; names: function -> new column.

    Equal keys are counted first, map-side, so a key that a third of all rows
    share is one row when the distinct keys are sorted by range and numbered;
    rows then look up their key. Nulls are keys of their own and come first
    (last if descending), as Spark orders them.
    """
    known = ("rank", "dense_rank", "percent_rank", "cume_dist")
    if set(names) - set(known):
        raise ValueError(f"known ranks: {', '.join(known)}")
    n, before, place = (free(df, c) for c in ("_n", "_before", "_place"))
    keys = df.groupBy(*order).agg(F.count(F.lit(1)).alias(n))
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    numbered = running(keys, by, {before: ("sum", n), place: ("count", F.lit(1))})
    total = F.lit(df.count())
    first = F.col(before) - F.col(n) + 1
    value = {
        "rank": first,
        "dense_rank": F.col(place),
        "percent_rank": F.when(total > 1, (first - 1) / (total - 1)).otherwise(F.lit(0.0)),
        "cume_dist": F.col(before) / total,
    }
    right = numbered.select(*[F.col(c).alias(f"_k{i}_{n}") for i, c in enumerate(order)], *[value[f].cast("double" if f in ("percent_rank", "cume_dist") else "long").alias(out) for f, out in names.items()])
    same = F.lit(True)
    for i, c in enumerate(order):
        same = same & df[c].eqNullSafe(F.col(f"_k{i}_{n}"))
    return df.join(right, same).select(*[df[c] for c in df.columns], *names.values())
