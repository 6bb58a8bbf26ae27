"""Totals over the rows that an inequality joins, without forming the pairs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import free, materialised

from .joins import both
from .ranks import running

COMPARISONS = ("<", "<=", ">", ">=")


def inequality_totals(left: DataFrame, right: DataFrame, by: Sequence[str], on: tuple[str, str], op: str, totals: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    """Each left row with totals over the right rows of the same keys whose on[1] is `op` its own on[0].

    totals: name -> (sum or count, column of right). The result is that of a
    left join on the keys and the inequality, grouped by left row: without a
    match a count is 0 and a sum null, null keys and null places match
    nothing, repeated left rows stay repeated; an empty right side gives
    every left row no match. Sums are exact for whole numbers and decimals.

    Both sides are first reduced, map-side, to a row for each distinct key and
    place, so a place that a third of all rows share is one row; these are
    sorted by range and added up from part to part, and a key's total starts
    at what the keys before it add up to. A key may hold any share of the
    rows; what is written and sorted grows with the rows and never with the pairs.
    """
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op!r}; known: {', '.join(COMPARISONS)}")
    if {how for how, _ in totals.values()} - {"sum", "count"}:
        raise ValueError("totals are sums and counts")
    clash = {*totals} & {*left.columns}
    if clash:
        raise ValueError(f"left has columns named {', '.join(sorted(clash))}")
    by, names = list(by), list(totals)
    place, key = free(left, "_place"), [free(left, f"_key{i}") for i in range(len(by))]
    # of each total, the number of rows that it is over, as a sum over none is null, and what adds up
    parts, at = [], {}
    for n, (how, c) in totals.items():
        at[n] = len(parts)
        parts += [F.count(c)] if how == "count" else [F.count(c), F.sum(c)]
    own, upto, every, before = ([free(left, f"_{k}{i}") for i in range(len(parts))] for k in ("own", "upto", "every", "before"))
    known = both(*[F.col(c).isNotNull() for c in [*key, place]])
    ours = left.select(*[F.col(c).alias(k) for c, k in zip(by, key, strict=True)], F.col(on[0]).alias(place)).filter(known).distinct()
    placed = [F.col(c).isNotNull() for c in [*by, on[1]]]
    theirs = right.filter(both(*placed)).groupBy(*[F.col(c).alias(k) for c, k in zip(by, key, strict=True)], F.col(on[1]).alias(place)).agg(*[e.alias(o) for e, o in zip(parts, own, strict=True)])
    zero = [F.coalesce(F.col(o), F.lit(0)).alias(o) for o in own]
    places = theirs.select(*key, place, *own).unionByName(ours, allowMissingColumns=True).groupBy(*key, place).agg(*[F.sum(o).alias(o) for o in own]).select(*key, place, *zero)
    places = materialised(places, "places")  # read for the sample of the order, for the order and for the keys
    summed = running(places, [*key, place], {u: ("sum", o) for u, o in zip(upto, own, strict=True)})
    keys = places.groupBy(*key).agg(*[F.sum(o).alias(e) for e, o in zip(every, own, strict=True)])
    if key:
        keys = running(keys, key, {b: ("sum", e) for b, e in zip(before, every, strict=True)})
        keys = keys.select(*key, *every, *[(F.col(b) - F.col(e)).alias(b) for b, e in zip(before, every, strict=True)])
        summed = summed.join(keys, key)
    else:
        summed = summed.crossJoin(F.broadcast(keys.select("*", *[F.lit(0).alias(b) for b in before])))  # one row

    def value(i: int) -> Column:
        inside = F.col(upto[i]) - F.col(before[i])
        return {"<=": inside, "<": inside - F.col(own[i]), ">": F.col(every[i]) - inside, ">=": F.col(every[i]) - inside + F.col(own[i])}[op]

    given = [(value(at[n]) if how == "count" else F.when(value(at[n]) > 0, value(at[n] + 1))).alias(n) for n, (how, _) in totals.items()]
    given = summed.select(*key, place, *given)
    same = both(*[left[c] == given[k] for c, k in zip([*by, on[0]], [*key, place], strict=True)])
    out = left.join(given, same, "left").select(*[left[c] for c in left.columns], *[given[n] for n in names])
    return out.select(*left.columns, *[F.coalesce(n, F.lit(0)).alias(n) if how == "count" else F.col(n) for n, (how, _) in totals.items()])
