"""A grouped map in pandas whose groups are cut into chunks, so that no group is ever gathered in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.shipping import ship
from tessera.sources.tables import free

from .ranks import row_numbers


def chunked_map(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], how: Callable[[pd.DataFrame], pd.DataFrame], result: str, rows: int = 10_000, before: int = 0) -> DataFrame:
    """how's row for every row of df; a row's result may depend on the `before` rows before it in its group.

    how gets rows of one group in order, with df's columns, and returns a
    frame of as many rows, in the same order, with the columns of the schema
    `result`; what it gives for the leading rows that are only context is
    left out. order should be unique within a group: rows that tie come in
    any order. Null keys form groups, as in Spark. An empty table gives an
    empty table, for which how is not called.

    The table is sorted by (keys, order) by range and numbered; numbers are
    cut into chunks of `rows`, and the last `before` rows of each are sent to
    the next chunk too. So a task holds rows + before rows, whatever share of
    the table one key has, and rows are shuffled twice.
    """
    if rows < 1 or not 0 <= before <= rows:
        raise ValueError("a chunk has at least one row, and at most its own number of rows before it")
    ship(df.sparkSession)
    keys, columns = list(keys), list(df.columns)
    at, chunk, context = (free(df, n) for n in ("_at", "_chunk", "_context"))
    names = T._parse_datatype_string(result).names
    numbered = row_numbers(df, [*keys, *order], at)
    own = F.floor((F.col(at) - 1) / F.lit(rows)).cast("long")
    late = (F.col(at) - 1) % rows >= rows - before
    copies = F.array(F.struct(own.alias(chunk), F.lit(False).alias(context)))
    if before:
        copies = F.when(late, F.array_append(copies, F.struct((own + 1).alias(chunk), F.lit(True).alias(context)))).otherwise(copies)
    placed = numbered.select("*", F.inline(copies))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(at, kind="stable")
        groups = [g for _, g in frame.groupby(keys, dropna=False, sort=False)] if keys else [frame]
        done = []
        for g in groups:
            seen = int(g[context].sum())
            if seen == len(g):
                continue  # of the chunk before alone
            out = how(g[columns].reset_index(drop=True))
            if len(out) != len(g):
                raise ValueError(f"how gave {len(out)} rows for {len(g)}")
            done.append(out[names].iloc[seen:])
        return pd.concat(done, ignore_index=True) if done else pd.DataFrame(columns=names)

    return placed.groupBy(chunk).applyInPandas(run, result)
