"""Packing into optimal length buckets.

The global histogram of lengths is summed in Spark; a dynamic programme over
it chooses the bucket boundaries that pad least. Inside each bucket documents
are numbered and cut into batches whose padded size stays in a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free, named, without, written

#: Numbering is done in this many cells a bucket, so that no task holds a bucket.
CELLS = 1024


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """Upper bounds of at most `buckets` buckets over sorted distinct lengths, with the least padding."""
    n = len(lengths)
    if not n:
        return np.zeros(0, np.int64)
    rows = np.concatenate([[0.0], np.cumsum(counts, dtype=float)])
    mass = np.concatenate([[0.0], np.cumsum(lengths.astype(float) * counts)])
    top = lengths.astype(float)
    best = top * rows[1:] - mass[1:]  # one bucket up to each length
    choice = []
    for _ in range(min(buckets, n) - 1):
        cost, back = divided(best, top, rows, mass)
        back[cost >= best] = -1
        choice.append(back)
        best = np.minimum(cost, best)
    out, j = [n - 1], n - 1
    for back in reversed(choice):
        if back[j] >= 0:
            j = int(back[j])
            out.append(j)
    return lengths[np.array(sorted(out))]


def divided(best: np.ndarray, top: np.ndarray, rows: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each length j: the least cost of a bucket from after some i < j up to j on top of best[i], and the first such i.

    The best i never falls as j grows, so the middle j of a range halves the
    i's of both sides. Ranges of a level are searched together: O(n log n).
    """
    n = len(top)
    least, back = np.full(n, np.inf), np.full(n, -1)
    lo, hi, a, b = (np.array([x]) for x in (1, n - 1, 0, n - 2))
    while len(lo):
        mid = (lo + hi) // 2
        size = np.minimum(b, mid - 1) - a + 1
        start = np.cumsum(size) - size
        own = np.repeat(np.arange(len(mid)), size)
        i, j = np.arange(len(own)) - (start - a)[own], mid[own]
        cost = best[i] + top[j] * (rows[j + 1] - rows[i + 1]) - (mass[j + 1] - mass[i + 1])
        least[mid] = np.minimum.reduceat(cost, start)
        hit = np.flatnonzero(cost == least[j])
        at = i[hit[np.unique(own[hit], return_index=True)[1]]]
        back[mid] = at
        lo, hi, a, b = np.concatenate([lo, mid + 1]), np.concatenate([mid - 1, hi]), np.concatenate([a, at]), np.concatenate([at, b])
        some = lo <= hi
        lo, hi, a, b = lo[some], hi[some], a[some], b[some]
    return least, back


def histogram(df: DataFrame, length: str) -> tuple[np.ndarray, np.ndarray]:
    """All distinct lengths and their counts. Lengths that are all distinct add up to the square of their number over
    two, so the driver gets at most sqrt(2 * tokens) rows, 130,000 of 8 billion tokens."""
    got = df.groupBy(F.col(length).alias("_l")).agg(F.count(F.lit(1)).alias("_n")).toArrow().sort_by("_l")
    return got.column(0).to_numpy().astype(np.int64), got.column(1).to_numpy().astype(np.int64)


def length_buckets(df: DataFrame, length: str = "n_tokens", id_col: str = "doc_id", buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """df with bucket, bucket_len, batch and batch_row.

    bucket_len is the padded length of the row's bucket, that of its longest row; a batch holds at most
    max(1, budget // bucket_len) rows, numbered by batch_row, so only a row
    longer than the budget goes beyond it, alone. A null length counts as 0.
    Ties in order are broken by id and length; repeated rows keep a place
    each; an empty table gives an empty table. Columns of df named like an
    added one are replaced.
    """
    added = ("bucket", "bucket_len", "batch", "batch_row")
    df = without(df, *added)
    tmp, cell, nth, in_bucket, in_cell, first = (free(df, f"_pack_{k}") for k in ("len", "cell", "nth", "bucket", "of", "start"))
    df = df.withColumn(tmp, F.coalesce(named(length).cast("long"), F.lit(0)))
    lengths, counts = histogram(df, tmp)
    tops = boundaries(lengths, counts, buckets).tolist()
    bucket, top = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k in reversed(range(len(tops))):
        bucket = F.when(F.col(tmp) <= tops[k], F.lit(k)).otherwise(bucket)
        top = F.when(F.col(tmp) <= tops[k], F.lit(tops[k]).cast("long")).otherwise(top)
    df = df.withColumns({"bucket": bucket, "bucket_len": top, cell: F.pmod(F.xxhash64(named(id_col), tmp), F.lit(CELLS)).cast("int")})
    # buckets * CELLS rows at most: where each cell's numbering starts
    start = F.sum("_n").over(Window.partitionBy("bucket").orderBy(cell)) - F.col("_n")
    starts = F.broadcast(df.groupBy("bucket", cell).agg(F.count(F.lit(1)).alias("_n")).select(F.col("bucket").alias(in_bucket), F.col(cell).alias(in_cell), start.alias(first)))
    df = df.withColumn(nth, F.row_number().over(Window.partitionBy("bucket", cell).orderBy(named(id_col), tmp)))
    df = df.join(starts, (F.col("bucket") == F.col(in_bucket)) & (F.col(cell) == F.col(in_cell)))
    number, rows = F.col(first) + F.col(nth) - 1, F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1)))).cast("long")
    return df.withColumns({"batch": F.floor(number / rows).cast("long"), "batch_row": (number % rows).cast("long")}).drop(tmp, cell, nth, in_bucket, in_cell, first)


def packed(df: DataFrame, path: str, **options) -> DataFrame:
    """doc_id, n_tokens and the packing of every row of documents, by token counts of a tokenizer.

    A null or empty text has 0 tokens and is packed as such; null ids stay,
    repeated rows keep a place each, an empty table gives an empty table, and
    other columns are not read.
    """
    from .token_counts import token_counts

    return length_buckets(written(token_counts(df, path).select("doc_id", "n_tokens"), "lengths"), **options)
