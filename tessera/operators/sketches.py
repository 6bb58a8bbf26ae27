"""Mergeable states of distinct counts and quantiles, to be stored by day and rolled up without the rows.

HyperLogLog and KLL states are a few kilobytes whatever they have seen; their
errors are bounded as distinct_error() and RANK_ERROR say. Bitmaps count
whole numbers exactly; they are a row with a word of 64 bits for each 64
values of which one occurs, so never more rows than values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import free

#: Parameters: lg2 of the registers of a HyperLogLog state, k of a KLL state.
LG_REGISTERS, KLL_K = 12, 400
#: Share of rows by which the rank of a KLL quantile of k = 400 is off in no more than 1 of 100 cases, and no more after merges.
RANK_ERROR = 0.01
#: Words of 64 bits that a task keeps in memory, and rows that are dealt to one where there are more words, about.
TASK_WORDS = 1 << 19
#: Salts for each task that rows are dealt to; a word is summed up by salts, so more rows of it than these don't travel on.
SALTS = 16


def distinct_error(deviations: float = 3.0) -> float:
    """Relative error of a HyperLogLog estimate that so many standard deviations allow."""
    return deviations * 1.04 / (1 << LG_REGISTERS) ** 0.5


def states(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str | Column] | None = None, quantiles: Mapping[str, str | Column] | None = None) -> DataFrame:
    """keys and a state column for each name: of the distinct values of long, string or binary columns, of the quantiles of numeric ones. Nulls are passed over."""
    columns = [F.hll_sketch_agg(c, LG_REGISTERS).alias(n) for n, c in (distinct or {}).items()]
    columns += [F.kll_sketch_agg_double((F.col(c) if isinstance(c, str) else c).cast("double"), KLL_K).alias(n) for n, c in (quantiles or {}).items()]
    return df.groupBy(*keys).agg(*columns)


def merged(rows: DataFrame, keys: Sequence[str], distinct: Sequence[str] = (), quantiles: Sequence[str] = ()) -> DataFrame:
    """States of coarser keys from those of finer ones; what is merged may be merged again, in any order."""
    columns = [F.hll_union_agg(n).alias(n) for n in distinct] + [F.kll_merge_agg_double(n).alias(n) for n in quantiles]
    return rows.groupBy(*keys).agg(*columns)


def distinct_of(state: str | Column) -> Column:
    return F.hll_sketch_estimate(state)


def quantile_of(state: str | Column, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(state, F.lit(rank))


def rank_of(state: str | Column, value: Column) -> Column:
    return F.kll_sketch_get_rank_double(state, value)


def bitmaps(df: DataFrame, keys: Sequence[str], column: str, bucket: str = "bucket", bits: str = "bits") -> DataFrame:
    """keys, bucket and bits: the distinct whole numbers of a column, 64 to a word. Nulls are passed over.

    A hot key spreads over its buckets. Words that fit into a task's memory
    are summed up where the rows are read, so what is shuffled does not grow
    with repeats. Where there are more, as of sparse values, of which each has
    a word, rows are first dealt evenly over a number of tasks that goes by
    the rows, whatever the size of the files' splits, and summed up there; what
    is left is dealt by words over as many. Results don't depend on which.
    """
    x = F.col(column).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int"))
    words = df.filter(x.isNotNull()).select(*keys, F.shiftright(x, 6).alias(bucket), bit.alias(bits))
    n, distinct = words.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys, bucket))).first()
    if distinct > TASK_WORDS:
        tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_WORDS))
        salt = free(words, "_salt")
        dealt = words.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS * tasks)).cast("int")).repartition(tasks, salt)
        words = dealt.groupBy(*keys, bucket, salt).agg(F.bit_or(bits).alias(bits)).repartition(tasks, *keys, bucket)
    return words.groupBy(*keys, bucket).agg(F.bit_or(bits).alias(bits))


def merged_bitmaps(rows: DataFrame, keys: Sequence[str], bucket: str = "bucket", bits: str = "bits") -> DataFrame:
    return rows.groupBy(*keys, bucket).agg(F.bit_or(bits).alias(bits))


def bitmap_counts(rows: DataFrame, keys: Sequence[str], name: str = "n", bits: str = "bits") -> DataFrame:
    """The exact number of distinct values of each key; rows must be merged for these keys."""
    return rows.groupBy(*keys).agg(F.sum(F.bit_count(bits)).cast("long").alias(name))
