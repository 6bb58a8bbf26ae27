"""Window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rn") -> DataFrame:
    """The first n rows of each group. Spark prunes to n rows in each task before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")).filter(F.col(rank) <= n)


def sessions(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """key, start, end and number of rows of each session: rows of a key at most `gap` apart."""
    return df.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("last_ts")).select(key, F.col("w.start").alias("session_start"), "last_ts", "n")
