"""Regular series from rows at irregular times: buckets, gaps filled, values carried or interpolated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import ticks


def bucketed_values(df: DataFrame, keys: Sequence[str], ts: str, step: str, values: Mapping[str, Column]) -> DataFrame:
    """keys, bucket (the start of each step that has rows, as ts) and the aggregates `values`. Steps are of fixed length and count from the epoch; null times go."""
    seconds = step_micros(df, step)
    at = F.floor(ticks(F.col(ts), df.schema[ts].dataType) / F.lit(seconds)).cast("long")
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys, at.alias("bucket")).agg(*[v.alias(n) for n, v in values.items()])


def step_micros(df: DataFrame, step: str) -> int:
    """Microseconds of a step; one of months has no fixed length and is refused."""
    spark = df.sparkSession
    first, second = (spark.sql(f"SELECT timestamp_diff(MICROSECOND, timestamp_ntz'{d}', timestamp_ntz'{d}' + INTERVAL {step}) AS n".replace("timestamp_diff", "timestampdiff")).first()[0] for d in ("2001-01-01", "2001-02-01"))
    if first != second or first <= 0:
        raise ValueError(f"a step needs a fixed positive length, not {step!r}")
    return first


def fill_gaps(df: DataFrame, keys: Sequence[str], ts: str, step: str, values: Mapping[str, Column], carried: Sequence[str] = (), linear: Sequence[str] = (), longest: int | None = None) -> DataFrame:
    """A row for each step of each key from its first bucket to its last: keys, bucket, the values, and filled (whether the step had no rows).

    values are aggregates of a bucket; in steps without rows those named in
    carried have the last value before that is not null, those in linear lie on the line between
    the values around, others are null. longest: gaps of more steps stay
    unfilled beyond it, as null. Buckets come first, map-side, so the window of
    a key holds a row for each of its steps at most; a gap is made from the row
    before it, by one lookahead, without a calendar joined to all keys.
    """
    micros = step_micros(df, step)
    rows = bucketed_values(df, keys, ts, step, values)
    over = Window.partitionBy(*keys).orderBy("bucket")
    ahead = {n: f"next_{i}" for i, n in enumerate(linear)}
    known = [F.last(n, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0)).alias(n) if n in carried else F.col(n) for n in values]
    rows = rows.select(*keys, "bucket", *known, F.lead("bucket").over(over).alias("next_bucket"), *[F.lead(n).over(over).alias(a) for n, a in ahead.items()])
    steps = F.coalesce(F.col("next_bucket") - F.col("bucket"), F.lit(1))
    rows = rows.withColumn("gap", steps).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("gap") - 1)))
    near = F.lit(True) if longest is None else F.col("gap") - 1 <= longest
    columns = []
    for n in values:
        if n in carried:
            made = F.col(n)
        elif n in ahead:
            made = F.col(n) + (F.col(ahead[n]) - F.col(n)) * (F.col("i") / F.col("gap"))
        else:
            made = F.lit(None)
        columns.append(F.when(F.col("i") == 0, F.col(n)).when(near, made).alias(n))
    kind = df.schema[ts].dataType
    at = F.timestamp_micros((F.col("bucket") + F.col("i")) * micros)
    start = at if kind.typeName() == "timestamp" else (F.timestamp_add("MICROSECOND", (F.col("bucket") + F.col("i")) * micros, F.lit("1970-01-01").cast("timestamp_ntz")))
    return rows.select(*keys, start.alias("bucket"), *columns, (F.col("i") > 0).alias("filled"))
