"""Keyed upserts into a partitioned table that rewrite only the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources import deleted, exists, scratch


def upsert(rows: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], version: str) -> None:
    """Merge rows into the Parquet table at path, where each key holds its row of the highest version.

    keys must include partition_by, so a key never moves. Only partitions that
    occur in rows are read (the join on their values prunes the scan) and
    overwritten; others keep their files. A merge takes the greatest version
    of old and new rows, ties by the greatest row, so it gives the same table
    whatever the order of batches, and a batch that is run again after a
    failure, in part or whole, changes nothing: foreachBatch may call this
    with any batch once or more. One writer at a time. The shuffle is by key,
    with a row of each key and task at most. Rows with a null key or version
    form keys and lowest versions of their own; version and the other columns
    must be of types that have an order.
    """
    spark = rows.sparkSession
    if set(partition_by) - set(keys):
        raise ValueError("the partition columns must be part of the key")
    others = [c for c in rows.columns if c not in keys and c != version]
    if exists(spark, path):
        # null partition values are read back as nulls
        touched = F.broadcast(rows.select(*[F.col(c).alias(f"_{c}_touched") for c in partition_by]).distinct())
        old = spark.read.schema(rows.schema).parquet(path)
        same = F.lit(True)
        for c in partition_by:
            same = same & old[c].eqNullSafe(F.col(f"_{c}_touched"))
        rows = rows.unionByName(old.join(touched, same, "left_semi"))
    best = rows.groupBy(*keys).agg(F.max(F.struct(version, *others)).alias("best"))
    best = best.select(*[F.col(c) if c in keys else F.col("best").getField(c).alias(c) for c in rows.columns])
    # old files are read before they are replaced
    staged = scratch(spark, "upsert")
    best.write.parquet(staged)
    merged = spark.read.schema(best.schema).parquet(staged)
    merged.repartition(*partition_by, F.pmod(F.xxhash64(*keys), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    deleted(spark, staged)
