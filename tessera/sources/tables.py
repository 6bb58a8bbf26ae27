"""Loading tables, and reading and writing every built-in format.

A base URI may be local or any store Spark has a connector for, such as
s3a://bucket/prefix; nothing here opens a path outside Spark.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
FORMATS = ("parquet", "orc", "csv", "json", "xml", "text", "binaryFile")


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir, which driver and executors share; a local one only where that is unset and the master local."""
    conf = spark.sparkContext.getConf()
    top = conf.get("spark.checkpoint.dir", None)
    if not top and not re.match(r"local(\[|$)", conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(top or 'file://' + tempfile.mkdtemp(prefix='tessera-')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The rows as Parquet in scratch: what follows reads them again instead of working them out again, also after an executor is lost."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any store Spark reads, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def free(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def load_all(spark: SparkSession, base: str, *names: str) -> dict[str, DataFrame]:
    return {n: load(spark, base, n) for n in names or TABLES}


def object_store(spark: SparkSession, endpoint: str, path_style: bool = True) -> None:
    """Point s3a:// at an S3-compatible store. Credentials come from the environment; the connector's jar must be present."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint", endpoint)
    conf.set("fs.s3a.path.style.access", str(path_style).lower())
    if "AWS_ACCESS_KEY_ID" in os.environ:
        conf.set("fs.s3a.aws.credentials.provider", "software.amazon.awssdk.auth.credentials.EnvironmentVariableCredentialsProvider")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | T.StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """A source in any of FORMATS; a given schema spares the inference pass over the data."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    reader = spark.read.format(fmt).options(**(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: tuple[str, ...] = (), options: Mapping[str, str] | None = None) -> None:
    """A sink in any of FORMATS but binaryFile."""
    if fmt not in FORMATS or fmt == "binaryFile":
        raise ValueError(f"cannot write {fmt!r}")
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, *keys: str, mode: str = "errorifexists") -> None:
    """A table bucketed and sorted by keys, so joins and aggregates on them need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", files_per_trigger: int | None = None, only: str | None = None) -> DataFrame:
    """A stream of the files of a folder; only: a glob for their names."""
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.option("pathGlobFilter", only) if only else reader
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def rate_stream(spark: SparkSession, rows_per_batch: int, partitions: int | None = None, start: int = 0) -> DataFrame:
    """timestamp and value 0, 1, 2 ... in micro-batches of a fixed number of rows, dealt over partitions; the same rows if a batch is run again. start: milliseconds of the first."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("startTimestamp", start)
    return (reader.option("numPartitions", partitions) if partitions else reader).load()
