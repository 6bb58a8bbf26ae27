"""What the operators share: the shared work folder, shipping this package to executors, Arrow maps."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_shipped: dict[str, str] = {}
_own_dir: list[str] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application."""
    sc = spark.sparkContext
    if _shipped.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    to = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    sc.addPyFile(to)
    _shipped["app"] = sc.applicationId


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of spark.checkpoint.dir.

    A temporary folder of the driver stands in only if that is unset and the
    executors are in the driver's process; on a cluster it is an error.
    """
    conf = spark.sparkContext.getConf()
    top = conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[|$)", conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="tessera-"))
        top = f"file://{_own_dir[0]}"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch, where the session sets none.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
#: While a temporary table is written: small Arrow batches, and its shuffle files go once it is there.
WRITING = {BATCH[0]: BATCH[1], "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


#: With it, tables of in_place() that are joined by place and another column stay where they are.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def writing(spark: SparkSession, **more: str) -> Iterator[None]:
    conf = WRITING | more
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def written(df: DataFrame, name: str, **conf: str) -> DataFrame:
    """The rows as Parquet in the shared folder: cuts lineage, and survives lost executors. conf: settings while it is written."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with writing(spark, **conf):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def bucketed(df: DataFrame, key: str, name: str, unique: bool = False) -> DataFrame:
    """As written(), in a bucket for each shuffle partition: joins on the key do not shuffle these rows again. unique: one row of each key."""
    spark = df.sparkSession
    path, table, p = work_dir(spark, name), f"tessera_{name}_{uuid.uuid4().hex}", partitions(spark)
    df = df.repartition(p, key)
    if unique:
        df = df.dropDuplicates([key])
    try:
        with writing(spark):
            df.write.bucketBy(p, key).option("path", path).format("parquet").saveAsTable(table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    out = spark.table(table)
    out._written_to, out._table = path, table
    return out


def in_place(df: DataFrame, row: str, name: str) -> DataFrame:
    """The rows with column `place`, as a table in buckets by it that no row was moved for.

    row: monotonically_increasing_id(), whose upper bits number the tasks; that
    number is the place, so a task writes one file, and what is repartitioned
    by place joins these rows by place and row without moving them.
    """
    spark = df.sparkSession
    path, table = work_dir(spark, name), f"tessera_{name}_{uuid.uuid4().hex}"
    try:
        # several open files a task, so its rows are not sorted by bucket first
        with writing(spark, **{"spark.sql.maxConcurrentOutputFileWriters": "2"}):
            df.withColumn("place", F.shiftright(row, 33)).write.bucketBy(partitions(spark), "place").option("path", path).format("parquet").saveAsTable(table)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    out = spark.table(table)
    out._written_to, out._table = path, table
    return out


#: A group is hot if it holds more than this share of all rows, so there are fewer hot groups than its inverse.
HOT_SHARE = 0.001


def attached(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """rows left joined with the columns of their group; groups: one row of each key, with its number of rows.

    Hot groups, under 1 / HOT_SHARE of them, are broadcast, so their rows stay
    where they are; the other rows are shuffled by key. Both frames are read
    twice, so they should be written. Null keys have no group.
    """
    most = max(int(rows.count() * HOT_SHARE), 1)
    others = [c for c in groups.columns if c not in keys]
    hot = groups.filter(F.col(size) > most).select(*keys, F.struct(*others).alias("_hot"))
    near = rows.join(F.broadcast(hot), list(keys), "left")
    rest = near.filter("_hot is null").select(*rows.columns).join(groups.filter(F.col(size) <= most), list(keys), "left")
    return near.filter("_hot is not null").select(*rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in others]).unionByName(rest.select(*rows.columns, *others))


def forget(*frames: DataFrame) -> None:
    """Delete tables of written() or bucketed() that nothing will read again; other frames are passed over."""
    for df in frames:
        if not hasattr(df, "_written_to"):
            continue
        if hasattr(df, "_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._table}")
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Without these columns; a column that an operator adds replaces one of the same name, case aside."""
    lower = {n.lower() for n in names}
    return df.select(*[named(c) for c in df.columns if c.lower() not in lower])


def doc_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return df.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[Sequence]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow where fn yields the columns of each output batch.

    The plan may run long after this call, in a write of the caller's, so the
    size of its batches is set for the session, unless the caller did.
    """
    ship(df.sparkSession)
    if df.sparkSession.conf.get(BATCH[0], None) is None:
        df.sparkSession.conf.set(*BATCH)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                for columns in fn(batch):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)


def arrow_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence]], schema: str | T.StructType) -> DataFrame:
    """As arrow_map, where fn sees all batches of a partition one after another, so it may carry what it knows from one to the next."""
    ship(df.sparkSession)
    if df.sparkSession.conf.get(BATCH[0], None) is None:
        df.sparkSession.conf.set(*BATCH)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)
