"""A table of Parquet files with a commit log, as a Python data source: `tessera_log`.

    df.write.format("tessera_log").mode("append").save(path)
    spark.read.format("tessera_log").load(path).filter("ts >= ...")
    spark.readStream.format("tessera_log").load(path)
    stream.writeStream.format("tessera_log").option("path", path)

Files become visible by a commit, a JSON file _log/<version>.json that names
them with their rows and the least and greatest value of each column; what an
aborted or dead job wrote is never read. A read is a partition for each file;
filters that Spark pushes down leave out files by these values and rows by
the Parquet reader. A stream's offset is a version, so a batch is the files of
some commits, the same whenever it is read again. A micro-batch is committed
under its own number once. Paths are of any store pyarrow can open; one batch
writer at a time.
"""

from __future__ import annotations

import datetime
import decimal
import json
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

#: Parameter: rows of a data file.
ROWS = 1 << 20
COMPARES = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def opened(path: str):
    """The file system and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


def told(v):
    """A bound as JSON: a value of a type that has an order, marked where JSON has none."""
    if isinstance(v, datetime.datetime):
        return {"t": v.isoformat()}
    if isinstance(v, datetime.date):
        return {"d": v.isoformat()}
    if isinstance(v, decimal.Decimal):
        return {"n": str(v)}
    return v


def heard(v):
    if not isinstance(v, dict):
        return v
    kind, text = next(iter(v.items()))
    return {"t": datetime.datetime.fromisoformat, "d": datetime.date.fromisoformat, "n": decimal.Decimal}[kind](text)


def log_files(path: str) -> list[tuple[int, str]]:
    """(version, path) of the commits in order."""
    from pyarrow import fs

    store, top = opened(path)
    found = store.get_file_info(fs.FileSelector(f"{top}/_log", allow_not_found=True))
    return sorted((int(m[1]), f.path) for f in found if (m := re.fullmatch(r"(\d{20})\.json", f.base_name)))


def commits(path: str, after: int = -1, up_to: int | None = None) -> Iterator[dict]:
    """The commits after a version up to another."""
    store, _ = opened(path)
    for version, name in log_files(path):
        if version > after and (up_to is None or version <= up_to):
            with store.open_input_stream(name) as f:
                yield json.loads(f.read())


def commit(path: str, files: list[dict], schema: StructType, overwrite: bool = False, batch: str | None = None) -> None:
    """Make files visible as the next version; the log file appears whole, by a rename. batch: a name that is committed once only."""
    store, top = opened(path)
    if batch is not None and any(c.get("batch") == batch for c in commits(path)):
        return
    version = max((v for v, _ in log_files(path)), default=-1) + 1
    store.create_dir(f"{top}/_log", recursive=True)
    at, to = f"{top}/_log/.{uuid.uuid4().hex}", f"{top}/_log/{version:020d}.json"
    with store.open_output_stream(at) as f:
        f.write(json.dumps({"version": version, "files": files, "overwrite": overwrite, "batch": batch, "schema": schema.jsonValue()}).encode())
    store.move(at, to)


@dataclass
class FilePartition(InputPartition):
    name: str


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def may_hold(file: dict, conditions: Sequence[tuple[str, str, object]]) -> bool:
    """Whether a file's least and greatest values leave room for rows that meet all conditions."""
    for column, op, value in conditions:
        low, high, nulls = file["columns"].get(column, (None, None, None))
        if nulls is None:
            continue
        if low is None:
            return False  # nothing but nulls, which meet no comparison
        low, high = heard(low), heard(high)
        try:
            if not {"==": low <= value <= high, ">": high > value, ">=": high >= value, "<": low < value, "<=": low <= value}[op]:
                return False
        except TypeError:
            continue  # values of other kinds: the file is read
    return True


class Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.conditions = path, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a column with a value leave out files; Spark applies all filters again, as bounds alone are no proof."""
        for f in filters:
            if type(f) in COMPARES and len(f.attribute) == 1 and f.value is not None:
                self.conditions.append((f.attribute[0], COMPARES[type(f)], f.value))
            elif isinstance(f, IsNotNull):
                pass
            yield f

    def files(self) -> list[dict]:
        found: list[dict] = []
        for c in commits(self.path):
            found = c["files"] if c["overwrite"] else found + c["files"]
        return [f for f in found if may_hold(f, self.conditions)]

    def partitions(self) -> list[InputPartition]:
        return [FilePartition(f["name"]) for f in self.files()] or [FilePartition("")]

    def read(self, partition: FilePartition) -> Iterator:
        return batches(self.path, partition.name, self.schema)


def batches(path: str, name: str, schema: StructType) -> Iterator:
    if not name:
        return
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    store, top = opened(path)
    target = to_arrow_schema(schema)
    with store.open_input_file(f"{top}/{name}") as f:
        for b in pq.ParquetFile(f).iter_batches(batch_size=8192, columns=schema.fieldNames()):
            yield b.select(schema.fieldNames()).cast(target) if b.schema != target else b


class StreamReader(DataSourceStreamReader):
    """Offsets are versions: a batch is the files of the commits after one up to another."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def initialOffset(self) -> dict:
        return {"version": -1}

    def latestOffset(self) -> dict:
        return {"version": max((v for v, _ in log_files(self.path)), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [FilePartition(f["name"]) for c in commits(self.path, start["version"], end["version"]) for f in c["files"]] or [FilePartition("")]

    def read(self, partition: FilePartition) -> Iterator:
        return batches(self.path, partition.name, self.schema)


class FileWriter:
    """Tasks write files of their own names; nothing is visible before the commit."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, top = opened(self.path)
        files: list[dict] = []
        writer = sink = None
        try:
            for b in iterator:
                if not b.num_rows:
                    continue
                if writer is None:
                    store.create_dir(top, recursive=True)
                    files.append({"name": f"{uuid.uuid4().hex}.parquet", "rows": 0, "columns": {}})
                    sink = store.open_output_stream(f"{top}/{files[-1]['name']}")
                    writer = pq.ParquetWriter(sink, b.schema)
                writer.write_batch(b)
                own = files[-1]
                own["rows"] += b.num_rows
                for name, column in zip(b.schema.names, b.columns, strict=True):
                    if pa.types.is_nested(column.type) or pa.types.is_binary(column.type):
                        continue
                    nan = pa.types.is_floating(column.type) and pc.any(pc.is_nan(column)).as_py()
                    bounds = pc.min_max(column).as_py()
                    low, high, nulls = own["columns"].get(name, (None, None, 0))
                    if nan or nulls is None:
                        own["columns"][name] = (None, None, None)  # no bounds: NaN is above all numbers for Spark
                        continue
                    lows, highs = [x for x in (heard(low), bounds["min"]) if x is not None], [x for x in (heard(high), bounds["max"]) if x is not None]
                    own["columns"][name] = (told(min(lows)) if lows else None, told(max(highs)) if highs else None, nulls + column.null_count)
                if own["rows"] >= ROWS:
                    writer.close()
                    sink.close()
                    writer = None
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return Written(files)

    def removed(self, messages: list[Written | None]) -> None:
        store, top = opened(self.path)
        for m in messages:
            for f in m.files if m else []:
                store.delete_file(f"{top}/{f['name']}")


def all_files(messages: list[Written | None]) -> list[dict]:
    return [f for m in messages if m for f in m.files]


class Writer(FileWriter, DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        super().__init__(path, schema)
        self.overwrite = overwrite

    def commit(self, messages: list[Written | None]) -> None:
        commit(self.path, all_files(messages), self.schema, self.overwrite)

    def abort(self, messages: list[Written | None]) -> None:
        self.removed(messages)


class StreamWriter(FileWriter, DataSourceStreamArrowWriter):
    def __init__(self, path: str, schema: StructType, name: str):
        super().__init__(path, schema)
        self.name = name

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        commit(self.path, all_files(messages), self.schema, batch=f"{self.name}:{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.removed(messages)


class CommitLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tessera_log"

    @property
    def path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("tessera_log needs a path")
        return self.options["path"].rstrip("/")

    def schema(self) -> StructType:
        last = None
        for last in commits(self.path):
            pass
        if last is None:
            raise ValueError(f"no commits at {self.path}; give a schema")
        return StructType.fromJson(last["schema"])

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.path, schema)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.path, schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.path, schema, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.path, schema, self.options.get("sink", "stream"))


def register_commit_log(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed down to it."""
    from tessera.shipping import ship

    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CommitLog)
