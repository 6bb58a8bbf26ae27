"""Length-delimited binary records of token ids, with masked checksums and a separate offset index.

A data file is a run of records:

    uint64 length | uint32 masked crc32 of the length | payload | uint32 masked crc32 of the payload

and a payload is: uint8 flags (1: the id is null, 2: ids are 32 bits wide),
int64 document id, then the token ids, all little-endian. The index file of a
data file holds, for each record, its uint64 offset and its uint32 number of
ids, so any record can be read alone and in any order. The checksum is crc32,
masked by a rotation and a constant so that a checksum of data holding
checksums stays sound.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from .common import arrow_map, doc_text, partitions, ship, work_dir

#: Fixed value: the constant of the usual checksum mask.
MASK = 0xA282EAD8
INDEX = np.dtype([("offset", "<u8"), ("n", "<u4")])


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return struct.pack("<Bq", (doc_id is None) | wide << 1, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from("<Bq", payload)
    return (None if flags & 1 else doc_id), np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=9).astype("<u4")


def read_record(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """Payload and the offset after the record; ValueError where a checksum fails."""
    head = data[at : at + 8]
    n = struct.unpack("<Q", head)[0] if len(head) == 8 else 0
    if len(data) < at + n + 16 or len(head) < 8:
        raise ValueError("the record is cut off")
    if struct.unpack_from("<I", data, at + 8)[0] != masked(head):
        raise ValueError("the length of a record does not match its checksum")
    payload = bytes(data[at + 12 : at + 12 + n])
    if struct.unpack_from("<I", data, at + 12 + n)[0] != masked(payload):
        raise ValueError("a record does not match its checksum")
    return payload, at + n + 16


def store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_records(df: DataFrame, path: str, to: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> list[tuple]:
    """Encode and write every document in ascending id order; (file, records, ids) of each file in order.

    One file for each range of ids, so the manifest that comes to the driver
    has a row for each partition, not for each document. A task writes under a
    name of its attempt and then renames, so a repeated task does no harm.
    Null texts are empty documents, which hold the end id only; null ids come
    first; equal ids are ordered by text. An empty table gives no files.
    """
    ship(df.sparkSession)

    def write(batches):
        task = TaskContext.get()
        fs, base = store(to)
        name = f"part-{task.partitionId():06d}"
        trial = f"{base}/{name}.{task.taskAttemptId()}"
        out, index, at, own = None, [], 0, kernel.pieces(path)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, offsets, data in kernel.chunks(batch.column(1)):
                bounds, ids = own.ids(data, offsets)
                block = []
                for k in range(j - i):
                    record = frame(payload_of(doc_ids[i + k], np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id))))
                    index.append((at, int(bounds[k + 1] - bounds[k]) + 1))
                    at += len(record)
                    block.append(record)
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{trial}.bin")
                out.write(b"".join(block))
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{trial}.idx") as f:
                f.write(np.array(index, INDEX).tobytes())
            for kind in ("bin", "idx"):
                fs.move(f"{trial}.{kind}", f"{base}/{name}.{kind}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [len(index)], "ids": [sum(n for _, n in index)]})

    rows = doc_text(df, id_col, text_col).repartitionByRange(partitions(df.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return sorted(tuple(r) for r in rows.mapInArrow(write, "file string, records long, ids long").collect())


def read_records(spark: SparkSession, files: list[tuple], at: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and token ids of every record, from the files and their indexes."""
    starts = np.concatenate([[0], np.cumsum([n for _, _, n in files])]).tolist()
    rows = [(f, s) for (f, _, _), s in zip(files, starts, strict=False)]

    def read(batch) -> Iterator:
        fs, base = store(at)
        for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with fs.open_input_stream(f"{base}/{file}.idx") as f:
                index = np.frombuffer(f.read(), INDEX)
            first = start + np.concatenate([[0], np.cumsum(index["n"].astype(np.int64))])
            with fs.open_input_file(f"{base}/{file}.bin") as f:
                ends = np.append(index["offset"][1:], f.size()).astype(np.int64)
                i = 0
                while i < len(index):
                    a = int(index["offset"][i])
                    j = max(i + 1, int(np.searchsorted(ends, a + (4 << 20), "right")))
                    f.seek(a)
                    block = f.read(int(ends[j - 1]) - a)
                    out: list[list] = [[], [], [], [], []]
                    for k in range(i, j):
                        doc_id, ids = parse(read_record(block, int(index["offset"][k]) - a)[0])
                        if len(ids) != index["n"][k]:
                            raise ValueError(f"the index of {file} does not match its records")
                        for column, value in zip(out, (doc_id, int(first[k]), len(ids), zlib.crc32(ids.tobytes()), ids), strict=True):
                            column.append(value)
                    yield pa.array(out[0], pa.int64()), out[1], out[2], out[3], pa.array([x.astype(np.int32) for x in out[4]], pa.list_(pa.int32()))
                    i = j

    frame_ = spark.createDataFrame(rows, "file string, start long").repartition(max(1, len(rows)))
    return arrow_map(frame_, read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def token_records(df: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write df's token ids as records in the shared folder and read them back, a row for each row of df.

    Null and empty texts hold the end id only; null ids come first, equal ids
    are ordered by text, and repeated rows are repeated records; an empty
    table gives an empty table; other columns are not read.
    """
    to = work_dir(df.sparkSession, "records")
    return read_records(df.sparkSession, write_records(df, path, to, end_id), to)
