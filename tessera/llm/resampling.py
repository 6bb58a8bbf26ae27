"""Importance resampling towards a target distribution, by hashed features.

Every document and every target text is a bag of hashed word runs. Bucket
counts of both sides are summed on Spark; a bucket's gain is its log ratio,
and a document's weight the floored mean of the gains of its features, taken
from the array of gains by the array of its buckets. A seeded Gumbel number
per document turns weights into a draw without replacement: the documents of
the highest scores. Which ones these are is found by radix selection: the
composite key (score, doc_id, row number) is read digit by digit from the
top, each pass counts one digit of the keys that share all digits so far, and
the driver only sees those counts. Only rows up to the k-th key are sorted by
range and ranked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ranks import row_numbers

from .common import arrow_map, doc_text, written
from .kernel import utf8

#: Parameters: bytes of text taken at a time, the longest word whose checksum is taken in columns, bits of a digit of the radix selection.
SLICE, COLUMNS, DIGIT = 1 << 20, 48, 12
#: Fixed value: the reversed polynomial of crc32.
POLYNOMIAL = 0xEDB88320


def crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


def word_bytes() -> np.ndarray:
    """Which bytes are part of a word: digits, small letters and all beyond ASCII; capitals are made small before."""
    inside = np.zeros(256, bool)
    for a, b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        inside[a : b + 1] = True
    return inside


CRC, INSIDE = crc_table(), word_bytes()
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each span, a byte of all of them at a time."""
    n = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    live = np.flatnonzero((n > 0) & (n <= COLUMNS))
    for j in range(COLUMNS):
        if not len(live):
            break
        crc[live] = CRC[(crc[live] ^ data[starts[live] + j]) & 0xFF] ^ (crc[live] >> 8)
        live = live[n[live] > j + 1]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(n > COLUMNS).tolist():
        crc[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    return crc


def slices(data: np.ndarray, size: int = SLICE) -> Iterator[np.ndarray]:
    """A text in parts of about `size` bytes that cut no word; only a longer word makes a longer part."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            own = np.flatnonzero(~INSIDE[SMALL[data[at:end]]])
            if len(own):
                end = at + int(own[-1]) + 1
            else:
                while end < len(data) and INSIDE[SMALL[data[end]]]:
                    end += 1
        yield data[at:end]
        at = end


def word_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each word of some documents."""
    data = SMALL[data]
    edge = np.zeros(len(data) + 1, np.int8)
    inside = INSIDE[data]
    edge[:-1] += inside
    edge[1:] -= inside
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[inside[cut] & inside[cut - 1]]  # a word that ends and one that starts where two documents meet
    starts, ends = (np.sort(np.concatenate([np.flatnonzero(edge == k), cut])) for k in (1, -1))
    return (checksums(data, starts, ends) % np.uint32(buckets)).astype(np.uint32), np.searchsorted(offsets, starts, "right") - 1


def parts(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, offsets, bytes): many short documents or a part of a long one at a time, about SLICE bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        own = data[offsets[i] : offsets[j]]
        if len(own) <= SLICE:
            yield i, offsets[i : j + 1] - offsets[i], own
        else:
            for part in slices(own):
                yield i, np.array([0, len(part)]), part
        i = j


def features(df: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """The kept columns, n_features and the buckets of the features of each row of text, as little-endian 32-bit numbers."""
    names = list(keep)

    def run(batch: pa.RecordBatch):
        offsets, data = utf8(batch.column("text"))
        found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for first, bounds, part in parts(offsets, data):
            own, doc = word_buckets(part, bounds, buckets)
            at = np.searchsorted(doc, np.arange(len(bounds)))
            for d in range(len(bounds) - 1):
                found[first + d].append(own[at[d] : at[d + 1]])
        codes = [np.concatenate(f) if f else np.zeros(0, np.uint32) for f in found]
        yield [*[batch.column(c) for c in names], [len(c) for c in codes], [c.astype("<u4").tobytes() for c in codes]]

    schema = T.StructType([df.schema[c] for c in names] + [T.StructField("n_features", T.LongType()), T.StructField("codes", T.BinaryType())])
    return arrow_map(df.select(*names, "text"), run, schema)


def bucket_counts(coded: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket over all rows: each task sums its own into one array, and the driver gets a row for each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            _, data = utf8(b.column(0))
            total += np.bincount(data.view("<u4"), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in coded.select("codes").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # at most `buckets` rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the smoothed ratio of shares) of each bucket."""
    m, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((t + 1.0) * (s_all + m) / ((s + 1.0) * (t_all + m)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(coded: DataFrame, gain: np.ndarray, *keep: str) -> DataFrame:
    """The kept columns, n_features and the floored mean gain of each row's features; 0 without features."""
    names = list(keep)

    def run(batch: pa.RecordBatch):
        offsets, data = utf8(batch.column("codes"))
        codes, n = data.view("<u4"), np.diff(offsets) // 4
        total = np.zeros(len(n), np.int64)
        step = SLICE
        for a in range(0, len(codes), step):  # sums of a slice go to its rows, so memory is bounded by the slice
            b = min(len(codes), a + step)
            row = np.searchsorted(offsets // 4, np.arange(a, b), "right") - 1
            np.add.at(total, row, gain[codes[a:b]])
        yield [*[batch.column(c) for c in names], batch.column("n_features"), total // np.maximum(n, 1)]

    schema = T.StructType([coded.schema[c] for c in names] + [T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())])
    return arrow_map(coded.select(*names, "n_features", "codes"), run, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for a number u in (0, 1) that follows from seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def kth_key(rows: DataFrame, keys: list[str], k: int) -> tuple[int, ...] | None:
    """The k-th least of the keys, tuples of long columns without nulls, k from 1; None if there are fewer.

    Radix selection: digits are read from the top below the bits that all rows
    left share, so columns of a narrow range take few passes. A pass is a
    count by digit, at most 2**DIGIT rows.
    """
    top = 1 << 63
    chosen: list[int] = []
    for column in keys:
        low, high, n = rows.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
        if n < k:
            return None
        bits = -(-(low ^ high).bit_length() // DIGIT) * DIGIT if low ^ high >= 0 else -(-64 // DIGIT) * DIGIT
        found = (low + top) >> bits << bits
        while bits:
            bits -= DIGIT
            # with the sign bit turned, longs have the order of their bits
            digit = F.shiftrightunsigned(F.col(column).bitwiseXOR(F.lit(-top)), bits).bitwiseAND(F.lit((1 << DIGIT) - 1))
            counts = sorted(rows.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 2**DIGIT rows
            for value, n in counts:
                if k <= n:
                    break
                k -= n
            rows = rows.filter(digit == value)
            found += value << bits
        chosen.append(found - top)
    return tuple(chosen)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, buckets: int = 10_000, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of docs; rank from 1 for the floor(percent * N / 100) drawn, else null.

    N counts the rows of at least least_words words that have an id; ties of
    scores go to the smaller id, rows of one id and score in any order. A null
    text has no features and weight 0; a row with a null id has a weight but
    no score and is not drawn. An empty target or an empty table is no error.
    Texts are read in slices, so memory holds a text and a few bytes for each
    of its words. Other columns are not read.
    """
    coded = written(features(doc_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), buckets, "doc_id", "row"), "features")
    aims = features(doc_text(target, target_text, target_text).select("text"), buckets)
    gain = gains(bucket_counts(coded, buckets), bucket_counts(aims, buckets))
    scored = written(weights(coded, gain, "doc_id", "row").withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scores")
    able = scored.filter(F.col("doc_id").isNotNull() & (F.col("n_features") >= least_words)).select((-F.col("score")).alias("less"), "doc_id", "row")
    k = percent * able.count() // 100
    last = kth_key(able, ["less", "doc_id", "row"], k) if k else None
    if last is None:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    less, doc_id, row = (F.lit(v) for v in last)
    up_to = (F.col("less") < less) | (F.col("less") == less) & ((F.col("doc_id") < doc_id) | (F.col("doc_id") == doc_id) & (F.col("row") <= row))
    ranked = row_numbers(able.filter(up_to), ["less", "doc_id", "row"], "rank").select("row", "rank")
    return scored.join(ranked, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with their columns; rows of one id are drawn together."""
    from .common import free, named

    name = free(docs, "_drawn")
    ids = resample(docs, target, **options).filter("rank is not null").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, named(options.get("id_col", "doc_id")).cast("long") == F.col(name), "left_semi")
