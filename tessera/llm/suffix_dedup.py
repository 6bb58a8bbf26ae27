"""Exact substring dedup by distributed difference-cover suffix sorting.

Every string of `length` bytes that starts at two places or more of the corpus
is found. Suffixes whose first `length` bytes are equal must meet in one sort,
so the corpus is first cut by content: each window of `length` bytes belongs
to the least hash of the short strings inside it, and consecutive windows of
one owner form a piece. Equal windows always have the same owner, so a piece
whose owner occurs once holds no repeat and is left out, and pieces that are
equal as a whole are repeats without sorting. The rest is sorted owner by
owner with the difference-cover algorithm: sampled triples are sorted, the
names are sorted recursively, the remaining suffixes are merged in, and
adjacent prefixes are compared byte by byte.

An owner with more text than `big` is not sorted in one task: its pieces are
cut again by the least of other hashes of their short strings, up to LEVELS
times, and sorted by these owners. What no cut divides is text of a short
period, whose windows are few; these are counted as bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel
from .common import arrow_map, doc_text, forget, partitions, written
from .kernel import U64

#: Parameters: bytes of the short strings that own windows, most bytes of an owner that are sorted in one task,
#: bytes that are sorted at once, and rows that a task holds before it sends them on.
SHORT, BIG, SORT, FLUSH = 24, 4 << 20, 2 << 20, 400_000
#: How often the pieces of big owners are cut again, and windows that are grouped at once where none of it helps.
LEVELS, AT_ONCE = 3, 1 << 15
#: Bytes of pieces that are reduced at once, and bytes of text to sort in a partition.
PART_BYTES, SORT_BYTES = 12 << 20, 16 << 20


def suffix_order(t: np.ndarray, enough: int, reach: int = 1) -> np.ndarray:
    """Starts of the suffixes of t (values above 0) in order; suffixes equal in their first `enough` values may stand in any order.

    reach: how many values of the first string a value of t stands for.
    """
    n = len(t)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    pad = np.concatenate([t, np.zeros(3, np.int64)])
    extra = n % 3 == 1  # the sample of starts 1 mod 3 then has an empty suffix, which keeps the two halves apart
    one, two = np.arange(1, n + extra, 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    a, b, c = pad[sample], pad[sample + 1], pad[sample + 2]
    if int(t.max()) < 1 << 21:
        key = (a << 42) | (b << 21) | c
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
    else:
        order = np.lexsort((c, b, a))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0) | (np.diff(c[order]) != 0)
    names = np.zeros(len(sample), np.int64)
    names[order] = np.cumsum(new)
    if not new.all() and reach * 3 < enough:
        order = suffix_order(names, enough, reach * 3)
        names[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    sampled = sample[np.argsort(names, kind="stable")]
    sampled = sampled[sampled < n]
    # the other suffixes, by their first value and the rank after it
    rest = np.arange(0, n, 3)
    wide = int(rank.max()) + 1
    first = pad[rest] * wide + rank[rest + 1]
    by = np.argsort(first, kind="stable")
    rest, first = rest[by], first[by]
    # merge: how many sampled suffixes of either kind stand before each of the others
    m1, m2 = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(pad[m1] * wide + rank[m1 + 1], first)
    pair = np.unique(np.concatenate([pad[m2] * (int(pad.max()) + 1) + pad[m2 + 1], pad[rest] * (int(pad.max()) + 1) + pad[rest + 1]]), return_inverse=True)[1]
    before = before + np.searchsorted(np.maximum.accumulate(pair[: len(m2)] * wide + rank[m2 + 2]) if len(m2) else np.zeros(0, np.int64), pair[len(m2) :] * wide + rank[rest + 2])
    place = np.arange(len(rest)) + np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[place] = False
    out[place] = rest
    out[free] = sampled
    return out


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Of each piece, which of its windows start a string of `length` bytes that starts at another place too."""
    data = np.frombuffer(b"\0".join(pieces) + b"\0" * 8, np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1) - 1
    text = data[: ends[-1]].astype(np.int64) + 2
    text[ends[:-1]] = 1
    order = suffix_order(text, length)
    room = np.repeat(ends, sizes + 1)[: len(text)] - np.arange(len(text))
    order = order[room[order] >= length]
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for k in (*range(0, length - 7, 8), length - 8):
        same = same[words[a[same] + k] == words[b[same] + k]]
    found = np.zeros(len(text) + 1, bool)
    found[a[same]] = found[b[same]] = True
    return [found[e - n : max(e - n, e - length + 1)] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row, at the place of the first."""
    n = len(x) - width + 1
    full = -(-len(x) // width) * width
    blocks = np.concatenate([x, np.full(full - len(x), ~U64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def cut(data: np.ndarray, offsets: np.ndarray, length: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """Document, start, number of windows, owner, hash of each piece, and whether it may repeat inside itself. level: which hashes rank the short strings."""
    none = tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, U64, U64, bool))
    if len(data) < length:
        return none
    p = kernel.prefix_hashes(data)
    _, down = kernel.powers(len(p))
    short = kernel.mix((p[SHORT:] - p[:-SHORT]) * down[: len(p) - SHORT])
    if level:
        short = kernel.mix(short ^ kernel.mix(np.array([level], U64)))
    owner = least(short, length - SHORT + 1)
    n = len(owner)
    room = np.repeat(offsets[1:], np.diff(offsets))[:n] - np.arange(n)
    ok = room >= length
    on = ok.copy()
    on[1:] &= ok[:-1] & (owner[1:] == owner[:-1])
    on[0] = False
    start = np.flatnonzero(ok & ~on)
    if not len(start):
        return none
    # a window's own first short string owns it and the next window too: the owner occurs in the piece again
    again = np.flatnonzero((short[: n - 1] == owner[:-1]) & on[1:])
    number = np.cumsum(ok & ~on) - 1
    windows = np.bincount(number[ok], minlength=len(start))
    inner = np.bincount(number[again], minlength=len(start)) > 0
    return np.searchsorted(offsets, start, "right") - 1, start, windows, owner[start], kernel.span_hashes(p, start, start + windows + length - 1), inner


COLUMNS = (("owner", U64), ("hash", U64), ("k1", np.int64), ("k2", np.int64), ("start", np.int64), ("windows", np.int32), ("flags", np.int32))
RECORD = np.dtype([(n, k) for n, k in COLUMNS])
INNER, EQUAL = 1, 2


def runs_of(order_of: tuple[np.ndarray, ...]) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(order_of[0]), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in order_of])
    return np.flatnonzero(new)


def pieces_of(docs: DataFrame, length: int, total: int, most: int = BIG) -> DataFrame:
    """The pieces whose owner occurs again: owner, hash, k1, k2, start, windows, equal, sort, big.

    equal: the same piece occurs again; sort: its owner has other pieces too
    or may repeat inside. docs: k1, k2, text, of total bytes. Equal pieces of a task are
    reduced to one before the shuffle, the others being known as repeats.
    """
    # a window opens a piece with a chance of 2 in the number of its short strings and one
    pieces = total * 2 // (length - SHORT + 2)
    parts = max(partitions(docs.sparkSession), -(-pieces * RECORD.itemsize // PART_BYTES))

    def send(batch):
        seen: set[tuple[int, int]] = set()
        keys = [batch.column(k).to_numpy() for k in (0, 1)]
        held, n = [], 0

        def flush() -> Iterator:
            rows = np.concatenate(held)
            order = np.lexsort((rows["windows"], rows["hash"], rows["owner"]))
            rows = rows[order]
            first = runs_of((rows["owner"], rows["hash"], rows["windows"]))
            count = np.diff(np.append(first, len(rows)))
            same = np.repeat(count > 1, count)
            rows["flags"][same] |= EQUAL
            head = np.zeros(len(rows), bool)
            head[first] = True
            for known, some in ((False, rows[head]), (True, rows[~head])):
                key = some["owner"] if not known else some["hash"]
                part = (((key >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                some, part = some[order], part[order]
                edge = runs_of((part,)) if len(part) else np.zeros(0, np.int64)
                yield part[edge], [known] * len(edge), [b"".join(some[name][i:j].tobytes() for name, _ in COLUMNS) for i, j in zip(edge, np.append(edge[1:], len(part)), strict=True)] if len(part) else []

        for i, j, offsets, data in kernel.chunks(batch.column(2)):
            fresh = np.array([(key := (int(keys[0][k]), int(keys[1][k]))) not in seen and (seen.add(key) or True) for k in range(i, j)])
            doc, start, windows, owner, hashed, inner = cut(data, offsets, length)
            keep = fresh[doc] if len(doc) else np.zeros(0, bool)
            rows = np.zeros(int(keep.sum()), RECORD)
            doc = doc[keep]
            for name, x in (("owner", owner[keep]), ("hash", hashed[keep]), ("k1", keys[0][i + doc]), ("k2", keys[1][i + doc]), ("start", start[keep] - offsets[doc]), ("windows", windows[keep]), ("flags", inner[keep] * INNER)):
                rows[name] = x
            held.append(rows)
            n += len(rows)
            if n >= FLUSH:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    def unpacked(blobs: list[bytes]) -> np.ndarray:
        out = []
        for blob in blobs:
            n, at = len(blob) // RECORD.itemsize, 0
            rows = np.zeros(n, RECORD)
            for name, kind in COLUMNS:
                rows[name] = np.frombuffer(blob, kind, n, at)
                at += n * np.dtype(kind).itemsize
            out.append(rows)
        return np.concatenate(out)

    def told(rows: np.ndarray, equal: np.ndarray, sort: np.ndarray, big: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(rows[n]).view(np.int64) if k is U64 else np.ascontiguousarray(rows[n])) for n, k in COLUMNS[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(equal), pa.array(sort), pa.array(big)], [n for n, _ in COLUMNS[:-1]] + ["equal", "sort", "big"])

    def reduced(blobs: list[bytes]) -> pa.RecordBatch:
        rows = unpacked(blobs)
        blobs.clear()
        rows = rows[np.lexsort((rows["start"], rows["k2"], rows["k1"], rows["windows"], rows["hash"], rows["owner"]))]
        piece = runs_of((rows["owner"], rows["hash"], rows["windows"]))
        size = np.diff(np.append(piece, len(rows)))
        equal = np.repeat((size > 1) | (np.bitwise_or.reduceat(rows["flags"], piece) & EQUAL > 0), size)
        first = runs_of((rows["owner"],))
        count = np.diff(np.append(first, len(rows)))
        is_head = np.zeros(len(rows), np.int64)
        is_head[piece] = 1
        distinct = np.add.reduceat(is_head, first)
        text = np.add.reduceat(is_head * (rows["windows"].astype(np.int64) + length - 1), first)
        inner = np.bitwise_or.reduceat(rows["flags"], first) & INNER > 0
        sort = np.repeat((distinct > 1) | inner, count)
        keep = sort | equal
        return told(rows[keep], equal[keep], sort[keep], np.repeat(text > most, count)[keep])

    def reduce(batches):
        held = []
        for batch in batches:
            for known, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if known:
                    rows = unpacked([blob])
                    yes = np.ones(len(rows), bool)
                    yield told(rows, yes, ~yes, ~yes)
                else:
                    held.append(blob)
        if held:
            yield reduced(held)

    sent = arrow_map(docs.select("k1", "k2", "text"), send, "part int, known boolean, blob binary").repartitionById(parts, "part")
    return written(sent.mapInArrow(reduce, "owner long, hash long, k1 long, k2 long, start long, windows int, equal boolean, sort boolean, big boolean"), "pieces")


def marked(texts: DataFrame, length: int) -> DataFrame:
    """owner, hash, windows, at, n: runs of repeated windows in the pieces to sort. texts: owner, hash, windows, piece."""
    total = texts.agg(F.sum(F.col("windows").cast("long") + length - 1)).first()[0] or 0
    p = max(partitions(texts.sparkSession), -(-total // SORT_BYTES))

    def sort(batches):
        def told(keys, pieces):
            out = [[], [], [], [], []]
            for (owner, hashed, windows), found in zip(keys, repeated_starts(pieces, length), strict=True):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    for column, value in zip(out, (owner, hashed, windows, a, b - a), strict=True):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["owner", "hash", "windows", "at", "n"])

        keys, pieces, total = [], [], 0
        for batch in batches:
            for owner, hashed, windows, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if total > SORT and owner != keys[-1][0]:
                    yield told(keys, pieces)
                    keys, pieces, total = [], [], 0
                keys.append((owner, hashed, windows))
                pieces.append(piece)
                total += len(piece)
        if keys:
            yield told(keys, pieces)

    return texts.repartition(p, "owner").sortWithinPartitions("owner", "hash").mapInArrow(sort, "owner long, hash long, windows int, at long, n long")


def counted(texts: DataFrame, length: int, used: list[DataFrame]) -> DataFrame:
    """The same for pieces that no cut divides: windows are counted as bytes. texts: owner, hash, windows, at, piece.

    A task sends a row for each distinct window of some AT_ONCE places of a
    piece, so text of a short period is few rows.
    """

    def windows_of(batch):
        for owner, hashed, windows, base, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for i in range(0, len(piece) - length + 1, AT_ONCE):
                places: dict[bytes, list[int]] = {}
                for k in range(i, min(i + AT_ONCE, len(piece) - length + 1)):
                    places.setdefault(piece[k : k + length], []).append(base + k)
                n = len(places)
                yield list(places), [owner] * n, [hashed] * n, [windows] * n, list(places.values())

    rows = written(arrow_map(texts.select("owner", "hash", "windows", "at", "piece"), windows_of, "window binary, owner long, hash long, windows int, places array<long>"), "windows")
    used.append(rows)
    twice = rows.groupBy("window").agg(F.sum(F.size("places")).alias("n")).filter("n > 1").select("window")
    return rows.join(twice, "window").select("owner", "hash", "windows", F.explode("places").alias("at"), F.lit(1).cast("long").alias("n"))


def cut_again(texts: DataFrame, length: int, level: int) -> DataFrame:
    """The pieces that texts (owner, hash, windows, at, sub, piece) fall into by the hashes of this level, with their owners as sub."""

    def pieces(batch):
        *keys, at, sub = (batch.column(k).to_numpy() for k in range(5))
        for i, j, offsets, data in kernel.chunks(batch.column(5)):
            row, start, windows, owner, _, _ = cut(data, offsets, length, level)
            raw = data.tobytes()
            owner = kernel.mix(owner + kernel.mix(np.ascontiguousarray(sub[i + row]).view(U64)))
            yield *(k[i + row] for k in keys), at[i + row] + start - offsets[row], owner.view(np.int64), [raw[a:b] for a, b in zip(start.tolist(), (start + windows + length - 1).tolist(), strict=True)]

    columns = texts.select("owner", "hash", "windows", "at", "sub", "piece")
    return written(arrow_map(columns, pieces, "owner long, hash long, windows int, at long, sub long, piece binary"), "subs")


def divided(texts: DataFrame, length: int, big: int, used: list[DataFrame]) -> DataFrame:
    """owner, hash, windows, at, n: runs of repeated windows in the pieces of big owners. texts: owner, hash, windows, piece.

    Pieces of an owner share a short string and differ around it, so hashes
    that rank other strings first divide them. Equal windows have equal
    owners at each level, so a level's owners that are small enough are
    sorted and done with. Equal pieces are told by their bytes, in a grouping
    with partial counts, and sorted once. Tables that the result reads are added to used.
    """
    texts = texts.withColumn("at", F.lit(0).cast("long")).withColumn("sub", F.col("owner"))
    runs: list[DataFrame] = []
    for level in range(1, LEVELS + 1):
        if texts.isEmpty():
            break
        subs = cut_again(texts, length, level)
        distinct = written(subs.groupBy("sub", "piece").agg(F.count(F.lit(1)).alias("places")).withColumn("id", F.monotonically_increasing_id()), "distinct")
        sizes = written(distinct.groupBy("sub").agg(F.sum(F.octet_length("piece")).alias("size")).filter(F.col("size") > big).select("sub"), "big")
        used += [subs, distinct, sizes]
        small = distinct.join(sizes, "sub", "left_anti")
        windows = F.octet_length("piece") - (length - 1)
        found = marked(small.select(F.col("sub").alias("owner"), F.col("id").alias("hash"), windows.alias("windows"), "piece"), length).select(F.col("hash").alias("id"), F.col("at").alias("a"), "n")
        whole = small.filter("places > 1").select("id", F.lit(0).cast("long").alias("a"), windows.cast("long").alias("n"))
        found = found.join(small.filter("places = 1").select("id"), "id", "left_semi").union(whole)
        # a piece with runs goes to its places by its bytes
        told = small.select("id", "sub", "piece").join(found, "id").drop("id")
        runs.append(subs.join(told, ["sub", "piece"]).select("owner", "hash", "windows", (F.col("at") + F.col("a")).alias("at"), "n"))
        texts = subs.join(sizes, "sub", "left_semi").select("owner", "hash", "windows", "at", "sub", "piece")
    runs.append(counted(texts, length, used))
    return functools.reduce(DataFrame.union, runs)


def suffix_dedup(df: DataFrame, length: int = 200, big: int = BIG, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and the bytes that are left if with_text.

    A byte goes if a string of `length` bytes that covers it also starts at
    any other place of the input. Texts are judged as UTF-8 bytes and never
    across documents; a null text is empty, with the hash of no bytes. All
    copies of a repeated row lose what they share. An empty table gives an
    empty table; other columns are not read. length is 32 at least.
    """
    if length < 32:
        raise ValueError("length is 32 at least")
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = doc_text(df, id_col, text_col).select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(length), text).alias("k2"))
    long = docs.filter(F.octet_length("text") >= length)
    copies = long.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("low"), F.max(F.octet_length("text")).alias("size"))
    copies = written(copies, "copies")
    found = pieces_of(long, length, copies.agg(F.sum("size")).first()[0] or 0, big)
    # one place of each piece to sort, by text
    place = found.filter("sort").groupBy("owner", "hash", "windows", "big").agg(F.min(F.struct("k1", "k2", "start")).alias("at"))
    wanted = place.groupBy("at.k1", "at.k2").agg(F.collect_list(F.struct("owner", "hash", "windows", "big", "at.start")).alias("pieces")).join(copies.select("k1", "k2", "low"), ["k1", "k2"])
    readers = docs.join(wanted, ["k1", "k2"]).filter(F.col("doc_id").eqNullSafe(F.col("low"))).select("text", "pieces")

    def sliced(batch):
        texts = batch.column(0)
        for i in range(batch.num_rows):
            raw = texts[i].as_py().encode()
            some = batch.column(1)[i].as_py()
            yield [x["owner"] for x in some], [x["hash"] for x in some], [x["windows"] for x in some], [x["big"] for x in some], [raw[x["start"] : x["start"] + x["windows"] + length - 1] for x in some]

    cuts = written(arrow_map(readers, sliced, "owner long, hash long, windows int, big boolean, piece binary").dropDuplicates(["owner", "hash", "windows"]), "cuts")
    used = [copies, found, cuts]
    runs = marked(cuts.filter("not big").drop("big"), length).union(divided(cuts.filter("big").drop("big"), length, big, used))
    some = found.filter("sort and not equal").join(runs, ["owner", "hash", "windows"]).select("k1", "k2", (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + F.col("n") + length - 1).alias("b"))
    whole = found.filter("equal").select("k1", "k2", F.col("start").alias("a"), (F.col("start") + F.col("windows") + length - 1).alias("b"))
    single = copies.filter("copies = 1").select("k1", "k2")
    spans = some.union(whole).distinct().join(single, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))
    spans = written(spans.withColumn("copied", F.lit(False)).union(copies.filter("copies > 1").select("k1", "k2", F.lit(None).cast(spans.schema["spans"].dataType), F.lit(True))), "spans")
    forget(*used)
    rows = docs.join(spans.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "spans", "copied")

    def strip(batch):
        offsets, data = kernel.utf8(batch.column(1))
        raw = data.tobytes()
        out: list[list] = [[], [], [], [], []]
        lists, copied = batch.column(2), batch.column(3).to_pylist()
        bounds = lists.offsets.to_numpy()
        a, b = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        valid = lists.is_valid().to_pylist()
        for i in range(batch.num_rows):
            own = raw[offsets[i] : offsets[i + 1]]
            pieces, at, removed, n = [], 0, 0, 0
            if copied[i]:
                removed, n, at = len(own), 1, len(own)
            elif valid[i]:
                end = -1
                for x, y in zip(a[bounds[i] : bounds[i + 1]].tolist(), b[bounds[i] : bounds[i + 1]].tolist(), strict=True):
                    if x > end:
                        n += 1
                        pieces.append(own[at:x])
                        removed += y - x
                        end = at = y
                    elif y > end:
                        removed += y - end
                        end = at = y
            pieces.append(own[at:])
            left = b"".join(pieces)
            for column, value in zip(out, (len(own), removed, n, hashlib.sha256(left).hexdigest(), left), strict=True):
                column.append(value)
        yield [batch.column(0), *out[: 5 if with_text else 4]]

    return arrow_map(rows, strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
