"""Exact set similarity join of documents by the partition method.

Sets are the distinct word shingles of a document, as 64-bit hashes. Two sets
of sizes a and b with Jaccard similarity t differ in at most
H = (1 - t) / (1 + t) * (a + b) elements. The universe is cut into m segments
by hash, m by band of sizes, and each set gives its segments allocations that
add up to more than H, by the pigeonhole principle (0 to a segment: not
searched; 1: partners with the same subset are found; 2: partners whose subset
differs by one element too, by one-deletion neighbourhoods that both index):

Level 0 gives 1 to every segment whose subset few sets share (at most HOT) and
0 to the others, as those cost more than they find. A set for which that is
enough meets all its partners there. Level 1 takes the other sets alone and
gives 2 to a segment none of whose neighbourhood is hot, 1 where its subset
isn't and 0 otherwise. Sets that are still short consist mostly of what many
sets share. At level 2 each element is a segment of its own, and the cheapest
ones, those that the fewest sets hold, get 1 until it is enough; as all sets
take the same order of elements, both partners have an element with 1 in
common, and buckets may have any size.

In each bucket all sets are first held against one centre. Then pairs of
different components are formed, in blocks of bounded size and in rounds by
distance in an order of chance, each round after the links of the one before
have joined components, so that groups of copies never expand. Pairs whose
parities rule a link out are left, all others are verified on whole sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernel
from .common import arrow_map, bucketed, doc_text, forget, free, named, partitions, written
from .components import components, joined
from .kernel import U64

#: Parameter: the most sets in a bucket that is searched at levels 0 and 1.
HOT = 32
#: Rounds: distances in the order of chance below which pairs are formed (of units of WHOLE sets or fewer, all in the first);
#: blocks have about BLOCK sets or BLOCK_BYTES of parities at most.
DISTANCES, WHOLE, BLOCK, BLOCK_BYTES = (2, 8, 64, 512, None), 64, 2048, 1 << 24
#: Signatures that a task holds before it sends them on, and bytes of them that are sorted at once.
FLUSH, PART_BYTES = 1_000_000, 12 << 20
MARK = np.uint32(0xFFFFFFFF)
#: More than any set has segments.
PLENTY = 1 << 40

class Scheme:
    """Bands of sizes and segments for a similarity of percent / 100.

    Band k holds sizes from low[k] to low[k + 1] - 1, and partners lie in the
    same or a neighbouring band. Group g joins bands g and g + 1 under m[g]
    segments; a set of band k is in groups k (as lower) and k - 1 (as upper).
    """

    def __init__(self, percent: int):
        self.percent = percent
        low = [1, 2]
        while low[-1] < 1 << 31:
            low.append(max(low[-1] + 1, 100 * (low[-1] - 1) // percent + 1))
        self.low = np.array(low, np.int64)
        self.m = np.array([self.segments(g) for g in range(len(low) - 2)], np.int64)

    def apart(self, sizes: np.ndarray) -> np.ndarray:
        return (100 - self.percent) * sizes // (100 + self.percent)

    def need(self, n: np.ndarray, group: np.ndarray, upper: bool) -> np.ndarray:
        """Segments a set of size n must have for the pigeonhole with every partner in the group."""
        most = np.minimum(n, self.low[group + 1] - 1) if upper else 100 * n // self.percent
        return self.apart(n + most) + 1

    def segments(self, g: int) -> int:
        """The least number with which sets of the group have the segments they need, by a deviation to spare."""
        a, b, c = (int(x) for x in self.low[g : g + 3])
        n = np.array([a, b - 1, b, c - 1], float)
        need = np.concatenate([self.need(n[:2].astype(np.int64), np.array([g, g]), False), self.need(n[2:].astype(np.int64), np.array([g, g]), True)])
        m = int(need.max())
        while m < 4 * c:
            e = np.exp(-n / m)
            spare = m * (1 - (1 - 1 / m) ** n) - need
            if (spare >= np.sqrt(m * e * (1 - np.minimum(1, (1 + n / m) * e)))).all():
                break
            m += 1 + m // 64
        return m

    def band(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1


@functools.lru_cache(4)
def scheme(percent: int) -> Scheme:
    return Scheme(percent)


def fingerprints(bounds: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set; equal sets have equal ones."""
    n = len(bounds) - 1
    out = []
    for salt in (U64(3), U64(5)):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(kernel.mix(s + salt), dtype=U64)])
        out.append(kernel.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(U64) * salt))
    assert len(out[0]) == n
    return out[0], out[1]


class Signatures:
    """Of the sets of a chunk in one group role: hash and set of each non-empty segment.

    need: allocations that a set must add up to; count: what 1 for every
    segment gives; doubled: what 2 for every segment of more than one element
    gives.
    """

    def __init__(self, sch: Scheme, bounds: np.ndarray, s: np.ndarray, rows: np.ndarray, upper: bool, single: bool = False):
        sizes = np.diff(bounds)
        rows = rows[(sizes[rows] > 0) & ((not upper) | (sch.band(sizes[rows]) > 0))]
        self.rows, size = rows, sizes[rows]
        group = sch.band(size) - upper
        self.need = sch.need(size, group, upper)
        total = int(size.sum())
        at = np.repeat(bounds[:-1][rows] - np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64), size) + np.arange(total)
        own = np.repeat(np.arange(len(rows)), size)
        token = s[at]
        segment = token if single else ((token >> U64(32)) * sch.m[group].astype(U64)[own]) >> U64(32)
        new = np.ones(total, bool)
        new[1:] = (segment[1:] != segment[:-1]) | (own[1:] != own[:-1])
        first = np.flatnonzero(new)
        self.token = kernel.mix(token)
        self.salt = (segment * U64(kernel.BASE) + group.astype(U64)[own] * kernel.MIX_A)[first]
        self.sum = np.add.reduceat(self.token, first) if total else np.zeros(0, U64)
        self.first, self.length, self.owner = first, np.diff(np.append(first, total)), own[first]
        self.count = np.bincount(self.owner, minlength=len(rows))
        self.doubled = self.count + np.bincount(self.owner, self.length > 1, len(rows)).astype(np.int64)

    def subsets(self) -> tuple[np.ndarray, np.ndarray]:
        return kernel.mix(self.sum + self.salt), self.owner

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.length > 1)
        run = np.repeat(some, self.length[some])
        at = np.repeat(self.first[some] - np.concatenate([[0], np.cumsum(self.length[some])[:-1]]).astype(np.int64), self.length[some]) + np.arange(len(run))
        return kernel.mix(self.sum[run] - self.token[at] + self.salt[run]), self.owner[run]


def tag_of(n: np.ndarray, upper: bool, deletion: bool) -> np.ndarray:
    return (n.astype(np.uint32) << np.uint32(2)) | np.uint32(2 * upper + deletion)


class Sender:
    """Gathers signatures and packs them by part, hot ones reduced to a mark and a loss row for each set."""

    def __init__(self, parts: int, most: int = HOT):
        self.parts, self.most, self.held, self.n = parts, most, [], 0

    def add(self, sig: np.ndarray, fp: np.ndarray, tag: np.ndarray) -> Iterator:
        self.held.append((sig, fp, tag))
        self.n += len(sig)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator:
        if not self.n:
            return
        sig, fp, tag = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.n = [], 0
        order = np.argsort(sig)
        sig, fp, tag = sig[order], fp[order], tag[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(first, len(sig)))
        lost = np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.uint32)
        if (count > self.most).any():
            hot = np.repeat(count > self.most, count)
            marks = sig[first[count > self.most]]
            lost = fp[hot], fp[hot], tag[hot]
            sig, fp, tag = np.concatenate([sig[~hot], marks]), np.concatenate([fp[~hot], np.zeros(len(marks), U64)]), np.concatenate([tag[~hot], np.full(len(marks), MARK)])
        for kind, (a, b, c) in enumerate(((sig, fp, tag), lost)):
            part = (((a >> U64(32)) * U64(self.parts)) >> U64(32)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            a, b, c, part = a[order], b[order], c[order], part[order]
            edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
            yield part[edge], [kind] * len(edge), [a[i:j].tobytes() + b[i:j].tobytes() + c[i:j].tobytes() for i, j in zip(edge, np.append(edge[1:], len(part)).astype(np.int64), strict=True)] if len(part) else []


def gathered(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns = [[], [], []]
    for blob in blobs:
        n = len(blob) // 20
        for column, kind, at in zip(columns, (U64, U64, np.uint32), (0, 8 * n, 16 * n), strict=True):
            column.append(np.frombuffer(blob, kind, n, at))
    return tuple(np.concatenate(c) for c in columns)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def buckets(df: DataFrame, emit, signatures: int, most: int = HOT) -> DataFrame:
    """hot, kin, fp, tag, centre, held of the signatures that two sets or more share.

    emit(batch, sender) yields a sender's output for the batch; signatures:
    about how many there are in all, by which the parts are made. Rows that
    are hot tell that a set has a segment in more than `most` sets; only their
    fp and tag count. kin is a hash of the sets in a bucket that isn't hot,
    held their number and the centre the least of them. Similar texts share
    many buckets of the same sets, of which one is enough, so a task keeps one
    bucket of each kin.
    """
    p = partitions(df.sparkSession)
    parts = max(p, -(-signatures * 20 // PART_BYTES))

    def send(batch):
        sender = Sender(parts, most)
        yield from emit(batch, sender)
        yield from sender.flush()

    def told(hot, kin, fp, tag, centre, held):
        columns = [np.full(len(fp), hot), kin, signed(fp), tag.view(np.int32), centre, held]
        return pa.RecordBatch.from_arrays([pa.nulls(len(fp), pa.int64()) if c is None else pa.array(c) for c in columns], ["hot", "kin", "fp", "tag", "centre", "held"])

    def reduced(blobs: list[bytes]):
        sig, fp, tag = gathered(blobs)
        blobs.clear()
        order = np.lexsort((fp, sig))
        sig, fp, tag = sig[order], fp[order], tag[order]
        # a set that stands in a bucket twice, as from two tasks or by two neighbourhoods, is there once
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])])
        sig, fp, tag = sig[new], fp[new], tag[new]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.append(first, len(sig)))
        large = (count > most) | np.maximum.reduceat(tag == MARK, first)
        hot = np.repeat(large, count) & (tag != MARK)
        yield told(True, None, fp[hot], tag[hot], None, None)
        kin = kernel.mix(np.add.reduceat(kernel.mix(fp + U64(7)), first) + count.astype(U64))
        rest = np.flatnonzero((count > 1) & ~large)
        one = np.zeros(len(count), bool)
        one[rest[np.unique(kin[rest], return_index=True)[1]]] = True
        keep = np.repeat(one, count)
        yield told(False, signed(np.repeat(kin, count)[keep]), fp[keep], tag[keep], signed(np.repeat(fp[first], count)[keep]), np.repeat(count, count)[keep])

    def reduce(batches):
        own = []
        for batch in batches:
            for lost, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if lost:
                    _, fp, tag = gathered([blob])
                    yield told(True, None, fp, tag, None, None)
                else:
                    own.append(blob)
        if own:
            yield from reduced(own)

    sent = arrow_map(df, send, "part int, lost int, blob binary").repartitionById(parts, "part")
    return written(sent.mapInArrow(reduce, "hot boolean, kin long, fp long, tag int, centre long, held long"), "buckets")


def sets_of(column, size: int) -> Iterator:
    for i, j, offsets, data in kernel.chunks(column):
        yield i, j, *kernel.shingle_sets(data, offsets, size)


def parities(bounds: np.ndarray, s: np.ndarray) -> list[bytes]:
    """Of each set, the parity of its elements in each of at least 2 n bits.

    Two bitmaps differ in at most as many bits as the sets in elements, so
    pairs that differ in more bits than similar sets may are left out safely.
    """
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        bits = max(64, 1 << (2 * (b - a) - 1).bit_length())
        out.append(np.packbits((np.bincount((s[a:b] & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes())
    return out


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """The bitmaps at the length of the shortest, a row each: folding keeps parities."""
    width = min(map(len, bitmaps)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(b, U64).reshape(-1, width), axis=0) for b in bitmaps])


def index_all(percent: int, size: int, text_at: int):
    """emit() of level 0: the subsets of all sets."""

    def emit(batch, sender):
        sch, seen = scheme(percent), set()
        for _, _, bounds, s in sets_of(batch.column(text_at), size):
            sizes = np.diff(bounds)
            fp = fingerprints(bounds, s)[0]
            rows = []
            for k, f in enumerate(fp.tolist()):
                if sizes[k] and f not in seen:
                    seen.add(f)
                    rows.append(k)
            for upper in (False, True):
                x = Signatures(sch, bounds, s, np.array(rows, np.int64), upper)
                sig, owner = x.subsets()
                row = x.rows[owner]
                yield from sender.add(sig, fp[row], tag_of(sizes[row], upper, False))

    return emit


def signatures_of(percent: int, size: int, single: bool):
    """For each chunk of rows fp, text, short0, short1 and each role in which a set is short: sets, signatures and owners."""

    def signatures(batch):
        sch = scheme(percent)
        for i, j, bounds, s in sets_of(batch.column(1), size):
            fp = batch.column(0)[i:j].to_numpy().view(U64)
            for upper in (False, True):
                own = np.flatnonzero(batch.column(2 + upper)[i:j].to_numpy(zero_copy_only=False))
                x = Signatures(sch, bounds, s, own, upper, single)
                for deletion, (sig, owner) in enumerate([x.subsets()] if single else [x.subsets(), x.deletions()]):
                    row = x.rows[owner]
                    yield sig, fp[row], tag_of(np.diff(bounds)[row], upper, bool(deletion))

    return signatures


def index_short(percent: int, size: int):
    """emit() of level 1: subsets and one-deletion neighbourhoods."""
    signatures = signatures_of(percent, size, False)

    def emit(batch, sender):
        for x in signatures(batch):
            yield from sender.add(*x)

    return emit


def differing(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of each pair of bitmaps, from words x[i[k]:i[k + 1]] and y[j[k]:j[k + 1]], the bits that differ at the length of the shorter."""
    out = np.zeros(len(i) - 1, np.int64)
    a, b = np.diff(i), np.diff(j)
    for m, n in set(zip(a.tolist(), b.tolist(), strict=True)):
        own, w = np.flatnonzero((a == m) & (b == n)), min(m, n)
        step = max(1, (1 << 20) // (m + n))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            left, right = (np.bitwise_xor.reduce(z[at[part][:, None] + np.arange(size)].reshape(len(part), -1, w), axis=1) for z, at, size in ((x, i, m), (y, j, n)))
            out[part] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return out


def likely(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose parities do not rule them out; far fewer bytes move than with the texts."""
    left, right = (texts.select(F.col("fp").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab")
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def check(batch):
        (i, x), (j, y) = (kernel.utf8(batch.column(k)) for k in (4, 5))
        apart = differing(x.view(U64), i // 8, y.view(U64), j // 8)
        keep = np.flatnonzero(apart * (100 + percent) <= (100 - percent) * (batch.column(2).to_numpy() + batch.column(3).to_numpy()))
        yield batch.column(0).take(keep), batch.column(1).take(keep)

    return arrow_map(rows, check, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """a, b of the pairs whose sets have percent or more in common, from their whole texts."""
    pairs = written(likely(pairs, texts, percent), "likely")
    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def check(batch):
        i = 0
        cost = np.cumsum(sum(np.diff(kernel.utf8(batch.column(k))[0]) for k in (2, 3)))
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(cost, (cost[i - 1] if i else 0) + 2 * kernel.CHUNK, "right")))
            part = batch.slice(i, j - i)
            (p, x), (q, y) = (kernel.shingle_sets(data, offsets, size) for offsets, data in (kernel.utf8(part.column(2)), kernel.utf8(part.column(3))))
            keep = []
            for k in range(j - i):
                u, v = x[p[k] : p[k + 1]], y[q[k] : q[k + 1]]
                both = np.concatenate([u, v])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(u) + len(v) - common))
            keep = np.flatnonzero(keep)
            yield part.column(0).take(keep), part.column(1).take(keep)
            i = j

    links = written(arrow_map(rows, check, "a long, b long"), "links")
    forget(pairs)
    return links


def unit_pairs(n: np.ndarray, label: np.ndarray, bits: np.ndarray, split: int, low: int, high: int | None, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of a unit that may be links of different labels, at distances from low to high - 1.

    Rows before split are a block, the others, if any, another; pairs are of
    the two blocks, or else of the one. Every pair has one distance.
    """
    total = len(n)
    left, right = split, total - split
    ring = max(left, right)
    high = ring if high is None else min(high, ring)
    wide = max(1, bits.shape[1])
    step = max(1, (1 << 16) // max(1, left))
    for c in range(low if right else max(low, 1), high, step):
        shift = np.arange(c, min(c + step, high))
        i = np.broadcast_to(np.arange(left), (len(shift), left))
        j = i + shift[:, None]
        if right:
            j = j % ring
            ok = j < right
            j = j + split
        else:
            ok = j < left
        i, j = i[ok], j[ok]
        some = (label[i] != label[j]) & (percent * np.maximum(n[i], n[j]) <= 100 * np.minimum(n[i], n[j]))
        i, j = i[some], j[some]
        for k in range(0, len(i), max(1, (1 << 20) // wide)):
            a, b = i[k : k + max(1, (1 << 20) // wide)], j[k : k + max(1, (1 << 20) // wide)]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            keep = apart * (100 + percent) <= (100 - percent) * (n[a] + n[b])
            if keep.any():
                yield a[keep], b[keep]


def across(units: DataFrame, percent: int, low: int, high: int | None) -> DataFrame:
    """Distinct pairs a < b of different labels whose parities do not rule a link out.

    units: kin, p, q, side, fp, n, label, bits; a unit (kin, p, q) is a block
    of a bucket (p = q) or two blocks. Pairs are at distances from low to
    high - 1 in the order of the units' rows; of units of at most WHOLE sets
    all pairs are formed when low is 0.
    """

    def pairs(batches):
        now, held, out = None, [], []

        def told():
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            out.clear()
            ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

        def unit():
            side, fp, n, label = (np.concatenate(x) for x in zip(*(h[:4] for h in held), strict=True))
            if (label == label[0]).all():
                return
            bits = folded([b for h in held for b in h[4]])
            top = WHOLE if low == 0 and len(fp) <= WHOLE else high
            for i, j in unit_pairs(n, label, bits, int((side == 0).sum()), low, top, percent):
                out.append((fp[i], fp[j]))
                if sum(len(a) for a, _ in out) > 100_000:
                    yield told()

        for batch in batches:
            kin, p, q, side, fp, n, label = (c.to_numpy() for c in batch.columns[:7])
            first = np.flatnonzero(np.concatenate([[True], (kin[1:] != kin[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(kin)], strict=True):
                key = kin[i], p[i], q[i]
                if key != now:
                    if held:
                        yield from unit()
                    now, held = key, []
                held.append((side[i:j], fp[i:j], n[i:j], label[i:j], batch.column(7)[i:j].to_pylist()))
        if held:
            yield from unit()
        if out:
            yield told()

    parts = partitions(units.sparkSession)
    rows = units.select("kin", "p", "q", "side", "fp", "n", "label", "bits").repartition(parts, "kin", "p", "q")
    rows = rows.sortWithinPartitions("kin", "p", "q", "side", F.xxhash64("kin", "fp"), "fp")
    return rows.mapInArrow(pairs, "a long, b long").distinct()


def units_of(rows: DataFrame, size: Column | int) -> DataFrame:
    """kin, p, q, side, fp, n: the units of the buckets. rows: kin, fp, n, held; size: bytes of a set's parities."""
    most = F.greatest(F.lit(16), F.least(F.lit(BLOCK), F.floor(BLOCK_BYTES / size)))
    blocks = F.ceil(F.col("held") / most)
    rows = rows.withColumn("blocks", blocks).withColumn("x", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rows = rows.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("kin", F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q"), (F.col("x") > F.col("y")).cast("int").alias("side"), "fp", "n")


def role_of(name: str) -> Column:
    return (F.col(name).bitwiseAND(2) > 0).cast("int")


def short_sets(found: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """fp, short0, short1 of the sets whose allocations at the level are not enough, by role.

    A hot subset takes 1 from a set at level 0 and 2 at level 1, a hot
    deletion 1; what is taken twice from one segment only sends a set to the
    next level for nothing.
    """
    worth = F.when((F.col("tag").bitwiseAND(1) > 0) | F.lit(level == 0), 1).otherwise(2)
    lost = found.filter("hot").groupBy("fp").agg(*[F.sum(F.when(role_of("tag") == k, worth).otherwise(0)).alias(f"loss{k}") for k in (0, 1)])
    rows = classes.select(F.col("f1").alias("fp"), *[F.col(f"spare{level}{k}").alias(f"spare{k}") for k in (0, 1)]).join(lost, "fp", "left")
    short = [(F.coalesce(f"loss{k}", F.lit(0)) > F.col(f"spare{k}")) for k in (0, 1)]
    rows = rows.select("fp", *[x.alias(f"short{k}") for k, x in enumerate(short)]).filter("short0 OR short1")
    return rows.groupBy("fp").agg(F.max("short0").alias("short0"), F.max("short1").alias("short1"))


def cheapest(chosen: DataFrame, percent: int, size: int) -> DataFrame:
    """Level 2: kin, fp, n, centre, held of the buckets of single elements, each set in those of its rarest ones.

    Of two similar sets in one order the first (1 - t) * n + 1 elements have
    one in common; the order is by how many sets hold an element. Elements
    that a set shares with none are its first.
    """
    signatures = signatures_of(percent, size, True)

    def emit(batch):
        for sig, fp, tag in signatures(batch):
            yield signed(sig), signed(fp), tag.view(np.int32)

    own = written(arrow_map(chosen, emit, "sig long, fp long, tag int"), "elements")
    count = own.groupBy("sig").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    by_set = Window.partitionBy("fp", "upper")
    ranked = own.join(count, "sig").withColumns({"upper": role_of("tag"), "n": F.shiftright("tag", 2)})
    ranked = ranked.withColumns({"nth": F.row_number().over(by_set.orderBy("sets", "sig")), "shared": F.count(F.lit(1)).over(by_set)})
    prefix = F.floor(F.col("n") * (100 - percent) / 100) + 1
    ranked = written(ranked.filter(F.col("nth") + F.col("n") - F.col("shared") <= prefix).select("sig", "fp", "n"), "prefixes")
    bucket = ranked.groupBy("sig").agg(F.count(F.lit(1)).alias("held"), F.min("fp").alias("centre"), F.max("n").alias("longest"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.sum(F.xxhash64(F.lit(1), "fp").cast("decimal(20,0)")).alias("y")).filter("held > 1")
    # buckets of the same sets once
    bucket = bucket.groupBy(F.xxhash64("x", "y", "held").alias("kin")).agg(*[F.min_by(c, "sig").alias(c) for c in ("held", "centre", "longest")], F.min("sig").alias("sig"))
    out = written(ranked.join(bucket, "sig").select("kin", "fp", "n", "centre", "held", "longest"), "hot")
    forget(own, ranked)
    return out


def jaccard_join(df: DataFrame, percent: int = 75, size: int = 5, hot_bucket: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two documents link when 100 * intersection >= percent * union of their
    shingle sets; component_id is the least id reachable by links. A null text,
    or one without words, has no shingles and links with nothing. Rows of equal
    sets are one class; repeated rows stay repeated. A null id is passed over
    in the least id, so a component of null ids alone has a null component_id.
    An empty table gives an empty table; other columns are not read.
    """
    docs = doc_text(df, id_col, text_col).withColumn("key", F.xxhash64("text"))

    def measure(batch):
        sch = scheme(percent)
        for i, j, bounds, s in sets_of(batch.column(1), size):
            f1, f2 = fingerprints(bounds, s)
            spare = np.full((4, j - i), PLENTY)
            for upper in (0, 1):
                x = Signatures(sch, bounds, s, np.arange(j - i), bool(upper))
                spare[upper, x.rows], spare[2 + upper, x.rows] = x.count - x.need, x.doubled - x.need
            yield batch.column(0)[i:j], batch.column(2)[i:j], np.diff(bounds), signed(f1), signed(f2), *spare

    slim = written(arrow_map(docs, measure, "doc_id long, key long, n_shingles long, f1 long, f2 long, spare00 long, spare01 long, spare10 long, spare11 long"), "sets")
    full = slim.filter("n_shingles > 0")
    spares = [F.min(f"spare{level}{k}").alias(f"spare{level}{k}") for level in (0, 1) for k in (0, 1)]
    classes = written(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("low"), F.min("key").alias("key"), F.max("n_shingles").alias("n"), *spares), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0

    # a set has segments for about a third of its elements in each of its two roles
    found = buckets(docs.select("doc_id", "text"), index_all(percent, size, 1), total * 2 // 3, hot_bucket)
    short = written(short_sets(found, classes, 0), "short")
    wanted = found.filter("not hot").select("fp").union(short.select("fp")).distinct()
    # one document of each class that may have a partner; if no row of the class has an id, one of its texts
    readers = classes.join(wanted.withColumnRenamed("fp", "f1"), "f1", "left_semi").select(F.coalesce("low", "key").alias("by"), F.col("low").isNull().alias("no_id"), F.col("f1").alias("fp"), "f2")
    keyed = docs.select("text", F.coalesce("doc_id", "key").alias("by"), F.col("doc_id").isNull().alias("no_id")).join(readers, ["by", "no_id"]).select("fp", "f2", "text")

    def own(batch):
        seen: set[int] = set()
        for i, j, bounds, s in sets_of(batch.column(2), size):
            f1, f2 = fingerprints(bounds, s)
            same = (signed(f1) == batch.column(0)[i:j].to_numpy()) & (signed(f2) == batch.column(1)[i:j].to_numpy())
            keep = [k for k, f in enumerate(f1.tolist()) if same[k] and f not in seen and not seen.add(f)]
            bits = parities(bounds, s)
            yield batch.column(0)[i:j].take(keep), batch.column(2)[i:j].take(keep), [bits[k] for k in keep], np.diff(bounds)[keep]

    texts = bucketed(arrow_map(keyed, own, "fp long, text string, bits binary, n long"), "fp", "texts", unique=True)
    chosen = written(texts.join(short, "fp").select("fp", "text", "short0", "short1"), "chosen")
    unsafe = classes.join(short.select(F.col("fp").alias("f1")), "f1", "left_semi")
    again = buckets(chosen, index_short(percent, size), (unsafe.agg(F.sum("n")).first()[0] or 0) * 3, hot_bucket)
    last = written(chosen.select("fp", "text").join(short_sets(again, unsafe, 1), "fp"), "last")
    hot = cheapest(last, percent, size)
    # buckets of the same sets once
    rows = found.filter("not hot").union(again.filter("not hot"))
    rows = written(rows.select("kin", "fp", F.shiftright("tag", 2).alias("n"), "centre", "held").distinct(), "rows")
    forget(found, again, short, chosen, last)

    # each set of a bucket against its centre
    sizes = texts.select(F.col("fp").alias("a"), F.col("n").alias("m"))
    stars = rows.select("fp", "n", "centre").union(hot.select("fp", "n", "centre")).filter("fp <> centre").distinct()
    ratio = percent * F.greatest("n", "m") <= 100 * F.least("n", "m")
    stars = stars.select(F.col("centre").alias("a"), F.col("fp").alias("b"), "n").join(sizes, "a").filter(ratio).select("a", "b")
    links = verified(stars, texts, percent, size)
    labels = components(links)
    forget(links)

    # then what is apart, in rounds; the centre was held against all
    def labelled(x: DataFrame) -> DataFrame:
        return written(x.join(labels.withColumnRenamed("v", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labelled")

    def opened(x: DataFrame) -> DataFrame:
        """The units that hold several labels."""
        several = x.groupBy("kin", "p", "q").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("kin", "p", "q")
        return x.join(several, ["kin", "p", "q"], "left_semi")

    one = [F.lit(0).cast("long").alias(k) for k in "pq"]
    small = rows.filter("held > 2 and fp <> centre").select("kin", *one, F.lit(0).alias("side"), "fp", "n")
    large = written(units_of(hot.filter("held > 2 and fp <> centre"), F.greatest(F.lit(8), F.col("longest") / 2)), "units")
    low = 0
    longest = large.groupBy("kin", "p", "q").count().agg(F.max("count")).first()[0] or 0
    for high in DISTANCES:
        if low and low >= longest:
            break
        x = labelled(large if low else small.union(large))
        links = verified(across(opened(x).join(texts.select("fp", "bits"), "fp"), percent, low, high), texts, percent, size)
        if links.limit(1).count():
            before, labels = labels, joined(labels, links)
            forget(before)
        forget(x, links)
        low = high
    forget(rows, texts, hot, large)

    by_class = classes.join(labels.withColumnRenamed("v", "f1"), "f1", "left").withColumn("label", F.coalesce("label", "f1"))
    lowest = by_class.groupBy("label").agg(F.min("low").alias("component_id"))
    by_class = by_class.join(lowest, "label").select("f1", "f2", "component_id")
    out = full.join(by_class, ["f1", "f2"]).select("doc_id", "n_shingles", "component_id")
    return out.union(slim.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """df with one document of each component, that of the least id.

    Documents without shingles stay, as do rows with a null id. Rows that
    share an id are one document, which goes if it is not the least of a
    component that it lies in.
    """
    joined = jaccard_join(df, id_col=id_col, **options)
    gone = free(df, "_gone")
    rows = joined.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(gone)).distinct()
    return df.join(rows, named(id_col).cast("long") == F.col(gone), "left_anti")
