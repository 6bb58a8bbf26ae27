"""Exact deduplication by composable polynomial fingerprints.

A text, its white space made single blanks, is cut into pieces of PIECE bytes.
The pieces are written in the order of the input and hashed each by itself,
wherever their part of a file is read: the value of a byte string x is
sum(x[i] * BASE**i) modulo a prime, for two primes. As
h(x + y) = h(x) + BASE**len(x) * h(y), the pieces of a huge text combine by a
shift of the known length, in any grouping. Rows of equal length and
fingerprint form a group, whose pieces are then compared one by one with those
of the group's first row; rows that differ go into a group of their own, so
the result does not rest on the fingerprint.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CO_LOCATED, arrow_map, attached, forget, in_place, named, partitions, written
from .kernel import U64, chunks

#: Parameters: bytes of a piece, members of a group that one copy of its first row's text is compared with.
PIECE, SPAN = 1 << 18, 512
#: Two primes under 2**31, so that products fit 64 bits, and a base for each.
PRIMES, BASES = (2147483647, 2147483629), (1160605003, 728294971)
WHITE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


@functools.lru_cache(8)
def powers(base: int, prime: int, size: int) -> np.ndarray:
    """base**i modulo prime for i < size, by doubling."""
    out = np.ones(1, U64)
    while len(out) < size:
        out = np.concatenate([out, out * U64(pow(base, len(out), prime)) % U64(prime)])
    return out[:size]


def fingerprints(data: np.ndarray, offsets: np.ndarray, base: int, prime: int) -> np.ndarray:
    """h of each of the byte strings that lie in data one after another."""
    size = 1 << max(10, (len(data) + 1).bit_length())
    up, down = powers(base, prime, size), powers(pow(base, -1, prime), prime, size)
    sums = np.zeros(len(data) + 1, U64)
    # bytes count from 1; a term is under 2**39, so 2**24 of them fit
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    span = (sums[offsets[1:]] - sums[offsets[:-1]]) % U64(prime)
    return (span * down[offsets[:-1]] % U64(prime)).astype(np.int64)


def combined(prints: Column, k: int, piece: int, primes: tuple[int, ...]) -> Column:
    """The fingerprint of a text from those of its pieces, all but the last of `piece` bytes: from the end, shift and add."""
    shift = pow(BASES[k], piece, primes[k])
    return F.aggregate(F.sort_array(prints, asc=False), F.lit(0).cast("long"), lambda h, p: (h * F.lit(shift) + p[f"h{k}"]) % F.lit(primes[k]).cast("long"))


def pieces_of(text: Column, size: int) -> Column:
    """The bytes of a text in pieces; those of an empty one are one empty piece."""
    starts = lambda b: F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length(b) - 1, F.lit(0)) / size).cast("int"))
    return F.flatten(F.transform(F.array(text.cast("binary")), lambda b: F.transform(starts(b), lambda i: F.substring(b, i * size + 1, F.lit(size)))))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, piece: int = PIECE, primes: tuple[int, ...] = PRIMES) -> tuple[DataFrame, DataFrame]:
    """The pieces of the texts, and doc_id, keep_id, group_size, kept and text_sha256 of each row, both with its number and place.

    keep: the pieces carry the row itself as struct `whole` with the first of
    a text's pieces, so kept rows can be had without moving the others.
    """
    spark = df.sparkSession
    text = F.regexp_replace(F.coalesce(named(text_col).cast("string"), F.lit("")), WHITE_RUN, " ")
    rows = df.select(named(id_col).cast("long").alias("doc_id"), text.alias("text"), *([F.struct(*[named(c) for c in df.columns]).alias("whole")] if keep else []), F.monotonically_increasing_id().alias("row"))
    cut = rows.select("doc_id", "row", *(["whole"] if keep else []), F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha"), pieces_of(F.col("text"), piece).alias("p"))
    cut = cut.select("doc_id", "row", "n", "sha", F.size("p").alias("parts"), F.posexplode("p").alias("part", "piece"), *(["whole"] if keep else []))
    if keep:
        cut = cut.withColumn("whole", F.when(F.col("part") == 0, F.col("whole")))
    stored = in_place(cut, "row", "pieces")

    def hashed(batch: pa.RecordBatch):
        values = [np.zeros(batch.num_rows, np.int64) for _ in primes]
        for i, j, offsets, data in chunks(batch.column("piece")):
            for k, prime in enumerate(primes):
                values[k][i:j] = fingerprints(data, offsets, BASES[k], prime)
        yield [*[batch.column(c) for c in ("doc_id", "row", "n", "sha", "parts", "part")], *values]

    prints = [f"h{k}" for k in range(len(primes))]
    slim = stored.select("doc_id", "row", "n", "sha", "parts", "part", "piece")
    each = written(arrow_map(slim, hashed, "doc_id long, row long, n long, sha string, parts int, part int, " + ", ".join(f"{h} long" for h in prints)), "prints")
    head = ["doc_id", "row", "n", "sha", "parts"]
    long = each.filter("parts > 1").groupBy("row").agg(*[F.first(c).alias(c) for c in head if c != "row"], F.collect_list(F.struct("part", *prints)).alias("p"))
    long = long.select(*head, *[combined(F.col("p"), k, piece, primes).alias(h) for k, h in enumerate(prints)])
    state = each.filter("parts = 1").select(*head, *prints).unionByName(long).withColumn("turn", F.lit(0))

    key, first = ["n", *prints, "turn"], F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    turn = 0
    while True:
        state = written(state, "state")
        groups = written(state.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.min(first).alias("first")).filter("size > 1"), "groups")
        joined = attached(state, groups, key, "size")
        size = F.coalesce("size", F.lit(1))
        joined = joined.select(*state.columns, size.cast("long").alias("size"), F.coalesce("first.doc_id", F.when(F.col("size").isNull(), F.col("doc_id"))).alias("keep_id"), F.coalesce("first.row", "row").alias("keep_row"))
        joined = written(joined, "classes")
        forget(groups)
        bad = written(unequal(stored, joined.filter((F.col("size") > 1) & (F.col("turn") == turn))), "unequal", **CO_LOCATED)
        if bad.isEmpty():
            forget(state, bad, each)
            break
        state = joined.select(*state.columns).join(bad.withColumn("other", F.lit(True)), "row", "left").withColumn("turn", F.when(F.col("other"), F.lit(turn + 1)).otherwise(F.col("turn"))).select(*state.columns)
        turn += 1
    out = joined.select("row", "doc_id", "keep_id", F.col("size").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"))
    return stored, out


def unequal(stored: DataFrame, members: DataFrame) -> DataFrame:
    """row of the members whose pieces are not those of their group's first row.

    Only texts of members move. A group's members are dealt to one salt for
    each SPAN of them, and its first row goes to all salts, so a task gets a
    piece of a few hundred texts at most, and reads them as a stream.
    """
    salts = F.ceil(F.col("size") / SPAN).cast("int")
    slim = members.select("row", "keep_row", salts.alias("salts"), F.pmod(F.xxhash64("row"), salts).cast("int").alias("salt"))
    texts = only(stored, slim, "inner").select("row", "keep_row", "salts", "salt", "part", "piece")
    first = texts.filter("row = keep_row").select("keep_row", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("piece").alias("want"))
    both = texts.filter("row <> keep_row").join(first, ["keep_row", "salt", "part"], "left")
    return both.filter(~F.col("piece").eqNullSafe(F.col("want"))).select("row").distinct()


def only(stored: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of a table of in_place() joined with others by `row`; the table is neither moved nor sorted, the others go to it and are held in memory, a partition's at a time."""
    there = rows.withColumn("place", F.shiftright("row", 33)).repartition(partitions(stored.sparkSession), "place")
    return stored.join(there.hint("shuffle_hash"), ["place", "row"], how)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Texts are equal if they are the same after each run of white space became
    one blank; a null text is an empty one. Of equal texts the row with the
    least id stays, of several rows of that id any one; rows without an id
    come after all others, and a group of only such rows keeps one of them,
    with a null keep_id. An empty table gives no rows; other columns are not
    read. Texts of any length are held by one JVM row at a time and by Python
    in pieces.
    """
    stored, out = classes(df, id_col, text_col, **options)
    forget(stored)
    return out.drop("row")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of df that stay, with their columns."""
    stored, out = classes(df, id_col, text_col, keep=True, **options)
    kept = only(stored.filter("part = 0"), out.filter("kept").select("row"), "left_semi")
    return written(kept.select(*[F.col("whole").getField(c).alias(c) for c in df.columns]), "kept", **CO_LOCATED)
