"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups are rows of equal text. One that alone holds more than
1/(CELLS_PER_SHARD) of a shard in any measure is a heavy group: it is counted
and numbered in pieces by document id, each below that size, and placed whole
where it fits; only one that no shard can take, such as a text on a third of
all rows, is placed piece by piece, as the law of near equal bytes could not
hold otherwise. The other groups are too many to place one by one and are
dealt to cells by hash, which are placed. So no task grows with one key, and
the driver packs at most `cells` + 6 * shards * CELLS_PER_SHARD vectors,
however many rows there are. All go, largest first, where the dot product of
their vector with the shard's residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, written

#: Parameters: cells of a shard that a heavy group exceeds, and how far a whole group may exceed a shard's capacity.
CELLS_PER_SHARD, SLACK = 64, 0.002


def pack(demand: np.ndarray, shards: int, group: np.ndarray | None = None) -> np.ndarray:
    """Shard of each row of demand (items x measures), largest first, where the dot product with residual capacity is highest.

    Rows of one group (0 or above) are placed together if they fit a shard
    whole, beyond its capacity by SLACK at most; else each by itself.
    """
    total = demand.sum(axis=0)
    scaled = demand / np.where(total > 0, total, 1) * shards
    residual = np.ones((shards, demand.shape[1]))
    out = np.zeros(len(demand), np.int64)
    alone = np.ones(len(demand), bool) if group is None else group < 0
    members = {} if group is None else {g: np.flatnonzero(group == g) for g in np.unique(group[group >= 0]).tolist()}
    units = [(float(scaled[i].max()), [i]) for i in np.flatnonzero(alone).tolist()]
    units += [(float(scaled[m].sum(axis=0).max()), m.tolist()) for m in members.values()]
    waiting = sorted(units, key=lambda u: (-u[0], u[1][0]))[::-1]
    while waiting:
        _, own = waiting.pop()
        load = scaled[own].sum(axis=0)
        fits = (residual - load >= -SLACK).all(axis=1) if len(own) > 1 else np.ones(shards, bool)
        if not fits.any():
            waiting += [(float(scaled[i].max()), [i]) for i in own]
            continue
        k = int(np.argmax(np.where(fits, residual @ load, -np.inf)))
        out[own] = k
        residual[k] -= load
    return out


def shard(df: DataFrame, shards: int = 16, cells: int = 1 << 14, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row, under the law `bytes`.

    Rows of equal text share a shard unless no shard can take their group. A
    null text has size 1, checksum 0 and forms a group with the other nulls;
    tokens are words between white space. A heavy group of one id (a row many
    times over) is one piece. Slots number a shard's rows from 0 without
    gaps. Repeated rows each get a slot; an empty table gives an empty table.
    grown_shard is null, as the law is not `key`. Other columns are not read.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long")
    slim = doc_text(df, id_col, text_col).select(
        "doc_id",
        (size + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.xxhash64("text").alias("grp"),
    )
    slim = written(slim, "shard")
    slim = slim.withColumn("cell", F.pmod("grp", F.lit(cells)).cast("int"))
    sums = [F.sum("size"), F.sum("tokens"), F.count(F.lit(1))]
    loads = {r[0]: np.array(r[1:], float) for r in slim.groupBy("cell").agg(*sums).collect()}  # at most `cells` rows
    total = sum(loads.values(), np.zeros(3))
    most = total / (shards * CELLS_PER_SHARD)
    heavy = [c for c, v in loads.items() if (v > most).any()]  # at most 3 * shards * CELLS_PER_SHARD cells
    split: dict[int, int] = {}
    if heavy:
        limit = F.lit(False)
        for k, m in enumerate(most.tolist()):
            limit = limit | (F.col(f"v{k}") > m)
        big = slim.filter(F.col("cell").isin(heavy)).groupBy("grp").agg(*[s.alias(f"v{k}") for k, s in enumerate(sums)], F.countDistinct("doc_id").alias("ids")).filter(limit & (F.col("ids") > 1))
        for r in sorted(big.collect()):  # at most 3 * shards * CELLS_PER_SHARD groups
            split[r[0]] = int(min(np.ceil(2 * (np.array(r[1:4], float) / most).max()), r[4]))
    first, table, group_of = cells, [], {}
    for n, (grp, pieces) in enumerate(split.items()):
        table.append((grp, first, pieces))
        group_of |= dict.fromkeys(range(first, first + pieces), n)
        first += pieces
    if table:
        pieces = F.broadcast(spark.createDataFrame(table, "grp long, first int, pieces int"))
        slim = slim.join(pieces, "grp", "left").withColumn("cell", F.coalesce(F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"), "cell"))
        loads = {r[0]: np.array(r[1:], float) for r in slim.groupBy("cell").agg(*sums).collect()}
    keys = sorted(loads)
    to = pack(np.array([loads[k] for k in keys]).reshape(-1, 3), shards, np.array([group_of.get(k, -1) for k in keys], np.int64))
    offset, used = [], [0] * shards
    for k, s in zip(keys, to.tolist(), strict=True):
        offset.append((k, s, used[s]))
        used[s] += int(loads[k][2])
    places = F.broadcast(spark.createDataFrame(offset, "cell int, shard int, base long"))  # a row for each cell
    within = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size")
    return slim.withColumn("nth", F.row_number().over(within)).join(places, "cell").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
