"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is the hash of the words at the kept positions of a fixed mask laid
over a text; the ignored positions may differ. Seeds of the test items and of
the documents are joined, and the windows of the item that hold a hit are
compared with the document word by word on the diagonal of the hit: a document
is contaminated by an item if some window of `window` words of the item (all of
a shorter item) agrees with the document in all but a share of substituted
words. Words are known by 64-bit hashes.

A hit's place in the item with the words around it is a spot; items that share
these share the spot, so a phrase of many items is compared once and spread to
them where it was found. The documents' seeds are joined where the texts lie.
Of documents with hits, the words are read again in blocks, each sent once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_text, free, named, written

#: Parameters: the masks (1: kept, 0: ignored), all of one span. In 13 words with any three substituted, one of them fits.
MASKS = ("1110011", "1101011", "1011101", "1111100", "0010111")
SPAN = len(MASKS[0])
WORD_BREAK = r"[^\p{L}\p{N}]+"
#: Most test seeds that are broadcast (16 bytes each before hashing); more are joined by shuffle.
BROADCAST_SEEDS = 1_000_000
#: Most spots that are broadcast (about 200 bytes each for windows of 13 words); more are joined by shuffle.
BROADCAST_SPOTS = 200_000
#: Words of a block of a document, without those at its ends that the next blocks hold too.
BLOCK = 128


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    return F.transform(word_array(text), lambda w: F.xxhash64(w))


def missed(width: int, wrong: int) -> list[str]:
    """Placements of so many substituted words (0) in width words that no mask fits; each is a mask of its own."""
    fits = lambda at: len(at) == SPAN and any(all(a >= m for a, m in zip(at, mask)) for mask in MASKS)
    placed = [""]
    for _ in range(width):
        placed = [p + b for p in placed for b in "01" if (p + b).count("0") <= wrong and not fits((p + b)[-SPAN:])]
    return [p for p in placed if p.count("0") == wrong]


def masks_of(widths: list[int], agree: float) -> dict[int, tuple[str, ...]]:
    """The masks beside MASKS that windows of these widths need, by span: whole windows under SPAN, else what MASKS miss."""
    need = {w: ("1" * w,) if w < SPAN else tuple(missed(w, w - math.ceil(w * agree))) for w in widths if w > 0}
    return {w: masks for w, masks in need.items() if masks}


def seed_of(mask: str, word: list[Column]) -> Column:
    return F.xxhash64(F.lit(int("1" + mask, 2)), *[w for w, bit in zip(word, mask) if bit == "1"])


def seeds(hashed: DataFrame, keys: list[str], masks: tuple[str, ...]) -> DataFrame:
    """keys, pos and seed of each mask at each position; hashed: keys, h (hashes of the words); masks: of one span."""
    span = len(masks[0])
    n = F.size("h") - (span - 1)
    shifted = F.arrays_zip(*[F.slice("h", k + 1, n).alias(f"h{k}") for k in range(span)])
    placed = hashed.filter(F.size("h") >= span).select(*keys, F.posexplode(shifted).alias("pos", "z"))
    word = [F.col("z").getField(f"h{k}") for k in range(span)]
    return placed.select(*keys, "pos", F.explode(F.array(*[seed_of(m, word) for m in masks])).alias("seed"))


def spots(hashed: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """item_hash, spot, around, lead, width and seeds of each position of these items; hashed: item_hash, h, width.

    around holds the hashes of all windows with the whole mask at that position, which is lead words from its start.
    """
    span, n = len(masks[0]), F.size("h")
    start = lambda at: F.greatest(F.lit(0), at + span - F.col("width"))
    at = lambda i: F.struct((i - start(i)).alias("lead"), F.slice("h", start(i) + 1, F.least(n, i + F.col("width")) - start(i)).alias("around"))
    placed = hashed.select("item_hash", "width", F.explode(F.transform(F.sequence(F.lit(0), n - span), at)).alias("z")).select("item_hash", "width", "z.lead", "z.around")
    word = [F.get("around", F.col("lead") + k) for k in range(span)]
    return placed.select("item_hash", F.xxhash64("around", "lead", "width").alias("spot"), "around", "lead", "width", F.array(*[seed_of(m, word) for m in masks]).alias("seeds"))


def small(df: DataFrame, most: int) -> DataFrame:
    """Broadcast if it has at most so many rows."""
    return F.broadcast(df) if df.count() <= most else df


def contaminated(docs: DataFrame, items: DataFrame, window: int = 13, agree: float = 0.75, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, matched and compared of each contaminated document and item; the best window of the pair.

    Case and everything but letters and digits are ignored. Every window of at
    least SPAN words that agrees in the share is found: where MASKS miss
    placements of substitutions in the widths at hand (8, 9 and 12 words, not
    13), these are masks as well. Items of fewer words match where all their
    words are, in their order and without others between; null texts and those
    without words match nothing. Equal ids are one document or item with
    several texts, a null id is never reported; other columns are not read;
    empty tables give an empty table.
    """
    if window < SPAN or not 0 < agree <= 1:
        raise ValueError(f"window must be at least {SPAN} words and agree in (0, 1]")
    tests = items.select(named(item_col).cast("long").alias("item_id"), word_hashes(named(item_text).cast("string")).alias("h")).filter("item_id is not null")
    tests = written(tests.withColumn("item_hash", F.xxhash64("h")).distinct(), "items")
    # items of the same words are searched once
    hashed = tests.dropDuplicates(["item_hash"]).select("item_hash", "h", F.least(F.lit(window), F.size("h")).alias("width"))
    more = masks_of(sorted(r[0] for r in hashed.select("width").distinct().collect()), agree)  # at most `window` widths
    places = spots(hashed.filter(F.col("width") >= SPAN), MASKS)
    for width, masks in more.items():
        places = places.unionByName(spots(hashed.filter(F.col("width") == width), masks))
    places = written(places, "spots")

    key = ["doc_id", "text_key"]
    rows = doc_text(docs, id_col, text_col).filter("doc_id is not null and text is not null").withColumn("text_key", F.xxhash64("text"))
    # a window may reach past a document's ends by as many words as may differ
    beyond = F.array_repeat(F.lit(0).cast("long"), window - math.ceil(window * agree))
    padded = F.concat(beyond, word_hashes(F.col("text")), beyond).alias("h")
    own = rows.select(*key, padded)
    found = seeds(own, key, MASKS)
    for masks in more.values():
        found = found.unionByName(seeds(own, key, masks))
    test_seeds = small(places.select(F.explode("seeds").alias("seed"), "spot").distinct(), BROADCAST_SEEDS)
    hits = written(found.join(test_seeds, "seed").select(*key, "pos", "spot").distinct(), "hits")

    with_hits = small(hits.select(*key).distinct(), BROADCAST_SEEDS)
    read = rows.join(with_hits, key, "left_semi").select(*key, padded)
    start = lambda b: F.greatest(b * BLOCK - (window - SPAN), F.lit(0))
    block = lambda b: F.struct(b.alias("block"), start(b).alias("start"), F.slice("h", start(b) + 1, (b + 1) * BLOCK + window - start(b)).alias("own"))
    blocks = read.select(*key, F.explode(F.transform(F.sequence(F.lit(0), F.expr(f"int((size(h) - 1) div {BLOCK})")), block)).alias("z")).select(*key, "z.*")
    blocks = blocks.groupBy(*key, "block", "start").agg(F.first("own").alias("own"))  # repeated rows

    known = small(places.groupBy("spot").agg(F.first("around").alias("around"), F.first("lead").alias("lead"), F.first("width").alias("width")), BROADCAST_SPOTS)
    both = hits.withColumn("block", F.expr(f"int(pos div {BLOCK})")).join(known, "spot").join(blocks, [*key, "block"])
    at = F.col("pos") - F.col("lead") - F.col("start")
    same = F.transform("around", lambda w, i: F.coalesce(F.when(i + at >= 0, F.get("own", i + at)) == w, F.lit(False)).cast("int"))
    sums = F.transform(F.sequence(F.lit(0), F.size("same") - F.col("width")), lambda s: F.aggregate(F.slice("same", s + 1, F.col("width")), F.lit(0), lambda a, x: a + x))
    best = both.select("doc_id", "spot", "width", same.alias("same")).select("doc_id", "spot", "width", F.array_max(sums).alias("matched"))
    best = best.filter(F.col("matched") >= F.ceil(F.col("width") * agree)).groupBy("doc_id", "spot").agg(F.max("matched").alias("matched"), F.max("width").alias("compared"))
    most = lambda df, *by: df.groupBy(*by).agg(F.max("matched").cast("long").alias("matched"), F.max("compared").cast("long").alias("compared"))
    of_items = most(best.join(places.select("spot", "item_hash").distinct(), "spot"), "doc_id", "item_hash")
    return most(of_items.join(tests.select("item_hash", "item_id"), "item_hash"), "doc_id", "item_id")


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs without those of contaminated ids, with their columns; rows with a null id stay."""
    name = free(docs, "_contaminated")
    bad = contaminated(docs, items, **options).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, named(options.get("id_col", "doc_id")).cast("long") == F.col(name), "left_anti")
