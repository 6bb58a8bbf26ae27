"""Quality rules: base counts, then distribution divergence from references of each language.

The references are the character-class and common-word histograms of each
language over all documents, each smoothed towards those of all languages, so
that a language with little text has a reference too. A document is held
against its language's, without its own part in it, by Jensen-Shannon distance
(base 2, so from 0 to 1); only short documents are not judged.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel
from .common import arrow_map, named, without, written
from .kernel import U64

#: Fixed value: the signs that the symbol count counts.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "white", "stop", "symbol", "other ASCII", "wide")
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Parameters: a word is common if it makes up this share of its language's words, so there are at most 1 / COMMON;
#: all languages count in a language's reference like so many words of it, and alone for all but the largest LANGUAGES.
COMMON, LANGUAGE_WORDS, LANGUAGES = 1 / 500, 20_000, 1000
LETTERS = [CLASSES.index(k) for k in ("lower", "upper")]
WIDE = CLASSES.index("wide")


@functools.lru_cache(1)
def class_table() -> np.ndarray:
    t = np.full(256, 6, np.uint8)
    t[97:123], t[65:91], t[48:58] = 0, 1, 2
    t[list(kernel.WHITE)] = 3
    t[[ord(c) for c in ".,;:!?'\"-()"]] = 4
    t[[ord(c) for c in SYMBOLS]] = 5
    t[128:] = 7
    return t


def features(offsets: np.ndarray, data: np.ndarray) -> dict[str, np.ndarray]:
    """Of a chunk: the base counts, the class histogram, and document and hash of each word."""
    n = len(offsets) - 1
    starts, ends, doc = kernel.words(data, offsets)
    p = kernel.prefix_hashes(data)
    h = kernel.span_hashes(p, starts, ends)
    lead = (data & 0xC0) != 0x80
    kind = class_table()[data]
    row = np.repeat(np.arange(n), np.diff(offsets))
    classes = np.bincount(row[lead] * len(CLASSES) + kind[lead], minlength=n * len(CLASSES)).reshape(n, -1)
    out = {"n_words": kernel.row_sums(doc, n), "word_chars": classes.sum(axis=1) - classes[:, 3], "n_symbols": classes[:, 5], "classes": classes}
    salt = kernel.mix(np.arange(1, n + 1, dtype=U64))
    # lines: from after a line feed or the document's start to the next
    cut = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    cut = cut[cut < len(data)]
    line_doc = np.searchsorted(offsets, cut, "right") - 1
    end = np.append(cut[1:], len(data))
    end = end - ((end > cut) & (data[end - 1] == 10)) if len(cut) else end
    with_word = np.searchsorted(starts, end) > np.searchsorted(starts, cut)
    cut, end, line_doc = cut[with_word], end[with_word], line_doc[with_word]
    out["n_dup_lines"] = kernel.row_sums(line_doc[_again(kernel.span_hashes(p, cut, end) ^ salt[line_doc])], n)
    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        w = kernel.mix(h[:-2] + kernel.mix(h[1:-1] + kernel.mix(h[2:] + U64(1)))) ^ salt[doc[:-2]]
        whole = doc[:-2] == doc[2:]
        twice = np.flatnonzero(whole)[_again(w[whole], False)]
        for k in range(3):
            covered[twice + k] = True
    out["n_repeat_words"] = kernel.row_sums(doc[covered], n)
    return out | {"doc": doc, "hash": h}


def _again(keys: np.ndarray, keep: str | bool = "first") -> np.ndarray:
    import pandas as pd

    return pd.Series(keys).duplicated(keep).to_numpy()


def _merged(batch: pa.RecordBatch, column: int):
    for i, j, offsets, data in kernel.chunks(batch.column(column)):
        yield i, j, features(offsets, data)


def references(df: DataFrame) -> dict[str | None, tuple[np.ndarray, ...]]:
    """Of each of the largest languages, and as None for all others: class counts, those of all languages as they count
    here, hashes of the common words, and their counts and those of the rest, own and of all languages.

    df: lang, text. Each Arrow batch is reduced to a row for each language and
    distinct word before the shuffle. What comes to the driver is at most
    LANGUAGES languages with 2 / COMMON words each.
    """

    def count(batch):
        import pandas as pd

        langs = np.array(batch.column(0).to_pylist(), object)
        codes, names = pd.factorize(langs)
        for i, j, f in _merged(batch, 1):
            lang = codes[i:j]
            counts = pd.DataFrame({"l": lang[f["doc"]], "h": f["hash"].view(np.int64)}).value_counts(sort=False)
            where = counts.index.get_level_values(0).to_numpy()
            yield names[where], counts.index.get_level_values(1).to_numpy(), counts.to_numpy(), np.ones(len(counts), bool)
            for k in np.unique(lang):
                yield [names[k]] * len(CLASSES), np.arange(len(CLASSES)), f["classes"][lang == k].sum(axis=0), np.zeros(len(CLASSES), bool)

    rows = arrow_map(df.select(F.coalesce("lang", F.lit("")).alias("lang"), "text"), count, "lang string, key long, n long, word boolean")
    sums = written(rows.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "histograms")
    totals = sums.filter("word").groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    if not every:
        return {None: (np.zeros(len(CLASSES)), np.ones(len(CLASSES)), np.zeros(0, U64), np.zeros(1), np.ones(1))}
    largest = F.broadcast(totals.orderBy(F.desc("total"), "lang").limit(LANGUAGES))
    own = sums.join(largest, "lang")
    is_common = F.col("word") & (F.col("n") >= F.col("total") * COMMON)
    keys = F.broadcast(own.filter(is_common).select("key").distinct().withColumn("own", F.lit(True)))
    in_all = sums.filter("word").groupBy("key").agg(F.sum("n").alias("n")).join(keys, "key", "left")
    in_all = {r["key"]: r["n"] / every for r in in_all.filter(F.col("own") | (F.col("n") >= every * COMMON)).collect()}
    pooled = [k for k, share in in_all.items() if share >= COMMON]
    all_classes = np.zeros(len(CLASSES))
    for r in sums.filter(~F.col("word")).groupBy("key").agg(F.sum("n").alias("n")).collect():
        all_classes[r["key"]] = r["n"]
    all_classes *= LANGUAGE_WORDS / every
    by: dict[str | None, tuple[np.ndarray, dict[int, int], int]] = {None: (np.zeros(len(CLASSES)), {}, 0)}
    for r in own.filter(~F.col("word") | is_common | F.col("key").isin(pooled)).collect():
        classes, words, _ = by.setdefault(r["lang"], (np.zeros(len(CLASSES)), {}, r["total"]))
        if r["word"]:
            words[r["key"]] = r["n"]
        else:
            classes[r["key"]] = r["n"]
    out = {}
    for lang, (classes, words, total) in by.items():
        some = [(np.array([k], np.int64).view(U64)[0], words.get(k, 0), LANGUAGE_WORDS * in_all[k]) for k in {*words, *pooled}]
        some = sorted(x for x in some if x[1] + x[2] >= COMMON * (total + LANGUAGE_WORDS))
        n, prior = np.array([x[1] for x in some], float), np.array([x[2] for x in some], float)
        out[lang] = classes, all_classes, np.array([x[0] for x in some], U64), np.append(n, total - n.sum()), np.append(prior, max(0.0, LANGUAGE_WORDS - prior.sum()))
    return out


def in_script(prior: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The class counts of all languages for each row of c, its letters wide or not in the row's own ratio."""
    letters, narrow = prior[[*LETTERS, WIDE]].sum(), prior[LETTERS].sum()
    all_own = c[:, [*LETTERS, WIDE]].sum(axis=1)
    wide = np.divide(c[:, WIDE], all_own, out=np.full(len(c), prior[WIDE] / max(letters, 1e-9)), where=all_own > 0)
    out = np.tile(prior, (len(c), 1))
    out[:, WIDE] = letters * wide
    out[:, LETTERS] = (letters * (1 - wide))[:, None] * (prior[LETTERS] / narrow if narrow else np.full(2, 0.5))
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of each row of p from q; both are shares."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=-1)
    return np.sqrt(np.maximum(0, (a + b) / 2))


def quality(df: DataFrame, min_words: int = 50, guard: int = 50, most_class: float = 0.32, most_words: float = 0.45, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: bool = False) -> DataFrame:
    """doc_id, the base counts, class_distance, word_distance, base_failed and kept of every row.

    base_failed: fewer than min_words words, or more than half of the words in
    repeated three-word windows. Others are kept unless they have at least
    `guard` words and lie further than most_class or most_words from their
    language's references; distances are null below that. A null
    text has no words and fails. A null language is a language of its own.
    Repeated rows stay repeated; an empty table gives an empty table. Other
    columns are not read; with carry, df's columns come first, in place of
    doc_id, and those named like an added one are replaced.
    """
    tidy = {"text": named(text_col).cast("string"), "lang": F.coalesce(named(lang_col).cast("string"), F.lit(""))}
    rows = df.select(*[c.alias(k) for k, c in tidy.items()])
    known = references(rows)
    added = [*BASE_COUNTS, "class_distance", "word_distance", "base_failed", "kept"]
    front = without(df, *added) if carry else df.select(named(id_col).cast("long").alias("doc_id"))
    n_front = len(front.columns)
    source = without(df, *added) if carry else df
    rows = source.select(*([named(c) for c in front.columns] if carry else [named(id_col).cast("long").alias("doc_id")]), *[c.alias(f"_quality_{k}") for k, c in tidy.items()])

    def judge(batch):
        langs = np.array(batch.column(n_front + 1).to_pylist(), object)
        for i, j, f in _merged(batch, n_front):
            n = j - i
            distance = np.full((2, n), np.nan)
            names = np.array([x if x in known else None for x in langs[i:j]], object)
            for lang in set(names):
                classes, all_classes, words, count, all_count = known[lang]
                own = np.flatnonzero((names == lang) & (f["n_words"] >= guard))
                if not len(own):
                    continue
                at = np.searchsorted(words, f["hash"])
                at[at == len(words)] = 0
                at = np.where(words[at] == f["hash"], at, len(words)) if len(words) else np.zeros(len(f["hash"]), np.int64)
                width = len(words) + 1
                place = np.full(n, -1)
                place[own] = np.arange(len(own))
                mine = place[f["doc"]] >= 0
                hist = np.bincount(place[f["doc"][mine]] * width + at[mine], minlength=len(own) * width).reshape(len(own), -1)
                c = f["classes"][own]
                # without the document's own part in the counts; it has none in None's
                for k, (mine, others) in enumerate(((c, np.maximum(0, classes - c) + in_script(all_classes, c)), (hist, np.maximum(0, count - hist) + all_count))):
                    distance[k, own] = js_distance(mine / mine.sum(axis=1, keepdims=True), others / others.sum(axis=1, keepdims=True))
            yield [*[batch.column(k)[i:j] for k in range(n_front)], *[f[k] for k in BASE_COUNTS], *[pa.array(d, mask=np.isnan(d)) for d in distance]]

    schema = T.StructType(front.schema.fields + [T.StructField(k, T.LongType()) for k in BASE_COUNTS] + [T.StructField(k, T.DoubleType()) for k in added[5:7]])
    out = arrow_map(rows, judge, schema)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > most_class) | (F.coalesce("word_distance", F.lit(0.0)) > most_words)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def keep_good(df: DataFrame, **options) -> DataFrame:
    """The rows of df that are kept, with their columns."""
    return quality(df, carry=True, **options).filter("kept").select(*[named(c) for c in df.columns])
