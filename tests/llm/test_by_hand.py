"""Sharding and the verdict of the quality rules against plain versions on strings, without hashes of words or Arrow."""

import math
from collections import Counter, defaultdict

import pytest
import xxhash

from tessera.llm import quality, sharding

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    """The documents, one of them three times over, with a null and an empty text, a null language and a rare one."""
    out = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()]
    out += [out[3], out[3], (9001, None, "en"), (9002, "", "de"), (9003, out[5][1], None), (9004, "Ärger über öde Wörter äußern " * 3 + out[7][1], "xx")]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


WHITE = " \t\n\v\f\r"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c not in WHITE:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def packed_by_hand(rows, shards, cells=1 << 14):
    """shard and slot by (doc_id, text): cells of equal hash, largest first, each where the dot product with the room left is highest."""
    cell_of = {t: (42 if t is None else xxhash.xxh64(t.encode(), seed=42).intdigest()) % cells for _, t, _ in rows}
    load = defaultdict(lambda: [0, 0, 0])
    for _, t, _ in rows:
        v = load[cell_of[t]]
        for k, x in enumerate((len((t or "").encode()) + 1, len(words_of(t)), 1)):
            v[k] += x
    total = [sum(v[k] for v in load.values()) for k in range(3)]
    share = {c: [v[k] / total[k] * shards for k in range(3)] for c, v in load.items()}
    assert max(map(max, share.values())) < 1 / sharding.CELLS_PER_SHARD, "no group is to be heavy"
    room, to = [[1.0] * 3 for _ in range(shards)], {}
    for c in sorted(share, key=lambda c: (-max(share[c]), c)):
        fit = [sum(a * b for a, b in zip(r, share[c], strict=True)) for r in room]
        to[c] = fit.index(max(fit))
        room[to[c]] = [a - b for a, b in zip(room[to[c]], share[c], strict=True)]
    out, used = [], [0] * shards
    for c in sorted(share):
        for i, t, _ in sorted((r for r in rows if cell_of[r[1]] == c), key=lambda r: (r[0], r[1] or "")):
            out.append((i, to[c], used[to[c]]))
            used[to[c]] += 1
    return sorted(out)


@pytest.mark.parametrize("shards", [2, 3])
def test_sharding_is_the_greedy_packing(spark, shards):
    """Texts of like length, so that no group is heavy and each cell is placed by itself."""
    some = [(i, None if i % 300 == 0 else " ".join(f"w{(i * k) % 97}" for k in range(40 + i % 9)) + f" {i % 690}", "en") for i in range(700)]
    df = spark.createDataFrame(some, "doc_id long, text string, lang string").repartition(4)
    got = sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard(df, shards).collect())
    assert got == packed_by_hand(some, shards)


def kind_of(c):
    if c in WHITE:
        return "white"
    if ord(c) > 127:
        return "wide"
    if c in ".,;:!?'\"-()":
        return "stop"
    if c in quality.SYMBOLS:
        return "symbol"
    return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "other ASCII"


def distance(p, q):
    """Jensen-Shannon, of two counts by name."""
    n, m, d = sum(p.values()), sum(q.values()), 0.0
    for k in {*p, *q}:
        a, b = p.get(k, 0) / n, q.get(k, 0) / m
        d += sum(x * math.log2(x / ((a + b) / 2)) for x in (a, b) if x) / 2
    return math.sqrt(max(0.0, d))


def distances_by_hand(rows):
    """class and word distance of each row: from the other rows of its language and all languages as so many words of it."""
    words, kinds = defaultdict(Counter), defaultdict(Counter)
    for _, t, lang in rows:
        words[lang or ""].update(words_of(t))
        kinds[lang or ""].update(map(kind_of, t or ""))
    every, every_kind = sum(words.values(), Counter()), sum(kinds.values(), Counter())
    n, weight, common = every.total(), quality.LANGUAGE_WORDS, quality.COMMON
    pooled = {w for w, k in every.items() if k / n >= common}
    out = []
    for _, t, lang in rows:
        known, own, mine = words[lang or ""], Counter(words_of(t)), Counter(map(kind_of, t or ""))
        if own.total() < 50:
            out.append((None, None))
            continue
        total = known.total()
        listed = {w for w, k in known.items() if k >= total * common} | pooled
        listed = {w for w in listed if known[w] + weight * every[w] / n >= common * (total + weight)}
        fold = lambda c: Counter({w: c[w] for w in listed}) + Counter({None: c.total() - sum(c[w] for w in listed)})
        others = Counter({w: known[w] - own[w] for w in listed} | {None: fold(known)[None] - fold(own)[None]})
        for w in listed:
            others[w] += weight * every[w] / n
        others[None] += weight * (1 - sum(every[w] for w in listed) / n)
        prior = {k: every_kind[k] * weight / n for k in quality.CLASSES}
        letters = prior["lower"] + prior["upper"] + prior["wide"]
        all_own = mine["lower"] + mine["upper"] + mine["wide"]
        wide = mine["wide"] / all_own if all_own else prior["wide"] / letters
        narrow = prior["lower"] + prior["upper"]
        script = prior | {"wide": letters * wide} | {k: letters * (1 - wide) * prior[k] / narrow for k in ("lower", "upper")}
        out.append((distance(mine, {k: kinds[lang or ""][k] - mine[k] + script[k] for k in quality.CLASSES}), distance(fold(own), others)))
    return out


def test_quality_verdict_by_brute_force(rows, table):
    got = sorted((tuple(r) for r in quality.quality(table, id_col="doc_id").select("doc_id", "n_words", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept").collect()), key=repr)
    want = {}
    for (i, t, _), (c, w) in zip(rows, distances_by_hand(rows), strict=True):
        want[i] = len(words_of(t)), c, w
    judged = 0
    for i, n, repeats, c, w, failed, kept in got:
        words, want_c, want_w = want[i]
        assert n == words
        assert (c is None) == (want_c is None) and (w is None) == (want_w is None)
        assert failed == (n < 50 or 100 * repeats > 50 * n)
        if c is not None:
            assert c == pytest.approx(want_c, abs=1e-9) and w == pytest.approx(want_w, abs=1e-9)
            judged += 1
        assert kept == (not failed and (want_c or 0) <= 0.32 and (want_w or 0) <= 0.45)
    assert len(got) == len(rows) and judged > 100
    assert {k for *_, k in got} == {True, False}
