"""Exact deduplication, conversation repair and resampling against brute force, on odd rows and on empty tables."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from tessera.llm import conversation_repair, exact_dedup, queries, resampling

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# exact deduplication


def classes_by_hand(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(f"[{WHITE}]+", " ", t or "")].append((i is None, i or 0, k))
    out = []
    for t, members in groups.items():
        first = min(members)
        out += [(rows[m[2]][0], rows[first[2]][0], len(members), m == first, hashlib.sha256(t.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


ODD = [(1, None), (2, ""), (3, " "), (4, "a  b"), (5, "a\t\nb"), (6, "a b"), (7, " a b"), (None, "a b"), (None, "zz"), (None, "zz"), (8, "a b"), (8, "a b"), (9, "é" * 700), (10, "é" * 700), (11, "é" * 699 + "e "), (12, "x y" * 1000), (13, "x  y" * 1000)]
ODD += [(100 + i, f"t{i % 7}") for i in range(60)]


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (3, 2)])
@pytest.mark.parametrize("piece", [7, exact_dedup.PIECE])
def test_exact_dedup(spark, piece, primes):
    """Also with fingerprints that often agree by chance, which the comparison of pieces must tell apart."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    assert rows_of(exact_dedup.exact_dedup(df, piece=piece, primes=primes)) == classes_by_hand(ODD)


def test_exact_dedup_on_documents(spark):
    docs = queries.table(spark, SF, "documents")
    assert rows_of(queries.op11_exact_dedup(spark, SF)) == classes_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_exact_dedup_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a ", 6), (3, "a  ", 7), (None, "c", 8)], "id long, text string, `Row` long")
    kept = exact_dedup.deduplicated(df, id_col="id")
    assert kept.columns == df.columns and rows_of(kept) == [(1, "a", 5), (2, "a ", 6), (None, "c", 8)]
    assert exact_dedup.exact_dedup(df.filter("1 = 0"), id_col="id").count() == 0


def test_fingerprints_combine():
    import numpy as np

    base, prime = exact_dedup.BASES[0], exact_dedup.PRIMES[0]
    data = np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    whole = exact_dedup.fingerprints(data, np.array([0, 5000]), base, prime)[0]
    assert whole == sum((int(b) + 1) * pow(base, i, prime) for i, b in enumerate(data)) % prime
    a, b = exact_dedup.fingerprints(data, np.array([0, 1234, 5000]), base, prime).tolist()
    assert (a + pow(base, 1234, prime) * b) % prime == whole


def test_exact_dedup_moves_no_pieces(spark):
    """The table of pieces joins the members of groups without an exchange or a sort of its own."""
    stored, out = exact_dedup.classes(queries.table(spark, SF, "documents"))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        plan = exact_dedup.only(stored, out.filter("group_size > 1").select("row"), "inner")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    above, below = plan.split("FileScan parquet spark_catalog", 1)
    assert "Exchange" not in above and "Sort " not in above and "Exchange hashpartitioning(place" in below


# conversation repair


def damaged_by_hand(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


GRAMMAR = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, repaired rows) over all edits, up to four insertions in a row."""

    @functools.cache
    def go(i, last, inserted):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def step(cost, label, out, *to):
            rest = go(*to)
            if rest:
                found.append((cost + rest[0], label + rest[1], out + rest[2]))

        other = [("user", "u"), ("assistant", "a")]
        if inserted < 4:
            for role, o in other:
                if o in GRAMMAR[last]:
                    step(3, "I", ((role, ""),), i, o, inserted + 1)
        if i < len(rows):
            initial, fault, role, text = rows[i]
            step(4, "D", (), i + 1, last, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if initial and initial in GRAMMAR[last]:
                    step(more, "K", ((role, text),), i + 1, initial, 0)
                for new, o in other:
                    if o in GRAMMAR[last]:
                        step(3 + more, "R", ((new, text),), i + 1, o, 0)
        return min(found, key=lambda w: w[:2]) if found else None

    return go(0, "", 0)


def report_by_hand(rows):
    conversations = defaultdict(list)
    for r in rows:
        conversations[r[0]]
    for c, *r in damaged_by_hand(rows):
        conversations[c].append(r)
    out = []
    for c, own in conversations.items():
        digest = lambda r: hashlib.sha256(":".join(["" if c is None else str(c), str(len(r[1])), r[1], r[2]]).encode()).hexdigest()  # noqa: E731, B023
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        seen, symbols, n = set(), [], defaultdict(int)
        for _, role, text in own:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            n[fault] += 1
            symbols.append((role[:1], fault, role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:], strict=False))
        cost, audit, fixed = cheapest(tuple(symbols))
        out.append((c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks(spark):
    rnd, rows = random.Random(5), []
    for c in [*range(60), None]:
        for t in range(rnd.choice([1, 2, 3, 5, 9, 40])):
            role = rnd.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            rows.append((c, rnd.choice([t, t, t, None, t + 3]), role, rnd.choice(["Hi.", "Hi", "  ", "", None, "what? ", "ok!\n", "a b c", "x. y"])))
    return rows + rows[:30] + [(999, 5, "user", "Same.")] * 40


@pytest.mark.parametrize("bits", [10, 1])
def test_conversation_repair(spark, talks, bits, monkeypatch):
    """Also in segments of two rows, so conversations are folded from many."""
    monkeypatch.setattr(conversation_repair, "SEGMENT_BITS", bits)
    df = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS `At`", "2 AS digest")
    assert rows_of(conversation_repair.report(conversation_repair.damaged(df), df)) == report_by_hand(talks)


def test_conversation_repair_on_conversations(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in queries.table(spark, SF, "conversations").collect()]
    assert rows_of(queries.op12_conversation_repair(spark, SF)) == report_by_hand(rows)


def test_repaired_rows_follow_the_grammar(spark, talks):
    df = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    rows = conversation_repair.repaired(df).collect()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id or -1, r.nth)):
        by[r.conv_id].append(r)
    for own in by.values():
        assert [r.nth for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in own))
    assert conversation_repair.report(df.filter("1 = 0")).count() == 0


# resampling

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def resampled_by_hand(docs, target, least=20):
    m = 10_000
    coded = lambda t: [zlib.crc32(w.encode()) % m for w in WORDS.findall(re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))]
    s, t, codes = [0] * m, [0] * m, [coded(x) for _, x in docs]
    for own in codes:
        for k in own:
            s[k] += 1
    for x in target:
        for k in coded(x):
            t[k] += 1
    gain = [math.floor(1000 * math.log((t[k] + 1) * (sum(s) + m) / ((s[k] + 1) * (sum(t) + m)))) for k in set().union(*codes, [0])]
    gain = dict(zip(set().union(*codes, [0]), gain, strict=True))
    out = []
    for (i, _), own in zip(docs, codes, strict=True):
        weight = sum(gain[k] for k in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[0] is not None and r[1] >= least), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: len(able) * 10 // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    target = [r.text for r in queries.table(spark, SF, "benchmark").collect()]
    assert rows_of(queries.op13_resampling(spark, SF)) == resampled_by_hand(docs, target)


def test_resampling_odd_rows(spark, monkeypatch):
    """Nulls, ties of all keys, words longer than a slice; with few bits a digit and small slices."""
    monkeypatch.setattr(resampling, "DIGIT", 3)
    monkeypatch.setattr(resampling, "SLICE", 64)
    docs = [(1, None), (2, ""), (None, "a b c " * 10), (3, "é" * 500 + " x" * 30), (4, "A1-b2_c3\x00d" * 20)] + [(5, "same text " * 15)] * 30 + [(i, f"w{i} " * 25) for i in range(-20, 0)] + [(2**63 - 1, "x " * 25), (-(2**63), "y " * 25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS `Row`", "2 AS score")
    target = spark.createDataFrame([("w-3 a b",), (None,)], "text string")
    assert rows_of(resampling.resample(frame, target)) == resampled_by_hand(docs, ["w-3 a b", None])
    assert resampling.resample(frame.filter("1 = 0"), target).count() == 0
    assert rows_of(resampling.resample(frame, target.filter("1 = 0"))) == resampled_by_hand(docs, [])
    assert resampling.drawn(frame, target).columns == frame.columns


def test_kth_key_over_all_longs(spark, monkeypatch):
    monkeypatch.setattr(resampling, "DIGIT", 5)
    rnd = random.Random(3)
    values = [(rnd.choice([-(2**63), 2**63 - 1, 0, -1, 5, 6, 7, rnd.getrandbits(62)]), i) for i in range(300)]
    df = spark.createDataFrame(values, "a long, b long")
    assert [resampling.kth_key(df, ["a", "b"], k) for k in (1, 2, 77, 299, 300)] == [sorted(values)[k - 1] for k in (1, 2, 77, 299, 300)]
    assert resampling.kth_key(df, ["a", "b"], 301) is None


def test_word_checksums():
    import numpy as np

    text = "abc " + "long" * 40 + " é1 z"
    data = np.frombuffer(text.encode(), np.uint8)
    codes, _ = resampling.word_buckets(data, np.array([0, len(data)]), 1 << 31)
    assert codes.tolist() == [zlib.crc32(w.encode()) % (1 << 31) for w in text.split()]
