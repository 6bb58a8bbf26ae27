"""Conversation structure repair by weighted finite-state composition.

Three machines: the input acceptor, a chain with one arc for each row of a
conversation (its symbol: initial of the role, fault); the edit transducer,
whose arcs keep, rerole or delete a row or insert one, each with a label and a
cost; and the role grammar, an acceptor of role initials. They are composed
lazily: a state is (rows read, grammar state), and its arcs are made when they
are first asked for, each an edit of one row after as many insertions as lead
to new grammar states. Weights are (cost, label string), compared in this
order; the shortest path is found in topological order from the end, as labels
in front keep the order of strings while labels behind would not.

A conversation may hold any share of all rows. Rows are sorted by range and
cut into segments of SEGMENT rows at most; a segment is summed up by the best
weight between each two grammar states, segments of a conversation are folded
from the end by costs and ranks of strings alone, and only the chosen strings
are fetched. All labels of a row end in a letter that insertions don't have,
so of two paths over the same rows no string is the start of another, and
ranks order whatever follows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_stream, attached, named, partitions, written

#: Parameters: rows of a segment (a power of two), costs of the edits.
SEGMENT_BITS, RENAME, DELETE, INSERT, TRUNCATED = 10, 3, 4, 3, 3
#: The role grammar s?(ua)+ or nothing: states by what came last (0 nothing, 1 s, 2 u, 3 a), and those that may end.
GRAMMAR, FINAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), (0, 3)
STATES = range(len(GRAMMAR))
NAMES = {"u": "user", "a": "assistant"}
#: Faults of a row; the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT = range(4)
LEGAL = ("su", "ua", "au")
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
Weight = tuple[int, str]


def edits(initial: str, fault: int) -> Iterator[tuple[str, str | None, int]]:
    """Arcs of the edit transducer that read a row: label, initial written (None: nothing), cost."""
    yield "D", None, DELETE
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        yield "K", initial, more
        for out in NAMES:
            yield "R", out, RENAME + more


@functools.cache
def insertions(state: int) -> tuple[tuple[int, int, str], ...]:
    """State, cost and labels of each run of insertions that meets no grammar state twice; others cost more and lead nowhere else."""
    found, paths = [], [(state, 0, "", {state})]
    while paths:
        at, cost, labels, seen = paths.pop()
        found.append((at, cost, labels))
        for out in NAMES:
            to = GRAMMAR[at].get(out)
            if to is not None and to not in seen:
                paths.append((to, cost + INSERT, labels + "I", seen | {to}))
    return tuple(found)


@functools.cache
def arcs(state: int, initial: str, fault: int) -> dict[int, Weight]:
    """The composed machine's arcs over one row: the least weight into each grammar state."""
    best: dict[int, Weight] = {}
    for at, cost, labels in insertions(state):
        for label, out, more in edits(initial, fault):
            to = at if out is None else GRAMMAR[at].get(out)
            if to is not None:
                w = (cost + more, labels + label)
                best[to] = min(best.get(to, w), w)
    return best


@functools.cache
def closing(state: int) -> Weight:
    """The least weight of insertions after the last row."""
    return min((cost, labels) for at, cost, labels in insertions(state) if at in FINAL)


def summed_up(symbols: list[tuple[str, int]]) -> list[dict[int, Weight]]:
    """For each grammar state before the rows, the least weight to each state after them."""
    best: list[dict[int, Weight]] = [{q: (0, "")} for q in STATES]
    for initial, fault in reversed(symbols):
        new = []
        for q in STATES:
            own: dict[int, Weight] = {}
            for to, (cost, label) in arcs(q, initial, fault).items():
                for b, (more, rest) in best[to].items():
                    w = (cost + more, label + rest)
                    if b not in own or w < own[b]:
                        own[b] = w
            new.append(own)
        best = new
    return best


def folded(costs: list[list[int | None]], ranks: list[list[int]]) -> tuple[int, list[tuple[int, int]]]:
    """Least cost of a conversation and the states before and after each of its segments on the best path."""
    size = len(GRAMMAR)
    ends = [closing(q) for q in STATES]
    order = sorted({s for _, s in ends})
    after = [(c, order.index(s)) for c, s in ends]
    choice = []
    for cost, rank in zip(reversed(costs), reversed(ranks), strict=True):
        ways = [[(cost[q * size + b] + after[b][0], rank[q * size + b], after[b][1], b) for b in STATES if cost[q * size + b] is not None] for q in STATES]
        best = [min(w) for w in ways]
        order = sorted({w[1:3] for w in best})
        after = [(w[0], order.index(w[1:3])) for w in best]
        choice.append([w[3] for w in best])
    path, q = [], 0
    for to in reversed(choice):
        path.append((q, to[q]))
        q = to[q]
    return after[0][0], path


def damaged(df: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of conversations after damage by the checksum of id and turn; nulls are read as one blank.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes out full
    stops, exclamation and question marks, 3 gives it twice, 4 makes its role
    user.
    """
    text = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = df.select(named("conv_id").cast("long").alias("conv_id"), named("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with their place `at`, increasing through each conversation, initial and faults of their own; written.

    Rows are sorted by range of conversation, turn (null first), role and
    digest, and last by row, so a long conversation or a row many times over
    is spread over tasks; rows alike in all of these are the same row.
    """
    blank = F.lit(" ")
    role, text = (F.coalesce(named(c).cast("string"), blank) for c in ("role", "text"))
    rows = rows.select(named("conv_id").cast("long").alias("conv_id"), named("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    bare = F.rtrim("text", F.lit(WHITE))
    last = F.right(bare, F.lit(1))
    initial = F.substring("role", 1, 1)
    own = F.when(bare == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(CUT)
    digest = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "text"), 256)
    rows = rows.select("conv_id", "turn", "role", "text", "row", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), own.alias("fault"), digest.alias("digest"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "row"]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row").withColumn("at", F.monotonically_increasing_id()), "rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, at, initial and fault of each row; a row is a duplicate if an equal one has a lesser place."""
    slim = rows.select("conv_id", "turn", "at", "initial", "fault", "digest")
    first = written(slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1"), "firsts")
    fault = F.when((F.col("fault") != BLANK) & (F.col("at") > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    return written(attached(slim, first, ["digest"], "n").select("conv_id", "turn", "at", "initial", fault.alias("fault")), "faults")


def runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Rows of the batches in runs of an equal value in a column; a run may cross batches."""
    own: list[tuple] = []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if own and row[key] != own[-1][key]:
                yield own
                own = []
            own.append(row)
    if own:
        yield own


def segments(marked: DataFrame) -> DataFrame:
    """A row for each segment: its first place, its costs, string ranks and strings between grammar states, and its adjacent initials."""

    def work(batches):
        out = []
        for rows in runs(batches, 0):
            _, conv_id, head, *_ = rows[0]
            best = summed_up([(r[3], r[4]) for r in rows])
            pairs = [best[q].get(b) for q in STATES for b in STATES]
            order = {s: i for i, s in enumerate(sorted({w[1] for w in pairs if w}))}
            initials = [r[3] for r in rows]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
            out.append((conv_id, head, [w and w[0] for w in pairs], [order[w[1]] if w else 0 for w in pairs], [w and w[1] for w in pairs], initials[0], initials[-1], illegal))
            if len(out) == 256:
                yield list(zip(*out, strict=True))
                out = []
        if out:
            yield list(zip(*out, strict=True))

    # a segment: rows of one conversation among 2**SEGMENT_BITS that follow each other
    seg = F.shiftright("at", SEGMENT_BITS)
    rows = marked.select(F.struct(seg.alias("seg"), "conv_id").alias("key"), "conv_id", "at", "initial", "fault", seg.alias("seg"))
    rows = rows.repartition(partitions(marked.sparkSession), "seg").sortWithinPartitions("seg", "at").select("key", "conv_id", "at", "initial", "fault")
    return written(arrow_stream(rows, work, "conv_id long, head long, costs array<long>, ranks array<int>, strings array<string>, first string, last string, illegal long"), "segments")


def paths(parts: DataFrame) -> DataFrame:
    """conv_id, head, cell (of the chosen states), tail (insertions after the last row), cost and illegal of each segment; the two last are the conversation's, on its first segment."""
    size = len(GRAMMAR)

    def work(batches):
        out = []
        for rows in runs(batches, 0):
            cost, path = folded([r[2] for r in rows], [r[3] for r in rows])
            across = sum(a[5] + b[4] not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
            for i, (r, (q, b)) in enumerate(zip(rows, path, strict=True)):
                tail = closing(b)[1] if i == len(rows) - 1 else ""
                out.append((r[0], r[1], q * size + b, tail, None if i else cost, None if i else across + sum(r[6] for r in rows)))
            if len(out) > 4096:
                yield list(zip(*out, strict=True))
                out = []
        if out:
            yield list(zip(*out, strict=True))

    rows = parts.select("conv_id", "head", "costs", "ranks", "first", "last", "illegal")
    rows = rows.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions("conv_id", "head")
    return arrow_stream(rows, work, "conv_id long, head long, cell int, tail string, cost long, illegal long")


def told(rows: DataFrame, parts: DataFrame, chosen: DataFrame, as_rows: bool) -> DataFrame:
    """Audit and digest of each repaired conversation, or its rows: conv_id, nth, edit, role, text.

    The rows of a conversation pass one task as a stream, since the digest is
    a chain over them; the task holds a batch and the audit.
    """

    def work(batches):
        out, conv, begun = [], None, False
        state = nth = 0
        audit: list[str] = []
        digest = hashlib.sha256()
        labels = ""

        def put(label: str, role: str, text: str):
            nonlocal nth
            if as_rows:
                out.append((conv, nth, label, role, text))
            else:
                digest.update((b"\n" if nth else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            nth += 1

        def insert() -> None:
            nonlocal state
            initial = "a" if state == 2 else "u"
            put("I", NAMES[initial], "")
            state = GRAMMAR[state][initial]

        def end() -> None:
            for _ in labels:
                insert()
            if not as_rows:
                out.append((conv, "".join(audit), digest.hexdigest()))

        for b in batches:
            for conv_id, _, kind, strings, role, text, initial in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if not begun or conv_id != conv:
                    if begun:
                        end()
                    conv, begun, state, nth, labels = conv_id, True, 0, 0, ""
                    audit.clear()
                    digest = hashlib.sha256()
                if kind == 0:
                    labels += strings
                    audit.append(strings)
                    continue
                k = len(labels) - len(labels.lstrip("I"))
                for _ in range(k):
                    insert()
                label, labels = labels[k], labels[k + 1 :]
                if label == "D":
                    continue
                if label == "R":
                    initial = "a" if state == 2 else "u"
                    role = NAMES[initial]
                put(label, role, text)
                state = GRAMMAR[state][initial]
            if len(out) > 4096:
                yield list(zip(*out, strict=True))
                out = []
        if begun:
            end()
        if out:
            yield list(zip(*out, strict=True))

    strings = parts.select("head", "strings").join(chosen, "head").select("conv_id", "head", F.concat(F.get("strings", F.col("cell")), "tail").alias("strings"))
    none = F.lit(None).cast("string")
    both = strings.select("conv_id", F.col("head").alias("at"), F.lit(0).alias("kind"), "strings", none.alias("role"), none.alias("text"), none.alias("initial"))
    both = both.unionByName(rows.select("conv_id", "at", F.lit(1).alias("kind"), none.alias("strings"), "role", "text", "initial"))
    both = both.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return arrow_stream(both, work, "conv_id long, nth long, edit string, role string, text string" if as_rows else "conv_id long, audit string, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, nth, edit, role and text of the rows of the repaired conversations; the edits and odd rows are as in report()."""
    rows = ordered(rows)
    parts = segments(faults(rows))
    return told(rows, parts, written(paths(parts), "paths"), True)


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation.

    rows: conv_id, turn, role, text; conversations: further ids to report,
    with zeros, no audit and the digest of nothing. Rows go by turn, null
    first; rows of one turn by role and digest, so repeated rows are adjacent
    and the later ones are duplicates. Nulls in role or text are one blank,
    rows without conv_id form a conversation. Other columns are not read, an
    empty table gives no rows.
    """
    rows = ordered(rows)
    marked = faults(rows)
    parts = segments(marked)
    chosen = written(paths(parts), "paths")
    count = lambda k: F.sum((F.col("fault") == k).cast("long"))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
    counts = marked.groupBy("conv_id").agg(gaps.alias("gaps"), count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(CUT).alias("truncated"))
    costs = chosen.filter("cost is not null").select("conv_id", "illegal", "cost")
    all_parts = [counts, costs, told(rows, parts, chosen, False)]
    if conversations is not None:
        all_parts.append(conversations.select(named("conv_id").cast("long").alias("conv_id")).distinct())
    # one row of each id and kind: put together by grouping, as null is an id too
    together = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), all_parts)
    zero: dict[str, Column] = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), F.lit(0).cast("long"))
    zero |= {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return together.groupBy("conv_id").agg(*[F.coalesce(F.first(c, ignorenulls=True), z).alias(c) for c, z in zero.items()])
