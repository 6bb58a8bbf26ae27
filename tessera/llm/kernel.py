"""Vectorised text kernels over Arrow string columns.

Everything here works on the UTF-8 bytes of a whole column chunk at once:
word boundaries, rolling hashes, shingle sets and byte-level pre-tokens come
out of a few numpy passes instead of a Python loop over words. Documents are
cut into chunks of about CHUNK bytes, so memory is bounded by the chunk (or by
the one longest document).
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U64 = np.uint64
#: Multipliers of the splitmix64 finaliser.
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: The white space of the word rule, x20 and x09-x0D.
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x *= MIX_A
    x ^= x >> U64(27)
    x *= MIX_B
    x ^= x >> U64(31)
    return x


@functools.lru_cache(1)
def byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, the same after A-Z went to lower case, and which bytes are white space."""
    table = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
    lower = table.copy()
    lower[65:91] = table[97:123]
    white = np.zeros(256, bool)
    white[list(WHITE)] = True
    return table, lower, white


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i < n at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1024)
        inverse = pow(BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, b, U64)]), dtype=U64) for b in (BASE, inverse)]
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """p with p[j] - p[i] = BASE**i * hash of data[i:j]."""
    up, _ = powers(len(data) + 1)
    p = np.zeros(len(data) + 1, U64)
    values = byte_tables()[lower][data]
    values *= up[: len(data)]
    np.cumsum(values, out=p[1:])
    return p


def span_hashes(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(p))
    return mix((p[ends] - p[starts]) * down[starts] + (ends - starts).astype(U64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, offsets from 0, bytes) of parts of about CHUNK bytes."""
    offsets, data = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        yield i, j, offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]]
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word; a word never crosses documents."""
    inside = ~byte_tables()[2][data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = heads[heads > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def row_sums(row: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, values, n).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each document as 64-bit hashes: bounds and values sorted within a document.

    Words are lower-cased in A-Z. A document of fewer words has its whole word
    sequence as one shingle; one without words has none.
    """
    n = len(offsets) - 1
    starts, ends, doc = words(data, offsets)
    h = span_hashes(prefix_hashes(data, lower=True), starts, ends)
    count = row_sums(doc, n)
    factor = mix(np.arange(11, 11 + size, dtype=U64) * U64(BASE)) | U64(1)
    if len(h) >= size:
        full = len(h) - size + 1
        s = np.zeros(full, U64)
        for j in range(size):
            s += mix(h[j : j + full] + U64(j + 1)) * factor[j]
        ok = doc[:full] == doc[size - 1 :]
        s, s_doc = mix(s[ok]), doc[:full][ok]
    else:
        s, s_doc = np.zeros(0, U64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])[short]
        total = np.zeros(len(short), U64)
        for j in range(size - 1):
            more = count[short] > j
            total[more] += mix(h[first[more] + j] + U64(j + 1)) * factor[j]
        total = mix(total + count[short].astype(U64) * U64(MIX_A))
        where = np.searchsorted(s_doc, short)
        s, s_doc = np.insert(s, where, total), np.insert(s_doc, where, short)
    bounds = np.searchsorted(s_doc, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            s[a:b].sort()
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (s_doc[1:] != s_doc[:-1])
    return np.concatenate([[0], np.cumsum(new)])[bounds], s[new]


@functools.lru_cache(1)
def char_classes() -> np.ndarray:
    """Per code point: 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "." for c in range(0x110000))
    out = np.full(0x110000, 3, np.uint8)
    for value, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (0, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[m.start() : m.end()] = value
    return out


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position and code point of each character of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    if len(at) == len(data):
        return at, lead.astype(np.int32)
    point = lead.astype(np.int32)
    for low, n, keep in ((0xC0, 1, 0x1F), (0xE0, 2, 0x0F), (0xF0, 3, 0x07)):
        some = np.flatnonzero(lead >= low)
        if not len(some):
            break
        value = (lead[some] & keep).astype(np.int32)
        for j in range(1, n + 1):
            value = (value << 6) | (data[np.minimum(at[some] + j, len(data) - 1)] & 0x3F)
        point[some] = value
    return at, np.minimum(point, 0x10FFFF)


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte starts of the pre-tokens; they tile every document.

    The split is the byte-level one: contractions, then an optional blank with
    letters, numbers or other signs, then white space, whose last character
    goes to what follows if it is a blank.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    at, point = code_points(data)
    kind = char_classes()[point]
    n = len(at)
    head = np.zeros(n + 1, bool)
    head[np.searchsorted(at, offsets[:-1])] = True
    head[n] = True
    start = head[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~head[1:n])
    start[after] = True
    start[after[point[after] == 0x20] + 1] = False
    quote = np.flatnonzero((point[:-1] == 0x27) & start[:-1] & ~head[1:n] & (kind[1:] == 1))
    if len(quote):
        one = point[quote + 1]
        two = np.where((quote + 2 < n) & ~head[np.minimum(quote + 2, n)], point[np.minimum(quote + 2, n - 1)], 0)
        c = lambda x: ord(x)
        length = np.where(np.isin(one, [c("s"), c("t"), c("m"), c("d")]), 2, 0)
        length = np.where(((one == c("r")) | (one == c("v"))) & (two == c("e")) | (one == c("l")) & (two == c("l")), 3, length)
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        then = quote + length
        start[then[then < n]] = True
    return at[start]


class Pieces:
    """Token ids of pre-tokens, asked of the tokenizers library once per distinct pre-token.

    ids() and counts() give what the library gives for whole texts without
    added begin or end tokens. Strings of special tokens inside a text are
    special tokens, as is the library's default. The memory of known
    pre-tokens is emptied beyond `keep` entries; that only costs time. With
    with_ids=False only numbers of pieces are kept, for counts() alone.
    """

    def __init__(self, path: str, with_ids: bool = True, keep: int = 1_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib, self.with_ids, self.keep = Tokenizer.from_file(path), with_ids, keep
        self.special = {t.content.encode(): i for i, t in self.lib.get_added_tokens_decoder().items()}
        self.clear()

    def clear(self) -> None:
        self.keys, self.entry = np.zeros(0, U64), np.zeros(0, np.int64)  # hashes of the known pre-tokens in order, and their entries
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The new entries of ids, whose lengths are given."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        n = len(self.first)
        self.first = np.concatenate([self.first, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.used += len(ids)
        return np.arange(n, n + len(lengths))

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """keys: in order and not known."""
        encoded = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.zeros(0, np.uint32)
        if self.with_ids:
            ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in encoded), np.uint32, int(lengths.sum()))
        entry = self._add(lengths, ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.entry = np.insert(self.keys, at, keys), np.insert(self.entry, at, entry)

    def _codes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and entry of each pre-token of a chunk."""
        import pandas as pd

        starts = pre_tokens(data, offsets)
        if not len(starts):
            return starts, starts
        ends = np.append(starts[1:], len(data))
        code, distinct = pd.factorize(span_hashes(prefix_hashes(data), starts, ends))
        if len(self.first) + len(distinct) > self.keep:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != distinct[inside]
        if new.any():
            where = np.zeros(len(distinct), np.int64)
            where[code[::-1]] = np.arange(len(code))[::-1]
            fresh = np.flatnonzero(new)
            fresh = fresh[np.argsort(distinct[fresh])]
            raw, some = data.tobytes(), where[fresh]
            self._learn(distinct[fresh], [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
            at = np.searchsorted(self.keys, distinct)
        return np.searchsorted(offsets, starts, "right") - 1, self.entry[at][code]

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Offsets of the parts between special strings, the document of each part, and the specials (part before, id)."""
        raw = data.tobytes()
        if not any(s in raw for s in self.special):
            return offsets, np.arange(len(offsets) - 1), []
        import re

        pattern = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        bounds, doc, special = [0], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            at = a
            for m in pattern.finditer(raw, a, b):
                for end, is_special in ((m.start(), False), (m.end(), True)):
                    bounds.append(end)
                    doc.append(i)
                    if is_special:
                        special.append([len(doc) - 1, self.special[m.group()]])
                at = m.end()
            bounds.append(b)
            doc.append(i)
        return np.array(bounds, np.int64), np.array(doc), special

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        bounds, doc, special = self._parts(data, offsets)
        part, entry = self._codes(data, bounds)
        length = self.length[entry]
        per_part = np.bincount(part, length, len(doc)) if len(part) else np.zeros(len(doc))
        per_part[[p for p, _ in special]] = 1
        return row_sums(doc, len(offsets) - 1, per_part)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the documents in the ids, and the ids."""
        bounds, doc, special = self._parts(data, offsets)
        part, entry = self._codes(data, bounds)
        if special:
            inside = {p: i for p, i in special}
            keep = ~np.isin(part, list(inside))
            part, entry = part[keep], entry[keep]
            where = np.searchsorted(part, list(inside))
            extra = self._add(np.ones(len(inside), np.int64), np.array(list(inside.values()), np.uint32))
            part, entry = np.insert(part, where, list(inside)), np.insert(entry, where, extra)
        if not len(entry):
            return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint32)
        length, first = self.length[entry], self.first[entry]
        done = np.cumsum(length)
        ids = self.pool[np.repeat(first - (done - length), length) + np.arange(done[-1])]
        return np.concatenate([[0], np.cumsum(row_sums(doc[part], len(offsets) - 1, length))]), ids


@functools.lru_cache(2)
def pieces(path: str, with_ids: bool = True) -> Pieces:
    return Pieces(path, with_ids)
