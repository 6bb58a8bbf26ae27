"""Personal data: base patterns, and further candidates judged by boosted trees; DataFrame functions only.

Generators of high recall propose spans that the base patterns leave out:
phone-like and identity-like numbers, spelled-out addresses, account numbers
and keys. Boosted trees over format and context features score them, and a
threshold calibrated on held-out examples decides. The trees are trained on
the driver, on `EXAMPLES` made-up examples from a fixed seed, and run as SQL
expressions.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_text, named, without

#: The kinds in their order. \G and the looks behind only spare the engine starts inside a run that cannot match, and
#: possessive quantifiers only spare it stack; the matches are those of the plain patterns.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Between the labels of a spelled-out domain, of which the last has two characters at least.
DOT = r"(?: ?(?i:\.|\(dot\)|\[dot\]|\{dot\}) ?)"
#: Generators: kind, pattern. Keys and the parts of addresses have no greatest length; the trees see the length.
CANDIDATES = {
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9][0-9 ()./-]{6,22}[0-9](?![0-9A-Za-z])",
    "address": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?i:\(at\)|\[at\]|\{{at\}}) ?[A-Za-z0-9-]++(?:{DOT}(?:[A-Za-z0-9-]{{2,}}+|[A-Za-z0-9-](?={DOT}[A-Za-z0-9-]))){{1,126}}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
KINDS = (*BASE, *CANDIDATES)
#: Parameters: examples, trees, depth, rate, seed, characters of context, and the precision that the threshold must reach.
EXAMPLES, TREES, DEPTH, RATE, SEED, CONTEXT, PRECISION = 4000, 24, 3, 0.3, 7, 24, 0.99
#: Words before a span that tell what it is.
TELLS = r"(?i)(?:tel|phone|call|mobile|fax|contact|card|visa|account|acct|iban|ssn|social|passport|mail|reach|write|secret|token|passw\w*|key|auth\w*|bearer)\W{0,6}(?:\w{1,6}\W{1,3})?$"

#: Words before a number that tell that it is none of a person.
OTHERS = r"(?i)(?:number|numbers|nr|no|order|part|parts|item|model|version|page|pages|isbn|issn|sku|ref|reference|invoice|serial|lot|batch|date|dated|year|years|from|since|total|count|section|chapter|room|build|commit|sha\w*|md5|hash|checksum|digest|id)\W{0,4}$"

#: Features of a span m with the text before it.
FEATURES = {
    "digits": (r"[^0-9]", "count"),
    "letters": (r"[^A-Za-z]", "count"),
    "upper": (r"[^A-Z]", "count"),
    "breaks": (r"[^ ()./-]", "count"),
    "slashes": (r"[^/.]", "count"),
    "phone_form": (r"^(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$", "match"),
    "identity_form": r"^[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}$",
    "date_form": r"^(?:[0-9]{1,2}[/.-][0-9]{1,2}[/.-](?:[0-9]{2}|[0-9]{4})|(?:1[0-9]|20)[0-9]{2}[/.-][0-9]{1,2}[/.-][0-9]{1,2})(?: .*)?$",
    "years": r"^(?:1[5-9]|20)[0-9]{2} ?[-/] ?(?:1[5-9]|20)[0-9]{2}$",
    "at_sign": r"(?i:\(at\)|\[at\]|\{at\})",
    "account_form": r"^[A-Z]{2}[0-9]{2}[ A-Z0-9]{9,}$",
    "hex": r"^[0-9a-f]{24,}$",
    "mixed": r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z].*[A-Za-z]).{20,}$",
}
FEATURES = {k: v if isinstance(v, tuple) else (v, "match") for k, v in FEATURES.items()}
NAMES = (*FEATURES, "length", "tell", "other")


#: Spans that are folded at once: appending copies an array, so long ones are made of blocks.
BLOCK = 256
SPAN = "array<struct<kind:string,start:int,end:int,m:string,before:string>>"


def bound(x: Column, f) -> Column:
    """f(x) with x evaluated once, as expressions in the functions of arrays are evaluated at each use."""
    return F.element_at(F.transform(F.array(x), f), 1)


def scan(items: Column, zero: Column, step, kind: str) -> Column:
    """The outputs of a fold over an array, one for each item: step(state, item) gives (state, output) of the types of zero and kind.

    Blocks of BLOCK items are folded one by one, so work grows with the
    number of items and not with its square, save for a 256 * 256th of it.
    """
    none = F.array().cast(f"array<{kind}>")

    def inner(acc: Column, x: Column) -> Column:
        state, out = step(acc["s"], x)
        return F.struct(state.alias("s"), F.array_append(acc["o"], out).alias("o"))

    def outer(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["s"].alias("s"), none.alias("o")), inner)
        return bound(done, lambda d: F.struct(d["s"].alias("s"), F.array_append(acc["o"], d["o"]).alias("o")))

    def folded(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda k: F.slice(x, k * BLOCK + 1, BLOCK))
        out = F.aggregate(blocks, F.struct(zero.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("o")), outer, lambda acc: F.flatten(acc["o"]))
        return F.when(F.size(x) > 0, out).otherwise(none)

    return bound(items, folded)


def spans(text: Column, pattern: str, kind: str, possible: Column) -> Column:
    """Array of (kind, start, end, m, before) of the leftmost matches, in code points; before: the CONTEXT characters before the match."""
    # gaps and matches alternate, so their lengths give the places
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = bound(F.struct(gaps.alias("g"), found.alias("m")), lambda z: F.zip_with(F.slice(z["g"], 1, F.size(z["m"])), z["m"], lambda g, m: F.struct(g.alias("g"), m.alias("m"))))
    last = lambda x: F.substring(x, -CONTEXT, CONTEXT)

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        start = state["at"] + F.char_length(x["g"])
        end = start + F.char_length(x["m"])
        before = last(F.concat(state["tail"], last(x["g"])))
        out = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("m"), before.alias("before"))
        return F.struct(end.alias("at"), last(F.concat(before, last(x["m"]))).alias("tail")), out

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
    return F.when(possible, scan(pairs, zero, step, SPAN[6:-1])).otherwise(F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def base_ok(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def valid(kind: str):
    return lambda s: base_ok(kind, s["m"])


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def feature_columns(m: Column, before: Column) -> dict[str, Column]:
    out = {k: F.char_length(F.regexp_replace(m, p, "")) if how == "count" else m.rlike(p).cast("int") for k, (p, how) in FEATURES.items()}
    return out | {"length": F.char_length(m), "tell": before.rlike(TELLS).cast("int"), "other": before.rlike(OTHERS).cast("int")}


def feature_row(m: str, before: str) -> list[int]:
    import regex

    out = [len(regex.sub(p, "", m)) if how == "count" else int(bool(regex.search(p, m))) for p, how in FEATURES.values()]
    return [*out, len(m), int(bool(regex.search(TELLS, before))), int(bool(regex.search(OTHERS, before)))]


def examples(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Made-up candidates and whether they are personal data."""
    r = np.random.default_rng(seed)
    d = lambda k: "".join(r.choice(list("0123456789"), k))
    w = lambda k, a="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(list(a), k))
    pick = lambda *x: x[r.integers(len(x))]
    plain = lambda: pick("", "the ", "about ", "in ", "see ", "of the ", "and ", "with ")
    tell = lambda: pick("call ", "the call number ", "phone ", "card ", "account ", "contact: ", "key ", "reach ", "mail ", "social ")
    other = lambda: pick("parts ", "order no. ", "page ", "version ", "total ", "item ", "model ", "ISBN ", "sku: ", "invoice ", "serial number ", "ref ", "commit ", "sha256: ", "dated ", "since ")
    aside = lambda: pick(plain, plain, tell, other)()
    x, y = [], []
    for _ in range(n):
        yes = bool(r.integers(2))
        kind = r.integers(5 if yes else 7)
        if yes:
            m, before = [
                (lambda: (pick(f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)} {d(3)} {d(4)}"), pick(plain(), "call ", "tel: ", "phone ", "mobile: "))),
                (lambda: (pick(f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}"), pick("ssn ", "SSN: ", "social security ", plain()))),
                (lambda: (f"{w(r.integers(3, 9))}{pick('', '.' + w(4))}{pick('(at)', ' (at) ', ' [at] ', '[at]')}{w(6)}{pick('.', ' (dot) ', ' [dot] ')}{pick('com', 'org', 'net')}", pick(plain(), "mail ", "write to "))),
                (lambda: (f"{w(2, 'ABCDEFGHIKLMNOPRST')}{d(2)} {d(4)} {d(4)} {d(4)} {d(pick(2, 4))}".replace(" ", pick(" ", "")), pick("iban ", "IBAN: ", "account ", plain()))),
                (lambda: (w(r.integers(28, 64), "0123456789abcdef") if r.integers(2) else w(r.integers(24, 48), "abcdefghjkABCDEFGH0123456789"), pick("token = ", "token: ", "secret ", "key=", "password ", "api_key: "))),
            ][kind]()
        else:
            m, before = [
                (lambda: (pick(f"{r.integers(1, 29)}/{r.integers(1, 13)}/{r.integers(1950, 2030)}", f"{r.integers(1950, 2030)}-{d(2)}-{d(2)}", f"{r.integers(1500, 2030)}-{r.integers(1500, 2030)}"), aside())),
                (lambda: (pick(d(8), d(9), d(10), d(11), d(12), d(16), d(18)), aside())),
                (lambda: (pick(f"{d(3)}.{d(3)}.{d(3)}", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{d(4)}.{d(4)}", f"{d(1)}.{d(2)}.{d(3)}.{d(4)}.{d(2)}", f"{d(5)}/{d(5)}", f"{d(6)}-{d(3)}"), aside())),
                (lambda: (w(r.integers(20, 60)), aside())),
                (lambda: (pick("-", "_").join(w(r.integers(3, 9)) for _ in range(r.integers(4, 8))), aside())),
                # numbers in the form of a person's, and digests, of which the words before say that they are something else
                (lambda: (pick(f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}"), other())),
                (lambda: (w(pick(32, 40, 64), "0123456789abcdef"), pick(plain, other)())),
            ][kind]()
        x.append(feature_row(m, before))
        y.append(yes)
    return np.array(x, float), np.array(y, float)


def grow(x: np.ndarray, residual: np.ndarray, weight: np.ndarray, depth: int):
    """A regression tree as nested tuples (feature, cut, low, high) or a leaf value."""
    leaf = float(residual.sum() / (weight.sum() + 1.0))
    if not depth or len(x) < 20:
        return leaf
    gain, found = 1e-6, None
    whole = residual.sum() ** 2 / (weight.sum() + 1.0)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[:-1] + values[1:]) / 2 if len(values) < 40 else np.quantile(x[:, j], np.linspace(0.03, 0.97, 32)):
            low = x[:, j] <= cut
            g, h = residual[low].sum(), weight[low].sum()
            now = g * g / (h + 1.0) + (residual.sum() - g) ** 2 / (weight.sum() - h + 1.0) - whole
            if now > gain:
                gain, found = now, (j, float(cut))
    if found is None:
        return leaf
    j, cut = found
    low = x[:, j] <= cut
    return j, cut, grow(x[low], residual[low], weight[low], depth - 1), grow(x[~low], residual[~low], weight[~low], depth - 1)


def tree_value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, cut, low, high = tree
    return np.where(x[:, j] <= cut, tree_value(low, x), tree_value(high, x))


@functools.lru_cache(1)
def model() -> tuple[list, float]:
    """Trees, and the least raw score at which held-out precision reaches PRECISION."""
    x, y = examples(EXAMPLES, SEED)
    half = 3 * len(x) // 4
    trees, raw = [], np.zeros(len(x))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(x[:half], (y - p)[:half], (p * (1 - p))[:half], DEPTH)
        trees.append(tree)
        raw += RATE * tree_value(tree, x)
    held, good = raw[half:], y[half:] > 0
    order = np.argsort(-held, kind="stable")
    precision = np.cumsum(good[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(precision >= PRECISION)
    return trees, max(0.0, float(held[order[enough[-1]]])) if len(enough) else float("inf")


def tree_column(tree, columns: list[Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    j, cut, low, high = tree
    return F.when(columns[j] <= cut, tree_column(low, columns)).otherwise(tree_column(high, columns))


def chosen(span: Column) -> Column:
    """Whether the trees select a candidate span. Features are computed once, in an array."""
    trees, least = model()
    features = feature_columns(span["m"], span["before"])
    one = F.transform(F.array(F.array(*[features[k].cast("double") for k in NAMES])), lambda f: sum((tree_column(t, [F.element_at(f, k + 1) for k in range(len(NAMES))]) * RATE for t in trees), F.lit(0.0)) >= least)
    return F.element_at(one, 1)


def apart(base: Column, more: Column) -> Column:
    """The spans of more that meet none of base, by two folds over the starts of both: one up, one down."""
    flagged = lambda x, is_base: F.transform(x, lambda s: F.struct(s["start"].alias("a"), F.lit(is_base).alias("b"), s["end"].alias("z"), s.alias("s")))
    kind = f"struct<a:int,b:boolean,z:int,s:{SPAN[6:-1]}>"
    kept = lambda x, ok: F.when(ok | x["b"], x).otherwise(F.lit(None).cast(kind))
    up = F.array_sort(F.concat(flagged(base, True), flagged(more, False)))
    # the furthest end of the base spans that start before or at a span, then the nearest start of those that start at or after it
    up = scan(up, F.lit(0), lambda end, x: (F.when(x["b"], F.greatest(end, x["z"])).otherwise(end), kept(x, end <= x["a"])), kind)
    down = F.reverse(F.filter(up, lambda x: x.isNotNull()))
    down = scan(down, F.lit((1 << 31) - 1), lambda start, x: (F.when(x["b"], x["a"]).otherwise(start), kept(x, start >= x["z"])), kind)
    return F.transform(F.reverse(F.filter(down, lambda x: x.isNotNull() & ~x["b"])), lambda x: x["s"])


def with_spans(df: DataFrame, text_col: str, base: str = "_base", more: str = "_more") -> DataFrame:
    """df with base spans and chosen further spans; a further span that meets a base one, or a better one before it, goes."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    digit = text.rlike("[0-9]")
    parts = []
    for kind, (pattern, need) in BASE.items():
        possible = (text.contains(need) if kind == "email" else digit & text.contains(need)) if need else digit
        parts.append(F.filter(spans(text, pattern, kind, possible), valid(kind)))
    df = df.withColumn(base, F.concat(*parts))
    possible = {"number": digit, "address": text.rlike(r"(?i)[(\[{]at[)\]}]"), "account": digit, "key": text.rlike("[A-Za-z0-9_-]{20}")}
    df = df.withColumn(more, F.concat(*[spans(text, pattern, kind, possible[kind]) for kind, pattern in CANDIDATES.items()]))
    df = df.withColumn(more, F.when((F.size(more) > 0) & (F.size(base) > 0), apart(F.col(base), F.col(more))).otherwise(F.col(more)))
    df = df.withColumn(more, F.when(F.size(more) > 0, F.filter(F.col(more), chosen)).otherwise(F.col(more)))
    kind = f"struct<start:int,e:int,s:{SPAN[6:-1]}>"
    order = F.array_sort(F.transform(more, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("e"), s.alias("s"))))
    free = scan(order, F.lit(0), lambda end, x: (F.when(x["start"] >= end, -x["e"]).otherwise(end), F.when(x["start"] >= end, x).otherwise(F.lit(None).cast(kind))), kind)
    disjoint = F.transform(F.filter(free, lambda x: x.isNotNull()), lambda x: x["s"])
    return df.withColumn(more, F.when(F.size(more) > 1, disjoint).otherwise(F.col(more)))


def listed(found: Column) -> Column:
    """kind:start:end, comma-joined; the spans of a kind are in order already."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_kind(found: Column) -> Column:
    return F.concat(*[F.filter(found, of_kind(k)) for k in KINDS])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    A null or empty text has no spans, so the hash is that of the empty
    string. Ends are exclusive and in code points. Repeated rows stay
    repeated; an empty table gives an empty table; other columns are not read.
    """
    rows = with_spans(doc_text(df, id_col, text_col), "text")
    counts = [F.size(F.filter("_base", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(by_kind(F.concat("_base", "_more"))).alias("spans"))


def redact(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """df with every found span replaced by its kind in brackets, such as [EMAIL]; overlapping spans become one.

    chars_col, if df has it, becomes the new number of code points. Null texts
    stay null; all rows and other columns stay.
    """
    tmp = "_pii"
    while any(c.lower().startswith(tmp) for c in df.columns):
        tmp += "_"
    found, more, last = f"{tmp}b", f"{tmp}m", f"{tmp}e"
    rows = with_spans(df, text_col, found, more)
    order = F.array_sort(F.transform(F.concat(found, more), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # each span from where the ones before end; those that begin inside go on without a mark of their own
    piece_kind = "struct<a:int,b:int,mark:string>"
    marked = lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
    step = lambda at, s: (F.greatest(at, s["end"]), F.struct(at.alias("a"), F.greatest(at, s["start"]).alias("b"), F.when((s["start"] >= at), marked(s)).otherwise(F.lit("")).alias("mark")))
    rows = rows.withColumn(last, F.coalesce(F.array_max(F.transform(order, lambda s: s["end"])), F.lit(0)))
    rows = rows.withColumn(more, F.when(F.size(found) + F.size(more) > 0, scan(order, F.lit(0), step, piece_kind)).otherwise(F.array().cast(f"array<{piece_kind}>")))
    text = named(text_col)

    def put(block: Column) -> Column:
        """The text from the first piece of the block to its last, cut from that stretch alone, as a cut reads from the start."""
        first = F.element_at(block, 1)["a"]
        stretch = F.substring(text, first + 1, F.element_at(block, -1)["b"] - first)
        return bound(F.struct(first.alias("at"), stretch.alias("t")), lambda z: F.array_join(F.transform(block, lambda p: F.concat(F.substring(z["t"], p["a"] - z["at"] + 1, p["b"] - p["a"]), p["mark"])), ""))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(more) - 1) / BLOCK).cast("int")), lambda k: F.slice(F.col(more), k * BLOCK + 1, BLOCK))
    clean = F.concat(F.array_join(F.transform(blocks, put), ""), F.substring(text, F.col(last) + 1, F.char_length(text)))
    k = F.size(more)
    rows = rows.withColumn(text_col, F.when((k > 0) & text.isNotNull(), clean).otherwise(text))
    if chars_col and chars_col in df.columns:
        rows = rows.withColumn(chars_col, F.when(k > 0, F.char_length(named(text_col)).cast(df.schema[chars_col].dataType)).otherwise(named(chars_col)))
    return rows.select(*[named(c) for c in df.columns])
