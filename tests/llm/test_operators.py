"""The operators on odd rows, against brute force, and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import common, decontamination, extraction, jaccard_join, kernel, packing, pii, quality, records, sharding, suffix_dedup, token_counts
from tessera.llm import components as components_module
from tessera.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0d]+")
PASSAGE = " ".join(f"passage{i} word" for i in range(30))
LONG = " ".join(f"w{i * i % 977} v{i % 101}" for i in range(3000))
TEXTS = [
    None, "", "   ", "one", "one", "A b c d", "a B C D", LONG, LONG, LONG + " tail", LONG.replace("w1 ", "q1 ", 1), PASSAGE, "intro " + PASSAGE + " outro", "ab" * 300, "é" * 150, "x" * 199,
    "tab\tand\x0bmore\nlines\nlines\n\nlines", "don't <|endoftext|> we'll  stop　here 😀", "mail a.b@c.de or 10.0.0.1, +1 (743) 555-3824 and 4316 5226 7852 5456", "the same three words " * 40, "### $$$ " * 60,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"s{i}", len(t or "")) for i, t in enumerate(TEXTS)] + [(None, "no id", "en", "s", 5), (7, LONG, "en", "s", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumnsRenamed({"source": "N_words"})


def empty(docs):
    return docs.filter("1 = 0")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def components(sets):
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: top(i) for i in sets}


def test_sharding(docs):
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {r.text_crc32 for r in rows if r.doc_id == 3} == {zlib.crc32(b"one")}
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 0} == {(1, 0)}
    assert sharding.shard(empty(docs)).count() == 0


def test_sharding_keeps_groups_that_fit_whole(spark):
    """Equal texts share a shard though they exceed a cell many times; only the group of a third of all rows is split."""
    df = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot text, which is long enough' WHEN id % 3 = 1 THEN concat('group ', id % 60, repeat(' x', 20)) ELSE concat('own ', id, repeat(' y', 20)) END AS text")
    rows = sharding.shard(df, 8).join(df, "doc_id").collect()
    shards, sizes, counts = {}, Counter(), Counter()
    for r in rows:
        shards.setdefault(r.text, set()).add(r.shard)
        sizes[r.shard] += r.size
        counts[r.shard] += 1
    assert all(len(s) == 1 for t, s in shards.items() if not t.startswith("hot"))
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8
    for k in counts:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))


def test_sharding_balance_and_hot_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot text' ELSE repeat(cast(id AS string), cast(1 + id % 50 AS int)) END AS text")
    sizes = Counter()
    for r in sharding.shard(df, 8).collect():
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_extraction(spark):
    html = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href="/">menu</a></nav><!-- c --><div class="ad">buy</div><article><h1>Head &amp; more</h1><p>One,  two\n three.<p><b>Four<br>five</b></p></article><div id="comments"><p>reader</p></div><form>f</form><footer>foot &copy;</footer>'
    rows = spark.createDataFrame([(1, "u", html), (2, None, None), (3, "v", "<p>a<p>b"), (4, "v", "<nav>x</nav>"), (5, "v", "<" * 9)], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in extraction.extract(rows).collect()}
    assert got[1] == ("Head & more One, two three. Four five", 37)
    assert got[2] == got[4] == ("", 0) and got[3] == ("a b", 3)
    assert extraction.extract(rows.filter("1 = 0")).count() == 0


@pytest.mark.parametrize("tag", ['<p class="a"">', "<p title=it's>", '<p "a>', "<p it's a=1>", '<p a==">', '<p a="x > y" b>', "<p a = 'x > \"y'>", '<p a="b"c="d>e">', "<p a=>", '<p = ="x>y">', "<p a=/x'/>"])
def test_extraction_reads_quotes_as_browsers(tag):
    assert extraction.main_text(f'<article>{tag}Hello world, one.</p><p class="b">More text two.</p><p>It\'s three</p></article>') == "Hello world, one. More text two. It's three"


def test_extraction_keeps_first_of_attributes_with_stray_quotes():
    assert extraction.Node("p", None, ' "x class="a"" CLASS=b id=it\'s hidden role').marks() == ("a it's", "", True)


STORY = "".join(f"<p>Paragraph {k} of the story, with enough words, commas, and sense to count as text.</p>" for k in range(4))
STORY_TEXT = " ".join(re.findall("<p>(.*?)</p>", STORY))


@pytest.mark.parametrize(
    "wrapper",
    ['<div class="content has-sidebar">', '<div id="page" class="no-sidebar">', '<div class="sidebar">', '<div class="search">', '<div class="header-fixed side-by-side">', '<div class="menu"><article>', '<div class="widget"><main class="share">', '<section class="sidebar-left"><div class="notice">'],
)
def test_extraction_keeps_text_in_wrappers(wrapper):
    aside = '<div class="sidebar"><p>Other things, not of the story, in a column beside it.</p></div><div class="related"><article><p>Another story, which is short, and only a card.</p></article></div>'
    assert extraction.main_text(f"<body>{wrapper}{STORY}</div></body>") == STORY_TEXT
    assert extraction.main_text(f"<body>{wrapper}<article>{STORY}{aside}</article></body>") == STORY_TEXT


@pytest.mark.parametrize("name", ["sidebar", "site-header", "cookie-banner", "comments", "ad-728x90", "main_nav", "share"])
def test_extraction_drops_by_name(name):
    assert extraction.main_text(f'<body><div>{STORY}<div class="{name}"><p>Not a part of the story, whatever it says, and dropped.</p></div></div></body>') == STORY_TEXT


def test_extraction_keeps_short_article_and_drops_cards():
    assert extraction.main_text('<body><div class="search"><article><p>One.</p></article></div></body>') == "One."
    cards = '<div class="related"><article><p>Another story, which is short, and only a card.</p></article></div>'
    assert extraction.main_text(f"<body><div>{STORY}{cards}</div></body>") == STORY_TEXT


def test_extraction_reads_attributes_by_name():
    assert extraction.main_text(f'<body><div class="overflow hidden md">{STORY}</div><div title="a" hidden><p>Not to be seen, as the element is hidden from view.</p></div></body>') == STORY_TEXT


def test_extraction_keeps_text_of_a_page_in_one_form():
    form = '<form><p>Leave your name, please, and your address for the news.</p><label>Name</label><input><button>Go</button></form>'
    assert extraction.main_text(f'<body><form id="aspnet" action="/">{STORY}<button>Send</button></form></body>') == STORY_TEXT
    assert extraction.main_text(f"<body><div>{STORY}{form}</div></body>") == STORY_TEXT


P = [f"Sentence number {k} of a text, which has some words, commas, and no markup." for k in range(5)]
NOTICES = '<nav>Home <a href="/">Start</a></nav><div class="cookie-banner">We use cookies, as everybody does, to know who reads this.</div>'


@pytest.mark.parametrize(
    "body",
    [
        "<div><p>{0}</p></div><div><p>{1}</p></div><div><p>{2}</p></div><div><p>{3}</p></div><div><p>{4}</p></div>",
        "<div><p>{0}</p><p>{1}</p><p>{2}</p></div><div><p>{3}</p></div><div><p>{4}</p></div>",
        "<div><p>{0}</p></div><div><p>{1}</p></div><div><p>{2}</p><p>{3}</p><p>{4}</p></div>",
        "{0}<div><p>{1}</p><p>{2}</p><p>{3}</p></div>{4}",
        "<div><div><p>{0}</p></div></div><div><div><p>{1}</p><p>{2}</p></div></div><div><div><p>{3}</p></div><div>{4}</div></div>",
        "<div>{0}</div><div>{1}</div><div>{2}</div><div>{3}</div><div>{4}</div>",
        "<div>{0}<br>{1}</div><div>{2}<br><br>{3}</div>{4}",
        "<section><h2>{0}</h2><p>{1}</p></section><section><p>{2}</p></section><section><p>{3}</p><p>{4}</p></section>",
        "<table><tr><td><p>{0}</p><p>{1}</p></td></tr><tr><td>{2}</td></tr></table><div>{3}</div><div>{4}</div>",
        "<ul><li>{0}</li><li>{1}</li></ul><div><p>{2}</p><p>{3}</p></div><p>{4}</p>",
        "<div><p>{0}</p><blockquote>{1}</blockquote></div><div><ol><li>{2}</li><li>{3}</li></ol></div><pre>{4}</pre>",
        '<div id="a"><div><div><p>{0}</p></div></div></div><div id="b"><p>{1}</p></div><div id="c"><div><p>{2}</p><p>{3}</p></div></div><div>{4}</div>',
        "<b>{0}</b> {1}<div><p>{2}</p></div><i>{3}</i><div>{4}</div>",
        "<center>{0}</center><div><div>{1}</div>{2}</div><center><p>{3}</p></center><p>{4}</p>",
        "<div><p>{0}</p></div><hr><div><p>{1}</p></div><hr><div><p>{2}</p><p>{3}</p></div><hr>{4}",
        "<div><span>{0}</span></div><div><span>{1}</span> <em>{2}</em></div><div><p>{3}</p></div><div><p>{4}</p></div>",
        "<main><div><p>{0}</p></div><div><p>{1}</p></div>{2}<div><div><p>{3}</p></div></div><p>{4}</p></main>",
        "<article><div><p>{0}</p></div><div><p>{1}</p></div>{2}<div><div><p>{3}</p></div></div><p>{4}</p></article>",
        "<dl><dt>{0}</dt><dd>{1}</dd></dl><div><p>{2}</p><p>{3}</p></div><div>{4}</div>",
        "<div><p>{0}<p>{1}</div><div><p>{2}<p>{3}</div><div><p>{4}",
    ],
)
def test_extraction_keeps_text_of_pages_of_any_form(body):
    """All text of pages with and without an article, in page order, and none of the menus and notices."""
    page = "<html><body>" + NOTICES + body.format(*P) + "<footer>Imprint, terms and so on</footer></body></html>"
    assert extraction.main_text(page) == " ".join(P)


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "text, and more text than a block must have", "<span>" * 20_000 + "<hr></b>" * 20_000, "<div><p>one, two, three and four, five and six" * 20_000, "<li>" * 20_000 + "<td>" * 20_000])
def test_extraction_work_grows_with_the_page(page):
    import time

    began = time.time()
    extraction.main_text(page)
    assert time.time() - began < 10


def test_components_take_few_rounds(spark, monkeypatch):
    """A path in chance order, a star, a clique and odd edges; rounds do not grow with the path."""
    rnd = np.random.default_rng(4)
    path = rnd.permutation(1000).tolist()
    edges = [*zip(path, path[1:], strict=False), *[(5000, 2000 + k) for k in range(50)], *[(a, b) for a in range(3000, 3008) for b in range(3000, 3008)], (7, None), (9000, 9000)]
    names = []
    monkeypatch.setattr(components_module, "written", lambda df, name: names.append(name) or common.written(df, name))
    got = dict(map(tuple, components_module.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == dict.fromkeys(range(1000), 0) | dict.fromkeys([5000, *range(2000, 2050)], 2000) | dict.fromkeys(range(3000, 3008), 3000)
    assert names.count("links") - 1 <= 12 and len(names) <= 60
    assert components_module.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_extraction_drops_long_comments():
    comments = f'<div id="comments"><div class="comment">{STORY * 5}</div></div>'
    assert extraction.main_text(f"<body><div>{STORY}{comments}</div></body>") == STORY_TEXT


@pytest.mark.parametrize("hot", [32, 2])
def test_jaccard(spark, hot):
    base = [f"t{i}" for i in range(60)]
    r = np.random.default_rng(3)
    texts = list(TEXTS)
    for k in range(60):
        w = list(base) if k % 2 else [*base[:40], *[f"u{k}x{j}" for j in range(k % 30)]]
        for j in r.integers(0, len(w), k % 4):
            w[j] = f"edit{k}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = components(sets)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_join(df, hot_bucket=hot).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_jaccard_links_across_allocations(spark):
    """S has segments that many share, T doesn't; S is short and T isn't, or the other way round."""
    texts = []
    for seed in range(3):
        r = np.random.default_rng(seed)
        s = [f"s{seed}x{i}" for i in range(13)]
        texts += [" ".join(s), " ".join([*s, *[f"t{seed}x{i}" for i in range(4)]])]
        texts += [" ".join([str(r.choice(s)), *[f"o{seed}x{k}x{j}" for j in range(11 + k % 5)]]) for k in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard_join.jaccard_join(df, size=1, hot_bucket=8).collect()}
    assert all(got[k] == got[k + 1] == k for k in (0, 152, 304))


@pytest.mark.parametrize(("seed", "hot"), [(0, 32), (1, 3), (2, 1)])
def test_jaccard_skewed_words_by_brute_force(spark, seed, hot):
    """Sets of few and skewed words, of which most share several hot ones, and a large group of near copies that drift apart."""
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(150):
        n = int(r.integers(1, 24))
        rows.append({f"w{int(x)}" for x in np.minimum(r.zipf(1.25, n), 400)})
    for _ in range(120):
        own = set(rows[int(r.integers(0, len(rows)))])
        for x in list(own)[: int(r.integers(0, 3))]:
            own.remove(x)
        rows.append(own | {f"n{int(x)}" for x in r.integers(0, 30, int(r.integers(0, 3)))} or {"one"})
    base = [f"b{i}" for i in range(16)]
    for _ in range(150):
        rows.append({*[base[i] for i in r.choice(16, 14, False)], *[f"c{int(x)}" for x in r.integers(0, 40, 1)]})
    texts = [" ".join(sorted(x)) for x in rows]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = components({i: frozenset(x) for i, x in enumerate(rows)})
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_join(df, size=1, hot_bucket=hot).collect()}
    assert got == {i: (len(rows[i]), want[i]) for i in want}


def test_jaccard_rows_without_id_bridge(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[a : a + 30]) for a in (0, 3, 6)]
    df = spark.createDataFrame([(5, texts[0]), (None, texts[1]), (None, texts[1]), (9, texts[2]), (9, texts[2]), (None, "alone")], "doc_id long, text string")
    got = sorted(tuple(x) for x in jaccard_join.jaccard_join(df, size=1).select("doc_id", "component_id").collect() if x.doc_id is not None)
    assert got == [(5, 5), (9, 5), (9, 5)]


def test_unit_pairs_form_every_pair_once():
    for left, right in ((1, 0), (2, 0), (7, 0), (7, 7), (3, 9), (9, 3), (70, 0)):
        total = left + right
        n, label, bits = np.full(total, 9), np.arange(total), np.zeros((total, 1), np.uint64)
        got, low = [], 0
        for high in (2, 5, None):
            got += [(int(a), int(b)) for i, j in jaccard_join.unit_pairs(n, label, bits, left, low, high, 75) for a, b in zip(i, j, strict=True)]
            low = high
        want = [(a, b) for a in range(left) for b in (range(left, total) if right else range(a + 1, left))]
        assert sorted((min(x), max(x)) for x in got) == want


def test_keep_one_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 0), (2, "a b", 0), (3, None, 1)], "doc_id long, text string, _gone int")
    assert sorted(r.doc_id for r in jaccard_join.keep_one(df).collect()) == [1, 3]


def test_jaccard_odd_tables(docs):
    assert jaccard_join.jaccard_join(docs).count() == docs.count()
    assert jaccard_join.jaccard_join(empty(docs)).count() == 0


def stripped(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("big", [4 << 20, 300])
def test_suffix_dedup(spark, docs, big):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(df, big=big).collect()}
    assert got == dict(enumerate(stripped(TEXTS)))


@pytest.mark.parametrize("big", [1, 700, 4000, 30_000])
def test_suffix_dedup_divides_big_owners(spark, big):
    """A phrase of 24 bytes or more amid other words, passages of over 200 bytes that many documents share, and runs of one and three letters."""
    r = np.random.default_rng(7)
    word = lambda n: " ".join("".join(chr(97 + x) for x in r.integers(0, 26, 5)) for _ in range(n))
    phrase, passage = " one phrase that stands in every text and owns much of it ", word(60)
    texts = [word(int(r.integers(5, 60))) + phrase + word(int(r.integers(5, 60))) for _ in range(60)]
    texts += [word(9) + phrase + passage + word(int(r.integers(5, 30))) for _ in range(12)] + ["a" * n for n in (199, 200, 201, 460, 461, 900)] + ["xyz" * 150, "yzx" * 90 + word(40), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(df, big=big).collect()}
    assert got == dict(enumerate(stripped(texts)))


def test_pieces_cut_again_hold_every_window(spark):
    """Each level cuts what the one before holds, and a phrase that owns all pieces owns few after a level or two."""
    r = np.random.default_rng(3)
    letters = lambda n: bytes(r.integers(97, 123, n).astype(np.uint8))
    pieces = [letters(180) + b"a phrase of 24 bytes that owns" + letters(180) for _ in range(40)]
    texts = spark.createDataFrame([(5, i, len(p) - 199, 0, 5, p) for i, p in enumerate(pieces)], "owner long, hash long, windows int, at long, sub long, piece binary")
    for level in (1, 2):
        texts = suffix_dedup.cut_again(texts, 200, level)
        rows = texts.collect()
        assert all(pieces[x.hash][x.at : x.at + len(x.piece)] == bytes(x.piece) for x in rows)
        assert sorted((x.hash, x.at + k) for x in rows for k in range(len(x.piece) - 199)) == sorted((i, k) for i, p in enumerate(pieces) for k in range(len(p) - 199))
    held = Counter()
    for x in rows:
        held[x.sub] += 1
    assert max(held.values()) < len(pieces) and len(held) > 40


def test_suffix_dedup_odd_tables(docs):
    assert suffix_dedup.suffix_dedup(docs).count() == docs.count()
    assert suffix_dedup.suffix_dedup(empty(docs)).count() == 0


def test_suffix_order():
    r = np.random.default_rng(1)
    for k in range(60):
        t = r.integers(1, 2 + k % 5, 1 + 3 * k).astype(np.int64)
        assert suffix_dedup.suffix_order(t, 10**9).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(again)


def test_quality(docs):
    rows = quality.quality(docs).filter("doc_id is not null").collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(TEXTS[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.quality(empty(docs)).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_judges_small_languages(spark):
    """Every document over the guard has a verdict: junk goes and prose stays, whatever the language and its size."""
    r = np.random.default_rng(5)
    stop, rest = ["the", "of", "and", "to", "in", "is"], ["".join(r.choice(list("abcdefghilmnoprstu"), 6)) for _ in range(3000)]

    def prose(n):
        return " ".join(str(r.choice(stop)) if r.random() < 0.3 else str(r.choice(rest)) for _ in range(n)) + "."

    def junk(n):
        return " ".join(f"{x}{'#$%&*<>'[k % 7] * 6}" for k, x in enumerate(r.choice(rest, n)))

    cyrillic = str.maketrans("abcdefghilmnoprstu", "абцдефгхилмнопрсту")
    rows = [(i, prose(300), "en") for i in range(100)]
    rows += [(100 + i, junk(300), lang) for i, lang in enumerate(["zz", None, "yy", "yy", "yy", "En"])]
    rows += [(200, prose(300), "EN"), (201, prose(300), None), (202, prose(300).translate(cyrillic), "ru"), (203, junk(300).translate(cyrillic), "ru")]
    got = {x.doc_id: x for x in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(x.class_distance is not None and x.word_distance is not None and not x.base_failed for x in got.values())
    assert {i for i, x in got.items() if not x.kept} == {*range(100, 106), 203}


def test_quality_agrees_with_labels(spark):
    """The verdict on documents that pass the base rules is that of the labels, which it never reads."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == k] for k in (1, 0))
    assert len(good) > 100 and len(bad) > 10
    assert all(r.kept for r in good) and not any(r.kept for r in bad)


def test_js_distance():
    p = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]])
    assert np.allclose(quality.js_distance(p, np.array([0.5, 0.5, 0.0])), [0, 1])


def test_boundaries_are_optimal():
    from itertools import combinations

    r = np.random.default_rng(2)
    lengths = np.sort(r.choice(100, 9, False)) + 1
    counts = r.integers(1, 20, 9)

    def cost(tops):
        return sum(int(c) * (min(t for t in tops if t >= x) - int(x)) for x, c in zip(lengths, counts, strict=True))

    for k in (1, 2, 3, 9):
        best = min(cost([*some, lengths[-1]]) for some in combinations(lengths[:-1], k - 1))
        assert cost(packing.boundaries(lengths, counts, k)) == best


def test_packing_with_clashing_names_and_equal_ids(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, 5, 0), (None, 7, 1), (None, None, 1), (2, 900, 2)], "doc_id long, n_tokens long, _b int").selectExpr("*", "1 AS _c", "2 AS _start", "3 AS _pack_len", "4 AS _pack_nth", "'x' AS Batch")
    rows = packing.length_buckets(df, buckets=2, budget=20).collect()
    assert len(rows) == 5 and all(r._b in (0, 1, 2) and (r._c, r._start, r._pack_len, r._pack_nth) == (1, 2, 3, 4) for r in rows)
    assert sorted((r.batch, r.batch_row) for r in rows if r.bucket == 0) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_packing(docs):
    rows = packing.packed(docs, tokenizer(), buckets=4, budget=200).collect()
    assert len(rows) == docs.count()
    for (_, _), own in {(r.bucket, r.batch): [x for x in rows if (x.bucket, x.batch) == (r.bucket, r.batch)] for r in rows}.items():
        assert len(own) == 1 or len(own) * own[0].bucket_len <= 200
        assert sorted(x.batch_row for x in own) == list(range(len(own)))
        assert all(x.n_tokens <= x.bucket_len for x in own)
    assert packing.packed(empty(docs), tokenizer()).count() == 0


def test_packing_pads_least_beyond_4096_lengths(spark):
    """All distinct lengths count, however many they are and however long the longest is."""
    lengths, counts = np.append(np.arange(1, 5001), 1_000_000), np.append(1 + np.arange(5000) % 7, 1)
    df = spark.createDataFrame([(int(x), int(c)) for x, c in zip(lengths, counts, strict=True)], "n_tokens long, c int")
    df = df.selectExpr("n_tokens", "explode(sequence(1, c)) AS doc_id")
    rows = packing.length_buckets(df, buckets=5).groupBy("bucket_len").agg({"n_tokens": "max", "*": "count"}).collect()
    assert all(r["bucket_len"] == r["max(n_tokens)"] for r in rows)
    padded = sum(r["bucket_len"] * r["count(1)"] for r in rows)
    # the quadratic programme
    n = np.concatenate([[0], np.cumsum(counts)])
    best = lengths * n[1:]
    for _ in range(4):
        best = np.array([min(best[j], (best[:j] + lengths[j] * (n[j + 1] - n[1 : j + 1])).min(initial=best[j])) for j in range(len(n) - 1)])
    assert padded == best[-1]


def encoded():
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer())
    return [lib.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_token_counts(docs):
    ids = encoded()
    for r in token_counts.token_counts(docs, tokenizer()).filter("doc_id is not null").collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((TEXTS[r.doc_id] or "").encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 512)
    other = token_counts.token_counts(docs, tokenizer("piece_bpe_32k.model"))
    assert other.count() == docs.count()


def test_records(docs):
    ids = encoded()
    rows = sorted(records.token_records(docs, tokenizer()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: -1 if x is None else x)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id is not None:
            want = np.array([*ids[r.doc_id], 0], "<u4")
            assert r.n_tokens == len(want) and r.ids_crc32 == zlib.crc32(want.tobytes()) and list(r.ids) == want.tolist()
    assert records.token_records(empty(docs), tokenizer()).count() == 0


def test_record_checksums():
    data = bytearray(records.frame(b"payload"))
    assert records.read_record(bytes(data)) == (b"payload", len(data))
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            records.read_record(bytes(bad))


def test_decontamination(spark, docs):
    item = " ".join(f"bench{i}" for i in range(20))
    changed = item.replace("bench7 ", "other ").replace("bench13 ", "thing ")
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (1, item)], "item_id long, text string")
    rows = spark.createDataFrame([(1, "x y " + item.upper() + " z"), (2, "a " + changed), (3, "bench1 bench2 bench3 bench4 bench5 bench6 bench7 alone"), (4, None), (None, item)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(rows, items).collect()}
    assert got == {(1, 1), (2, 1)}
    assert sorted(str(r.doc_id) for r in decontamination.decontaminate(rows, items).collect()) == ["3", "4", "None"]
    assert decontamination.contaminated(empty(docs), items).count() == 0
    assert decontamination.contaminated(rows, items.filter("1 = 0")).count() == 0


def test_decontamination_of_equal_items_and_clashing_names(spark):
    item = " ".join(f"bench{i}" for i in range(20))
    items = spark.createDataFrame([(k, item.upper() if k % 2 else item) for k in range(40)], "item_id long, text string")
    rows = spark.createDataFrame([(1, item, 0), (1, "other", 0), (2, "clean text", 1)], "doc_id long, text string, _contaminated int")
    got = sorted((r.doc_id, r.item_id, r.matched, r.compared) for r in decontamination.contaminated(rows, items).collect())
    assert got == [(1, k, 13, 13) for k in range(40)]
    assert [r.doc_id for r in decontamination.decontaminate(rows, items).collect()] == [2]


def test_decontamination_finds_all_of_three_substitutions_and_short_items(spark):
    from itertools import combinations

    words = [f"bench{i}" for i in range(13)]
    places = list(combinations(range(13), 3))
    rows = [(i, " ".join("other" if k in p else w for k, w in enumerate(words))) for i, p in enumerate(places)]
    rows += [(1000, "x five words of an item y"), (1001, "x five words of item an y"), (1002, "one"), (1003, ""), (1004, None)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "Five words, of an item"), (3, "one"), (4, ""), (5, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(i, 1) for i in range(len(places))} | {(1000, 2), (1002, 3)}


def contaminated_by_force(rows, items, window=13, agree=0.75):
    """Every diagonal of every document and item; matched and compared of the best window."""
    split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    out = {}
    for d, text in rows:
        for k, item in items:
            own, words = split(text), split(item)
            width = min(window, len(words))
            if d is None or k is None or not width:
                continue
            least = -(-width * 3 // 4) if width >= decontamination.SPAN else width
            for shift in range(-len(words), len(own)):
                same = [0 <= i + shift < len(own) and own[i + shift] == w for i, w in enumerate(words)]
                best = max(sum(same[i : i + width]) for i in range(len(words) - width + 1))
                if best >= least:
                    out[d, k] = max(out.get((d, k), (0, 0)), (best, width))
    return {(*pair, *found) for pair, found in out.items()}


def test_decontamination_against_every_diagonal(spark):
    rng = np.random.default_rng(7)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5, n))
    items = [(k, word(int(n))) for k, n in enumerate(rng.integers(1, 40, 60))]
    items += [(60 + k, f"shared words of every question in this set {word(9)}") for k in range(20)] + [(3, word(12)), (None, word(20)), (90, None), (91, "")]
    rows = [(d, word(int(n))) for d, n in enumerate(rng.integers(0, 60, 60))]
    rows += [(100, word(700)), (101, "x " * 124 + items[5][1] + " y"), (101, "x " * 300 + items[62][1]), (102, items[62][1].replace("w1", "q")), (103, "shared words of every question in this set"), (None, items[5][1]), (104, None)]
    rows += [(105, word(140))] * 50
    for i, (_, item) in enumerate(items[:60]):
        words = item.split()
        for j in rng.integers(0, len(words), 1 + len(words) // 5):
            words[j] = "other"
        rows.append((200 + i, f"start {' '.join(words)} end"))
    got = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.item_id, r.matched, r.compared) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == contaminated_by_force(rows, items)


def test_decontamination_finds_every_placement_of_substitutions(spark):
    from itertools import combinations

    items, rows = [], []
    for n in range(7, 14):
        words = [f"item{n}word{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for p in combinations(range(n), n - -(-n * 3 // 4)):
            rows.append((1000 * n + len(rows), " ".join("other" if k in p else w for k, w in enumerate(words))))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(d, d // 1000) for d, _ in rows}
    assert [len(decontamination.missed(n, n - -(-n * 3 // 4))) for n in range(7, 14)] == [0, 5, 1, 0, 0, 3, 0]


def test_decontamination_with_other_columns_nulls_and_bad_options(spark):
    item = " ".join(f"bench{i}" for i in range(20))
    rows = spark.createDataFrame([(None, None, 1, 2), (1, item, 3, 4)], "doc_id long, text string, block int, h int")
    items = spark.createDataFrame([(1, item, 1)], "item_id long, text string, spot int")
    assert [tuple(r) for r in decontamination.contaminated(rows, items).collect()] == [(1, 1, 13, 13)]
    with pytest.raises(ValueError):
        decontamination.contaminated(rows, items, window=5)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            ok = {"email": lambda: True, "ip": lambda m=m: all(int(x) < 256 for x in m[0].split(".")), "card": lambda d=d, total=total: 13 <= len(d) <= 19 and total % 10 == 0, "phone": lambda d=d: 9 <= len(d) <= 15}[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii(spark, docs):
    texts = [*TEXTS, "a@b.c@d.e a@b.c_d@e.f é x@y.z.w-", "1.2.3.4.5.6.7.8 300.1.1.1 0001.002.3.4", "9" * 5000, "1 " * 3000, "+1+2 +123456789 +49 30 1234 5678", 'token = "11acdfb36bb72224148e6160f674b" on 12/05/2001']
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        want = base_spans(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for k, a, b in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}
    clean = {r.doc_id: r.text for r in pii.redact(df.withColumn("n_chars", pii.F.length("text")), "text").collect()}
    assert clean[18].startswith("mail [EMAIL] or [IP], [PHONE] and ") and clean[0] is None and clean[len(texts) - 1] == 'token = "[KEY]" on 12/05/2001'
    assert pii.find_pii(empty(docs)).count() == 0
    assert pii.redact(docs).columns == docs.columns


def test_pii_long_keys_and_short_or_capital_addresses(spark):
    key = ("11acdfb36bb72224148e6160f674b" * 20)[:500]
    found = {0: f'token = "{key}"', 1: "write to j(at)example.com now", 2: "write to jo.doe (AT) example (Dot) com", 3: f"mail {'b' * 50}(at){'c' * 50}.org", 4: "mail jo.doe(at)x.org", 5: f"token: {key[:201]}", 6: "mail jo.doe(at)mail.x.org", 7: "mail jo.doe(at)mail (dot) x (dot) org"}
    odd = {10: "a." * 50_000, 11: "a(at)" * 20_000, 12: "x" * 100_000, 13: "a(at)b" + ".c" * 50_000}
    df = spark.createDataFrame(list((found | odd).items()), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(df).collect()}
    assert got[0] == "key:9:509" and got[5] == "key:7:208"
    assert [got[k] for k in (1, 2, 4, 6, 7)] == ["address:9:25", "address:9:38", "address:5:20", "address:5:25", "address:5:37"] and got[3] == "address:5:113"


def spans_by_hand(text):
    """Base spans, then the chosen candidates: those that meet no base span, leftmost and longest first."""
    base = base_spans(text)
    trees, least = pii.model()
    more = []
    for kind, pattern in pii.CANDIDATES.items():
        import regex

        for m in regex.finditer(pattern, text):
            if all(m.end() <= a or b <= m.start() for _, a, b in base):
                x = np.array([pii.feature_row(m[0], text[max(0, m.start() - pii.CONTEXT) : m.start()])], float)
                if sum(pii.RATE * pii.tree_value(t, x)[0] for t in trees) >= least:
                    more.append((m.start(), -m.end(), kind))
    end, kept = 0, []
    for a, b, kind in sorted(more):
        if a >= end:
            kept.append((kind, a, -b))
            end = -b
    return base, kept


def test_pii_spans_by_brute_force_beyond_a_block(spark):
    r = np.random.default_rng(4)
    some = ["(743) 555-3824", "743-555-3824", "parts 555 123 4567", "123-45-6789", "a@b.co", "10.0.0.1", "+1 743 555 3824", "4316 5226 7852 5456", "jo(at)x.org", "token = 11acdfb36bb72224148e6160f674b2", "call number 2019-03-12", "é", "word", "12/05/2001", "GB12 1234 1234 1234 12"]
    texts = [" ".join(some[int(k)] for k in r.integers(0, len(some), n)) for n in (1, 5, 40, 700, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {x.doc_id: x.text for x in pii.redact(df).collect()}
    for x in pii.find_pii(df).collect():
        base, more = spans_by_hand(texts[x.doc_id])
        both = sorted(base + more, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert x.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in both)
        out, at = [], 0
        for k, a, b in sorted(base + more, key=lambda s: (s[1], s[2], s[0])):
            if a >= at:
                out += [texts[x.doc_id][at:a], f"[{k.upper()}]"]
            at = max(at, b)
        assert clean[x.doc_id] == "".join(out) + texts[x.doc_id][at:]


def test_pii_work_grows_with_the_text(spark):
    import time

    df = spark.createDataFrame([(0, "555 123 4567 and " * 30_000), (1, "10.0.0.1, " * 30_000)], "doc_id long, text string")
    began = time.time()
    assert all(r.spans or r.doc_id == 0 for r in pii.find_pii(df).collect()) and len(pii.redact(df).collect()) == 2
    assert time.time() - began < 240


def test_pii_leaves_numbers_that_are_told_to_be_others(spark):
    texts = ["the call number 2019-03-12 is on the shelf", "parts 555 123 4567 in stock", "order no. 123-45-6789 was sent", "commit 11acdfb36bb72224148e6160f674b211acdfb36b", "call 743-555-3824 now", "SSN: 123-45-6789"]
    got = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[k] for k in range(4)] == [""] * 4 and got[4] == "number:5:17" and got[5] == "number:5:16"


def test_pii_model_on_held_out():
    x, y = pii.examples(2000, 99)
    trees, least = pii.model()
    chosen = sum(pii.RATE * pii.tree_value(t, x) for t in trees) >= least
    assert y[chosen].mean() > 0.97 and chosen[y > 0].mean() > 0.8


def test_shingle_counts():
    import pyarrow as pa

    for i, j, offsets, data in kernel.chunks(pa.array(TEXTS)):
        bounds, _ = kernel.shingle_sets(data, offsets)
        assert np.diff(bounds).tolist() == [len(shingles(t)) for t in TEXTS[i:j]]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "/root/testdata/sf0.001")
        assert after.columns == docs.columns, name
        after.write.parquet(f"{tmp_path}/{len(name)}")
        after = spark.read.parquet(f"{tmp_path}/{len(name)}")
        assert 0 < after.count() <= docs.count()
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_pipeline_stages_keep_the_right_rows(spark, tmp_path):
    """Each stage on its own documents, against what plain Python keeps; then the whole on an empty table."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id < 80")
    rows = {r.doc_id: r for r in docs.collect()}
    sf = "/root/testdata/sf0.001"
    kept = {r.doc_id for r in stages["quality rules"](spark, docs, sf).collect()}
    assert kept == {r.doc_id for r in quality.quality(docs).filter("kept").collect()} and all(base_counts(rows[i].text)[0] >= 50 for i in kept)
    want = components({i: shingles(r.text) for i, r in rows.items()})
    assert {r.doc_id for r in stages["n-gram Jaccard join"](spark, docs, sf).collect()} == {i for i in rows if want[i] == i}
    items = [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]

    def holds_item(text):
        own = re.findall(r"[^\W_]+", text.lower())
        grams = {}
        for i in range(len(own) - 12):
            grams.setdefault(tuple(own[i : i + 13]), i)
        return any(tuple(w[i : i + 13]) in grams for w in items for i in range(len(w) - 12))

    clean = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, sf).collect()}
    assert not any(holds_item(rows[i].text) for i in clean) and len(clean) > len(rows) // 2
    for r in stages["PII"](spark, docs, sf).collect():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
    os_dir = f"{tmp_path}/sf"
    docs.filter("1 = 0").write.parquet(f"{os_dir}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{os_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, os_dir).count() == 0


def test_arrow_batches_are_bounded_unless_the_session_says(spark):
    key, ours = common.BATCH
    df = spark.newSession().createDataFrame([(1, "a b")], "doc_id long, text string")
    own = df.sparkSession
    before = own.conf.get(key, None)
    common.written(df, "plain")
    assert own.conf.get(key, None) == before
    if before is None:
        common.arrow_map(df, lambda batch: iter([batch.columns]), df.schema)
        assert own.conf.get(key) == ours
    own.conf.set(key, "1m")
    assert common.arrow_map(df, lambda batch: iter([batch.columns]), df.schema).collect() == df.collect()
    common.written(df, "plain")
    assert own.conf.get(key) == "1m"
