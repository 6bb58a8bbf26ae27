"""Main text of HTML pages by tree scoring.

The page is parsed into a tree without menus, headers, footers, sidebars,
adverts, forms, scripts and comments. Each block of text passes points for its
length and commas to its ancestors, half as many a level up, discounted by
link density. The best container is taken together with what reads like text
beside it and, unless it is or lies in an article, beside its ancestors.
"""

from __future__ import annotations

import functools
import html
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, named

#: Fixed values of HTML: elements without content, raw text, blocks, and what an opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body dd dt li td th tr tbody thead tfoot legend summary figcaption".split()) | frozenset(("dd", "dt", "li"))
CLOSES_SAME = {
    "li": ("li", "ul ol menu dir"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "thead": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"), "option": ("option", "select"),
}
CLOSES_SAME = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES_SAME.items()}
#: Parameters: elements and words of class, id or role that mark what is not the article, and those that mark it.
DROPPED = frozenset("script style noscript template iframe object embed svg canvas audio video nav footer aside button select textarea input head title menu dialog noembed noframes xmp".split())
UNLIKELY = re.compile(
    r"ad|ads|advert\w*|adbox|banner|sponsor\w*|promo\w*|breadcrumb\w*|comment|comments|commentlist|reply|replies|disqus|cookie\w*|consent|notice|notices|alert|disclaimer|footer|foot|header|masthead|menu|nav|navbar|navigation|pagination|pager|popup|modal|overlay|related|recommend\w*|share|sharing|social|sidebar|side|subscribe\w*|newsletter|signup|login|widget|toolbar|skip|search"
)
#: Words that a name may hold besides and still mean the same: a site-header is one, what has-sidebar is not.
PLACES = frozenset("site global page post article entry main top bottom left right primary secondary first last box bar list links link item items block section area container wrapper wrap inner text button buttons icons form".split())
COMMENTS = frozenset("comment comments commentlist reply replies disqus".split())
LIKELY = re.compile(r"(?<![a-z])(article|body|content|entry|main|page|post|story|text)(?![a-z])")
UNLIKELY_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MIN_BLOCK, SIBLING_SHARE, SIBLING_DENSITY, ARTICLE_SHARE, FORM_SHARE = 25, 0.2, 0.25, 0.25, 0.9

#: A quote opens a value only right after the equals sign of an attribute, as in browsers; elsewhere it is an ordinary character.
VALUE = r"=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?"
NAME = r"(?:=[^\s=>/]*+|[^\s=>/]++)"
TOKEN = re.compile(rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{NAME}(?:\s*+{VALUE})?)*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(rf"({NAME})(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>\"'][^\s>]*+))?)?")
SPACE = re.compile(r"\s+")
NOT_LETTERS = re.compile(r"[^a-z]+")


class Node:
    __slots__ = ("tag", "parent", "items", "attrs", "score", "points", "length", "links", "commas")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.items, self.attrs = tag, parent, [], attrs
        self.score, self.points, self.length, self.links, self.commas = 0.0, 0.0, 0, 0, 0

    def marks(self) -> tuple[str, str, bool]:
        if not self.attrs:
            return "", "", False
        a = {k.lower(): x or y or z for k, x, y, z in reversed(ATTRIBUTE.findall(self.attrs))}
        style = a.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in a or "display:none" in style or "visibility:hidden" in style or a.get("aria-hidden", "").lower() == "true"
        return f"{a.get('class', '')} {a.get('id', '')}".lower(), a.get("role", "").lower(), hidden


def parse(page: str) -> Node:
    """The tree of a page; never fails, whatever the markup."""
    root = node = Node("html", None)
    at, lower = 0, None
    depth: dict[str, int] = {}  # how many elements of a name are open, so that none is looked for in vain

    def leave(to: Node) -> Node:
        inner = node
        while inner is not to:
            depth[inner.tag] -= 1
            inner = inner.parent
        return to

    def enter(to: Node) -> Node:
        depth[to.tag] = depth.get(to.tag, 0) + 1
        return to

    while True:
        m = TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            node.items.append(page[at:end])
        if not m:
            return root
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node if depth.get(tag) else None
            while up is not None and up.tag != tag:
                if up.tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot") and tag not in BLOCKS:
                    up = None
                    break
                up = up.parent
            if up is not None and up.parent is not None:
                node = leave(up.parent)
            elif tag == "br":
                node.items.append(Node("br", node))
            continue
        if tag in ("html", "body", "head"):
            if tag == "head":
                node = enter(Node("head", node))
                node.parent.items.append(node)
            elif tag == "body":
                while node is not root and node.tag == "head":
                    node = leave(node.parent)
                root.attrs = ""
            continue
        if node.tag == "head" and tag not in RAW and tag not in VOID:
            node = leave(node.parent)
        if tag in CLOSES_P and depth.get("p"):
            up = node
            while up is not None and up.tag != "p" and up.tag not in BLOCKS:
                up = up.parent
            if up is not None and up.tag == "p":
                node = leave(up.parent)
        if tag in CLOSES_SAME and any(depth.get(x) for x in CLOSES_SAME[tag][0]):
            same, stop = CLOSES_SAME[tag]
            up, last = node, None
            while up is not None and up.tag not in stop:
                if up.tag in same:
                    last = up
                up = up.parent
            if last is not None:
                node = leave(last.parent)
        child = Node(tag, node, m[3])
        node.items.append(child)
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == len(page) else re.sub("[A-Z]", lambda x: x[0].lower(), page)
            close = lower.find(f"</{tag}", at)
            if close < 0:
                return root
            child.items.append(page[at:close])
            at = page.find(">", close) + 1 or len(page)
            continue
        node = enter(child)


def gone(node: Node, inside: bool) -> bool:
    """Whether the node is left out for its element, role or being hidden; inside: it lies in an article, where a header is part of it."""
    if node.tag in DROPPED:
        return True
    _, role, hidden = node.marks()
    return hidden or role in UNLIKELY_ROLES or node.tag == "header" and not inside


@functools.lru_cache(10_000)
def unlikely_parts(names: str) -> frozenset[str]:
    """The words of class and id names that mark what is not the article; none if a whole name is one of the article's."""
    out = set()
    for name in names.split():
        if LIKELY.fullmatch(name):
            return frozenset()
        parts = [x for x in NOT_LETTERS.split(name) if len(x) > 1]
        bad = {x for x in parts if UNLIKELY.fullmatch(x)}
        if all(x in bad or x in PLACES for x in parts):
            out |= bad
    return frozenset(out)


def unlikely(node: Node, inside: bool) -> frozenset[str]:
    """What in the names of the node speaks for leaving it out."""
    if not node.attrs or node.tag in ("article", "main", "body", "p", "header") or node.tag not in BLOCKS and node.tag not in ("span", "a", "ins") or inside and node.tag in ("h1", "h2", "h3"):
        return frozenset()
    return unlikely_parts(node.marks()[0])


def holds(root: Node) -> dict[int, float]:
    """Of nodes by id, their share of the points for length and commas of the page's blocks without their links; of
    those in articles and mains only, if these have a fair part. What is left out by any means and comments have none."""
    order, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        order.append((node, inside))
        stack += [(x, inside) for x in node.items if not isinstance(x, str) and not gone(x, inside) and not unlikely(x, inside) & COMMENTS]
    own: dict[int, tuple[int, int]] = {}
    points: dict[int, tuple[float, float]] = {}
    for node, inside in reversed(order):
        n = commas = 0
        whole = within = 0.0
        for x in node.items:
            if isinstance(x, str):
                n += len("".join(x.split()))
                commas += x.count(",")
            elif id(x) in own:
                whole, within = whole + points[id(x)][0], within + points[id(x)][1]
                if x.tag not in BLOCKS and x.tag != "a":
                    n += own[id(x)][0]
                    commas += own[id(x)][1]
        if node.tag in BLOCKS and n:
            more = (1 + commas) * (n >= MIN_BLOCK) + min(3, n / 100)
            whole, within = whole + more, within + more * inside
        own[id(node)], points[id(node)] = (n, commas), (whole, within)
    whole, within = points[id(root)]
    k = int(within > ARTICLE_SHARE * whole)
    return {i: x[k] / (whole, within)[k] for i, x in points.items() if x[k]}


def prune(root: Node) -> None:
    """Take out what is not the article by element, role or name; a name does not count where most of the page's text is, nor a form that wraps nearly all of it."""
    share = None
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        items = []
        for x in node.items:
            if not isinstance(x, str):
                if gone(x, inside):
                    continue
                if x.tag == "form" or unlikely(x, inside):
                    share = holds(root) if share is None else share
                    if share.get(id(x), 0.0) <= (FORM_SHARE if x.tag == "form" else 0.5):
                        continue
                stack.append((x, inside))
            items.append(x)
        node.items = items


def score(root: Node) -> list[Node]:
    """Set lengths, link lengths, scores and the points of all blocks within; the containers in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in reversed(node.items) if not isinstance(x, str)]
    own: dict[int, list[int]] = {}
    for node in reversed(order):
        n = commas = 0
        for x in node.items:
            if isinstance(x, str):
                n += len("".join(x.split()))
                commas += x.count(",")
            else:
                node.length += x.length
                node.links += x.links
                node.commas += x.commas
                if x.tag not in BLOCKS:
                    n += own[id(x)][0]
                    commas += own[id(x)][1]
        own[id(node)] = [n, commas]
        direct = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
        node.length += direct
        node.commas += sum(x.count(",") for x in node.items if isinstance(x, str))
        if node.tag == "a":
            node.links = node.length
    # a parent has the points of its blocks in full and half of what these have from theirs
    for node in reversed(order):
        n, commas = own[id(node)]
        density = node.links / node.length if node.length else 0.0
        points = (1 + commas + min(3, n / 100)) * (1 - density) if node.tag in BLOCKS and n >= MIN_BLOCK else 0.0
        node.points += points
        if node.parent is None:
            node.score += points
        else:
            node.parent.score += points + node.score / 2
            node.parent.points += node.points
    containers = [node for node in order if node.tag in BLOCKS and node.length]
    for node in containers:
        bonus = 25 if node.tag in ("article", "main") else 0
        names = node.marks()[0]
        if names and LIKELY.search(names):
            bonus += 10
        node.score = (node.score + bonus) * (1 - (node.links / node.length))
    return containers


def reads_like_text(x: Node, beside: Node) -> bool:
    """Whether a block beside the container, or beside one of its ancestors, is part of the text; beside an article only what is much like it or a paragraph."""
    density = x.links / x.length if x.length else 1.0
    if x.tag in ("p", "pre", "blockquote", "h1", "h2", "h3") and density < SIBLING_DENSITY:
        return True
    if beside.tag in ("article", "main"):
        return x.tag in BLOCKS and x.score >= max(10.0, SIBLING_SHARE * beside.score)
    return x.points > 0 and density < SIBLING_DENSITY


def beside_of(node: Node) -> tuple[list, list]:
    """What is to be kept of the items before and after a node in its parent: blocks that read like text, and runs of text and inline elements that are no links."""
    sides: tuple[list, list] = ([], [])
    run: list = []
    side = 0

    def end() -> None:
        length = sum(len("".join(x.split())) if isinstance(x, str) else x.length for x in run)
        links = sum(0 if isinstance(x, str) else x.links for x in run)
        if length and links / length < SIBLING_DENSITY and node.tag not in ("article", "main"):
            sides[side].extend(run)
        run.clear()

    for x in node.parent.items:
        if isinstance(x, str) or x.tag not in BLOCKS:
            run.append(x)
            continue
        end()
        if x is node:
            side = 1
        elif reads_like_text(x, node):
            sides[side].append(x)
    end()
    return sides


def best(root: Node) -> list:
    """The best container and what is kept beside it and its ancestors, in page order."""
    containers = [c for c in score(root) if c is root or c.tag not in ("p", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "ul", "ol", "tr", "dt", "dd")]
    if not containers:
        return [root]
    top = max(containers, key=lambda c: c.score)
    if top.score <= 0 or top.parent is None:
        return [root]
    out, node = deque([top]), top
    while node.parent is not None:
        before, after = beside_of(node)
        out.extendleft(reversed(before))
        out.extend(after)
        if node.tag in ("article", "main"):
            break
        node = node.parent
    return list(out)


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order, references decoded, white space made one blank."""
    parts: list[list[str]] = [[]]
    stack: list = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            parts.append([])
        elif isinstance(x, str):
            parts[-1].append(x)
        elif x.tag == "br":
            parts[-1].append(" ")
        else:
            block = x.tag in BLOCKS
            if block:
                parts.append([])
                stack.append(None)
            stack += reversed(x.items)
    texts = (SPACE.sub(" ", html.unescape("".join(p))).strip() for p in parts)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    return " ".join(blocks(best(root)))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page has the empty text; so has a page of which nothing
    but menus and the like remains. Broken and cut markup never fails: tags,
    quotes and what an opening tag closes are read by the rules of HTML, but
    misnested formatting and text between table rows stay where they are. A
    form goes with its text unless it wraps nearly all of the page; its
    controls always go. Work grows in proportion to a page's length. Repeated rows stay repeated; an empty table gives an empty table;
    other columns are not read.
    """
    rows = df.select(named(id_col).cast("long").alias("page_id"), named(url_col).cast("string").alias("url"), named(html_col).cast("string").alias("html"))

    def run(batch):
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            yield part.column(0), part.column(1), [main_text(p) for p in part.column(2).to_pylist()]

    return arrow_map(rows, run, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
