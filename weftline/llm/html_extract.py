"""HTML extraction: a page as flat text blocks, each classified by a decision tree on its own and its neighbours' figures.

A block is the text between two block-level tags. Its features are word count and link density of itself, of the block before
and of the block after, and two figures of where it lies: whether under an element that is named as page furniture, and whether in, outside or
without an element named as main text. A small decision tree (Gini, grown when the module is first used) keeps or drops it; its labelled table
are the blocks of LAYOUTS below, page layouts whose blocks are marked by hand.

Names. Element names, roles and the words of class and id name furniture or main text. A class names it only if all its words do or are neutral
("cookie-notice", "site-footer", not "has-sidebar", "comments-open", "related-work"). A name is ignored on an element that wraps the page: one
that has all elements named as main text, or, where none is, over half the words. Main text is ignored where it has under a
third of the words outside furniture.

Pages are mapped in Arrow batches without a shuffle; a page's work follows its length, and the scan never looks back.

Defined results. Null or empty html, or a page without kept blocks: empty text. Repeated pages give a row each. A page cut
off inside a tag loses that tag only; unclosed elements end with the page, and p, li and table cells where the next one starts. Extra columns
are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!important\s*)?(?:;|$)", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# HTML element names by kind.
RAW = frozenset("script style noscript textarea title template iframe object svg select button annotation annotation-xml".split())
BLOCKS = frozenset(
    """address article aside base blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav ol optgroup option p pre search section summary table
    tbody td tfoot th thead title tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where the next one of the name starts.
SELF_ENDING = frozenset("p li dt dd td th tr option".split())
FURNITURE = frozenset("nav footer aside form menu dialog search".split())
#: Those whose name holds even if they wrap the page.
ALWAYS = frozenset("nav footer aside menu dialog search".split())
MAIN = frozenset("article main".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar toolbar".split())
# Words in class or id that name page furniture, main text, or nothing by themselves.
FURNITURE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies
    cookiebar copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager paging pagination popup promo
    promoted promotion related replies reply respond responses share sharing sharebar sidebar sidenav signin signup skip social sponsor sponsored subscribe
    subscription tags teaser teasers toolbar topbar trending widget widgets""".split()
)
MAIN_WORDS = frozenset("article content entry main post story".split())
NEUTRAL_WORDS = frozenset(
    """area articles bar block body bottom box btn button buttons col column container div form global group header inner item items left link links
    list message module outer page panel popular posts primary right row section secondary site stories text thread top wrap wrapper""".split()
)


@dataclass
class Element:
    """An element with a name that says something. up: the index of the one around it, or -1; start, end: its blocks; last: the index behind
    those of the elements in it."""

    up: int
    start: int
    furniture: bool = False
    always: bool = False
    header: bool = False
    main: bool = False
    end: int = 0
    last: int = 0


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    within: int = -1
    furniture: bool = False
    #: 1 in main text, -1 outside it, 0 if the page names none.
    place: int = 0
    text: str = ""
    words: int = 0
    link_density: float = 0.0


def _element(name: str, attrs: str, up: int, start: int) -> Element | None:
    """What name and attrs say of an element; None if nothing."""
    e = Element(up, start, furniture=name in FURNITURE, always=name in ALWAYS, header=name == "header", main=name in MAIN)
    if "=" in attrs or "hidden" in attrs:
        for m in ATTRIBUTE.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and UNSEEN.search(value)):
                e.furniture = True
            elif key == "role":
                roles = set(value.lower().split())
                e.furniture |= bool(roles & FURNITURE_ROLES)
                e.main |= "main" in roles or "article" in roles
            elif key in ("class", "id"):
                for token in value.split():
                    words = {w.lower() for w in PARTS.findall(token)}
                    named = words & FURNITURE_WORDS
                    if named and words <= FURNITURE_WORDS | NEUTRAL_WORDS | MAIN_WORDS:
                        e.furniture = True
                    elif "header" in words and words <= NEUTRAL_WORDS:
                        e.header = True
                    elif words & MAIN_WORDS and words <= MAIN_WORDS | NEUTRAL_WORDS:
                        e.main = True
    e.main = e.main and not e.furniture
    return e if e.furniture or e.header or e.main else None


def _placed(found: list[Block], elements: list[Element]) -> list[Block]:
    """Sets furniture and place of the blocks by the elements that they lie in."""
    total = [0]
    for b in found:
        total.append(total[-1] + b.words)
    mains = [k for k, e in enumerate(elements) if e.main]
    inside: list[tuple[bool, bool]] = []  # for each element: under furniture, under main text
    for k, e in enumerate(elements):
        furniture, main = inside[e.up] if e.up >= 0 else (False, False)
        claim = e.furniture or (e.header and not main)
        if claim and not furniture and not e.always:
            held = bisect_left(mains, e.last) - bisect_left(mains, k)
            wraps = held == len(mains) if mains else 2 * (total[e.end] - total[e.start]) > total[-1]
            claim = not wraps
        furniture = furniture or claim
        inside.append((furniture, (main or e.main) and not furniture))
    named = loose = 0
    for b in found:
        b.furniture, main = inside[b.within] if b.within >= 0 else (False, False)
        b.place = 1 if main else -1
        named += b.words if main else 0
        loose += b.words if not main and not b.furniture else 0
    if not named or 2 * named < loose:
        for b in found:
            b.place = 0
    return found


def blocks(page: str) -> list[Block]:
    """The page's text blocks, in page order; blank ones are left out."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements: name, index of the element around what they hold
    counts: Counter[str] = Counter()
    elements: list[Element] = []
    within = -1
    links = 0
    current = Block()

    def cut() -> None:
        nonlocal current
        if current.parts:
            current.text = " ".join("".join(current.parts).split())
            if current.text:
                current.words = len(current.text.split(" "))
                current.link_density = min(1.0, len("".join(current.linked).split()) / current.words)
                out.append(current)
        current = Block(within=within)

    def say(text: str) -> None:
        text = entities.unescape(text) if "&" in text else text
        current.parts.append(text)
        if links:
            current.linked.append(text)

    def close(size: int) -> None:
        """Ends the open elements but the first size."""
        nonlocal within
        cut()
        while len(stack) > size:
            name, own = stack.pop()
            counts[name] -= 1
            if own >= 0:
                elements[own].end, elements[own].last = len(out), len(elements)
                within = elements[own].up
        current.within = within

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        flows = name not in BLOCKS and "-" not in name
        if m["end"] or m["end2"]:
            if name == "a":
                links = max(0, links - 1)
            elif not flows:
                if counts[name]:
                    k = len(stack) - 1
                    while stack[k][0] != name:
                        k -= 1
                    close(k)
                else:
                    cut()
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            if name == "title":
                cut()
            continue
        if name == "br":
            current.parts.append(" ")
        elif name == "a":
            links += 1
        elif flows:
            continue
        elif name in VOID:
            cut()
        else:
            top = stack[-1][0] if stack else ""
            if top == "p" or (top == name and name in SELF_ENDING):
                close(len(stack) - 1)
            cut()
            own = None if name in ("html", "body") else _element(name, attrs, within, len(out))
            if own:
                elements.append(own)
                within = len(elements) - 1
                current.within = within
            stack.append((name, within if own else -1))
            counts[name] += 1
    close(0)
    return _placed(out, elements)


# The labelled table: page layouts, and for each of their blocks, in page order, whether it is main text (1) or not (0). w40 stands for forty words.
LAYOUTS = (
    ("<body><header><h2>w2</h2></header><nav><ul><li><a>w1</a><li><a>w1</a><li><a>w2</a></ul></nav><article><h1>w8</h1><p>w45<p>w60 <a>w3</a><p>w20</article><aside><h3>w2</h3><p>w25</aside><footer>w14</footer>", "0 000 1111 00 0"),
    ("<body><div class=menu><a>w1</a> <a>w1</a></div><div class=ad>w9</div><main><h1><a>w7</a></h1><p>w3 <a>w2</a><p>w80<h2>w3</h2><p>w40<ul><li>w5<li>w8</ul><p>w12</main><div class='cookie-notice'>w22</div>", "00 1111111 1 0"),
    ("<body><div><a>w1</a></div><div><a>w2</a></div><div><a>w3</a></div><div>w60</div><div>w45</div><div>w90 <a>w4</a></div><div><a>w1</a></div><div><a>w2</a></div>", "000 111 00"),
    ("<body><table><tr><td><a>w1</a> <a>w1</a> <a>w2</a><td><h1>w6</h1><p>w35<p>w22<p>w9<p>w50</td><td><a>w5</a> w2<td><a>w4</a></table><p><a>w2</a> <a>w1</a></p>", "0 11111 00 0"),
    ("<body><div>w3</div><div><a>w1</a></div><div><a>w1</a></div><h1>w9</h1><div>w70</div><div>w30</div><h2>w4</h2><div>w55</div><div><a>w2</a></div><div><a>w2</a></div><div>w4 <a>w4</a></div>", "000 11111 000"),
    ("<body><nav><a>w3</a></nav><article><h1>w5</h1><p>w30<ul><li><a>w4</a><li><a>w3</a><li><a>w6</a></ul><p>w25<h2>w2</h2><ul><li><a>w8</a><li><a>w5</a></ul></article><section id=comments><h3>w2</h3><p>w40<p>w70<p>w6</section>", "0 11111 1111 0000"),
    ("<body><div class=content><h1>w4</h1><p>w6<p>w90<p>w3</div><div class=sidebar><h3>w2</h3><p>w30<a>w2</a></div><div>w12</div><div><a>w1</a> <a>w2</a></div>", "1111 00 00"),
    ("<body><form><h1>w5</h1><p>w80<p>w45<p>w20</form>", "1111"),
    ("<body><main><p>w16</main>", "1"),
    ("<body><p>w12", "1"),
    ("<body><h1>w3</h1><p>w9<p>w14", "111"),
    ("<body><article><p>w1<p>w2<p>w1 <a>w1</a></article><p>w18<p>w3 <a>w2</a>", "111 00"),
    ("<body><article><p><a>w9</a></article><div>w6</div>", "1 0"),
    ("<body><article><h1>w10</h1><p>w120<div class=ad><p>w14</div><p>w60<div class='share-buttons'><a>w1</a> <a>w1</a></div><form><p>w5</form><div class=comments><p>w55<p>w35<p>w100</div></article><div class=related><ul><li><a>w6</a><li><a>w7</a></ul></div>", "11 0 1 0 0 000 00"),
    ("<body><div class=banner>w30</div><div class=popup><p>w60</div><div><p>w40<p>w75<p>w5<p>w66</div><div class=newsletter>w20 <a>w2</a></div>", "00 1111 0"),
    ("<body><main><div class=breadcrumbs><a>w1</a> w1 <a>w1</a></div><h1>w6</h1><blockquote>w25</blockquote><pre>w40</pre><dl><dt>w1<dd>w9<dt>w2<dd>w7</dl></main><div>w35</div><div>w8 <a>w8</a></div>", "0 1111111 00"),
    ("<body><article><h1>w2</h1><p>w40<ul><li><a>w3</a><li><a>w1</a></ul><h2>w1</h2><p>w9<p><a>w2</a><p><a>w30</a><h2>w2</h2><p>w3<p><a>w4</a></article>", "11111111111"),
    ("<body><main><p>w1<p>w1<p>w5<p><a>w1</a><p>w2 <a>w2</a><p>w2<p><a>w60</a></main><p>w90", "1111111 0"),
    ("<body><h2>w2</h2><p>w30</p><ul><li><a>w2</a><li><a>w3</a></ul><h2>w3</h2><p>w50<p>w15<ul><li>w2 <a>w1</a><li>w9</ul><p>w28<p><a>w2</a>", "1100 111 11 1 0"),
    ("<body><div class=menu><a>w1</a> w1</div><div class=tags>w1 <a>w1</a></div><h1>w4</h1><p>w50<p>w6 <a>w2</a><p>w20<div class=comments><p>w2 <a>w1</a><p>w30 <a>w5</a><p>w8 <a>w2</a><p>w12</div><div class=footer>w2 <a>w1</a></div>", "00 1111 0000 0"),
    ("<body><div class=toolbar>w1 <a>w1</a></div><p>w30 <a>w9</a><p>w2 <a>w1</a><p>w40<div class=share>w2 <a>w1</a> <a>w1</a></div>", "0 111 0"),
    ("<body><article><p>w150</article><div>w20 <a>w30</a></div><div>w25</div><div>w12 <a>w17</a></div><div>w30</div><div>w3 <a>w4</a></div><div>w50</div><div>w9 <a>w4</a></div><div>w33</div>", "1 00000000"),
    ("<body><div><a>w1</a></div><div>w1</div><div><a>w2</a></div><div>w24</div><div><a>w6</a></div><div>w31</div><div>w2</div><div><a>w1</a></div><div>w5</div><div><a>w2</a></div>", "000 1 0 1 0000"),
    ("<body><ul><li><a>w2</a><li><a>w1</a></ul><div><h1>w7</h1><div>w25 <a>w2</a></div><div>w33</div><ul><li>w6<li>w9</ul><div>w48</div></div><div>w2 <a>w3</a></div><div><a>w3</a></div>", "00 111111 00"),
)

Tree = tuple  # (probability,) or (feature, threshold, tree up to it, tree above it)


def labelled(layouts: tuple[tuple[str, str], ...] = LAYOUTS) -> tuple[tuple, ...]:
    """The rows that the tree is grown on: kept (0 or 1), then the features."""
    out = []
    for page, kept in layouts:
        found = blocks(re.sub(r"\bw(\d+)\b", lambda m: " ".join(["word"] * int(m[1])), page))
        labels = kept.replace(" ", "")
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks, {len(labels)} labels: {page}")
        out += [(int(k), *row[1:]) for k, row in zip(labels, features(found), strict=True)]
    return tuple(out)


def grow(rows: tuple, depth: int = 8, least: int = 1) -> Tree:
    """A Gini tree; ties go to the first feature and the lowest threshold."""
    share = sum(r[0] for r in rows) / len(rows)
    if depth == 0 or share in (0, 1) or len(rows) < 2 * least:
        return (share,)
    best: tuple = (share * (1 - share) * len(rows) - 1e-9, None)
    for f in range(1, len(rows[0])):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:], strict=False):
            low = [r[0] for r in rows if r[f] <= lo]
            n, k, total = len(low), sum(low), share * len(rows)
            if n < least or len(rows) - n < least:
                continue
            score = k * (1 - k / n) + (total - k) * (1 - (total - k) / (len(rows) - n))
            if score < best[0] - 1e-9:
                best = (score, f, (lo + hi) / 2)
    if best[1] is None:
        return (share,)
    _, f, at = best
    return (f, at, grow(tuple(r for r in rows if r[f] <= at), depth - 1, least), grow(tuple(r for r in rows if r[f] > at), depth - 1, least))


def kept(tree: Tree, row: tuple) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0] >= 0.5


def features(found: list[Block]) -> list[tuple]:
    """A row for each block: None for the label, words, link density, the same of the block before and of the block after, furniture, place. A missing
    neighbour has no words and no links."""
    edge = Block()
    around = [edge, *found, edge]
    return [
        (None, b.words, b.link_density, a.words, a.link_density, c.words, c.link_density, int(b.furniture), b.place)
        for a, b, c in zip(around, found, around[2:], strict=False)
    ]


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    return "\n\n".join(b.text for b, row in zip(found, features(found), strict=True) if kept(tree, row))


def html_extraction(pages: DataFrame, layouts: tuple[tuple[str, str], ...] = LAYOUTS) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages."""
    tree = grow(labelled(layouts))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), tree) for x in batch["html"]]
            yield pa.record_batch([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
