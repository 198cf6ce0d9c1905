"""HTML extraction: blocks of text are labelled content or boilerplate by a minimum cut.

A page is cut into blocks at its block elements. A linear classifier gives each block its log-odds of being content, which
become the capacity of its edge to the source or the sink. Smoothness edges join blocks that follow one another and blocks
that share a parent, so a short paragraph goes with what stands around it. The cut of least capacity separates the two.

A block whose own capacity outweighs all its edges has the same label in every minimum cut; such blocks are settled first,
one after another, and only what is left goes through max-flow.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.llm.textbytes import by_size

# Element names by what they mean for the text inside.
RAW = frozenset("script style textarea title noscript iframe template xmp noframes noembed".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre"
    " search section select summary table tbody td tfoot th thead tr ul object svg".split()
)
# A start tag of the first ends an open element of the second, unless one of the third lies between.
ENDS = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "option": ("option", "select"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# The classifier's log-odds. Of an element and of the words in its class, id and role; what lies inside inherits them.
TAG_ODDS = {
    "article": 6.0, "main": 5.0, "nav": -16.0, "footer": -16.0, "aside": -16.0, "menu": -16.0, "button": -16.0,
    "select": -16.0, "dialog": -16.0, "header": -8.0, "head": -40.0, "object": -16.0, "svg": -16.0, "fieldset": -16.0, "search": -16.0,
}
WORD_ODDS = {
    **dict.fromkeys(
        "ad ads adv advert adverts advertisement advertising advertorial banner sponsor sponsored promo promoted promotion"
        " cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall"
        " sidebar sidebars widget widgets related recommended recommendations trending popular share sharing social"
        " comment comments commentlist disqus replies reply respond discussion reader-comments reactions"
        " nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager skip"
        " login signin signup subscribe subscription newsletter search searchbox copyright legal disclaimer"
        " complementary contentinfo navigation".split(),
        -16.0,
    ),
    "header": -8.0, "article": 3.0, "content": 2.0, "main": 3.0, "post": 2.0, "entry": 2.0, "story": 2.0, "body": 1.0, "text": 1.0,
}
# Listed words that as often say what a text is about: they need company that is listed too.
UNCERTAIN = frozenset(
    "alert banner consent discussion disclaimer legal menu menus notice notices notification popular promotion reactions related reply"
    " replies search share sharing social trending copyright subscription".split()
)
# Words of names that say nothing of what is inside.
STRUCTURE = frozenset(
    "area bar block bottom box buttons center column container footer form group holder icons inner item items js left links list lists"
    " media outer page panel posts primary right row secondary section site slot title top unit wrap wrapper".split()
)
FORM, WEAK = -16.0, -2.0
BIAS, PER_CHAR, MOST_CHARS, PER_LINK, SENTENCE, HEADING = -0.5, 0.012, 250, -5.0, 1.0, 1.0
ADJACENT, APART, SIBLING = 1.2, 0.3, 0.6

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^<>])*+)>?")  # quotes count after = only
ATTRIBUTE = re.compile(r"([^\s/=>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
READ = frozenset("class id role hidden style aria-hidden".split())
# A form with one of these inside is round a page, not a form of it.
PAGE_PARTS = frozenset("article main nav aside".split())
# An open paragraph goes on below these.
KEEPS_P = frozenset("td th button object caption".split())
# Words that say what a page has or lacks elsewhere, as "has-sidebar" on a wrapper of the whole page.
LAYOUT = re.compile(r"(?:has|with|without|no|is)-")
# Class names that say what a post is about, as "category-legal"; on an article they say nothing about its place on the page.
TOPIC = re.compile(r"(?:post-)?(?:category|categories|cat|tags?|topics?|subject|term|taxonomy|type|author)-")


class Node:
    """An open element: its ``odds`` are the sum over itself and what it lies in, ``weak`` if names of little weight are among them.

    ``form`` is the number of the form around, and ``p_at`` the place on the stack of the paragraph that a block start would end.
    """

    __slots__ = ("tag", "odds", "weak", "in_link", "in_article", "number", "form", "p_at")

    def __init__(
        self, tag: str, odds: float, weak: bool, in_link: bool, in_article: bool, number: int, form: int | None, p_at: int
    ) -> None:
        self.tag, self.odds, self.weak, self.in_link, self.in_article = tag, odds, weak, in_link, in_article
        self.number, self.form, self.p_at = number, form, p_at


def attributes_of(raw: str) -> dict[str, str]:
    """The values, in lower case, of those attributes that count; of repeated ones the first holds."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        name = m[1].lower()
        if name in READ:
            found.setdefault(name, unescape(m[2] or m[3] or m[4] or "").lower())
    return found


def undisplayed(style: str) -> bool:
    declared = (x.partition(":") for x in style.split(";"))
    return any(name.strip() == "display" and value.split("!")[0].strip() == "none" for name, _, value in declared)


def name_odds(name: str, in_article: bool) -> float:
    """The odds of one class name or the like, ``WEAK`` if a listed word is but a part of it.

    A compound is boilerplate if its last word is, words of structure apart ("cookie-notice", "share-bar"); if that word is
    uncertain, no other may be unknown ("market-share"). With an unknown or a content word in its place ("social-security",
    "legal-content") the name is weak.
    """
    listed = {k: v for k, v in ((w, WORD_ODDS.get(w, 0.0)) for w in (name, *name.split("-"))) if not (k == "header" and in_article)}
    if LAYOUT.match(name) or listed.get(name):
        return 0.0 if LAYOUT.match(name) else listed[name]
    parts = [x for x in (w.rstrip("0123456789") for w in name.split("-")) if x]
    odds = [0.0 if w == "header" and in_article else WORD_ODDS.get(w, 0.0) for w in parts]
    if min(odds, default=0.0) >= 0:
        return max(odds, default=0.0)
    last = max(i for i, w in enumerate(parts) if w not in STRUCTURE or odds[i] < 0)
    known = all(x or w in STRUCTURE for x, w in zip(odds, parts, strict=True))
    return odds[last] if odds[last] < 0 and (known or parts[last] not in UNCERTAIN) else WEAK


def own_odds(tag: str, attributes: str, in_article: bool) -> tuple[float, bool]:
    """The odds that an element adds for what lies inside, but for ``WEAK``, and whether that is to be added as well.

    Of an article or main only whole names of its class and role count, uncertain ones weakly; its id names its subject.
    """
    odds, weak = TAG_ODDS.get(tag, 0.0), False
    if tag == "header" and in_article:
        odds = 0.0  # the heading of the article itself
    if attributes and tag not in ("html", "body"):
        against = [0.0]
        for name, value in attributes_of(attributes).items():
            if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and undisplayed(value):
                odds -= 16.0
            elif tag in ("article", "main") and name != "style" and name != "aria-hidden":
                found = [WORD_ODDS.get(x, 0.0) for x in value.split() if name != "id" and x not in UNCERTAIN]
                weak |= name != "id" and any(x in UNCERTAIN for x in value.split())
                against.append(min(found, default=0.0))
                odds += max(found, default=0.0) if against[-1] >= 0 else 0.0
            elif name in ("class", "id", "role"):
                names = value.replace("_", "-").split()
                if name == "class" and any(TOPIC.match(x) for x in names):
                    others = [x for x in names if not TOPIC.match(x)]
                    names = others if max((name_odds(x, in_article) for x in others), default=0.0) > 0 else names
                found = [name_odds(x, in_article) for x in names]
                weak |= WEAK in found
                against.append(min((x for x in found if x != WEAK), default=0.0))
                odds += max(found, default=0.0) if min(found, default=0.0) >= 0 else 0.0
        odds += min(0.0, *against)
    return odds, weak


def blocks_of(html: str) -> list[tuple[str, float, tuple[int, int]]]:
    """Text, log-odds and the numbers of parent and grandparent of each block in page order; blocks without text are left out.

    A form is boilerplate unless it is round a page: a part of a page starts in it, or over half of the text is in its paragraphs.
    """
    found: list[tuple[str, float, tuple[int, int]]] = []
    stack = [Node("", 0.0, False, False, False, 0, None, -1)]
    open_tags: Counter[str] = Counter()
    forms: list[int | None] = []  # of each block found
    form_around: dict[int, int | None] = {}
    form_text: Counter[int] = Counter()
    round_page: set[int | None] = {None}
    pieces: list[str] = []
    linked = 0
    numbers = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                node = stack[-1]
                i = len(stack) - 1
                while i and stack[i].tag not in BLOCK:
                    i -= 1
                odds = node.odds + BIAS + PER_CHAR * min(len(text), MOST_CHARS) + PER_LINK * min(1.0, linked / len(text))
                odds += WEAK * node.weak + SENTENCE * (text[-1] in ".!?…:;\"'”»)") + HEADING * (stack[i].tag in HEADINGS)
                # Blocks of one container are siblings: the number is that of the element around the block's own.
                found.append((text, odds, (stack[max(i - 1, 0)].number, stack[max(i - 2, 0)].number)))
                forms.append(node.form)
                if node.form is not None and stack[i].tag == "p":
                    form_text[node.form] += len(text)
            pieces.clear()
        linked = 0

    def cut(i: int) -> None:
        for node in stack[i:]:
            open_tags[node.tag] -= 1
        del stack[i:]

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = unescape(raw)
            pieces.append(raw)
            if stack[-1].in_link:
                linked += len(raw)

    at, n = 0, len(html)
    while at < n:
        begin = html.find("<", at)
        if begin < 0:
            text(html[at:])
            break
        after = html[begin + 1 : begin + 2]
        if after == "!" or after == "?":
            text(html[at:begin])
            if html.startswith("<!--", begin):
                end = html.find("-->", begin + 4)
                at = n if end < 0 else end + 3
            elif html.startswith("<![CDATA[", begin):
                end = html.find("]]>", begin)
                text(html[begin + 9 : n if end < 0 else end])
                at = n if end < 0 else end + 3
            else:
                end = html.find(">", begin)
                at = n if end < 0 else end + 1
            continue
        m = TAG.match(html, begin)
        if not m:
            text(html[at : begin + 1])
            at = begin + 1
            continue
        text(html[at:begin])
        at = m.end()
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if closing:
            if tag == "br":
                pieces.append(" ")
            elif open_tags[tag]:
                if tag in BLOCK:
                    flush()
                    i = len(stack) - 1
                    while stack[i].tag != tag:
                        i -= 1
                    cut(i)
                else:  # an inline end tag never closes a block
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag:
                            del stack[i]
                            open_tags[tag] -= 1
                            break
                        if stack[i].tag in BLOCK:
                            break
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if stack[-1].p_at >= 0:  # a block start ends an open paragraph
                cut(stack[-1].p_at)
            if tag in ENDS and any(open_tags[x] for x in ENDS[tag][0]):
                ended, until = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in until:
                        break
                    if stack[i].tag in ended:
                        cut(i)
                        if tag != "tr":
                            break
        if tag in VOID:
            continue
        numbers += 1
        top = stack[-1]
        if tag in PAGE_PARTS:
            around = top.form
            while around not in round_page:
                round_page.add(around)
                around = form_around[around]
        if not attributes.endswith("/"):
            odds, weak = own_odds(tag, attributes, top.in_article)
            form, p_at = top.form, len(stack) if tag == "p" else -1 if tag in KEEPS_P else top.p_at
            if tag == "form":
                form_around[numbers], form = form, numbers
            in_article = top.in_article or tag in ("article", "main")
            stack.append(Node(tag, top.odds + odds, top.weak or weak, top.in_link or tag == "a", in_article, numbers, form, p_at))
            open_tags[tag] += 1
    flush()
    for form in sorted(form_around, reverse=True):  # inner ones first
        if form_around[form] is not None:
            form_text[form_around[form]] += form_text[form]
    most = sum(len(text) for text, _, _ in found) / 2
    round_page.update(x for x in form_text if form_text[x] > most)
    return [(text, odds + FORM * (form not in round_page), place) for (text, odds, place), form in zip(found, forms, strict=True)]


def smoothness(places: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order, weaker ones if their parents are neither one nor parent and child, and between
    each block and the one before it under the same parent."""
    edges = []
    for i in range(1, len(places)):
        (a, above_a), (b, above_b) = places[i - 1], places[i]
        edges.append((i - 1, i, ADJACENT if a == b or above_a == b or a == above_b else APART))
    before: dict[int, int] = {}
    for i, (parent, _) in enumerate(places):
        if parent in before:
            edges.append((before[parent], i, SIBLING))
        before[parent] = i
    return edges


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut; capacities are in thousandths. A tie is boilerplate."""
    own = [round(1000 * x) for x in odds]
    near: list[dict[int, int]] = [{} for _ in own]
    for i, j, weight in edges:
        w = round(1000 * weight)
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    total = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * len(own)
    queue = deque(range(len(own)))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(own[i]) > total[i] or label[i] is None and not near[i]:
            label[i] = own[i] > 0
            for j, w in near[i].items():
                own[j] += w if label[i] else -w
                total[j] -= w
                del near[j][i]
                queue.append(j)
            near[i] = {}
    left = [i for i in range(len(own)) if label[i] is None]
    if left:
        side = max_flow_side({i: own[i] for i in left}, {i: near[i] for i in left})
        for i in left:
            label[i] = i in side
    return [bool(x) for x in label]


def max_flow_side(own: dict[int, int], near: dict[int, dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after max-flow.

    In each round, nodes get their distance from the source, and flow goes along shortest ways until all of them are full.
    """
    room = {i: dict(x) for i, x in near.items()}
    source = {i: x for i, x in own.items() if x > 0}
    sink = {i: -x for i, x in own.items() if x < 0}
    while True:
        depth = {i: 0 for i, x in source.items() if x > 0}
        queue, reached = deque(depth), False
        while queue:
            i = queue.popleft()
            reached |= sink.get(i, 0) > 0
            for j, x in room[i].items():
                if x > 0 and j not in depth:
                    depth[j] = depth[i] + 1
                    queue.append(j)
        if not reached:
            return set(depth)
        open_ways = {i: [j for j in room[i] if depth.get(j) == depth[i] + 1] for i in depth}
        for start in [i for i, x in source.items() if x > 0]:
            path = [start]
            while path and source[start] > 0:
                i = path[-1]
                if sink.get(i, 0) > 0:
                    flow = min([source[start], sink[i], *(room[a][b] for a, b in zip(path, path[1:], strict=False))])
                    source[start] -= flow
                    sink[i] -= flow
                    full = len(path)
                    for k, (a, b) in reversed(list(enumerate(zip(path, path[1:], strict=False), 1))):
                        room[a][b] -= flow
                        room[b][a] += flow
                        full = k if not room[a][b] else full
                    del path[full:]
                elif open_ways[i] and (not room[i][open_ways[i][-1]]):
                    open_ways[i].pop()
                elif open_ways[i]:
                    path.append(open_ways[i][-1])
                else:
                    path.pop()
                    if path:
                        open_ways[path[-1]].pop()


def main_text(html: str | None) -> str:
    """The blocks labelled content, joined by line feeds."""
    blocks = blocks_of(html or "")
    content = min_cut([b[1] for b in blocks], smoothness([b[2] for b in blocks]))
    return "\n".join(b[0] for b, keep in zip(blocks, content, strict=True) if keep)


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html`` and with ``text``, the main text: white space runs inside a block are one space, blocks one line each.

    A null or empty page, or one without content, has an empty text. A column that is already called ``text`` is replaced.
    Pages are independent of one another: one pass, no shuffle, repeated rows stay repeated.
    """
    names = [c for c in pages.columns if c not in (html, text)]
    schema = T.StructType([pages.schema[c] for c in names] + [T.StructField(text, T.StringType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "__html", 1 << 20):
            texts = [main_text(page) for page in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*names, text])

    return pages.select(*names, pages[html].alias("__html")).mapInArrow(extract, schema)
