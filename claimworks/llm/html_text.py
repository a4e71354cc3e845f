"""Main text of web pages: boosted trees over DOM nodes and hierarchical decoding."""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm import boosting
from claimworks.llm.common import table

SAMPLE_PAGES = 600  # pages the trees are fitted on: those with the smallest checksum of their html
SAMPLE_CHARS = 200_000  # longer pages are extracted, but not learned from
MAX_DEPTH = 200  # elements nested deeper get no node; their text hangs below this level
MAX_LEFT_OPEN = 20  # elements a page never ends that are each followed by one more parse
BATCH_NODES = 20_000
MAIN_BONUS = 2.0  # log-odds added below elements whose names mark main text
NAME_PENALTY = 12.0  # log-odds taken from an element whose own names say boilerplate, and from no other
WHOLE = 0.9  # an element with this share of the page's text is the page: its words tell nothing apart

# Element classes of HTML, and words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset(
    "script style noscript template iframe svg math title label button select textarea object canvas audio "
    "video map dialog".split()
)
#: What cannot hold blocks: a start tag of the second kind ends it, if the author did not.
FLAT = frozenset("svg math title label button select textarea".split())
BREAKS = frozenset(
    "address article aside blockquote dl footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption summary caption".split())
BOILERPLATE_TAGS = frozenset("nav aside footer header menu".split())
MAIN_TAGS = frozenset("article main".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies copyright disclaimer disqus discussion footer footnav form gdpr header hidden legal login masthead menu modal nav "
    "navbar navigation newsletter notice notification overlay pager pagination paywall popup promo promoted "
    "promotion recommend recommended related replies reply reply responses share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags teaser toolbar topbar tracking widget widgets complementary "
    "contentinfo search alert aside outbrain taboola respond".split()
)
MAIN_WORDS = frozenset("article articlebody body content entry main mainentity post story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")


class Dom(HTMLParser):
    """Block-level nodes in page order with their text; tags that HTML lets an author leave open are closed."""

    def __init__(self, plain=frozenset()):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.attr_words = ["#root"], [-1], [()]
        self.text, self.link_chars = [[]], [0]
        self.open = [("#root", 0)]  # element name, its node
        self.skip = []  # the open element whose content is left out, and those inside it
        self.skip_at, self.left_open = None, set()  # where it begins; where those begin that the page never ended
        self.plain = plain  # beginnings of such elements, known from a parse before, or None for all: their tags are passed over
        self.count = Counter()  # open elements by name
        self.links = 0
        self.run: list[str] = []
        self.run_links = 0

    def node(self, tag, words=()):
        self.tag.append(tag)
        self.parent.append(self.open[-1][1])
        self.attr_words.append(words)
        self.text.append([])
        self.link_chars.append(0)
        return len(self.tag) - 1

    def flush(self):
        """The text collected so far is a block of the innermost block element."""
        if self.run:
            text = SPACE.sub(" ", "".join(self.run)).strip()
            links, self.run, self.run_links = self.run_links, [], 0
            if text:
                at = self.open[-1][1]
                if self.tag[at] not in TEXTUAL or self.text[at]:
                    at = self.node("#text")
                self.text[at].append(text)
                self.link_chars[at] += min(links, len(text))

    def close_to(self, depth):
        self.flush()
        while len(self.open) > depth:
            name = self.open.pop()[0]
            self.count[name] -= 1
            if name == "a":
                self.links = max(0, self.links - 1)

    def enter(self, tag, at):
        self.open.append((tag, at))
        self.count[tag] += 1

    def unskip(self):
        """An element left open by its author ends; what was opened inside gets no node, but keeps its end tag."""
        inside, self.skip = self.skip[1:], []
        for tag in inside:
            self.links += tag == "a"
            self.enter(tag, self.open[-1][1])

    def handle_starttag(self, tag, attrs):
        if tag == "head":
            return  # what it may hold is left out by itself; its end tag is optional
        if self.skip:
            if not (tag == "body" and not self.count["body"] or tag in BREAKS and self.skip[0] in FLAT and "foreignobject" not in self.skip):
                if tag not in VOID:
                    self.skip.append(tag)
                return
            self.unskip()
        if tag in SKIP:
            self.flush()
            if tag in ("script", "style") or self.plain is not None and self.getpos() not in self.plain:
                self.skip.append(tag)
                self.skip_at = self.getpos()
            return
        if tag == "br":
            self.run.append("\n")
            return
        if tag == "body" and self.count["body"]:
            return
        if tag in BLOCK or tag in VOID and tag == "hr":
            for i in range(len(self.open) - 1, 0, -1):
                name = self.open[i][0]
                if name == "p":
                    self.close_to(i)
                    break
                if name in BLOCK:
                    break
        if tag in ENDS and any(self.count[t] for t in ENDS[tag]):
            for i in range(len(self.open) - 1, 0, -1):
                name = self.open[i][0]
                if name in ENDS[tag]:
                    self.close_to(i)
                    break
                if name in SCOPE.get(tag, ()):
                    break
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag == "a":
            self.links += 1
        if tag not in BLOCK:
            self.enter(tag, self.open[-1][1])
            return
        self.flush()
        if len(self.open) > MAX_DEPTH:
            self.enter(tag, self.open[-1][1])
            return
        words = []
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                words.extend(WORD.findall(CAMEL.sub(" ", value).lower()))
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                words.append("hidden")
            elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
                words.append("hidden")
        at = self.node(tag, tuple(words))
        self.enter(tag, at)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "section", "article"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
                return
            if tag not in BLOCK or not self.count[tag]:
                return
            if tag in ("body", "html"):
                self.never_ended()
            self.unskip()  # an enclosing block ends
        if tag in ("body", "html"):
            self.flush()
            return
        if not self.count[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name == tag:
                if tag in BLOCK:
                    self.close_to(i)
                else:
                    # an inline end tag leaves other open inline elements alone
                    del self.open[i]
                    self.count[tag] -= 1
                    if tag == "a":
                        self.links = max(0, self.links - 1)
                return
            if tag not in BLOCK and name in BLOCK:
                return

    def never_ended(self):
        if self.skip and self.skip[0] not in ("script", "style"):
            self.left_open.add(self.skip_at)

    def handle_data(self, data):
        if not self.skip:
            self.run.append(data)
            if self.links:
                self.run_links += len(data.strip())


def parsed(html: str) -> Dom:
    plain: frozenset | None = frozenset()
    while True:
        dom = Dom(plain)
        dom.feed(html)
        dom.close()
        dom.never_ended()
        if plain is None or dom.left_open <= plain:
            break
        plain = plain | dom.left_open if len(plain) < MAX_LEFT_OPEN else None
    dom.skip = []
    dom.flush()
    return dom


FEATURES = [
    "boilerplate tag", "main tag", "boilerplate words",
    "main words", "boilerplate above", "main above", "depth", "own chars", "subtree chars", "subtree share",
    "link share", "chars per node", "boilerplate below", "main below", "siblings", "place", "same tag share",
    "sibling chars", "sentence marks", "child count", "mean chars of blocks below", "text place",
    "form above",
]
#: What a page tells only by its markup's names; hidden from the trees in half of the training rows.
NAMED = [FEATURES.index(n) for n in (
    "boilerplate tag", "main tag", "boilerplate words", "main words", "boilerplate above", "main above",
    "boilerplate below", "main below",
)]


def names(dom: Dom) -> tuple[list[int], list[int], list[bool]]:
    """Per node the boilerplate words and main words of its names, and whether they say boilerplate and nothing else.

    Words on html, body and whatever else holds nearly all text (a layout class such as right-sidebar) do not count.
    """
    below = [sum(map(len, t)) for t in dom.text]
    for i in range(len(below) - 1, 0, -1):
        below[dom.parent[i]] += below[i]
    bad, good, plain = [], [], []
    for tag, words, chars in zip(dom.tag, dom.attr_words, below):
        page = tag in ("html", "body") or chars >= WHOLE * max(1, below[0])
        bad.append(0 if page else sum(w in BOILERPLATE_WORDS for w in words))
        good.append(sum(w in MAIN_WORDS for w in words))
        plain.append(bad[-1] > 0 and not good[-1] and tag not in MAIN_TAGS)
    return bad, good, plain


def features(dom: Dom) -> np.ndarray:
    n = len(dom.tag)
    own = [sum(map(len, t)) for t in dom.text]
    marks = [sum(s.count(".") + s.count("?") + s.count("!") + s.count(",") for s in t) for t in dom.text]
    below, links, count, kids, blocks = own[:], dom.link_chars[:], [1] * n, [0] * n, [0] * n
    bad_tag = [t in BOILERPLATE_TAGS for t in dom.tag]
    good_tag = [t in MAIN_TAGS for t in dom.tag]
    bad, good, plain = names(dom)
    bad_below, good_below = [0] * n, [0] * n
    all_marks = marks[:]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n):
        blocks[i] = own[i] > 0
    for i in range(n - 1, 0, -1):
        p = dom.parent[i]
        children[p].append(i)
        below[p] += below[i]
        links[p] += links[i]
        count[p] += count[i]
        blocks[p] += blocks[i]
        all_marks[p] += all_marks[i]
        kids[p] += 1
        bad_below[p] += bad_below[i] + (bad_tag[i] or plain[i])
        good_below[p] += good_below[i] + (good_tag[i] or good[i] > 0)
    total = max(1, below[0])
    out = np.zeros((n, len(FEATURES)))
    depth, bad_above, good_above, form, seen = [0] * n, [0] * n, [0] * n, [0] * n, 0
    place, mates, same, near = [0.0] * n, [0] * n, [0.0] * n, [0.0] * n
    for group in children:
        group.reverse()
        m = len(group)
        if not m:
            continue
        chars = sum(below[c] for c in group)
        tags: dict[str, int] = {}
        for c in group:
            tags[dom.tag[c]] = tags.get(dom.tag[c], 0) + 1
        for k, c in enumerate(group):
            place[c], mates[c], same[c] = k / m, m, tags[dom.tag[c]] / m
            near[c] = (chars - below[c]) / max(1, m - 1)
    for i in range(n):
        p = dom.parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            form[i] = form[p] or dom.tag[i] == "form"
            bad_above[i] = bad_above[p] + (bad_tag[p] or plain[p])
            good_above[i] = good_above[p] + (good_tag[p] or good[p] > 0)
        out[i] = (
            bad_tag[i], good_tag[i], bad[i], good[i], bad_above[i], good_above[i], depth[i], own[i],
            below[i], below[i] / total, links[i] / max(1, below[i]), below[i] / count[i], bad_below[i],
            good_below[i], mates[i], place[i], same[i], near[i], all_marks[i] / max(1, below[i]), kids[i],
            below[i] / max(1, blocks[i]), seen / total, form[i],
        )
        seen += own[i]
    return out


def weak_labels(dom: Dom) -> np.ndarray:
    """Content or not by what the markup's names say; -1 for a page whose names do not say where its main text is."""
    n = len(dom.tag)
    state = np.zeros(n, int)  # 0 outside, 1 inside main text, 2 inside boilerplate
    out = np.zeros(n)
    if not any(t in MAIN_TAGS for t in dom.tag) and not any(
        w in ("articlebody", "article", "main") for ws in dom.attr_words for w in ws
    ):
        return np.full(n, -1.0)
    bad, _, plain = names(dom)
    chars, titled = [sum(map(len, t)) for t in dom.text], [t in ("h1", "h2") for t in dom.tag]
    for i in range(n - 1, 0, -1):
        chars[dom.parent[i]] += chars[i]
        titled[dom.parent[i]] |= titled[i]
    for i in range(1, n):
        up = state[dom.parent[i]]
        tag, words = dom.tag[i], dom.attr_words[i]
        # names that say both (content with-sidebar, entry-header) go by what the element holds
        named_bad = plain[i] or bad[i] > 0 and not titled[i] and 2 * chars[i] < chars[0]
        named_main = tag in MAIN_TAGS or any(w in ("articlebody", "article", "main") for w in words)
        if up == 2 or named_bad or tag in BOILERPLATE_TAGS and not (tag == "header" and up == 1):
            state[i] = 2
        elif up == 1 or named_main:
            state[i] = 1
        out[i] = state[i] == 1
    for i in range(n - 1, 0, -1):
        if out[i] and state[dom.parent[i]] != 2:
            out[dom.parent[i]] = 1.0  # what holds main text cannot be rejected
    out[0] = 1.0
    return out


def train(pages: list[str]):
    """Trees over the nodes of pages whose names mark the main text; None if they show only one class."""
    xs, ys = [], []
    for html in pages:
        dom = parsed(html)
        y = weak_labels(dom)
        if len(y) and y[0] >= 0 and len(y) > 1:
            xs.append(features(dom)[1:])
            ys.append(y[1:])
    if not xs:
        return None
    x, y = np.concatenate(xs), np.concatenate(ys)
    if y.min() == y.max():
        return None
    # every other row loses the names, so that shape has to decide as well
    blind = x.copy()
    blind[:, NAMED] = 0
    return boosting.fit(np.concatenate([x, x, blind]), np.concatenate([y, y, y]))


def fallback(x: np.ndarray) -> np.ndarray:
    """Log-odds when no page could teach the trees: names where there are any, else length and links."""
    f = {n: x[:, i] for i, n in enumerate(FEATURES)}
    bad = f["boilerplate tag"] + f["boilerplate words"] + f["boilerplate above"]
    good = f["main tag"] + f["main words"] + f["main above"]
    return 0.5 + good - 4 * (bad > good) - 3 * (f["link share"] > 0.5)


def disliked(dom: Dom, inside: list[bool]) -> list[bool]:
    """Nodes whose own names say boilerplate and nothing else; a header of or inside main text may hold the title."""
    _, good, plain = names(dom)
    return [
        plain[i] or tag in BOILERPLATE_TAGS and not (tag == "header" and (inside[i] or good[i]))
        for i, tag in enumerate(dom.tag)
    ]


def decode(dom: Dom, odds: np.ndarray) -> str:
    """The best consistent choice: a node is kept only if all its ancestors are.

    Every node is worth its log-odds if kept and nothing if rejected, together with all below it.  One pass
    from the leaves up finds the worth of each subtree, one pass down keeps what is worth more than nothing.
    A heading shares the fate of what follows it.  Names that say boilerplate cost their element ``NAME_PENALTY``
    and no more, so enough main text below outweighs them.
    """
    n = len(dom.tag)
    inside = [False] * n
    bad, good, _ = names(dom)
    for i in range(1, n):
        p = dom.parent[i]
        inside[i] = inside[p] or dom.tag[p] in MAIN_TAGS or (
            dom.tag[p] not in ("html", "body") and good[p] > 0 and not bad[p]
        )
    worth = odds.tolist()
    for i in range(n):
        if inside[i]:
            worth[i] += MAIN_BONUS
    if all(t in ("#root", "#text", "html", "body") for t in dom.tag):
        worth = [1.0] * n  # no structure to choose from
    costs = disliked(dom, inside)
    for i in range(n):
        if costs[i]:
            worth[i] -= NAME_PENALTY
    following: dict[int, int] = {}  # last node seen below each parent: the next sibling
    for i in range(n - 1, 0, -1):
        p = dom.parent[i]
        if worth[i] <= 0 and dom.tag[i] in HEADINGS and not costs[i]:
            heads = following.get(p, following.get(dom.parent[p]) if dom.tag[p] in ("header", "hgroup") and not costs[p] else None)
            if heads is not None and worth[heads] > 0:
                worth[i] = worth[heads]  # a heading goes with what it heads
        if worth[i] > 0:
            worth[p] += worth[i]
        following[p] = i
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[dom.parent[i]] and worth[i] > 0
    return "\n\n".join(t for i in range(n) if keep[i] for t in dom.text[i])


def extract_task(model, keep):
    def run(batches):
        for batch in batches:
            html = batch.column(keep)
            start, doms, parts, held = 0, [], [], 0
            for i in range(batch.num_rows):
                dom = parsed(html[i].as_py() or "")
                x = features(dom)
                doms.append(dom)
                parts.append(x)
                held += len(x)
                if held >= BATCH_NODES or i + 1 == batch.num_rows:
                    flat = np.concatenate(parts)
                    odds = boosting.predict(model, flat) if model else fallback(flat)
                    cuts = np.cumsum([len(p) for p in parts])[:-1]
                    texts = [decode(d, o) for d, o in zip(doms, np.split(odds, cuts))]
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).slice(start, len(texts)) for k in range(keep)), pa.array(texts, pa.string())],
                        [*batch.schema.names[:keep], "text"],
                    )
                    start, doms, parts, held = i + 1, [], [], 0

    return run


def extract(pages: DataFrame, keys=("page_id", "url"), html: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``keys`` and ``text``, the main text of every row's whole html.

    The trees are fitted on at most ``sample_pages`` pages whose element and attribute names mark the main
    text; in half of the training rows those names are hidden, so that density, depth and siblings decide on
    pages that name nothing.  A null or empty html gives an empty text; rows may repeat; keys may be null;
    other columns are ignored; an empty table gives no rows.
    """
    body = F.col(html).cast("string")
    # only a share of the pages, given by their checksum, is ordered at all: a few for each one wanted
    usable = pages.where(body.isNotNull() & (F.length(body) <= SAMPLE_CHARS))
    share = int(2**32 * min(1.0, 4 * sample_pages / max(1, usable.count())))
    sample = (
        usable.select(body.alias("h"), F.crc32(body.cast("binary")).alias("c")).where(F.col("c") <= share)
        .dropDuplicates(["c"]).orderBy("c").limit(sample_pages).select("h")
    )
    model = train([r[0] for r in sample.collect()])  # a sample of bounded size
    picked = pages.select(*keys, body.alias("__html"))
    types = ", ".join(f"`{k}` {picked.schema[k].dataType.simpleString()}" for k in keys)
    return picked.mapInArrow(extract_task(model, len(keys)), f"{types}, text string")


def op9_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op9_html_text": op9_html_text}
