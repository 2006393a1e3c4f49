"""Main text of web pages by a tree-structured graphical model.

A page's block elements and text blocks form a tree. Each node is frame (it holds the main text and other things), content
or other. Node potentials come from what is seen of the node (element, words of its class and id, length, links,
punctuation), parent-child potentials from how states go together. Sum-product messages, once from the leaves up and once
down again, give every node's exact marginals; text blocks that are content with a probability over one half are the
main text.

Both kinds of potentials are counts over labelled pages: those that mark their article themselves.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievecraft.llm import texts

SAMPLE = 3000  # labelled pages learned from, about; taken by a hash of the page
SLICE = 4 << 20
PRIOR = 40.0  # weight, in nodes, of what each prior below says
FRAME, CONTENT, OTHER = range(3)

# Elements by their role in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr br img input"
    " math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover"
    " munderover mmultiscripts mprescripts mtable mtr mtd maction menclose mspace semantics annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|iframe|textarea|title"  # no elements in them; without an end tag they take the rest of the page
UNSEEN = frozenset("template object svg select button canvas".split())  # if they have an end
FOREIGN = frozenset("svg math".split())
ENDS_ITSELF = frozenset("button select".split())  # a second start tag ends the first element
IN_HEAD = frozenset("head base link meta noscript script style template title".split())
CLOSED_BY_BLOCKS = frozenset("p".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table tbody thead tfoot div section article main body".split())

# Words of a class or id that tell what an element is.
HINTS = {
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs",
    "footer": "footer foot copyright legal colophon",
    "header": "header masthead topbar",
    "side": "sidebar aside related widget rail recommend recommended more teaser",
    "notice": "cookie cookies notice consent gdpr popup modal overlay alert newsletter subscribe signup login paywall",
    "comment": "comment comments disqus reply replies respond discussion",
    "share": "share sharing social follow",
    "main": "article content main post entry story text body",
}
_HINT = {word: name for name, words in HINTS.items() for word in words.split()}
# What is seen of nodes that are other, and of content.
OUTSIDE = [
    "tag nav", "tag footer", "tag header", "tag aside", "tag form", "tag fieldset", "tag dialog", "tag menu", "hint advert",
    "hint menu", "hint footer", "hint header", "hint side", "hint notice", "hint comment", "hint share", "links most",
]
MARKS = ("tag article", "tag main")
INSIDE = ["tag article", "tag main", "tag p", "tag blockquote", "hint main", "length long"]
# Shares of frame, content and other nodes that are expected to be seen so.
RATES = {name: (0.002, 0.0005, 0.3) for name in OUTSIDE} | {name: (0.02, 0.2, 0.02) for name in INSIDE}
USUAL = (0.02, 0.02, 0.02)
NEUTRAL = {"tag div", "tag section", "tag table", "tag tbody", "tag tr", "tag td"}  # may be anything
#: How much what is seen may say against a state; text alone says less, as its traits depend on each other.
SURE, PLAIN, TEXT_WEIGHT = 9.0, 3.5, 0.4
PAIRS = np.array([[0.6, 0.1, 0.3], [0.001, 0.899, 0.1], [0.001, 0.001, 0.998]])  # parent, child

_OUT_TAGS = {x[4:] for x in OUTSIDE if x.startswith("tag ")}
def _token(raw_end: str) -> re.Pattern[str]:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        rf"|<({RAW})(?=[\s/>])[^>]*{raw_end}>.*?(?:</\1\s*>|\Z)"
        r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
        r"|</?[a-zA-Z][^>]*>"
        r"|<[!?/][^>]*>",
        re.S | re.I,
    )


_TOKEN, _FOREIGN_TOKEN = _token(""), _token("(?<!/)")  # in drawings and formulas, all elements may be closed by `/>`
_CLASS = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Tree:
    """Nodes of one page in page order: parent, what is seen, text (None for elements), and the element's tag."""

    parent: list[int] = field(default_factory=list)
    seen: list[list[str]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)

    def add(self, parent: int, seen: list[str], tag: str, text: str | None = None) -> int:
        self.parent.append(parent)
        self.seen.append(seen)
        self.tag.append(tag)
        self.text.append(text)
        return len(self.parent) - 1


def _hints(attributes: str) -> set[str]:
    found = set()
    for value in _CLASS.finditer(attributes):
        raw = re.sub(r"([a-z])([A-Z])", r"\1 \2", value[1] or value[2] or value[3] or "").lower()
        found.update(_HINT[word] for word in _WORD.findall(raw) if word in _HINT)
    return found


def _seen_in_text(text: str, linked: int) -> list[str]:
    size = len(text)
    length = "short" if size < 25 else "middle" if size < 120 else "long"
    links = "none" if not linked else "some" if linked * 3 < size else "most"
    stops = sum(map(text.count, ".!?,;:"))
    points = "none" if not stops else "few" if stops * 100 < size else "many"
    return ["tag #text", f"length {length}", f"links {links}", f"points {points}"]


@dataclass
class Token:
    """A tag, comment or raw-text element at page[start:end]. No name: left out; an empty one: left out, and parts words."""

    start: int
    end: int
    name: str | None = None
    closing: bool = False
    attributes: str = ""
    last: int | None = None  # of an unseen element that has an end: the token that ends it


def _tokens(page: str) -> list[Token]:
    """All tokens. Start tags of unseen elements know their end tags; one that a parent's end comes before has none."""
    out: list[Token] = []
    open_: list[tuple[str, int]] = []  # an element that ended itself stays, and its name is empty
    places: dict[str, list[int]] = {}  # in open_, of each name
    foreign, at = 0, 0
    while found := (_FOREIGN_TOKEN if foreign else _TOKEN).search(page, at):
        at = found.end()
        token = Token(found.start(), at, "" if found[1] else None)
        out.append(token)
        if found[3] is None:
            continue
        name = token.name = found[3].lower()
        token.closing, token.attributes = bool(found[2]), found[4] or ""
        if (foreign or name in FOREIGN) and name not in VOID and token.attributes.endswith("/"):
            token.name = ""
            continue
        if name in FOREIGN:
            foreign = max(foreign + (-1 if token.closing else 1), 0)
        if name in INLINE or name in VOID:
            continue
        if token.closing:
            while places.get(name):
                top, k = open_.pop()
                if top:
                    places[top].pop()
                if top == name:
                    if name in UNSEEN:
                        out[k].last = len(out) - 1
                    break
            continue
        own = places.setdefault(name, [])
        if name in ENDS_ITSELF and own:
            open_[own.pop()] = ("", -1)
        own.append(len(open_))
        open_.append((name, len(out) - 1))
    return out


def parsed(page: str) -> Tree:
    """The tree of a page. Unclosed and stray tags are put up with; scripts, styles, comments, form controls, drawings and
    embedded objects are left out. Of these, an element without an end is no element, and its text is kept; only raw text
    (RAW) goes on to the end of the page. A head ends where something begins that cannot be in it."""
    tree = Tree()
    open_: list[tuple[str, int]] = [("#page", tree.add(-1, ["tag #page"], "#page"))]
    places: dict[str, list[int]] = {}  # in open_, of each name
    parts: list[str] = []
    linked, in_link, at, unseen_head = 0, False, 0, False

    def flush() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                tree.add(open_[-1][1], _seen_in_text(text, min(linked, len(text))), "#text", text)
            parts.clear()
        linked, in_link = 0, False

    def close(place: int) -> None:
        """End the elements from a place on; each is ended once, so pages of any depth take time in proportion to them."""
        while len(open_) > place:
            places[open_.pop()[0]].pop()

    def innermost(names) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def words(raw: str) -> None:
        nonlocal linked, unseen_head
        if unseen_head and raw.strip():
            unseen_head = False
        if raw and not unseen_head:
            raw = html.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if in_link:
                linked += len(raw.strip())

    tokens, next_ = _tokens(page), 0
    while next_ < len(tokens):
        token = tokens[next_]
        next_ += 1
        words(page[at : token.start])
        at, name, closing = token.end, token.name, token.closing
        if not name or name in UNSEEN:
            if name is not None and not closing:
                parts.append(" ")
            if token.last is not None:
                next_, at = token.last + 1, tokens[token.last].end
            continue
        if name not in IN_HEAD and not closing:
            unseen_head = False
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                in_link = not closing
            continue
        if name == "head":
            unseen_head = not closing
            continue
        flush()
        if closing:
            if place := innermost((name,)):
                close(place)
            continue
        if name in VOID:
            continue
        if open_[-1][0] in CLOSED_BY_BLOCKS:
            close(len(open_) - 1)
        siblings = SIBLINGS.get(name, ())
        if siblings and (place := innermost(siblings)) > innermost(x for x in LISTS if x not in siblings):
            close(place)
        seen = [f"tag {name}", *sorted(f"hint {x}" for x in _hints(token.attributes))]
        places.setdefault(name, []).append(len(open_))
        open_.append((name, tree.add(open_[-1][1], seen, name)))
    words(page[at:])
    flush()
    return tree


def marked(tree: Tree) -> list[int] | None:
    """States of a page that marks one article: content is what lies in it and in nothing that says to be something else."""
    root = [k for k, tag in enumerate(tree.tag) if tag == "article"] or [
        k for k, tag in enumerate(tree.tag) if tag == "main"
    ]
    if len(root) != 1:
        return None
    state: list[int] = []
    for k, parent in enumerate(tree.parent):
        other = tree.tag[k] in _OUT_TAGS or any(f"hint {x}" in tree.seen[k] for x in HINTS if x != "main")
        inside = k == root[0] or (parent >= 0 and state[parent] == CONTENT and not other)
        state.append(CONTENT if inside else OTHER)
    k = tree.parent[root[0]]
    while k >= 0:
        state[k], k = FRAME, tree.parent[k]
    return state


@dataclass
class Potentials:
    node: dict[str, np.ndarray]  # log potential of each state, by what is seen
    pair: np.ndarray  # log P(child | parent), [parent, child]


def potentials(seen: dict[tuple[str, int], float], pairs: dict[tuple[int, int], float]) -> Potentials:
    """From counts of (what is seen, state) and (state of the parent, state)."""
    nodes = np.array([sum(c for (name, x), c in seen.items() if x == s and name.startswith("tag ")) for s in range(3)])
    out = {}
    for name in {*RATES, *(name for name, _ in seen)}:
        count = np.array([seen.get((name, s), 0.0) for s in range(3)])
        share = np.log((count + PRIOR * np.array(RATES.get(name, USUAL))) / (nodes + PRIOR))
        share = np.maximum(share - share.max(), -(SURE if name in OUTSIDE or name in MARKS else PLAIN))
        if name in NEUTRAL:
            share = share * 0
        out[name] = share * (1.0 if name.startswith(("tag", "hint")) else TEXT_WEIGHT)
    count = np.array([[pairs.get((a, b), 0.0) for b in range(3)] for a in range(3)])
    rate = (count + PRIOR * PAIRS) / (count.sum(axis=1, keepdims=True) + PRIOR)
    rate = np.maximum(rate, PAIRS / 2)  # labels show what is usual, not what never happens
    return Potentials(out, np.log(rate / rate.sum(axis=1, keepdims=True)))


def marginals(parent: np.ndarray, depth: np.ndarray, node: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probabilities of the states of every node of a forest, by messages up and down. Roots are frame."""
    belief = node.copy()
    belief[parent < 0, 1:] = -np.inf
    up = np.zeros_like(belief)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    for nodes in levels[:0:-1]:
        up[nodes] = np.logaddexp.reduce(belief[nodes][:, None, :] + pair[None], axis=2)
        np.add.at(belief, parent[nodes], up[nodes])
    for nodes in levels[1:]:
        above = belief[parent[nodes]] - up[nodes]
        above -= above.max(axis=1, keepdims=True)
        belief[nodes] += np.logaddexp.reduce(above[:, :, None] + pair[None], axis=1)
    belief -= belief.max(axis=1, keepdims=True)
    share = np.exp(belief)
    return share / share.sum(axis=1, keepdims=True)


def main_texts(pages: list[str], model: Potentials) -> list[str]:
    """The main text of each page: its content blocks, one a line."""
    trees = [parsed(page) for page in pages]
    parent, node = [], []
    usual = np.zeros(3)
    for tree in trees:
        base = len(parent)
        parent += [p + base if p >= 0 else -1 for p in tree.parent]
        node += [sum((model.node.get(x, usual) for x in seen), usual) for seen in tree.seen]
    up = np.array(parent, np.int64)
    depth = np.zeros(len(up), np.int64)
    for k, p in enumerate(parent):
        if p >= 0:
            depth[k] = depth[p] + 1
    content = marginals(up, depth, np.array(node).reshape(-1, 3), model.pair)[:, CONTENT] > 0.5
    out, at = [], 0
    for tree in trees:
        out.append("\n".join(t for k, t in enumerate(tree.text) if t is not None and content[at + k]))
        at += len(tree.parent)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts.slices(batches, SLICE):
        count: Counter = Counter()
        for page in batch.column("text").to_pylist():
            tree = parsed(page or "")
            label = marked(tree)
            if label is None:
                continue
            for k, parent in enumerate(tree.parent):
                for name in tree.seen[k]:
                    count["seen", name, label[k], 0] += 1
                if parent >= 0:
                    count["pair", "", label[k], label[parent]] += 1
        keys = sorted(count)
        columns = [pa.array([key[k] for key in keys], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32()))]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([count[key] for key in keys], pa.int64())], names=["kind", "name", "label", "above", "c"]
        )


def learned(pages: DataFrame) -> Potentials:
    """Potentials from about SAMPLE of the pages that mark their article, chosen by a hash of the page.

    What is gathered is one count for each element name and hint, whatever the number of pages: the 2,000 most frequent,
    of names of up to 20 characters. Rarer and longer ones, which a bounded sample says little about, count as unseen.
    """
    labelled = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    number = max(labelled.count(), 1)
    draw = F.pmod(F.xxhash64("html"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.filter(draw < SAMPLE / number).select(F.col("html").alias("text"))
    rows = sample.mapInArrow(_count, "kind string, name string, label int, above int, c long")
    known = F.col("name").rlike(r"^[a-z]+ [#a-z0-9]{1,20}$") | (F.col("kind") == "pair")
    totals = rows.filter(known).groupBy("kind", "name", "label", "above").agg(F.sum("c").alias("c"))
    top = totals.orderBy(F.desc("c"), "kind", "name", "label", "above").limit(2000).collect()
    return potentials(
        {(x["name"], x["label"]): x["c"] for x in top if x["kind"] == "seen"},
        {(x["above"], x["label"]): x["c"] for x in top if x["kind"] == "pair"},
    )


def extracted(pages: DataFrame, model: Potentials) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of `pages`: the main text of the whole html.

    Character references are decoded; white space inside a block becomes one space; blocks are joined by line breaks. A
    null or empty page, and one without content, has an empty text. Other columns are not read.
    """
    broadcast = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in texts.slices(batches, SLICE):
            found = main_texts([page or "" for page in batch.column("text").to_pylist()], broadcast.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(found, pa.string()),
                    pa.array([len(x) for x in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").alias("text"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
