"""Main text of web pages: boosted trees over DOM-node features with hierarchical decoding.

A page becomes a tree of block elements; text between them is a leaf of its own.  Trees score
each node from its tag, attribute tokens, depth, text and link density of its subtree, siblings
and what its ancestors are.  A dynamic programme over the tree then picks the best labels among
those that do not contradict each other: below a node that is left out nothing is kept, and
below a node that is kept something may be left out.

The model is trained here, on generated page layouts whose answers are known by construction
(:func:`training_pages`).
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm import words as W
from weftline.llm.boosting import BoostedTrees, fit

#: fixed values: element kinds of HTML
SKIPPED = frozenset("script style template iframe title textarea select option datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style textarea title".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul button label legend caption noscript".split())
IN_LINE = frozenset("button label".split())  # blocks of their own only where no sentence is open
CLOSES_P = BLOCKS - frozenset("noscript button label td th tr tbody thead tfoot html body".split())
#: a start tag closes an open element of these kinds, looking up to the nearest of those bounds
CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
          "td": ("td th", "tr table"), "th": ("td th", "tr table")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: fixed values: tags and attribute tokens with a feature of their own
TAGS = ("#text p h1 h2 h3 h4 li ul ol div section article main nav header footer aside form button label table td blockquote pre figure "
        "figcaption dl dd details body html").split()
TOKENS = {
    "content": "article content main post entry story text prose markdown articlebody maincontent",
    "inner": "body paragraph title headline lead intro chapter caption quote",
    "ads": "ad ads advert adverts advertisement advertising adsense banner promo promoted promotion sponsor sponsored doubleclick",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc links skip topbar",
    "head": "header masthead head branding logo site sitename toolbar",
    "foot": "footer foot copyright legal colophon imprint bottom",
    "side": "sidebar side aside widget widgets related recommended trending popular more recirculation tags tagcloud rail secondary complementary",
    "notice": "cookie cookies consent notice gdpr alert warning popup modal overlay dialog toast paywall privacy hidden",
    "talk": "comment comments commentlist reply replies respond discussion disqus thread reviews feedback",
    "form": "form search login signup subscribe subscription newsletter register poll share sharing social follow contact",
}
GROUPS = list(TOKENS)
GROUP_OF = {w: i for i, g in enumerate(GROUPS) for w in TOKENS[g].split()}
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|$)|<(?=/?[a-zA-Z])[^>]*(?:>|$)", re.DOTALL)
_ATTR = re.compile(r"(=?[^\s/>=]+|=)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")  # one attribute; only white space and / lie between two
ANCHORED = frozenset("section h1 h2 h3 h4 h5 h6".split())  # an id of three words or more there is an anchor made of a heading
READ = frozenset("class id role itemprop aria-label data-y style hidden aria-hidden".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "up", "groups", "gone", "truth", "pieces", "links", "kids", "text")

    def __init__(self, tag: str, up: int, groups: int = 0, gone: bool = False, truth: str | None = None):
        self.tag, self.up, self.groups, self.gone, self.truth = tag, up, groups, gone, truth
        self.pieces: list[str] = []
        self.links, self.kids, self.text = 0, 0, ""


def _attributes(raw: str, tag: str = "") -> tuple[int, bool, str | None]:
    """Token groups, whether the element is not shown, and the known answer.  ``aria-hidden`` hides no block: its text is on the page."""
    groups, gone, truth = 0, False, None
    if raw:
        for m in _ATTR.finditer(raw):
            name = m[1].lower()
            if name not in READ:
                continue
            value = m[2] or m[3] or m[4] or ""
            if name == "data-y":
                truth = value
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true" and tag not in BLOCKS):
                gone = True
            elif name == "style":
                gone |= "display:none" in value.replace(" ", "").lower()
            else:
                tokens = _TOKEN.findall(value)
                if name == "id" and tag in ANCHORED and len(tokens) > 2:
                    continue
                for t in tokens:
                    g = GROUP_OF.get(t.lower())
                    if g is not None:
                        groups |= 1 << g
    if tag == "p":  # a paragraph belongs where it stands, whatever it is called, unless it is an advert
        groups &= 1 << GROUPS.index("ads")
    return groups, gone, truth


def parse(page: str) -> list[Node]:
    """Block tree of a page in page order; node 0 is the root.  Text stands in ``#text`` leaves.

    A hidden element stands on the stack like any other, so it ends where the tree closes it, but it and
    what it holds make no nodes.
    """
    nodes = [Node("html", -1)]
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block they belong to
    leaf: Node | None = None
    skipping: str | None = None
    skip_depth, link_depth = 0, 0
    in_head = False  # until </head> or the first thing that cannot stand in it
    hidden: int | None = None  # place in the stack of the outermost hidden element
    at = 0

    def put(text: str) -> None:
        nonlocal leaf, in_head
        if hidden is not None or in_head and (not text or text.isspace()):
            return
        in_head = False
        if leaf is None:
            if not text or text.isspace():
                return
            leaf = Node("#text", stack[-1][1])
            nodes.append(leaf)
        leaf.pieces.append(text)
        if link_depth:
            leaf.links += len(text)

    def close(depth: int) -> None:
        nonlocal leaf, link_depth, hidden
        while len(stack) > depth:
            tag, own = stack.pop()
            if tag == "a":
                link_depth -= 1
            elif tag in BLOCKS and hidden is None and own != stack[-1][1]:
                leaf = None
            if len(stack) == hidden:
                hidden = None

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            if skipping is None:
                put(page[at:])
            break
        if m.start() > at and skipping is None:
            put(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1])
        if in_head and skipping is None:
            if closing and tag not in ("head", "body", "html", "br"):
                continue
            in_head = not closing and (tag in IN_HEAD or tag == "head")
        if skipping is not None:
            if tag == skipping:
                skip_depth += -1 if closing else (0 if m[3].endswith("/") else 1)
                if skip_depth == 0:
                    skipping = None
            continue
        if m[4] != ">":  # the page ends inside a tag
            break
        if closing:
            if tag == "p" and not any(t == "p" for t, _ in stack):
                if hidden is None:
                    leaf = None
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if tag not in BLOCKS and stack[i][0] in BLOCKS and tag != "a":
                    break
            continue
        if tag == "br":
            put(" ")
            continue
        if tag in VOID:
            if tag == "hr" and hidden is None:
                leaf = None
            continue
        if tag == "head":  # a second one means nothing
            in_head = len(nodes) == len(stack) == 1
            continue
        groups, gone, truth = _attributes(m[3], tag)
        if tag in SKIPPED or gone and m[3].endswith("/"):
            if m[3].endswith("/") and tag not in RAW:
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
            else:
                skipping, skip_depth = tag, 1
            continue
        if gone and hidden is None and tag in ("html", "body"):
            hidden = len(stack)
            stack.append((tag, stack[-1][1]))
            continue
        if tag in ("html", "body"):
            if tag == "html" or any(n.tag == "body" for n in nodes[:4]):
                nodes[0].groups |= groups
                continue
        if tag in BLOCKS:
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in bounds:
                        break
                    if stack[i][0] in ends:
                        close(i)
                        if tag != "tr":
                            break
        if gone and hidden is None:
            hidden = len(stack)
        in_line = tag in IN_LINE and (leaf is not None or nodes[stack[-1][1]].tag == "p")
        if tag in BLOCKS and hidden is None and not in_line:
            leaf = None
            if tag == "noscript" and not any(t in ("article", "main") for t, _ in stack):
                groups |= 1 << GROUPS.index("notice")  # there it speaks to the reader's browser; inside an article it repeats what a script shows
            nodes.append(Node(tag, stack[-1][1], groups, False, truth))
            stack.append((tag, len(nodes) - 1))
        else:
            if tag == "a":
                link_depth += 1
            stack.append((tag, stack[-1][1]))
    for n in nodes:
        if n.pieces:
            n.text = " ".join(entities.unescape("".join(n.pieces)).split())
    return nodes


N_TAGS, N_GROUPS = len(TAGS), len(GROUPS)
_TAG_NO = {t: i for i, t in enumerate(TAGS)}
_BOILER_TAGS = frozenset("nav header footer aside form button label".split())
N_FEATURES = N_TAGS + 3 * N_GROUPS + 14


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    n = len(nodes)
    x = np.zeros((n, N_FEATURES))
    size, links, leaves, marks = [0] * n, [0] * n, [0] * n, [0] * n
    depth, order, groups, above, tags_above, tag_no = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    other = _TAG_NO["div"]
    for i, v in enumerate(nodes):
        groups[i] = v.groups
        tag_no[i] = _TAG_NO.get(v.tag, other)
        if v.tag == "#text":
            t = v.text
            size[i], links[i], leaves[i] = len(t), min(v.links, len(t)), 1
            marks[i] = t.count(".") + t.count(",") + t.count("!") + t.count("?")
        if i:
            u = v.up
            parent = nodes[u]
            depth[i] = depth[u] + 1
            above[i] = above[u] | groups[u]
            tags_above[i] = tags_above[u] | (1 if parent.tag in _BOILER_TAGS else 2 if parent.tag in ("article", "main") else 0)
            order[i] = parent.kids
            parent.kids += 1
    up = [v.up for v in nodes]
    for i in range(n - 1, 0, -1):
        u = up[i]
        size[u] += size[i]
        links[u] += links[i]
        leaves[u] += leaves[i]
        marks[u] += marks[i]
    x[np.arange(n), tag_no] = 1
    size, links, leaves, marks, depth, order, groups, above, tags_above, up = (
        np.array(v) for v in (size, links, leaves, marks, depth, order, groups, above, tags_above, up))
    kids = np.fromiter((v.kids for v in nodes), np.float64, n)
    parent = np.maximum(up, 0)
    bits = np.arange(N_GROUPS)
    a = N_TAGS
    x[:, a:a + N_GROUPS] = (groups[:, None] >> bits) & 1
    x[:, a + N_GROUPS:a + 2 * N_GROUPS] = (groups[parent][:, None] >> bits) & 1
    x[:, a + 2 * N_GROUPS:a + 3 * N_GROUPS] = (above[:, None] >> bits) & 1
    total = max(1.0, size[0])
    x[:, a + 3 * N_GROUPS:] = np.stack([
        np.log1p(size), links / np.maximum(1, size), size / np.maximum(1, leaves), marks / np.maximum(1, size) * 100,
        size / total, np.minimum(depth, 12), np.log1p(kids), np.log1p(order), order / np.maximum(1, kids[parent]),
        np.log1p(kids[parent]), size / np.maximum(1, size[parent]), tags_above & 1, tags_above >> 1, np.log1p(leaves)], 1)
    return x


MIXED_COST = 0.9


def decode(nodes: list[Node], margin: np.ndarray) -> np.ndarray:
    """Which nodes are kept, by the best consistent labelling of the tree.

    Labels are *mixed* (nothing decided here; only for nodes with children), *kept* and *left out*.
    Below kept stand kept or left out, below left out only left out.
    """
    n = len(nodes)
    keep, drop = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
    mixed = np.array([-MIXED_COST if v.kids else -np.inf for v in nodes])
    for i in range(n - 1, 0, -1):
        u = nodes[i].up
        drop[u] += drop[i]
        keep[u] += max(keep[i], drop[i])
        mixed[u] += max(mixed[i], keep[i], drop[i])
    label = np.zeros(n, np.int8)  # 0 mixed, 1 kept, 2 left out
    for i in range(n):
        above = label[nodes[i].up] if i else 0
        if above == 2:
            label[i] = 2
        elif above == 1:
            label[i] = 1 if keep[i] >= drop[i] else 2
        else:
            best = max(mixed[i], keep[i], drop[i])
            label[i] = 1 if keep[i] == best else 2 if drop[i] == best else 0
    return label == 1


def _blocks(nodes: list[Node], kept: np.ndarray) -> str:
    return "\n".join(v.text for v, k in zip(nodes, kept) if k and v.tag == "#text" and v.text)


# --- generated layouts -------------------------------------------------------------------

_SYLLABLES = "ka lo mi ren tas vel dor un est ab ion pre sal cu ne or tha li".split()


def training_pages(count: int = 400, seed: int = 5) -> Iterator[str]:
    """Page layouts of many habits; ``data-y`` tells what is main text (1) and what is not (0)."""
    r = random.Random(seed)

    def word():
        return "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))

    def words(a, b):
        return " ".join(word() for _ in range(r.randint(a, b)))

    def sentences(a, b):
        return " ".join(words(3, 14).capitalize() + r.choice(".....!?") for _ in range(r.randint(a, b)))

    def name(*groups):
        if r.random() < 0.25:
            return ""
        token = r.choice(TOKENS[r.choice(groups)].split())
        if r.random() < 0.3:
            token = r.choice((f"{token}-{word()}", f"{word()}-{token}", f"{token}-box", f"site-{token}", f"{token}_{r.randint(1, 99)}"))
        return f' {r.choice(("class", "class", "id"))}="{token}"'

    def link():
        return f'<a href="/{word()}">{words(1, 4)}</a>'

    def links():
        return f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(r.randint(2, 12)))}</ul>"

    def prose(a, b):
        out = []
        for _ in range(r.randint(a, b)):
            t = sentences(1, r.choice((1, 2, 5, 9)))
            if r.random() < 0.15:
                t += f" {link()} {words(2, 9)}."
            k = r.random()
            out.append(f"<p>{t}</p>" if k < 0.72 else f"<p>{t}<br>" if k < 0.78 else f"<div>{t}</div>" if k < 0.84 else
                       f"<h2>{words(2, 7)}</h2><p>{t}</p>" if k < 0.9 else f"<blockquote><p>{t}</p></blockquote>" if k < 0.93 else
                       f"<ul>{''.join(f'<li>{words(3, 15)}</li>' for _ in range(r.randint(2, 6)))}</ul>" if k < 0.97 else
                       f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>")
        return "".join(out)

    def junk():
        k = r.randint(0, 10)
        short = sentences(1, 2)
        tag = r.choice(("div", "div", "section", "aside"))
        if k == 0:
            return f'<nav{name("menu")} data-y="0">{links()}</nav>'
        if k == 1:
            return f'<{tag} class="{r.choice(TOKENS["menu"].split())}" data-y="0">{links()}</{tag}>'
        if k == 2:
            return f'<{tag} class="{r.choice(TOKENS["ads"].split())}{r.choice(("", "-" + word(), " box"))}" data-y="0">{r.choice((short, f"<p>{short}</p>", link(), prose(1, 2)))}</{tag}>'
        if k == 3:
            return f'<{tag} {r.choice(("class", "id"))}="{r.choice(TOKENS["notice"].split())}" data-y="0">{r.choice((short, f"<p>{short}</p><button>{word()}</button>", prose(1, 2)))}</{tag}>'
        if k == 4:
            return f'<aside{name("side")} data-y="0">{r.choice((links(), prose(1, 3), f"<h3>{words(1, 3)}</h3>{links()}"))}</aside>'
        if k == 5:
            return f'<div {r.choice(("class", "id"))}="{r.choice(TOKENS["side"].split())}" data-y="0"><h3>{words(1, 3)}</h3>{r.choice((links(), prose(1, 3)))}</div>'
        if k == 6:
            return f'<form{name("form")} data-y="0"><label>{word()}</label><input name="q"><p>{short}</p><button>{word()}</button></form>'
        if k == 7:
            return f'<div class="{r.choice(TOKENS["form"].split())}" data-y="0">{r.choice((links(), short, prose(1, 1)))}</div>'
        if k in (8, 9):
            body = "".join(f'<{t}{name("talk")}>{r.choice((f"<b>{word()}</b> ", ""))}{prose(1, 2)}</{t}>' for t in [r.choice(("div", "li", "article"))] for _ in range(r.randint(1, 6)))
            return f'<{tag} {r.choice(("class", "id"))}="{r.choice(TOKENS["talk"].split())}" data-y="0">{r.choice(("", f"<h3>{words(1, 3)}</h3>"))}{body}</{tag}>'
        return f'<div data-y="0">{links()}</div>'

    def some(p):
        return "".join(junk() for _ in range(3) if r.random() < p)

    for _ in range(count):
        title = f"<h1>{words(2, 9)}</h1>"
        header = r.choice((f'<header{name("head")} data-y="0">{r.choice((f"<h1>{words(1, 3)}</h1>", f"<p>{words(2, 6)}</p>", link()))}{r.choice(("", links()))}</header>',
                           f'<div class="{r.choice(TOKENS["head"].split())}" data-y="0">{words(1, 4)}{r.choice(("", links()))}</div>', ""))
        foot = r.choice((f'<footer{name("foot")} data-y="0">{r.choice((f"&copy; {words(2, 5)}", f"<p>&copy; {sentences(1, 4)}</p>", sentences(2, 5), links()))}</footer>',
                         f'<footer data-y="0">&copy; {word()}.com &middot; {sentences(2, 4)}',
                         f'<div class="{r.choice(TOKENS["foot"].split())}" data-y="0">{r.choice((f"<p>{sentences(1, 3)}</p>", links(), sentences(1, 4)))}</div>', ""))
        nav = f'<nav{name("menu")} data-y="0">{links()}</nav>' if r.random() < 0.7 else ""
        inside = prose(1, r.choice((1, 2, 6, 14)))
        if r.random() < 0.25:
            inside += junk() + prose(1, 4)
        if r.random() < 0.2:
            inside += junk()
        head = r.choice((title, title, f'<header data-y="0"><p>{words(2, 5)}</p></header>{title}', ""))
        body = r.choice((f'<article{name("content")} data-y="1">{head}{inside}</article>', f'<article data-y="1">{head}{inside}</article>',
                         f'<main{name("content")}>{some(0.2)}<article data-y="1">{head}{inside}</article>{some(0.2)}</main>',
                         f'<main data-y="1">{head}{inside}</main>',
                         f'<div {r.choice(("class", "id"))}="{r.choice(TOKENS["content"].split())}" data-y="1">{head}{inside}</div>',
                         f'<section{name("content")} data-y="1">{head}{inside}</section>', f'<div data-y="1">{head}{inside}</div>'))
        page = header + nav + some(0.3) + body + some(0.35) + foot
        if r.random() < 0.3:
            page = f"<div{name('inner', 'head')}>{page}</div>"
        yield f'<!DOCTYPE html><html><head><title>{words(1, 5)}</title></head><body>{page}{"" if r.random() < 0.2 else "</body></html>"}'


def labelled_nodes(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 answers of the nodes of a generated page; undecided containers are left out."""
    nodes = parse(page)
    y = np.full(len(nodes), -1)
    for i, v in enumerate(nodes):
        inherited = y[v.up] if i else -1
        y[i] = 0 if inherited == 0 else int(v.truth) if v.truth is not None else inherited
    decided = y >= 0
    return features(nodes)[decided], y[decided]


@functools.cache
def trained_model(pages: int = 400, trees: int = 30) -> BoostedTrees:
    parts = [labelled_nodes(p) for p in training_pages(pages)]
    return fit(np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts]).astype(float), trees)


def extract(page: str | None, model: BoostedTrees) -> str:
    """Main text of one page."""
    return extract_many([page], model)[0]


def extract_many(pages: list[str | None], model: BoostedTrees) -> list[str]:
    trees = [parse(p or "") for p in pages]
    rows = [features(t) for t in trees]
    margin = model.margin(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for t in trees:
        out.append(_blocks(t, decode(t, margin[at:at + len(t)])))
        at += len(t)
    return out


def main_texts(pages: DataFrame, html: str = "html", carry: list[str] | None = None, model: BoostedTrees | None = None) -> DataFrame:
    """Rows ``(row, main)`` with the main text of every whole page.

    Blocks are joined by one line feed in page order; white space inside a block is one space.
    Null, empty and text-free pages give the empty string.  Damaged markup is read as far as it
    goes: open elements end with the page, and a tag that the page's end cuts is dropped.
    Repeated rows give repeated results; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or trained_model())

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(extract_many(texts.to_pylist(), shared.value), pa.string())]

    return W.text_map(pages, html, carry, run, "main string", 1 << 19)
