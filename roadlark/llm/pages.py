"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its tag path from the root.  Per path, text length,
punctuation and link text are added up; the ratios per node are smoothed over neighbouring
blocks, fused into one score, and a threshold picks the paths that carry content.  The element
that holds most of the picked text is the article; blocks on picked paths and the other blocks
of the article (its headings, say) are kept, except in parts that the markup itself names as
menus, footers, adverts and the like, and runs of links alone.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of the HTML standard by their part in layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li"
    " main menu nav noscript ol option p pre search section select summary table tbody td template"
    " tfoot th thead tr ul".split()
)
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that are never part of an article.
OUTSIDE = set(
    "head script style noscript template nav footer aside form button select option textarea"
    " iframe object embed svg canvas audio video map dialog menu search fieldset title xmp noembed"
    " noframes datalist".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar"
    " form toolbar".split()
)
# Words of class and id that name parts around an article.
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header"
    " masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription signup login register social share sharing related recommended comment comments"
    " commentlist disqus replies reply respond reactions pagination pager toolbar search copyright"
    " hidden skip banner topbar".split()
)
# Words that say nothing about what a part holds.
FILLERS = set(
    "area article bar block bottom box button buttons card cards col column container content entry"
    " form global group header icons inner item items left link links list main module outer page"
    " panel post posts primary region right row secondary section site slot small top unit user view"
    " wrap wrapper".split()
)
# A start tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
    "article": {"head"},
    "main": {"head"},
}
SCOPE = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "body"}

TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|([!?/]))")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HOLDS = re.compile(r"(?i)\b(?:with|has|no|without|hide|show|is)[-_]+[\w-]+")
PUNCTUATION = re.compile(r"[.,;:!?\u2026\u3001\u3002\uff0c\uff01\uff1f\u061f\u060c\u0964]")
SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("path", "at", "out", "named", "text", "linked", "heading", "lead", "links")


class Element:
    """An open element.  What depends on all elements around it is known from its parent, so no
    list of open elements is walked, however deep a broken page nests."""

    __slots__ = ("tag", "number", "outside", "named", "inside", "link", "path", "block")


class Reader:
    """Cuts one page into blocks; a block knows its innermost element, an element its parent."""

    def __init__(self, page: str) -> None:
        self.blocks: list[Block] = []
        root = Element()
        root.tag, root.number, root.outside, root.named, root.inside = "", 0, False, 0, False
        root.link, root.path, root.block = 0, 0, ""
        self.open: list[Element] = [root]
        self.of_tag: dict[str, int] = defaultdict(int)
        self.parent = [0]
        self.paths: dict[tuple[int, str], int] = {}
        self.articles: set[int] = set()
        self.pages: set[int] = set()
        # Links, and those around blocks.
        self.anchors: set[int] = set()
        self.wide: set[int] = set()
        self.pieces: list[str] = []
        self.links: dict[int, int] = {}
        self.read(page)
        self.flush()
        self.unwrap()

    def flush(self) -> None:
        text = SPACE.sub(" ", html.unescape("".join(self.pieces))).strip()
        if text:
            b, top = Block(), self.open[-1]
            b.path, b.text, b.heading = top.path, text, top.block in HEADING
            b.at, b.out, b.named = top.number, top.outside, top.named
            b.lead = top.block == "h1" or top.inside
            b.links = self.links
            self.blocks.append(b)
        self.pieces, self.links = [], {}

    def unwrap(self) -> None:
        """Set the link text of all blocks; a link around most of the page's text is none."""
        size, total = defaultdict(int), 0
        for b in self.blocks:
            if not b.out:
                total += len(b.text)
                for n, length in b.links.items():
                    size[n] += min(length, len(b.text))
        around = {n for n in self.wide if 2 * size[n] > total}
        for b in self.blocks:
            b.links = {n: length for n, length in b.links.items() if n not in around}
            b.linked = min(sum(b.links.values()), len(b.text))

    def add(self, text: str) -> None:
        if text:
            self.pieces.append(text)
            n = self.open[-1].link
            if n:
                self.links[n] = self.links.get(n, 0) + len(text)

    def drop(self, k: int) -> None:
        """Close the open elements from position k on."""
        for e in self.open[k:]:
            self.of_tag[e.tag] -= 1
        del self.open[k:]

    def drop_links(self, named_only: bool) -> None:
        """Close open links, or those without a target, but not what stands inside of them."""
        k, left = len(self.open), self.of_tag["a"]
        while left:
            k -= 1
            e = self.open[k]
            if e.tag != "a":
                continue
            left -= 1
            if not (named_only and e.number in self.anchors):
                del self.open[k]
                self.of_tag["a"] -= 1
                for around, inner in zip(self.open[k - 1 :], self.open[k:]):
                    self.parent[inner.number] = around.number
                    inner.link = inner.number if inner.number in self.anchors else around.link

    def tag_end(self, page: str, at: int) -> int:
        """Where a tag whose attributes begin at ``at`` ends; a quoted value may hold '>'."""
        while True:
            close = page.find(">", at)
            if close < 0:
                return -1
            quote = re.compile("=\\s*([\"'])").search(page, at, close)
            if not quote:
                return close
            end = page.find(quote[1], quote.end())
            if end < 0:  # never closed: the quote means nothing
                return close
            at = end + 1

    def read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            m = TAG.search(page, at)
            if not m:
                # A tag that the page's end cuts off is no text.
                self.add(page[at:])
                return
            self.add(page[at : m.start()])
            if m[3]:
                end = page.find("-->", m.end())
                at = size if end < 0 else end + 3
                continue
            if m[4]:
                end = page.find(">", m.end())
                at = size if end < 0 else end + 1
                continue
            end = self.tag_end(page, m.end())
            if end < 0:
                return
            tag, at = m[2].lower(), end + 1
            if m[1]:
                self.close(tag)
                continue
            attributes = page[m.end() : end]
            self.start(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                stop = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(page, at)
                at = size if not stop else stop.start()

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            if tag not in {"html", "body", "head"}:
                self.end_paragraph(tag)
            # A name of a place holds no blocks.
            self.drop_links(True)
            link = self.open[-1].link
            while link and link not in self.wide:
                self.wide.add(link)
                link = next((e.link for e in self.open if e.number == self.parent[link]), 0)
        elif tag == "a":
            self.drop_links(False)
        elif tag in ("br", "wbr", "img"):
            self.pieces.append(" " if tag != "wbr" else "")
        if tag in VOID:
            return
        around, e = self.open[-1], Element()
        e.tag, e.number = tag, len(self.parent)
        self.parent.append(around.number)
        outside = around.outside or tag in OUTSIDE or (tag == "header" and not around.inside)
        e.outside, e.named = outside, around.named
        if attributes.strip(" /"):
            out, name = self.judge(tag, attributes, around.inside)
            e.outside, e.named = outside or out, around.named or (e.number if name else 0)
        e.inside, e.link = around.inside, around.link
        e.path, e.block = around.path, around.block
        if tag in BLOCK:
            e.path = self.paths.setdefault((around.path, tag), len(self.paths) + 1)
            e.block = tag
        if tag in ("article", "main"):
            self.articles.add(e.number)
            e.inside = True
        elif tag in ("html", "body"):
            self.pages.add(e.number)
        elif tag == "a" and any(k.lower() == "href" for k, *_ in ATTRIBUTE.findall(attributes)):
            self.anchors.add(e.number)
            e.link = e.number
        self.of_tag[tag] += 1
        self.open.append(e)

    def end_paragraph(self, tag: str) -> None:
        closes = CLOSES.get(tag, set())
        ends = {"p"} | closes | (HEADING if tag in HEADING else set())
        if not any(self.of_tag[t] for t in ends):
            return
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k].tag
            if name in ends:
                self.drop(k)
                if name == "p" and closes:
                    return self.end_paragraph(tag)
                return
            if name in SCOPE and name not in closes:
                return

    def judge(self, tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
        """(hidden or of a foreign role, named like a part around articles)"""
        out, words, tokens = False, set(), []
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "")
            if key == "role":
                out |= value.strip().lower() in ROLES
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                out = True
            elif key == "style":
                flat = value.replace(" ", "").lower()
                out |= "display:none" in flat or "visibility:hidden" in flat
            elif key in ("class", "id"):
                # "with-sidebar" and the like name what an element holds, not what it is.
                tokens += [{w.lower() for w in PART.findall(t)} for t in HOLDS.sub(" ", value).split()]
                words.update(*tokens)
        if tag in ("html", "body", "main"):
            return False, False
        if tag == "article":
            return out, bool(words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"})
        if inside:
            # Inside of an article only whole names count: "related-work" is a section of its own.
            return out, any(w <= NAMES | FILLERS and w & (NAMES - {"header"}) for w in tokens)
        return out, bool(words & NAMES)

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if tag == "br":
            self.pieces.append(" ")
            return
        if not self.of_tag[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                self.drop(k)
                return
            if tag not in BLOCK and self.open[k].tag in BLOCK:
                return  # an inline end tag does not close a block

    def below(self, chosen: set[int]) -> list[bool]:
        """Of every element, whether it or one around it is chosen."""
        out = [0 in chosen]
        for n in range(1, len(self.parent)):
            out.append(n in chosen or out[self.parent[n]])
        return out


# So many links in a row, without other text, are a menu.
MENU = 3


def menus(blocks: list[Block], parent: list[int]) -> list[bool]:
    """Which blocks belong to a run of links alone: siblings, or several links of one block."""
    out, begin = [False] * len(blocks), 0
    for i in range(1, len(blocks) + 1):
        a = blocks[begin]
        if i < len(blocks):
            b = blocks[i]
            if b.path == a.path and parent[b.at] == parent[a.at] and alone(a) and alone(b):
                continue
        if alone(a) and sum(len(b.links) for b in blocks[begin:i]) >= MENU:
            out[begin:i] = [True] * (i - begin)
        begin = i
    return out


def alone(b: Block) -> bool:
    """Little more than links: a separator between them is no text."""
    return b.linked + 3 * len(b.links) >= len(b.text) and bool(b.links)


KERNEL = (0.25, 0.5, 1.0, 0.5, 0.25)
SHARE = 0.25


def scores(blocks: list[Block]) -> list[float]:
    """The fused and smoothed score of each block's path."""
    text, marks, links, nodes = (defaultdict(float) for _ in range(4))
    for b in blocks:
        text[b.path] += len(b.text)
        marks[b.path] += len(PUNCTUATION.findall(b.text))
        links[b.path] += b.linked
        nodes[b.path] += 1
    ratio = {
        p: text[p] / n * (1 + marks[p] / n) ** 0.5 * (1 - links[p] / text[p])
        for p, n in nodes.items()
    }
    raw = [ratio[b.path] for b in blocks]
    half, out = len(KERNEL) // 2, []
    for i in range(len(raw)):
        window = [(raw[j], KERNEL[j - i + half]) for j in range(max(0, i - half), min(len(raw), i + half + 1))]
        out.append(sum(r * w for r, w in window) / sum(w for _, w in window))
    # A path's score is its own ratio, raised by what stands around it, never above twice itself.
    near = defaultdict(list)
    for b, s in zip(blocks, out):
        near[b.path].append(s)
    fused = {p: (ratio[p] * min(sum(s) / len(s), 2 * ratio[p])) ** 0.5 for p, s in near.items()}
    return [fused[b.path] for b in blocks]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    reader = Reader(page)
    plain = [b for b in reader.blocks if not b.out]
    # A named element with most of the page's text and its article or title is no part around it.
    size, lead = defaultdict(int), set()
    for b in plain:
        size[b.named] += len(b.text)
        if b.lead:
            lead.add(b.named)
    most = sum(size.values()) / 2
    wrong = {n for n in lead if size[n] > most}
    # If the names leave nothing at all, they were wrong.
    blocks = [b for b in plain if not b.named or b.named in wrong] or plain
    if not blocks:
        return ""
    score = scores(blocks)
    weight = [len(b.text) - b.linked for b in blocks]
    mean = sum(s * w for s, w in zip(score, weight)) / max(sum(weight), 1)
    picked = [s >= SHARE * mean and 2 * b.linked <= len(b.text) for s, b in zip(score, blocks)]
    held = [0] * len(reader.parent)
    for b, p, w in zip(blocks, picked, weight):
        if p:
            held[b.at] += w
    for n in range(len(held) - 1, 0, -1):  # children have larger numbers than their parents
        held[reader.parent[n]] += held[n]
    total = max(sum(w for p, w in zip(picked, weight) if p), 1)
    # Articles that the markup declares, if they hold most of the picked text.
    declared = reader.below({n for n in reader.articles if held[n]})
    inner = [declared[b.at] for b in blocks]
    article = inner
    if 2 * sum(w for p, w, i in zip(picked, weight, inner) if p and i) < total:
        # Else the innermost element with most of it; other picked blocks stay, too.
        best = max((n for n in range(1, len(held)) if held[n] and 5 * held[n] >= 4 * total), default=0)
        within = reader.below({best} if best else set())
        inner = [p or within[b.at] for b, p in zip(blocks, picked)]
        # A whole page is no article: its other blocks of links stand around one.
        article = [within[b.at] and best not in reader.pages for b in blocks]
    keep = [
        b.text
        for b, p, i, a, m in zip(blocks, picked, inner, article, menus(blocks, reader.parent))
        if i and (p or b.heading or 2 * b.linked <= len(b.text) or (a and not m))
    ]
    return "\n".join(keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    The whole html is read.  Null or empty html, and pages without content, give an empty text;
    null ids and urls stay null, repeated rows stay repeated, an empty table stays empty, other
    columns are not read.  Pages without any markup are content as a whole.  A page that ends in the middle of a tag ends there.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    known = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "html")
    return known.mapInArrow(run, "page_id long, url string, text string, n_chars long")
