"""Main text of a page by tag-path ratios.

The text nodes of a page are grouped by their path of tags from the root to the
leaf (with class names, so that boxes of one kind form one path). For each path
two ratios are taken: text length per node, and punctuation per node; link text
counts against a path. The ratios are fused with the path's whole text (the
cube root of their product); a path that stands
between others in the page is smoothed towards the lesser of them, no further
than the length of its own text (links not counted) bears out, while what comes
before or after them all gets nothing. Paths whose fused ratio reaches a share of
the page's highest are content. This alone parts articles from menus, adverts
and footers where paragraphs are longer than these.

What HTML, roles, class names or ids say is a prior: in a box that is marked as
something else, or outside a marked article, a ratio counts a small part, and such
a path needs more than a floor. So long comments in a box of that name go, but
an article whose box has such a name stays. The headings of the content stay
with it, as do the lists, tables, quotations and preformatted blocks of a marked
article between kept blocks unless half of such a run's text is links.

A null page is empty; a page without any content path gives an empty text. A
page that ends in the middle of a tag is read up to there. Repeated rows get
equal results; each page is judged by itself. Columns other than page_id, url
and html are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import map_arrow

#: Share of the highest fused ratio that a content path reaches.
THRESHOLD = 0.6
#: Share of its neighbours' text per node from which a path between them is smoothed in full.
BORNE = 0.25
#: What a ratio counts in a box that is marked as something else, and what is left of it has to exceed.
PRIOR, FLOOR = 0.02, 3.0

# Element names of HTML by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_SKIP = frozenset("script style noscript template textarea title xmp iframe noembed noframes head button "
                  "select option svg canvas object audio video".split())
_BOX = frozenset("nav footer aside form dialog menu".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
_CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
           "tfoot": {"tbody", "thead", "tr", "td", "th"}}
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARTS = frozenset("blockquote caption dd dl dt figcaption li ol pre table td th tr ul".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
                    "sup time tt u var label".split())
_NOT_CONTENT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|header|login|masthead|menu|"
    r"modal|nav\w*|newsletter|notices?|notification|pager|pagination|popup|promo\w*|recommend\w*|related|replies|reply|respond|"
    r"share|sharing|sidebar|side|signup|skip|social|sponsor\w*|subscribe|tags|teaser|toolbar|widget\w*|alert|warning)(?:$|[\s_-])", re.I)
_ROLE = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|>|->|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:[^>]*+))(>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
_TELLING = re.compile(r"class|id\s*=|role|hidden|itemprop", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？¿¡»«\"]")


class _Node:
    __slots__ = ("tag", "path", "skip", "boxed", "article", "link", "heading", "inside")

    def __init__(self, tag, path, skip, boxed, article, link, heading, inside):
        self.tag, self.path, self.skip = tag, path, skip
        self.boxed = boxed  # in a box that is marked as something else than content
        self.article, self.link, self.heading = article, link, heading
        self.inside = inside  # of a list, table, quotation or preformatted block of the article


class _Block:
    """A run of text between block boundaries."""

    __slots__ = ("parts", "node", "linked", "chars")

    def __init__(self, node):
        self.parts, self.node, self.linked, self.chars = [], node, 0, 0


@lru_cache(4096)
def _traits(tag: str, raw: str) -> tuple[str, bool, bool, bool, bool]:
    """Step of the path; whether a tag is the article, holds no running text, is marked as something else, or is a header."""
    attributes = _attributes(raw) if raw else {}
    name = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    step = tag + "".join("." + c for c in attributes.get("class", "").split()[:2])
    role = attributes.get("role", "")
    article = tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop") == "articleBody"
    skip = tag in _SKIP or "hidden" in raw.lower().split() or attributes.get("aria-hidden") == "true"
    boxed = (tag in _BOX or role in _ROLE
             or tag not in ("html", "body", "article", "main") and bool(name and _NOT_CONTENT.search(name)))
    return step, article, skip, boxed, tag == "header"


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def blocks(html: str) -> list[tuple[_Node, str, float]]:
    """The text blocks of a page in order: the node they stand in, their text, the share of link text."""
    root = _Node("", "", False, False, False, False, False, False)
    stack, out, at = [root], [], 0
    current = _Block(root)

    def flush() -> None:
        nonlocal current
        if not current.chars:
            current = _Block(stack[-1])
            return
        text = " ".join("".join(current.parts).split())
        if text:
            out.append((current.node, text, current.linked / max(current.chars, 1)))
        current = _Block(stack[-1])

    def add(raw: str) -> None:
        node = stack[-1]
        if not raw or node.skip:
            return
        raw = unescape(raw) if "&" in raw else raw
        size = len(raw) - raw.count(" ") if not raw.isspace() else 0
        if size and not current.chars:
            owner = node
            for up in reversed(stack):  # inline tags share the path of their block
                owner = up
                if up.tag not in _INLINE:
                    break
            current.node = owner
        current.parts.append(raw)
        current.chars += size
        current.linked += size if node.link else 0

    def pop_to(i: int) -> None:
        del stack[i:]

    while at < len(html):
        m = _TOKEN.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        if not m[2] or not m[4]:  # a comment, declaration or a tag that the page's end cuts
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag in _BLOCK:
                        flush()
                    pop_to(i)
                    if tag in _BLOCK:
                        current = _Block(stack[-1])
                    break
                if stack[i].tag in _BLOCK and tag not in _BLOCK:
                    break
            continue
        if tag == "br":
            add("\n")
            continue
        if tag in _BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                up = stack[i].tag
                if up == "p" or up in _CLOSES.get(tag, ()) or (up in _HEADING and tag in _HEADING):
                    pop_to(i)
                    break
                if up not in _INLINE:
                    break
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
        up = stack[-1]
        step, article, skip, boxed, header = _traits(tag, m[3] if _TELLING.search(m[3]) else "")
        stack.append(_Node(tag, up.path if tag in _INLINE else f"{up.path}/{step}",
                           up.skip or skip, up.boxed or boxed or header and not up.article, up.article or article,
                           up.link or tag == "a", up.heading or tag in _HEADING,
                           up.inside or up.article and tag in _PARTS))
        if tag in _BLOCK:
            current = _Block(stack[-1])
    flush()
    return out


def main_text(html: str | None, threshold: float = THRESHOLD, *, ratios: bool = True, marks: bool = True) -> str:
    """The content blocks of a page, one a line. ``ratios`` and ``marks`` switch either kind of evidence off, for comparison."""
    found = [f for f in blocks(html) if not f[0].skip] if html else []
    if not found:
        return ""
    unlinked = np.array([len(t) * (1 - link) for _, t, link in found])
    points = np.array([len(_PUNCTUATION.findall(t)) * (1 - link) for _, t, link in found])
    article = np.array([f[0].article for f in found])
    heading = np.array([f[0].heading for f in found])
    boxed = np.array([f[0].boxed for f in found])
    if (article & ~heading & ~boxed).any():
        boxed |= ~article
    if not marks:
        boxed[:] = article[:] = False
    paths, code = np.unique([f[0].path for f in found], return_inverse=True)
    per = np.maximum(np.bincount(code), 1)
    length = np.bincount(code, weights=unlinked) / per
    fused = np.cbrt(length * (1 + np.bincount(code, weights=points) / per) * np.bincount(code, weights=unlinked))
    out = np.bincount(code, weights=boxed) == per
    prior = np.where(out, PRIOR, 1.0)
    fused = smooth_paths(fused * prior, code, length * prior)
    if not ratios:
        fused = prior * 2 * FLOOR
    linked = np.bincount(code, weights=[link for _, _, link in found]) / per
    content = (fused >= threshold * fused[~out].max(initial=0)) & (linked < 0.5) & (~out | (fused > FLOOR))
    keep = content[code]
    if keep.any():  # headings belong to the content that follows them
        first, last = np.flatnonzero(keep)[[0, -1]].tolist()
        inside = np.array([f[0].inside for f in found]) & ~boxed
        inside[:first] = inside[last:] = False
        run = np.cumsum(np.diff(inside.astype(int), prepend=0) != 0)  # a list or table is judged by its links as a whole
        size = np.array([len(t) for _, t, _ in found])
        keep |= inside & (2 * np.bincount(run, weights=size - unlinked) < np.bincount(run, weights=size))[run]
        at = np.arange(len(found))
        keep |= heading & (at <= last) & (article | (at >= first - 2)) & (~boxed | content[code])
    return "\n".join(t for (_, t, _), k in zip(found, keep) if k)


def smooth_paths(fused: np.ndarray, code: np.ndarray, length: np.ndarray, borne: float = BORNE) -> np.ndarray:
    """A path with others on both sides (a quotation among paragraphs) gets up to half of what the lesser of them has more.

    The half is lent in full to a path whose own text per node, links not counted, reaches ``borne`` of the
    neighbour's, and in proportion below that.
    """
    out = fused.copy()
    runs = code[np.flatnonzero(np.diff(code, prepend=-1))]
    for a, b, c in zip(runs[:-2], runs[1:-1], runs[2:]):
        least = a if fused[a] < fused[c] else c
        due = min(1.0, length[b] / max(borne * length[least], 1e-9))
        out[b] = max(out[b], fused[b] + due * (fused[least] - fused[b]) / 2)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html"))
    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
