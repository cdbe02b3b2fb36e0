"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into text blocks in page order (tags, comments, scripts and
styles apart; unclosed elements end where HTML ends them). A linear classifier
scores every block from its own evidence: the nearest telling ancestor (tag,
class, id or role), link share, length, punctuation, tag. A positive score is the capacity
from the source (the cost of calling the block boilerplate), a negative one the capacity to the
sink; neighbouring blocks and blocks of one parent are joined by smoothness
edges, stronger the closer they are in the DOM. The minimum cut, found by
max-flow, labels all blocks at once: a short line among article paragraphs
follows them, a link list inside an article does not.

Pages are independent, so this is one pass without a shuffle.

Defined results: a null or empty page has an empty text; a cut-off tag at the
end is markup and dropped; a page without article text gives an empty text;
repeated rows are extracted alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element kinds of HTML
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title", "svg", "math", "template",
       "object", "canvas", "audio", "video", "select", "noscript", "head"}
TO_THE_END = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"}      # unclosed: to the page's end
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "img", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}}
# words in a tag, class, id or role that tell what a part of a page is
AWAY_TAGS = {"nav", "footer", "aside", "form", "header", "button", "dialog", "menu", "fieldset"}
AWAY = {"nav", "navigation", "navbar", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "banner", "footer", "foot",
        "sidebar", "aside", "widget", "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored",
        "promo", "promotion", "cookie", "cookies", "consent", "notice", "notices", "gdpr", "popup", "modal", "overlay", "newsletter",
        "subscribe", "subscription", "signup", "login", "search", "form", "share", "sharing", "social", "related", "recommended",
        "pagination", "pager", "copyright", "toolbar", "skip", "complementary", "contentinfo", "alert", "paywall", "teaser", "outbrain", "taboola"}
REMARKS = {"comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "remarks"}
# first and last words of a class that states something of its element and does not name a part
STATE_FIRST = {"has", "no", "is", "with", "without", "hide", "show", "supports"}
STATE_LAST = {"open", "closed", "enabled", "disabled", "on", "off", "count"}
HERE_TAGS = {"article", "main"}
HERE = {"article", "main", "content", "post", "entry", "story", "text", "body", "articlebody", "maintext"}
# the classifier: weights of a block's evidence
W_AWAY, W_HERE, W_NONE, W_LINK, W_LENGTH, W_STOP, W_HEAD, W_PARA, W_RIGHTS = -6.0, 3.0, -0.6, -5.0, 1.5, 0.6, 0.8, 0.6, -1.5
NEAR, SIBLING = 1.0, 1.0

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Block:
    __slots__ = ("text", "links", "path", "tag")

    def __init__(self, text, links, path, tag):
        self.text, self.links, self.path, self.tag = text, links, path, tag


def _hint(tag: str, attrs: str, in_article: bool) -> int:
    """2 reader comments, 1 boilerplate, -1 main part, 0 nothing told.

    The page's own elements tell nothing; a header inside an article belongs to it.
    """
    if tag in ("body", "html"):
        return 0
    words = set()
    if attrs:
        for v in _NAMED.findall(attrs):
            for name in v.strip("\"'").split():
                parts = [w.lower() for w in _WORD.findall(name)]
                if len(parts) > 1 and (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
                    continue
                words.update(parts)
    if words & REMARKS:
        return 2
    away, here = words & AWAY, tag in HERE_TAGS or bool(words & HERE)
    if in_article:
        away = away - {"header"}
        here = here or tag == "header"
    if away or (tag in AWAY_TAGS and not (in_article and tag == "header")):
        return 1
    return -1 if here else 0


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of an element that is left out ends. One that is never closed, or only after
    it was opened again, is left out alone, but for those whose text runs to the end of the page."""
    e = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
    if tag in TO_THE_END:
        return e.end() if e else len(page)
    again = re.compile(rf"<{tag}\b", re.I).search(page, at, e.start()) if e else None
    return e.end() if e and not again else at


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. ``path`` is the open elements as (number, hint)."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []          # (tag, number, hint)
    text: list[str] = []
    links = number = depth_a = 0
    at, n = 0, len(page)

    def flush():
        nonlocal links
        got = " ".join("".join(text).split())
        if got:
            outer = [e for e in stack if e[0] not in INLINE]
            out.append(Block(got, links, tuple((e[1], e[2]) for e in outer), outer[-1][0] if outer else ""))
        text.clear()
        links = 0

    def data(piece):
        nonlocal links
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            text.append(piece)
            if depth_a:
                links += len(piece.strip())

    def close(i):
        nonlocal depth_a
        if any(e[0] not in INLINE for e in stack[i:]):
            flush()
        depth_a -= sum(e[0] == "a" for e in stack[i:])
        del stack[i:]

    while at < n:
        i = page.find("<", at)
        if i < 0:
            data(page[at:])
            break
        nxt = page[i + 1:i + 2]
        if nxt == "!" or nxt == "?":
            data(page[at:i])
            if page.startswith("<!--", i):
                j = page.find("-->", i + 4)
                at = n if j < 0 else j + 3
            else:
                j = page.find(">", i)
                at = n if j < 0 else j + 1
            continue
        if not (nxt.isalpha() or (nxt == "/" and page[i + 2:i + 3].isalpha())):
            data(page[at:i + 1])
            at = i + 1
            continue
        m = _TAG.match(page, i) or _LOOSE.match(page, i)
        data(page[at:i])
        if not m:                                    # cut off inside a tag
            break
        at, tag, attrs = m.end(), m[2].lower(), m[3]
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            else:
                if tag not in INLINE:
                    flush()
            continue
        if tag in RAW:
            if tag not in INLINE:
                text.append(" ")
            if not attrs.endswith("/"):
                at = _raw_end(page, tag, at)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag not in INLINE:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" and tag not in ("td", "th"):
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in SCOPE.get(tag, ()):
                        break
                    if stack[k][0] in CLOSES[tag]:
                        close(k)
                        if tag not in ("tr", "tbody", "tfoot"):
                            break
        if attrs.endswith("/") and tag not in INLINE:
            continue
        number += 1
        stack.append((tag, number, _hint(tag, attrs, any(e[0] == "article" for e in stack))))
        depth_a += tag == "a"
    flush()
    return out


def score(b: Block) -> float:
    """Classifier: above 0 speaks for content."""
    told = [h for _, h in b.path if h]
    if 2 in told:
        s = W_AWAY
    elif told:
        s = W_AWAY if told[-1] > 0 else W_HERE
    else:
        s = W_NONE
    n = len(b.text)
    s += W_LINK * max(0.0, b.links / n - 0.3)
    s += W_LENGTH * min(1.0, n / 200)
    if b.text[-1] in ".!?…\"'”»)":
        s += W_STOP
    if b.tag in ("h1", "h2"):
        s += W_HEAD
    elif b.tag in ("p", "blockquote", "pre"):
        s += W_PARA
    if b.text[0] == "©" or b.text[:9].lower() == "copyright":
        s += W_RIGHTS
    return s


def edges(found: list[Block]):
    """(i, j, capacity): neighbours in the page, and the nearest earlier block of the same parent."""
    last: dict[int, int] = {}
    for j, b in enumerate(found):
        near = -1
        if j:
            a = found[j - 1].path
            same = 0
            for x, y in zip(a, b.path):
                if x[0] != y[0]:
                    break
                same += 1
            yield j - 1, j, NEAR / (1 + max(len(a), len(b.path)) - same)
            near = j - 1
        parent = b.path[-2][0] if len(b.path) > 1 else 0
        i = last.get(parent, -1)
        if i >= 0 and i != near:
            yield i, j, SIBLING / 2
        last[parent] = j


def min_cut(scores: list[float], links) -> list[bool]:
    """Source side of the minimum cut: max-flow by shortest augmenting levels (Dinic)."""
    n = len(scores)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a, b, forth, back):
        out[a].append(len(to)); to.append(b); cap.append(forth)
        out[b].append(len(to)); to.append(a); cap.append(back)

    for i, x in enumerate(scores):
        if x > 0:
            add(s, i, x, 0.0)
        elif x < 0:
            add(i, t, -x, 0.0)
    for i, j, w in links:
        add(i, j, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        todo = deque([s])
        while todo:
            u = todo.popleft()
            for e in out[u]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    todo.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(cap[e] for e in path)
                cut = len(path)
                for k, e in enumerate(path):
                    cap[e] -= push
                    cap[e ^ 1] += push
                    if cap[e] <= tiny and k < cut:
                        cut = k
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[u] < len(out[u]):
                e = out[u][nxt[u]]
                if cap[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            else:
                if not path:
                    break
                level[u] = -1
                u = to[path.pop() ^ 1]
                nxt[u] += 1
                continue
            path.append(out[u][nxt[u]])
            u = to[path[-1]]


def main_text(page: str | None) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = min_cut([score(b) for b in found], edges(found))
    return " ".join(b.text for b, k in zip(found, keep) if k)


def _extract(col: str):
    def run(batches):
        for b in batches:
            text = [main_text(x) for x in b.column(col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, n in zip(b.columns, b.schema.names) if n != col), pa.array(text, pa.string()),
                 pa.array([len(x) for x in text], pa.int64())],
                [*(n for n in b.schema.names if n != col), "text", "n_chars"])
    return run


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns with text and n_chars (code points)."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "text string", "n_chars long"])
    return pages.select(*keep, F.col(html_col).cast("string").alias("__html")).mapInArrow(_extract("__html"), schema)
