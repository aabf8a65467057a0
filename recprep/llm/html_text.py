"""Operator 6: main text of a web page by tree scoring.

Markup is read into a light tree (unclosed and stray tags are repaired as
browsers do for paragraphs, list items and table cells). Parts that are never
an article are left out: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments, told by tag, role, or a word of
their class or id. A form and a class word only make an element doubtful: one
that holds nearly all of the page's prose wraps the article and stays. Every
paragraph passes points for its length and its commas
to its ancestors, fewer the further up; a container's points are discounted by
its link density. The best container is kept, with those of its siblings that
score well or are plain prose.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recprep.llm.common import append_columns

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label "
                   "mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
SCOPES = frozenset("ul ol dl table body html article section div main td th".split())

#: What is never part of an article.
NEVER_TAGS = frozenset("nav footer aside button select dialog menu template svg math object "
                       "canvas video audio input".split())
NEVER_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog "
                        "menu menubar note".split())
#: What is doubtful: it may also wrap the article.
DOUBTFUL_TAGS = frozenset("form fieldset".split())
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adslot adsense sponsor sponsored sponsors promo "
    "promotion banner sidebar sidebars aside rail menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead topbar comment comments disqus respond replies discussion cookie "
    "cookies consent gdpr notice notices notification notifications alert newsletter subscribe "
    "subscription signup login social share sharing related recommended recommendations popup modal "
    "overlay widget widgets pagination pager toolbar skip hidden".split())
#: the words of these that mark what readers wrote, which may well be longer than the article
READER_WORDS = frozenset("comment comments disqus respond replies discussion".split())
#: a doubtful element wraps the article if it has at least so many characters of
#: prose, so many times the prose beside it, and at most this share of link text
WRAP_CHARS, WRAP_TIMES, WRAP_TIMES_READERS, WRAP_LINKS = 100, 3, 10, 0.5
#: Containers that are never left out for a word of their class.
KEPT_TAGS = frozenset("html body article main".split())
#: What holds the whole page.
WHOLE = frozenset("body html #root".split())
BONUS = {"article": 10.0, "main": 8.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0,
         "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "address": -3.0, "table": -3.0}
#: blocks that give their points to their parent, not to themselves
LEAVES = frozenset("p pre li dt dd blockquote h1 h2 h3 h4 h5 h6 figcaption caption address th".split())

_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
#: the end of a tag, or a quote that opens a value
_STOP = re.compile(r"""=\s*(["'])|>""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")


class _Page:
    """The tree of one page, as parallel lists by node number."""

    def __init__(self):
        self.tag, self.parent, self.out, self.linked = ["#root"], [-1], [False], [False]
        self.doubt: dict[int, tuple] = {}            # node: (tag and class, whether readers wrote it)
        self.stack, self.open = [0], {}
        self.pieces: list[tuple[int, str]] = []      # node, text ("" is a break)

    def start(self, tag: str, attrs: str) -> None:
        for other in CLOSES.get(tag, ()):
            self._close_near(other)
        if tag not in INLINE and self.open.get("p"):
            self._close_near("p")
        up = self.stack[-1]
        out = self.out[up] or self._never(tag, attrs)
        if tag not in INLINE:
            self.pieces.append((up, ""))
        if tag in VOID:
            return
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        self.out.append(out)
        self.linked.append(self.linked[up] or tag == "a")
        if not out and (doubt := self._doubt(tag, attrs)):
            self.doubt[n] = doubt
        self.stack.append(n)
        self.open[tag] = self.open.get(tag, 0) + 1

    @staticmethod
    def _doubt(tag: str, attrs: str) -> tuple | None:
        doubtful, readers, marks = tag in DOUBTFUL_TAGS, False, []
        if tag not in KEPT_TAGS:
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name == "role" and value.lower() == "form":
                    doubtful = True
                if name in ("class", "id"):
                    words = {w.lower() for w in _WORD.findall(value)} & NEVER_WORDS
                    doubtful = doubtful or bool(words)
                    readers = readers or bool(words & READER_WORDS)
                    if name == "class":
                        marks.append(value)
        return ((tag, *marks), readers) if doubtful else None

    def _never(self, tag: str, attrs: str) -> bool:
        if tag in NEVER_TAGS:
            return True
        if tag == "header" and not (self.open.get("article") or self.open.get("main")):
            return True
        if not attrs or tag in KEPT_TAGS:
            return False
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name == "role" and value.lower() in NEVER_ROLES:
                return True
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return True
            if name == "style" and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _close_near(self, tag: str) -> None:
        """Close ``tag`` if it is open inside the nearest container."""
        if not self.open.get(tag):
            return
        for n in reversed(self.stack):
            if self.tag[n] == tag:
                self.end(tag)
                return
            if self.tag[n] in SCOPES:
                return

    def end(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        while True:
            n = self.stack.pop()
            t = self.tag[n]
            self.open[t] -= 1
            if t not in INLINE:
                self.pieces.append((self.parent[n], ""))
            if t == tag:
                return

    def text(self, s: str) -> None:
        self.pieces.append((self.stack[-1], s))


def _tag_end(s: str, at: int, absent: set) -> int:
    """The index of the ``>`` that ends the tag at ``at``; a quoted value, of
    any length, may hold one. A quote that is never closed ends at the next
    ``>``; -1: no end at all. ``absent`` has the quotes that are known not to
    come again, so that a page is searched for each of them once in vain."""
    while True:
        m = _STOP.search(s, at)
        if not m:
            return -1
        if m.group() == ">":
            return m.start()
        quote, at = m.group(1), m.end()
        close = -1 if quote in absent else s.find(quote, at)
        if close < 0:
            absent.add(quote)
        else:
            at = close + 1


def parse(s: str) -> _Page:
    page, at, n = _Page(), 0, len(s)
    absent: set = set()
    while at < n:
        lt = s.find("<", at)
        if lt < 0:
            page.text(s[at:])
            break
        if lt > at:
            page.text(s[at:lt])
        c = s[lt + 1:lt + 2]
        if c == "!" or c == "?":
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _NAME.match(s, lt + 2 if c == "/" else lt + 1)
        if not m:
            if c == "/":                              # a stray end tag is a comment
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                page.text("<")
                at = lt + 1
            continue
        tag = m.group().lower()
        end = _tag_end(s, m.end(), absent)
        if end < 0:                                   # the page ends inside a tag
            break
        at = end + 1
        if c == "/":
            page.end(tag)
            if tag == "br" or tag == "p":
                page.pieces.append((page.stack[-1], ""))
            continue
        attrs = s[m.end():end]
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(s, at)
            if not close:
                break
            end = s.find(">", close.start())
            at = n if end < 0 else end + 1
            page.pieces.append((page.stack[-1], ""))
            continue
        page.start(tag, attrs)
        if attrs.endswith("/") and tag in ("svg", "math") and tag not in VOID:
            page.end(tag)
    return page


def _drop_doubtful(page: _Page) -> None:
    """Leave out the doubtful elements that do not wrap the article. The one
    with the most prose is judged first, against the prose that is under no
    doubtful element; what stays counts as such prose for the next ones."""
    if not page.doubt:
        return
    tag, parent, out, doubt = page.tag, page.parent, page.out, page.doubt
    n = len(tag)
    size, links = [0] * n, [0] * n
    for node, s in page.pieces:
        if s and not out[node] and not s.isspace():
            size[node] += len(s.strip())
            if page.linked[node]:
                links[node] += len(s.strip())
    under = [0] * n                                   # the nearest doubtful element, 0: none
    prose = {0: 0, **dict.fromkeys(doubt, 0)}         # under it and no nearer one
    for i in range(n):
        under[i] = i if i in doubt else under[parent[i]] if i else 0
        prose[under[i]] += size[i] - links[i]
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        links[parent[i]] += links[i]
    beside, stays = prose[0], {0}
    likes: set = set()
    for i in sorted(doubt, key=lambda i: (links[i] - size[i], i)):
        if under[parent[i]] not in stays:
            continue                                  # inside one that goes
        (kind, readers), own = doubt[i], size[i] - links[i]
        times = WRAP_TIMES_READERS if readers else WRAP_TIMES
        if links[i] <= WRAP_LINKS * size[i] and ((parent[i], kind) in likes or (
                own >= WRAP_CHARS and own > times * beside)):
            stays.add(i)
            if len(kind) > 1:
                likes.add((parent[i], kind))          # those of its class beside it, such as the next post
            beside += prose[i]
    for i in range(1, n):
        out[i] = out[i] or out[parent[i]] or (i in doubt and i not in stays)


def _raise(page: _Page, best: int, score: list, scored: list, top: float, density) -> int:
    """The highest ancestor of ``best``, up to a main element, that has another
    branch which scores comparably: half as high, or a fifth and 10 points at
    least. Such branches are further parts of the article (sections, posts)."""
    tag, parent, out = page.tag, page.parent, page.out
    peak = [score[i] if scored[i] and not out[i] and tag[i] not in INLINE else 0.0 for i in range(len(tag))]
    for i in range(len(tag) - 1, 0, -1):
        if not out[i]:
            peak[parent[i]] = max(peak[parent[i]], peak[i])
    chain = [best]
    while parent[chain[-1]] >= 0 and tag[chain[-1]] != "main":
        chain.append(parent[chain[-1]])
    level = {node: k for k, node in enumerate(chain)}
    found = 0
    for i in range(1, len(tag)):
        k = level.get(parent[i], 0)
        if k > found and i not in level and not out[i] and density(i) <= 0.5 and (
                peak[i] >= 0.5 * top or peak[i] >= max(10.0, 0.2 * top)):
            found = k
    return chain[found]


def main_text(source: str | None) -> str:
    """The article text of one page ("" if there is none): character
    references decoded, each run of white space one space. Of containers that
    score alike the first in page order is the best; the others are further
    parts of the article."""
    if not source:
        return ""
    page = parse(source)
    _drop_doubtful(page)
    tag, parent, out = page.tag, page.parent, page.out
    n = len(tag)
    block = list(range(n))                            # nearest block of each node
    for i in range(1, n):
        if tag[i] in INLINE:
            block[i] = block[parent[i]]
    own: list[list[str]] = [[] for _ in range(n)]
    size, links = [0] * n, [0] * n
    pieces = []
    for node, raw in page.pieces:
        if out[node]:
            continue
        s = html.unescape(raw) if "&" in raw else raw
        pieces.append((node, s))
        if s and not s.isspace():
            own[block[node]].append(s)
            size[node] += len(s)
            if page.linked[node]:
                links[node] += len(s)
    score = [0.0] * n
    scored = [False] * n
    for i in range(n):
        if not own[i]:
            continue
        s = " ".join(" ".join(own[i]).split())
        points = min(len(s) / 100, 3.0) + s.count(",") + (1.0 if len(s) >= 25 else 0.1)
        to, level = (parent[i] if tag[i] in LEAVES and parent[i] >= 0 else i), 0
        while to >= 0 and level < 5:
            score[to] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            scored[to] = True
            to, level = parent[to], level + 1
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        links[parent[i]] += links[i]

    def density(i: int) -> float:
        return links[i] / size[i] if size[i] else 0.0

    best, top = -1, 0.0
    for i in range(n):
        if scored[i] and not out[i] and tag[i] not in INLINE:
            v = (score[i] + BONUS.get(tag[i], 0.0)) * (1 - density(i))
            score[i] = v
            if v > top:
                best, top = i, v
    if best < 0:
        return ""
    up = best                                         # a lone article around the best is the article
    while up > 0 and tag[up] != "article":
        up = parent[up]
    lone = up > 0 and sum(t == "article" and not o for t, o in zip(tag, out)) == 1
    if lone:
        best = up
    kept, cut = {best}, set()
    if not lone:
        raised = _raise(page, best, score, scored, top, density)
        if raised != best:
            best, kept = raised, {raised}
            if tag[best] in WHOLE:                    # what is mostly links there is a menu
                cut = {i for i in range(n) if i and parent[i] == best and tag[i] not in INLINE and density(i) > 0.5}
        elif tag[best] not in WHOLE and tag[best] != "article":
            for i in range(n):
                if i == best or parent[i] != parent[best] or out[i] or tag[i] in INLINE or not size[i]:
                    continue
                if scored[i] and score[i] >= max(10.0, 0.2 * top):
                    kept.add(i)
                elif tag[i] in LEAVES and density(i) < (0.25 if size[i] > 80 else 0.01):
                    kept.add(i)
                elif tag[parent[i]] not in WHOLE and not links[i]:
                    kept.add(i)                       # plain text beside the article, inside its container
    inside = [False] * n
    for i in range(n):
        inside[i] = not out[i] and i not in cut and (i in kept or (i > 0 and inside[parent[i]]))
    return " ".join("".join(" " if s == "" else s for node, s in pieces if inside[node]).split())


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Append ``text_col``: the main text of each whole page. Null or empty
    pages, and pages without an article, give the empty text. Every row and
    other column is kept; equal pages give equal texts."""
    def make():
        return lambda pages: [[main_text(p) for p in pages]]
    return append_columns(df, [html_col], [T.StructField(text_col, T.StringType(), False)], make)
