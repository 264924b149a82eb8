"""Main text of web pages by maximum-scoring subsequence (operator 8).

A page is a sequence of words and tags. Every word scores +1 (-1 inside an
element that is left out, so a long notice never outweighs a short article),
every tag a negative weight learned from labelled pages: pages that mark their
article (``article``, ``main`` or ``role=main``) tell how often a tag stands
outside of it and how many words follow it there. One linear scan finds the contiguous
region with the largest total. The text comes from the ancestor of that region
whose own total (left-out elements aside) is largest, so that weak first and
last blocks of an article are not lost; inside it menus, page headers and
footers, sidebars, notices, adverts, forms, scripts, styles, comments of the
mark-up and of readers are left out. Character references are decoded, white
space inside a block becomes one space, blocks are joined by one line feed.

Defined cases: null and empty pages, and pages without words, give an empty
text; unclosed, crossed and unknown tags are tolerated (a ``<`` that starts no
tag is text); plain text without tags is one block; very long pages are
scanned in linear time; repeated rows get equal results; without labelled
pages the weights are the fixed ones below; an empty table gives an empty
table; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 4_000       # labelled pages that the weights are learned from
FEATURES = 4_096          # most frequent tags with a weight of their own
LEAST = 0.2               # what a tag costs that only stands in articles
UNSEEN = 0.5              # what a tag without a weight costs
# Elements by their part in a page.
RAW = frozenset("script style noscript template iframe svg textarea select title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike "
                   "strong sub sup time tt u var wbr img object "
                   "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mpadded "
                   "mphantom menclose merror mmultiscripts mprescripts".split())
LEFT_OUT = frozenset("nav footer aside form button menu dialog head".split()) | RAW
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
LEFT_OUT_NAMES = frozenset("ad ads advert advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar "
                           "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
                           "signup share sharing social related recommended comments comment-list commentlist disqus respond masthead topbar "
                           "pagination pager widget".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article main section div td th table ul ol dl body html blockquote nav aside footer header form".split())
MARKS = frozenset(("article", "main"))
FIXED = {"nav": -12.0, "footer": -30.0, "aside": -30.0, "form": -12.0, "header": -12.0, "li": -2.0, "ul": -2.0, "a": -1.5, "title": -30.0}

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[^\s]+")
_SPLIT = re.compile(r"[\s_]+")
_SPACE = re.compile(r"\s+")
_SHUT = {name: re.compile("</" + name, re.I | re.A) for name in RAW}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open' | 'close', name, attributes) in page order;
    comments, declarations and the contents of raw elements are dropped."""
    at, n, text_from, unclosed = 0, len(page), 0, {}

    def find(what: str, start: int) -> int:
        if unclosed.get(what, n + 1) <= start:      # known to be missing from here on
            return -1
        k = page.find(what, start)
        if k < 0:
            unclosed[what] = start
        return k
    while True:
        lt = page.find("<", at)
        if lt < 0 or lt + 1 >= n:
            break
        c = page[lt + 1]
        if page.startswith("<!--", lt):
            end = find("-->", lt + 4)
            stop = n if end < 0 else end + 3
            kind = name = attrs = ""
        elif c in "!?":
            end = find(">", lt + 2)
            stop = n if end < 0 else end + 1
            kind = name = attrs = ""
        elif c.isascii() and (c.isalpha() or c == "/"):
            m = _NAME.match(page, lt + 1)
            if not m:
                at = lt + 2
                continue
            k = m.end()
            while True:                              # the first > outside of quotes
                gt = find(">", k)
                if gt < 0:
                    break
                quote = min((q for q in (page.find('="', k, gt), page.find("='", k, gt)) if q >= 0), default=-1)
                if quote < 0:
                    break
                shut = find(page[quote + 1], quote + 2)
                if shut < 0:
                    break
                k = shut + 1
            if gt < 0:
                at = lt + 1
                if find(">", lt) < 0:
                    break
                continue
            stop = gt + 1
            name, attrs = m[1].lower().rstrip("/"), page[m.end():gt]
            kind = "close" if c == "/" else "open"
        else:
            at = lt + 1
            continue
        if lt > text_from:
            yield "text", page[text_from:lt], ""
        if kind:
            yield kind, name, attrs
            if kind == "open" and name in RAW and not attrs.endswith("/"):
                shut = _SHUT[name].search(page, stop)
                stop = shut.start() if shut else n
        at = text_from = stop
    if text_from < n:
        yield "text", page[text_from:], ""


def names_of(attrs: str) -> tuple[set[str], str]:
    """Class and id names, and the role, of a tag."""
    names, role = set(), ""
    if attrs:
        for key, a, b, c in _ATTR.findall(attrs):
            value = (a or b or c).lower()
            if key.lower() == "role":
                role = value.strip()
            else:
                names.update(x for x in _SPLIT.split(value) if x)
    return names, role


def left_out(name: str, names: set[str], role: str, inside_article: bool) -> bool:
    return (name in LEFT_OUT or role in LEFT_OUT_ROLES or (name == "header" and not inside_article)
            or (name not in ("body", "html", "article", "main") and not names.isdisjoint(LEFT_OUT_NAMES)))


class Page:
    """Parallel lists over the tokens of a page: feature of a tag or None,
    words, text, whether left out, and the element it stands in."""

    def __init__(self, page: str):
        self.feature, self.words, self.text, self.out, self.owner = [], [], [], [], []
        self.parent, self.first, self.last, self.mark = [-1], [0], [0], [False]     # of each element; 0 is the page
        stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]          # name, element, left out, inside an article
        for kind, name, attrs in tokens(page):
            if kind == "text":
                self._add(None, name, stack[-1])
            elif kind == "open":
                self._imply(stack, name)
                names, role = names_of(attrs)
                top = stack[-1]
                inside = top[3] or name in MARKS or role == "main"
                feature = name + "".join(sorted("." + x for x in names))
                e = len(self.parent)
                out = top[2] or left_out(name, names, role, top[3])
                self.parent.append(top[1])
                self.first.append(len(self.feature))
                self.last.append(len(self.feature) + 1)
                self.mark.append(name in MARKS or role == "main")
                entry = (name, e, out, inside)
                self._add(feature, name, entry)
                if name not in VOID and not attrs.endswith("/"):
                    stack.append(entry)
            else:
                at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                self._add("/" + name, name, stack[at] if at else stack[-1])
                if at:
                    self._close(stack, at)
        self._close(stack, 1)
        self.last[0] = len(self.feature)

    def _add(self, feature, text, entry):
        self.feature.append(feature)
        self.text.append(text)
        self.words.append(0 if feature is not None else len(_WORDS.findall(text)))
        self.out.append(entry[2])
        self.owner.append(entry[1])

    def _close(self, stack, at):
        for entry in stack[at:]:
            self.last[entry[1]] = len(self.feature)
        del stack[at:]

    def _imply(self, stack, name):
        """End tags that a start tag implies."""
        ends = SELF_CLOSING.get(name)
        if ends is None and name not in INLINE and name not in VOID:
            ends = {"p"}
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    self._close(stack, i)
                    return
                if stack[i][0] in SCOPE:
                    return

    def region(self, weights: dict[str, float]) -> tuple[list[float], int, int]:
        """Scores, and the first and last token of the best contiguous region.
        Words that are left out count against a region as much as others for it."""
        score = [(-w if out else w) if f is None else weights.get(f, weights.get(f.split(".")[0], -UNSEEN))
                 for f, w, out in zip(self.feature, self.words, self.out)]
        best, lo, hi, total, start = 0.0, 0, -1, 0.0, 0
        for i, s in enumerate(score):
            if total <= 0:
                total, start = 0.0, i
            total += s
            if total > best:
                best, lo, hi = total, start, i
        return score, lo, hi

    def main_text(self, weights: dict[str, float]) -> str:
        score, lo, hi = self.region(weights)
        if hi < lo:
            return ""
        # totals of elements without what is left out
        prefix = [0.0]
        for s, out in zip(score, self.out):
            prefix.append(prefix[-1] + (0.0 if out else s))
        chain, e = [], self.owner[lo]
        while e >= 0:
            if self.first[e] <= lo and hi < self.last[e]:
                chain.append(e)
            e = self.parent[e]
        e = max(reversed(chain), key=lambda x: prefix[self.last[x]] - prefix[self.first[x]])     # the outermost of equals
        blocks, open_ = [], []
        for i in range(self.first[e], self.last[e]):
            if self.feature[i] is None:
                if not self.out[i]:
                    open_.append(self.text[i])
            elif self.text[i] not in INLINE:
                blocks.append(open_)
                open_ = []
        blocks.append(open_)
        done = (_SPACE.sub(" ", html.unescape("".join(b))).strip() for b in blocks if b)
        return "\n".join(b for b in done if b)

    def evidence(self) -> dict[str, list[float]] | None:
        """By tag: times inside and outside the marked article, and the words
        that follow it outside and are not left out anyway; None when the page
        marks none."""
        spans = [(self.first[e], self.last[e]) for e, m in enumerate(self.mark) if m]
        if not spans:
            return None
        found: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
        edges = sorted(spans)
        k, stop = 0, -1
        last = None
        for i, (f, w) in enumerate(zip(self.feature, self.words)):
            while k < len(edges) and edges[k][0] <= i:
                stop = max(stop, edges[k][1])
                k += 1
            inside = i < stop and not self.out[i]
            if f is None:
                if last is not None and not inside and not self.out[i]:
                    found[last][2] += w
            else:
                found[f][0 if inside else 1] += 1
                last = f
        return found


def train(pages: DataFrame, html_col: str = "html", key: str = "page_id", most: int = TRAIN_PAGES) -> dict[str, float]:
    """Tag weights from about ``most`` labelled pages (those whose hash lies
    under that share of them); at most FEATURES weights reach the driver."""
    marked = pages.where(F.lower(F.col(html_col)).rlike(r"<(article|main)[\s>]|role\s*=\s*[\"']?main"))
    share = min(1.0, most / max(marked.count(), 1))
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("train")), F.lit(1 << 20)) / float(1 << 20)
    part = marked.where(draw < share).select(F.col(html_col).alias("html"))

    def run(batches):
        total: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
        for b in batches:
            for x in b.column("html"):
                for f, v in (Page(x.as_py()).evidence() or {}).items():
                    total[f] = [p + q for p, q in zip(total[f], v)]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), *(pa.array([v[i] for v in total.values()], pa.float64()) for i in range(3))],
                                         ["tag", "inside", "outside", "words"])
    sums = (part.mapInArrow(run, "tag string, inside double, outside double, words double").groupBy("tag")
            .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"), F.sum("words").alias("words"))
            .orderBy(F.desc(F.col("inside") + F.col("outside")), "tag").limit(FEATURES).collect())
    weights = dict(FIXED)
    for r in sums:
        share = r.outside / (r.inside + r.outside + 1)
        follow = r.words / max(r.outside, 1.0)
        weights[r.tag] = -(LEAST + share * (1 + 1.5 * follow))
    return weights


def main_text(page: Column, weights: dict[str, float]) -> Column:
    """Main text of an HTML page (empty when it has none)."""
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in it:
            yield pa.array([Page(x.as_py() or "").main_text(weights) for x in column], pa.string())
    run.__annotations__ = {"it": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string").asNondeterministic()(page)
