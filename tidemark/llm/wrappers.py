"""Main text of web pages by union-free wrapper inference.

The pages of a host are token streams of structural tags and text. A first
page's stream is the wrapper; every further page is aligned with it. A text
matches any text (a slot). A mismatch is resolved into a repeated group (the same
run of tokens follows itself) or an optional group (one side has tokens the other
lacks). The result is a regular expression without unions over tags, slots,
``( )?`` and ``( )+``. It is compiled and matched against each page. Of a page it
matches, every element of the group's main opening token is a main region, and the
texts they cover are the article.

Texts are aligned by value where the wrapper matches: a container (a box, a list, a
table; no heading and no paragraph) that stands at one place with the same texts on
all pages of a group is template, its text no slot, and no part of an article. An
article's own "Summary" heading stays. Agreement counts from ``AGREEING`` different
pages on, two being alike by chance; where pages are copies, so that such texts are
more than half of a page's text, nothing is template.

The main region is the element that names itself the article (``article``,
``main`` or a telling class), else the innermost place that holds most of the slots'
text outside menus, headers, footers, sidebars, notices, adverts, forms and
comments. What such an element holds is left out wherever it stands.

A host's pages are dealt into groups of about ``GROUP_BYTES`` by a hash of the
row, so a host with any number of pages is many small tasks. A page that its
group's wrapper does not match is read by the same rules without it. NULL html
is empty; broken markup is closed at its end; markup cut off in the middle of a
tag ends there.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, keep, table

GROUP_BYTES = 1 << 20
AGREEING = 3

#: Fixed values of HTML: elements whose content is no text, that are empty, or
#: that stand within a line; and elements that a following one closes.
SILENT = ["script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "math"]
SILENT += ["audio", "video", "textarea", "select", "title"]
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source"]
VOID += ["track", "wbr", "param"]
INLINE = ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn"]
INLINE += ["em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span"]
INLINE += ["strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img", "link"]
INLINE += ["meta", "base", "input"]
SELF_CLOSING = ["p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "option"]

#: Elements that are a text of their own, not a box of texts.
TEXTUAL = ["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "pre"]
TEXTUAL += ["blockquote", "figcaption", "caption", "summary", "address", "option"]

#: Elements, and words of a class, id or role, that are not part of an article.
ASIDE_TAGS = ["nav", "footer", "aside", "form", "button", "dialog", "menu", "head", "fieldset"]
ASIDE_WORDS = ["nav", "navigation", "navbar", "menu", "header", "masthead", "footer", "sidebar"]
ASIDE_WORDS += ["aside", "notice", "cookie", "cookies", "consent", "banner", "popup", "modal"]
ASIDE_WORDS += ["overlay", "alert", "ad", "ads", "adv", "advert", "adverts", "advertisement"]
ASIDE_WORDS += ["sponsor", "sponsored", "promo", "promotion", "form", "newsletter", "subscribe"]
ASIDE_WORDS += ["signup", "login", "search", "comment", "comments", "disqus", "replies", "respond"]
ASIDE_WORDS += ["share", "sharing", "social", "related", "recommended", "breadcrumb", "breadcrumbs"]
ASIDE_WORDS += ["pagination", "pager", "toc", "skip", "widget", "contentinfo", "complementary"]
ASIDE_WORDS += ["reply", "discussion", "reactions", "reviews", "notification", "gdpr", "disclaimer"]
ASIDE_WORDS += ["copyright", "teaser", "topbar", "toolbar", "sitemap", "crumbs"]
MAIN_TAGS = ["article", "main"]
MAIN_WORDS = ["article", "articlebody", "main", "post", "entry", "story"]

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(SILENT)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*+(?:>|\Z)"
    r"|([^<]++|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")

TEXT = "#"
_inline, _void, _closing = set(INLINE), set(VOID), set(SELF_CLOSING)
_aside_tags, _aside_words = set(ASIDE_TAGS), set(ASIDE_WORDS)
_main_tags, _main_words = set(MAIN_TAGS), set(MAIN_WORDS)
_textual = set(TEXTUAL)


@dataclass
class Page:
    """A page's structural tokens and the text of each (empty for tags).

    A token is TEXT, "<name words" or ">" + the opening token it closes. ``names`` has
    all words of an opening token's class and id (empty for others).
    """

    tokens: list[str]
    texts: list[str]
    names: list[str]


def _signature(name: str, attributes: str) -> str:
    """The opening token: the element and the telling words of its names."""
    if not attributes or "=" not in attributes:
        return f"<{name}"
    words: set[str] = set()
    for found in _NAMES.findall(attributes):
        words.update(_WORD.findall(_CAMEL.sub("-", "".join(found)).lower()))
    telling = sorted(words & (_aside_words | _main_words))
    return " ".join([f"<{name}", *telling])


def read_page(source: str | None) -> Page:
    """The balanced structural token stream of a page."""
    tokens: list[str] = []
    texts: list[str] = []
    names: list[str] = []
    stack: list[tuple[str, str]] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = _SPACE.sub(" ", html.unescape("".join(pending))).strip()
            pending.clear()
            if text:
                tokens.append(TEXT)
                texts.append(text)
                names.append("")

    def close() -> None:
        tokens.append(">" + stack.pop()[1][1:])
        texts.append("")
        names.append("")

    for match in _TOKEN.finditer(source or ""):
        silent, slash, name, attributes, text = match.groups()
        if text is not None:
            pending.append(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name in _inline:
            if name == "br":
                pending.append(" ")
            continue
        flush()
        if slash:
            if any(n == name for n, _ in stack):
                while stack[-1][0] != name:
                    close()
                close()
            continue
        if name in _void or attributes.endswith("/"):
            continue
        if name in _closing and stack and stack[-1][0] == name:
            close()
        elif stack and stack[-1][0] == "p" and name not in _closing:
            close()
        token = _signature(name, attributes)
        stack.append((name, token))
        tokens.append(token)
        texts.append("")
        names.append(" ".join("".join(n) for n in _NAMES.findall(attributes)) if "=" in attributes else "")
    flush()
    while stack:
        close()
    return Page(tokens, texts, names)


@dataclass
class Element:
    """An element's tokens ``start`` to ``end`` and its place: names from the root down."""

    place: tuple
    start: int
    end: int


def elements_of(page: Page) -> list[Element]:
    """All elements of a page, inner ones first."""
    out, stack = [], []
    for at, token in enumerate(page.tokens):
        if token == TEXT:
            continue
        if token[0] == "<":
            above = stack[-1].place if stack else ()
            stack.append(Element((*above, (token, page.names[at])), at, at))
        else:
            stack[-1].end = at + 1
            out.append(stack.pop())
    return out


def _is_textual(element: Element) -> bool:
    return element.place[-1][0][1:].split(" ")[0] in _textual


def _texts_in(page: Page, element: Element) -> tuple[str, ...]:
    return tuple(t for t in page.texts[element.start : element.end] if t)


def _is_aside(token: str, in_article: bool = False) -> bool:
    """Whether an element is no part of an article; an article's own header is."""
    name, *words = token[1:].split(" ")
    if name == "header" or words == ["header"]:
        return not in_article
    if "header" in words and any(w in _main_words for w in words):
        words = [w for w in words if w != "header"]
    return name in _aside_tags or (name != "body" and any(w in _aside_words for w in words))


def _is_main(token: str) -> bool:
    name, *words = token[1:].split(" ")
    return name in _main_tags or any(w in _main_words for w in words)


# -- wrappers ---------------------------------------------------------------
# A wrapper is a list of nodes: a token, ("?", nodes) or ("+", nodes).

LONGEST_GROUP = 12


def fold(nodes: list) -> list:
    """Runs that follow themselves become repeated groups."""
    out: list = []
    for node in nodes:
        out.append(node)
        folded = True
        while folded:
            folded = False
            for size in range(1, min(LONGEST_GROUP, len(out)) + 1):
                group = out[-size:]
                before = out[-size - 1] if len(out) > size else None
                if before == ("+", tuple(group)):
                    del out[-size:]
                elif len(out) >= 2 * size and out[-2 * size : -size] == group:
                    if size == 1 and isinstance(group[0], tuple):
                        del out[-1:]
                    elif _balanced(group):
                        out[-2 * size :] = [("+", tuple(group))]
                    else:
                        continue
                else:
                    continue
                folded = True
                break
    return out


def _balanced(nodes: list) -> bool:
    depth = 0
    for node in nodes:
        if isinstance(node, str) and node != TEXT:
            depth += 1 if node[0] == "<" else -1
            if depth < 0:
                return False
    return depth == 0


def _plain(node):
    """A node without its quantifier, as a list."""
    return list(node[1]) if isinstance(node, tuple) else [node]


def align(wrapper: list, page: list) -> list:
    """The wrapper generalised to cover a folded page too."""
    out: list = []
    i = j = 0
    while i < len(wrapper) and j < len(page):
        a, b = wrapper[i], page[j]
        if a == b or (isinstance(a, tuple) and isinstance(b, tuple) and _plain(a) == _plain(b)):
            kinds = {n[0] for n in (a, b) if isinstance(n, tuple)}
            out.append(a if a == b else ("*", a[1]) if "?" in kinds or "*" in kinds else ("+", a[1]))
            i, j = i + 1, j + 1
            continue
        if isinstance(a, tuple):
            group = _plain(a)
            if page[j : j + len(group)] == group:
                out.append(a)
                i, j = i + 1, j + len(group)
                continue
        if isinstance(b, tuple):
            group = _plain(b)
            if wrapper[i : i + len(group)] == group:
                out.append(b)
                i, j = i + len(group), j + 1
                continue
        if isinstance(a, tuple) and a[0] in "?*":
            out.append(a)
            i += 1
            continue
        skip_a = _ahead(wrapper, i, b)
        skip_b = _ahead(page, j, a)
        if skip_b is not None and (skip_a is None or skip_b <= skip_a):
            out.append(("?", tuple(page[j : j + skip_b])))
            j += skip_b
        elif skip_a is not None:
            out.append(("?", tuple(wrapper[i : i + skip_a])))
            i += skip_a
        else:
            out += [("?", (a,)) if isinstance(a, str) else a, ("?", tuple(_plain(b)))]
            i, j = i + 1, j + 1
    for rest in (wrapper[i:], page[j:]):
        for node in rest:
            out.append(node if isinstance(node, tuple) and node[0] in "?*" else ("?", tuple(_plain(node))))
    return out


def _ahead(nodes: list, start: int, wanted) -> int | None:
    """How many balanced nodes stand before the next one equal to ``wanted``."""
    for k in range(start + 1, len(nodes)):
        if nodes[k] == wanted and _balanced(nodes[start:k]):
            return k - start
    return None


def _expression(nodes, symbols: dict[str, str]) -> str:
    parts = []
    for node in nodes:
        if isinstance(node, tuple):
            parts.append(f"(?:{_expression(node[1], symbols)}){node[0]}+")
        else:
            parts.append(re.escape(symbols[node]))
    return "".join(parts)


def template_parts(pages: list[Page]) -> set[tuple]:
    """(place, texts) of the containers that all different pages of a group share."""
    distinct = list({tuple(p.texts): p for p in pages if any(p.texts)}.values())
    if len(distinct) < AGREEING:
        return set()
    shared: set[tuple] | None = None
    for page in distinct:
        own = {(e.place, _texts_in(page, e)) for e in elements_of(page) if not _is_textual(e)}
        shared = own if shared is None else shared & own
    shared = {part for part in shared or () if part[1]}
    for page in distinct if shared else ():
        constant = sum(len(page.texts[at]) for at in template_places(page, shared))
        if 2 * constant > sum(map(len, page.texts)):
            return set()
    return shared


def template_places(page: Page, parts: set[tuple]) -> set[int]:
    """Places of the tokens within a page's template."""
    places: set[int] = set()
    for element in elements_of(page) if parts else ():
        if not _is_textual(element) and (element.place, _texts_in(page, element)) in parts:
            places.update(range(element.start, element.end))
    return places


class Wrapper:
    """The inferred expression of a group of pages."""

    def __init__(self, pages: list[Page]):
        self.symbols: dict[str, str] = {}
        wrapper: list | None = None
        seen: set[tuple] = set()
        for page in pages:
            folded = fold(page.tokens)
            shape = tuple(folded)
            if shape in seen or not folded:
                continue
            seen.add(shape)
            wrapper = folded if wrapper is None else fold(align(wrapper, folded))
        self.nodes = wrapper or []
        for page in pages:
            for token in page.tokens:
                self.symbols.setdefault(token, chr(0xE000 + len(self.symbols)))
        self.template = template_parts(pages)
        self.main = main_token(pages)
        self.place = None if self.main else main_place(pages, self.template)
        self.pattern = None
        if self.nodes and (self.main or self.place) and len(self.symbols) < 6000:
            try:
                self.pattern = re.compile(_expression(self.nodes, self.symbols))
            except (re.error, RecursionError):
                self.pattern = None

    def matches(self, page: Page) -> bool:
        if self.pattern is None:
            return False
        return self.pattern.fullmatch("".join(map(self.symbols.__getitem__, page.tokens))) is not None

    def regions(self, page: Page) -> list[tuple[int, int]]:
        """The main regions' tokens in a page that the expression matches."""
        if self.main:
            return elements(page, self.main)
        return sorted((e.start, e.end) for e in elements_of(page) if e.place == self.place)


def main_place(pages: list[Page], template: set[tuple]) -> tuple | None:
    """The innermost place that holds most of what varies between the pages."""
    holding: Counter = Counter()
    total = 0
    for page in pages:
        constant = template_places(page, template)
        aside: set[int] = set()
        found = elements_of(page)
        for element in found:
            if _is_aside(element.place[-1][0]):
                aside.update(range(element.start, element.end))
        sizes = [0 if at in constant or at in aside else len(t) for at, t in enumerate(page.texts)]
        sums = [0, *accumulate(sizes)]
        total += sums[-1]
        for element in found:
            if not _is_textual(element):
                holding[element.place] += sums[element.end] - sums[element.start]
    # A box in the same place several times over holds a part of the article each.
    full = [p for p, size in holding.items() if total and size * 10 >= total * 9]
    return max(full, key=lambda p: (len(p), holding[p], p), default=None)


def main_token(pages: list[Page], named_only: bool = True) -> str | None:
    """The opening token of the main region of a group of pages."""
    named: Counter = Counter()
    holding: Counter = Counter()
    total = 0
    depth_of: dict[str, int] = {}
    repeated: set[str] = set()
    for page in pages:
        repeated.update(t for t, n in Counter(page.tokens).items() if n > 1)
        stack: list[str] = []
        aside = 0
        for token, text in zip(page.tokens, page.texts, strict=True):
            if token == TEXT:
                if not aside:
                    total += len(text)
                    for open_token in set(stack):
                        holding[open_token] += len(text)
            elif token[0] == "<":
                stack.append(token)
                aside += _is_aside(token)
                depth_of[token] = max(depth_of.get(token, 0), len(stack))
            else:
                aside -= _is_aside(stack.pop())
    for token, size in holding.items():
        if _is_main(token) and not _is_aside(token):
            named[token] = size
    if named:
        # The largest; of nested ones with the same text the outermost.
        return max(named, key=lambda t: (named[t], -depth_of[t], t))
    if named_only:
        return None
    full = [t for t, size in holding.items() if size * 10 >= total * 9 and t not in repeated]
    return max(full, key=lambda t: (depth_of[t], t), default=None)


def regions_without_wrapper(page: Page) -> list[tuple[int, int]]:
    """The main regions by the page's own names, else the whole page."""
    return elements(page, main_token([page], named_only=False)) or [(0, len(page.tokens))]


def elements(page: Page, main: str | None) -> list[tuple[int, int]]:
    """The outermost elements that ``main`` opens."""
    spans, depth, start = [], 0, -1
    for at, token in enumerate(page.tokens):
        if token == TEXT:
            continue
        if start < 0 and token == main:
            start, depth = at, 0
        if start >= 0:
            depth += 1 if token[0] == "<" else -1
            if depth == 0:
                spans.append((start, at + 1))
                start = -1
    return spans


def blocks(page: Page, span: tuple[int, int], template: set[int] = frozenset()) -> list[str]:
    """The texts of a region, without ``template`` and those of elements that stand aside."""
    out, aside = [], 0
    in_article = span[0] < len(page.tokens) and _is_main(page.tokens[span[0]])
    for at in range(*span):
        token = page.tokens[at]
        if token == TEXT:
            if not aside and at not in template:
                out.append(page.texts[at])
        elif _is_aside(token, in_article):
            aside += 1 if token[0] == "<" else -1
    return out


def main_texts(sources: list[str | None]) -> list[str]:
    """The main text of each page of one group."""
    pages = [read_page(s) for s in sources]
    wrapper = Wrapper(pages)
    out = []
    for page in pages:
        matched = wrapper.matches(page)
        template = template_places(page, wrapper.template) if matched else set()
        spans = (wrapper.regions(page) if matched else []) or regions_without_wrapper(page)
        out.append("\n\n".join(b for s in spans for b in blocks(page, s, template)))
    return out


def extract_main_text(pages: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    sizes = rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes"))
    sizes = keep(sizes.select("host", (F.ceil(F.col("bytes") / group_bytes) + 1).alias("groups")))
    if sizes.count() <= BROADCAST_KEYS:
        sizes = F.broadcast(sizes)
    # Rows of one id and address are dealt apart too.
    place = F.xxhash64("page_id", "url", F.monotonically_increasing_id())
    groups = F.greatest(F.coalesce("groups", F.lit(1)), F.lit(1))
    dealt = rows.join(sizes, "host", "left").withColumn("part", F.pmod(place, groups))

    def extract(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["page_id", "url"], kind="stable")
        texts = main_texts(frame["html"].tolist())
        out = pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})
        out["n_chars"] = [len(t) for t in texts]
        out["page_id"] = out["page_id"].astype("Int64")
        return out

    shape = "page_id long, url string, text string, n_chars long"
    return dealt.select("page_id", "url", "html", "host", "part").groupBy("host", "part").applyInPandas(extract, shape)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
