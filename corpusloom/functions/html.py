"""Records from pages of HTML, with the standard parser in Arrow functions.

A selector is a tag, classes and attribute tests or any of them together, and several with blanks between them for elements in others:
``h1``, ``.title``, ``a.author``, ``time[datetime]``, ``.card a[href*="/u/"]``.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import _c

_SIMPLE = re.compile(r"\[([\w-]+)(?:([*^]?=)[\"']?([^\"'\]]*)[\"']?)?\]|([.#]?)([\w-]+)")
_EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
Test = tuple[str, str, str, str]


class _Node:
    __slots__ = ("tag", "attrs", "parts", "parent", "at", "end")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: _Node | None, at: int) -> None:
        self.tag, self.attrs, self.parts, self.parent, self.at, self.end = tag, attrs, [], parent, at, at + 1

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def up(self) -> Iterator[_Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class Page(HTMLParser):
    """The elements of a page in document order, each with its text; unclosed elements end with their parent."""

    def __init__(self, html: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[_Node] = []
        self.texts: list[str] = []
        self._open: list[_Node] = []
        self.feed(html or "")
        self.close()
        for node in self._open:
            node.end = len(self.nodes)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = _Node(tag, dict(attrs), self._open[-1] if self._open else None, len(self.nodes))
        self.nodes.append(node)
        if tag not in _EMPTY:
            self._open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i].tag == tag:
                for node in self._open[i:]:
                    node.end = len(self.nodes)
                del self._open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.texts.append(data)
        for node in self._open:
            node.parts.append(data)

    def select(self, selector: str, within: _Node | None = None) -> list[_Node]:
        """Elements that fit the last part of the selector and lie, outwards, in elements that fit the others."""
        chain = [_tests(part) for part in selector.split()]
        nodes = self.nodes if within is None else self.nodes[within.at + 1 : within.end]
        return [n for n in nodes if _fits(n, chain[-1]) and _inside(n, chain[:-1])]


@functools.lru_cache(maxsize=1024)
def _tests(part: str) -> tuple[Test, ...]:
    tests, at = [], 0
    for m in _SIMPLE.finditer(part):
        if m.start() != at:
            break
        attr, op, value, mark, name = m.groups()
        tests.append(("attr", attr, op or "", value or "") if attr else ({".": "class", "#": "id"}.get(mark, "tag"), name, "", ""))
        at = m.end()
    if at != len(part) or not tests:
        raise ValueError(f"selector {part!r}")
    return tuple(tests)


def _fits(node: _Node, tests: tuple[Test, ...]) -> bool:
    for kind, name, op, value in tests:
        if kind == "tag":
            ok = node.tag == name.lower()
        elif kind == "class":
            ok = name in node.classes
        elif kind == "id":
            ok = node.attrs.get("id") == name
        else:
            have = node.attrs.get(name) or ""
            ok = name in node.attrs and (op == "" or op == "=" and have == value or op == "*=" and value in have or op == "^=" and have.startswith(value))
        if not ok:
            return False
    return True


def _inside(node: _Node, outer: list[tuple[Test, ...]]) -> bool:
    above = node.up()
    return all(any(_fits(n, tests) for n in above) for tests in reversed(outer))


def text_of(node: _Node) -> str:
    """The pieces of text between tags, each without white space at its ends, put together."""
    return "".join(p.strip() for p in node.parts)


def lines_of(node: _Node) -> str:
    """The text as it is, without white space at the ends: what code must keep."""
    return "".join(node.parts).strip()


def first_text(page: Page, selectors: Sequence[str], within: _Node | None = None, of: Callable[[_Node], str] = text_of) -> str | None:
    """The text of the first selector's first element."""
    for s in selectors:
        if found := page.select(s, within):
            return of(found[0])
    return None


def first_attribute(page: Page, selectors: Sequence[str], attribute: str, within: _Node | None = None) -> str | None:
    """The attribute of the first selector's first element, null if it lacks it."""
    for s in selectors:
        if found := page.select(s, within):
            return found[0].attrs.get(attribute)
    return None


def _number(text: str | None) -> int:
    """The first run of digits without thousands separators, else 0."""
    m = re.search(r"\d+", (text or "").replace(",", ""))
    return int(m[0]) if m else 0


def _over_pages(kind: T.DataType, f):
    @F.pandas_udf(kind)
    def run(html: pd.Series) -> pd.Series:
        return html.map(lambda h: f(Page(h if isinstance(h, str) else None)))

    return run


def _records(kind: T.StructType, f: Callable[[Page, str], dict], html: Column | str, base: Column | str) -> Column:
    def run(htmls: pd.Series, bases: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([f(Page(h if isinstance(h, str) else None), b if isinstance(b, str) else "") for h, b in zip(htmls, bases)], columns=kind.names).astype(object)

    run.__annotations__ = {"htmls": pd.Series, "bases": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, kind)(_c(html), _c(base))


def select_text(html: Column | str, *selectors: str) -> Column:
    return _over_pages(T.StringType(), lambda p: first_text(p, selectors))(_c(html))


def select_attribute(html: Column | str, attribute: str, *selectors: str) -> Column:
    return _over_pages(T.StringType(), lambda p: first_attribute(p, selectors, attribute))(_c(html))


# Selectors of listing and script pages (fixed values).
CARD_TITLE = ('a[data-qa-id="ui-lib-card-link-title"]', ".card-title a", "h3 a", 'a[href*="/script/"]')
CARD_AUTHOR = ('a[class*="author"]', ".card-author a", '[data-qa-id*="author"] a')
CARD_LIKES = ('button[class*="boost"]', ".boost-button", '[data-qa-id*="boost"]', ".likes-count")
CARD_COMMENTS = ('a[data-qa-id="ui-lib-card-comment-button"]', ".comment-button", '[href*="comment"]')
TITLE = ('h1[data-name="legend-source-title"]', ".tv-chart-view__title", "h1.js-script-title", ".script-title h1", "h1")
DESCRIPTION = (
    ".content-aqIxarm1 .description-aqIxarm1", ".description-aqIxarm1", ".description-aqIxarm1 .update-_PPhhqv6", ".description-aqIxarm1 .ast-_PPhhqv6",
    ".tv-chart-view__description", ".js-description-content", '[data-name="description"]', ".script-description", ".description",
)
CREATED = ("time[datetime]", ".tv-chart-view__published-date time", '[data-name="published-date"]', ".published-date time")
CHART = ('a[href*="/chart/"]', ".js-chart-link", ".chart-link")
SYMBOL_NAME = ('[data-name="legend-source-description"] .js-symbol-name', ".tv-symbol-header__short-name", ".js-symbol-link", ".symbol-name")
USER = ('[class*="usernameOutline-"] [class*="username"]', "a[data-username]", ".tv-user-link", ".js-username-link", ".author-link")
LIKES = (".js-likes-count", ".js-boost-count", '[data-name="like-count"]', ".boost-count", ".likes-count")
EDITOR = ('span[class*="mtk"]',)
CODE = ("pre.tv-chart-view__source-code", ".js-source-code", 'textarea[name="source"]', ".CodeMirror-code", ".pine-code", ".source-code pre", '[class*="monaco-editor"]', '[class*="editor"]')
CODE_MARKS = ("@version", "indicator", "strategy")
CODE_TEXT = (r"@version\s*=\s*\d+", r"//@version\s*=\s*\d+", r"indicator\s*\([^)]+\)", r"strategy\s*\([^)]+\)")

CARD = T.StructType([
    T.StructField("script_url", T.StringType()), T.StructField("preview_title", T.StringType()), T.StructField("preview_author", T.StringType()), T.StructField("preview_author_url", T.StringType()),
    T.StructField("preview_created_at", T.StringType()), T.StructField("preview_created_display", T.StringType()), T.StructField("preview_likes_count", T.LongType()), T.StructField("preview_comments_count", T.LongType()),
])
SCRIPT = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("name", "description", "created_at", "chart_url", "symbol", "username", "profile_url")],
    T.StructField("pro_plan", T.BooleanType()), T.StructField("likes_count", T.LongType()), T.StructField("source_code", T.StringType()),
])


def _cards(page: Page, card: str) -> Iterator[tuple[_Node, _Node]]:
    """Each article whose class has ``card``, with its first link to ``/script/<id>/``."""
    for article in page.select(f'article[class*="{card}"]'):
        link = next((a for a in page.select("a[href]", article) if re.search(r"/script/[^/]+/", a.attrs["href"] or "")), None)
        if link is not None:
            yield article, link


def script_links(html: Column | str, card: str = "card") -> Column:
    """array<string>: the link of each card."""
    return _over_pages(T.ArrayType(T.StringType()), lambda page: [link.attrs["href"] for _, link in _cards(page, card)])(_c(html))


def preview_cards(html: Column | str, base: Column | str, card: str = "card") -> Column:
    """array<struct>: the preview record of each card of a listing page that links to a script; addresses are joined with ``base``."""

    def record(page: Page, base: str, article: _Node, link: _Node) -> dict:
        author, url = first_text(page, CARD_AUTHOR, article), first_attribute(page, CARD_AUTHOR, "href", article)
        time = next(iter(page.select("time", article)), None)
        return {
            "script_url": urljoin(base, link.attrs["href"]), "preview_title": first_text(page, CARD_TITLE, article) or None,
            "preview_author": author.replace("by ", "").strip() if author else None, "preview_author_url": urljoin(base, url) if author and url else None,
            "preview_created_at": time.attrs.get("datetime") if time else None, "preview_created_display": text_of(time) if time else None,
            "preview_likes_count": _number(first_text(page, CARD_LIKES, article)), "preview_comments_count": _number(first_text(page, CARD_COMMENTS, article)),
        }

    @F.pandas_udf(T.ArrayType(CARD))
    def run(htmls: pd.Series, bases: pd.Series) -> pd.Series:
        pages = [(Page(h if isinstance(h, str) else None), b if isinstance(b, str) else "") for h, b in zip(htmls, bases)]
        return pd.Series([[record(p, b, *found) for found in _cards(p, card)] for p, b in pages], dtype="object")

    return run(_c(html), _c(base))


def _created(page: Page) -> str | None:
    """The attribute of the first selector's first element, else its text."""
    for s in CREATED:
        if found := page.select(s):
            return found[0].attrs.get("datetime") or text_of(found[0])
    return None


def _user(page: Page, base: str) -> dict:
    """The first user element with a name: of its attribute, else its text; the link is the element's own or that around it; a later
    element of class ``pro`` or ``premium`` marks the plan."""
    for s in USER:
        node = next(iter(page.select(s)), None)
        name = node and (node.attrs.get("data-username") or text_of(node))
        if name:
            link = node if node.tag == "a" else next((n for n in node.up() if n.tag == "a"), None)
            href = link.attrs.get("href") if link is not None else None
            paid = any(re.search("pro|premium", c) for n in page.nodes[node.at + 1 :] for c in n.classes)
            return {"username": name, "profile_url": urljoin(base, href) if href else None, "pro_plan": paid}
    return {"username": None, "profile_url": None, "pro_plan": None}


def _digits(page: Page, within: _Node | None, key: str) -> str:
    """The digits of a counter that shows each in a grid of its own."""
    out = ""
    for grid in page.select(f'span[class*="{key}Grid-"]', within):
        digit = next(iter(page.select(f'span[class*="{key}-"]', grid)), None)
        if digit is not None and text_of(digit).isdigit():
            out += text_of(digit)
    return out


def _likes(page: Page) -> int:
    """Of the first counter of digits in a toggle button, else in the page, else of the first likes element."""
    for button in page.select("button[aria-pressed]"):
        for box in page.select('span[class*="container-"]', button)[:1]:
            if digits := _digits(page, box, "digit"):
                return int(digits)
    digits = _digits(page, None, "digit")
    return int(digits) if digits and int(digits) else _number(first_text(page, LIKES))


def _editor_code(page: Page) -> str | None:
    """The lines of a code editor: its tokens, those of one parent making a line."""
    lines: list[list[str]] = []
    before = None
    for token in next((found for s in EDITOR if (found := page.select(s))), []):
        row = next((n for n in token.up() if n.tag == "div"), None)
        if not lines or row is not before or row is None:
            lines.append([])
        lines[-1].append("".join(token.parts))
        before = row
    return "\n".join(map("".join, lines)) or None


def _embedded_code(page: Page) -> Iterator[str]:
    """The ``"source"`` strings in scripts."""
    for node in page.select("script"):
        for m in re.finditer(r'"source"\s*:\s*("(?:[^"\\]|\\.)*")', "".join(node.parts)):
            try:
                yield json.loads(m[1], strict=False)
            except ValueError:
                continue


def _found_code(page: Page) -> str | None:
    """Code in the page's text: from 100 characters before the first pattern that occurs to 2,000 after the blank line that ends it."""
    text = "".join(page.texts)
    for pattern in CODE_TEXT:
        if m := re.search(pattern, text, re.IGNORECASE):
            end = re.compile(r"\n\s*\n|\Z").search(text, m.end())
            return text[max(0, m.start() - 100) : end.start() + 2000].strip()
    return None


def source_code(page: Page) -> str | None:
    """The code by the first way that gives some with a mark of code: editor tokens, code elements, scripts; else by search."""
    marked = lambda code: any(mark in code for mark in CODE_MARKS)
    ways = [_editor_code(page), first_text(page, CODE, of=lines_of)]
    found = next((c for c in ways if c and marked(c)), None) or next((c for c in _embedded_code(page) if marked(c)), None)
    return found or _found_code(page)


def script_record(html: Column | str, url: Column | str | None = None) -> Column:
    """A struct of a script page's fields; ``url`` is its address, which links are joined with and which stands for a chart link."""

    def record(page: Page, url: str) -> dict:
        chart = first_attribute(page, CHART, "href")
        return {
            "name": first_text(page, TITLE), "description": first_text(page, DESCRIPTION), "created_at": _created(page), "chart_url": urljoin(url, chart) if chart else url or None,
            "symbol": first_text(page, SYMBOL_NAME) or first_attribute(page, ('meta[name="symbol"]',), "content"), **_user(page, url), "likes_count": _likes(page), "source_code": source_code(page),
        }

    return _records(SCRIPT, record, html, F.lit("") if url is None else url)


def script_id(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(url), "/script/([^/]+)/", 1), F.lit(""))


@F.pandas_udf(T.StringType())
def joined_url(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link resolved against its page's address (RFC 3986)."""
    return pd.Series([urljoin(b or "", x) if isinstance(x, str) else None for b, x in zip(base, link)], dtype="object")
