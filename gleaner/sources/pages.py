"""HTML pages as tables: index items, release notes, trending lists, article prose. Parsing is the one thing here that Spark
has no operator for; it runs on Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset("script style noscript template nav footer header aside form svg".split())
POST = re.compile(r"\b(?:post|news|article|entry|card|item)\b|(?:^|[-_])(?:post|news|article|entry|card|item)(?:$|[-_])", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            n = todo.pop()
            yield n
            todo.extend(reversed([c for c in n.children if isinstance(c, Node)]))

    def find(self, *tags: str) -> Iterator[Node]:
        return (n for n in self.walk() if n.tag in tags and n is not self)

    def text(self, skip: frozenset[str] = frozenset(("script", "style"))) -> str:
        out, todo = [], [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in skip:
                todo.extend(reversed(n.children))
        return " ".join("".join(out).split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("p", "li") and self.at.tag == tag:  # unclosed ones end where the next begins
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def index_items(page: str, base: str, most: int | None = None) -> list[tuple[str, str, str]]:
    """(title, url, summary) of an index page: containers are articles and list items whose class names a post, or the page;
    titles of 20 to 250 characters, no fragments, mail, scripts or repeated links; the summary is the first paragraph above 40
    characters, cut to 400. most bounds the containers where it is given."""
    root = parse(page)
    held = [n for n in root.find("article", "li") if n.tag == "article" and not n.attrs.get("class") or POST.search(n.attrs.get("class", ""))][:most] or [root]
    out, seen = [], set()
    for c in held:
        head = next(c.find("h1", "h2", "h3"), None)
        links = list(head.find("a")) if head else []
        a = next((x for x in links or c.find("a") if x.attrs.get("href")), None)
        title = (head or a).text() if head or a else ""
        href = (a.attrs["href"] if a else "").strip()
        if not 20 <= len(title) <= 250 or "#" in href or href.lower().startswith(("mailto:", "javascript:")):
            continue
        url = urljoin(base, href) if href.startswith("/") else href if href.startswith("http") else base
        if url in seen:
            continue
        seen.add(url)
        lead = next((t for t in (p.text() for p in list(c.find("p"))[:3]) if len(t) > 40), "")
        out.append((title, url, lead[:400]))
    return out


def release_items(page: str, base: str) -> list[tuple[str, str, str]]:
    """(version, url with #version, notes of at most 500 characters) of a release page's second-level headings."""
    out = []
    for h in parse(page).find("h2"):
        if "text-h2" not in h.attrs.get("class", "").split():
            continue
        after = [s for s in h.parent.children if isinstance(s, Node)]
        prose = next((s for s in after[after.index(h) + 1 :] if s.tag == "div" and "prose" in s.attrs.get("class", "").split()), None)
        version = h.text()
        out.append((version, f"{base}#{version}", prose.text()[:500] if prose else ""))
    return out


def trending_items(page: str, base: str, most: int = 25) -> list[tuple[str, str, str]]:
    """(owner / name, url, description of at most 300 characters with the stars) of a trending list."""
    out = []
    for art in list(parse(page).find("article"))[:most]:
        head = next(art.find("h2"), None)
        a = next(head.find("a"), None) if head else None
        if a is None:
            continue
        p, star = next(art.find("p"), None), next((x for x in art.find("a") if x.attrs.get("href", "").endswith("/stargazers")), None)
        text = (p.text() if p else "")[:300]
        out.append((a.text(), urljoin(base, a.attrs.get("href", "")), f"{text} ★ {star.text()}".strip() if star else text))
    return out


def paragraphs(page: str, least: int = 40) -> list[str]:
    """Paragraphs of the article: of article, role=main or main, else of the element with most paragraph text of its own."""
    root = parse(page)
    node = next((n for n in root.walk() if n.tag == "article" or n.attrs.get("role") == "main" or n.tag == "main"), None)
    if node is None:
        own = lambda n: sum(len(c.text(SILENT)) for c in n.children if isinstance(c, Node) and c.tag == "p")
        node = max(root.walk(), key=own, default=root)
    quiet = lambda n: any(x.tag in SILENT for x in _up(n))
    return [t for t in (p.text(SILENT) for p in node.find("p") if not quiet(p)) if len(t) >= least]


def _up(n: Node | None) -> Iterator[Node]:
    while n is not None:
        yield n
        n = n.parent


def trim_to_lead(parts: list[str], most: int = 12_000, lead: int = 2) -> str:
    """All paragraphs if they fit, else the first `lead`, cut to `most`."""
    whole = "\n\n".join(parts)
    return whole if len(whole) <= most else "\n\n".join(parts[:lead])[:most]


def items(pages: DataFrame, extract: Callable[[str, str], list[tuple[str, str, str]]] = index_items) -> DataFrame:
    """pages (url, html) to (page, pos, title, url, summary); null pages give nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(u, i, *x) for u, h in zip(b["url"], b["html"]) if isinstance(h, str) for i, x in enumerate(extract(h, u or ""))]
            yield pd.DataFrame(rows, columns=["page", "pos", "title", "url", "summary"])

    return pages.select("url", "html").mapInPandas(run, "page string, pos int, title string, url string, summary string")


def prose(pages: DataFrame, enough: int = 1_200) -> DataFrame:
    """pages (url, html) to (url, chars, kind, lead, paywall): kind is article from `enough` characters of prose on, else media if
    a player is embedded, else thin."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, h in zip(b["url"], b["html"]):
                parts = paragraphs(h) if isinstance(h, str) else []
                n = sum(map(len, parts))
                media = isinstance(h, str) and re.search(r"<(?:iframe|video|audio|embed)\b", h, re.I)
                wall = isinstance(h, str) and bool(re.search(r"subscribe to (?:read|continue)|subscribers only|sign in to (?:read|continue)|members only", h[:200_000], re.I))
                rows.append((u, n, "article" if n >= enough else "media" if media else "thin", trim_to_lead(parts), wall))
            yield pd.DataFrame(rows, columns=["url", "chars", "kind", "lead", "paywall"])

    return pages.select("url", "html").mapInPandas(run, "url string, chars int, kind string, lead string, paywall boolean")


def within_window(items_: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Items whose day lies in [first, last]; undated ones stay."""
    d = F.col(day)
    return items_.where(d.isNull() | d.between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
