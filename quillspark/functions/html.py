"""HTML functions: a small tree over the standard library's tokenizer, behind Arrow-batched functions.

The tree is lenient: an end tag closes the nearest open element of its name and all within it, one
without such an element is ignored, and nothing is closed implicitly. Text of scripts, styles and
templates, comments and declarations are no text of the elements around them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape, unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.config import Site
from quillspark.functions import urls
from quillspark.functions.text import relation_of
from quillspark.session import give_back

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())
UNSEEN = frozenset(("script", "style", "template"))
# What is no content of a page.
NOISE_TAGS = frozenset(("script", "style", "noscript", "iframe", "svg", "form", "header", "footer", "nav"))
NOISE_ROLES = frozenset(("banner", "contentinfo"))
NOISE_CLASSES = frozenset(("sharedaddy", "post-meta", "nav-links", "comments-wrapper", "footer-nav-widgets-wrapper"))
BLOCKS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "blockquote", "tr"))


class Node:
    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        """Elements below this one, in document order; children may be changed while they are visited."""
        stack = [iter(list(self.children))]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Node):
                    yield child
                    stack.append(iter(list(child.children)))
                    break
            else:
                stack.pop()

    def find(self, *names: str) -> Iterator[Node]:
        return (n for n in self.walk() if n.name in names)

    def strings(self) -> Iterator[str]:
        stack: list[Iterator] = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, str):
                    yield child
                elif child.name not in UNSEEN:
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def text(self) -> str:
        return " ".join(s for s in map(str.strip, self.strings()) if s)

    def source(self) -> str:
        """The element as HTML again."""
        out: list[str] = []
        stack: list[tuple[Node, Iterator]] = []

        def opened(node: Node) -> None:
            out.append(f"<{node.name}" + "".join(f' {k}="{escape(v or "")}"' for k, v in node.attrs.items()) + (">" if node.name not in VOID else "/>"))
            stack.append((node, iter(node.children)))

        opened(self)
        while stack:
            node, rest = stack[-1]
            for child in rest:
                if isinstance(child, Node):
                    opened(child)
                    break
                out.append(child if node.name in UNSEEN else escape(child, quote=False))
            else:
                if node.name not in VOID:
                    out.append(f"</{node.name}>")
                stack.pop()
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {}, None)
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        named: dict[str, str] = {}
        for k, v in attrs:
            named[k] = v or ""
        node = Node(tag, named, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(source: str | None) -> Node:
    builder = _Builder()
    builder.feed(source or "")
    builder.close()
    return builder.root


def links_of(source: str | None) -> list[tuple[int, str, str, list[str], str]]:
    """(place, href, text, classes, context) of each anchor with a href; the context is the nearest paragraph, list item or cell."""
    out = []
    for a in parse(source).find("a"):
        if "href" not in a.attrs:
            continue
        around = a.parent
        while around is not None and around.name not in ("p", "li", "td", "th"):
            around = around.parent
        out.append((len(out), a.attrs["href"], a.text(), a.classes, (around or a).text()))
    return out


def title_of(source: str | None) -> str | None:
    heads = list(parse(source).find("h1"))
    best = next((h for h in heads if "entry-title" in h.classes), heads[0] if heads else None)
    return best.text() if best else None


def article_of(source: str | None) -> str:
    tree = parse(source)
    for test in (lambda n: "entry-content" in n.classes, lambda n: n.name == "article", lambda n: n.name == "body"):
        for node in tree.walk():
            if test(node):
                return node.source()
    return source or ""


def number_block_of(source: str | None) -> str | None:
    """Text of the first paragraph of the introduction that follows the title among its siblings."""
    head = next((h for h in parse(source).find("h1") if "entry-title" in h.classes), None)
    if head is None:
        return None
    around = head.parent.children
    for node in around[next(i for i, c in enumerate(around) if c is head) + 1 :]:
        if not isinstance(node, Node) or node.name != "div":
            continue
        if {"intro-text", "section-inner"} <= set(node.classes):
            return next(node.find("p"), node).text()
        if "post-meta-wrapper" in node.classes:
            return None
    return None


def _cleaned(source: str | None) -> Node:
    tree = parse(source)
    for node in list(tree.walk()):
        if node.name in NOISE_TAGS or node.attrs.get("role") in NOISE_ROLES or NOISE_CLASSES & set(node.classes):
            node.parent.children = [c for c in node.parent.children if c is not node]
    for node in tree.walk():
        kept = {"a": ("href",), "img": ("src", "alt") if node.attrs.get("src") else ()}.get(node.name, ())
        node.attrs = {k: node.attrs[k] for k in kept if node.attrs.get(k)}
    return tree


def clean_of(source: str | None) -> str:
    """The page without noise, and without attributes but those of links and pictures."""
    return "".join(c.source() if isinstance(c, Node) else escape(c, quote=False) for c in _cleaned(source).children)


def _markdown_lines(tree: Node) -> Iterator[str]:
    for node in tree.walk():
        if node.name not in BLOCKS or not (text := node.text()):
            continue
        if node.name[0] == "h":
            yield f"{'#' * int(node.name[1])} {text}"
        elif node.name == "li":
            yield f"- {text}"
        elif node.name == "blockquote":
            yield f"> {text}"
        elif node.name == "tr":
            cells = [c.text() for c in node.find("th", "td")]
            if cells:
                yield f"| {' | '.join(cells)} |"
                if next(node.find("th"), None):
                    yield f"| {' | '.join(['---'] * len(cells))} |"
        else:
            for strong in node.find("strong"):
                strong.children = [f"**{strong.text()}**"]
            yield node.text()
        yield ""


def markdown_of(source: str | None) -> str:
    """Headings, paragraphs, list items, quotes and table rows of the cleaned page, with single empty lines between."""
    out: list[str] = []
    for line in "\n".join(_markdown_lines(_cleaned(source))).splitlines():
        line = line.rstrip()
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out).strip() + "\n"


def plain_of(source: str | None) -> str | None:
    return None if source is None else parse(unescape(source)).text()


def _batched(function, kind: str):
    @F.pandas_udf(kind)
    def run(pages: pd.Series) -> pd.Series:
        give_back()  # what the batch before took
        return pd.Series([function(None if p is None or p != p else p) for p in pages], dtype=object)

    return run


def page_links(page: Column | str) -> Column:
    """Anchors of a page as an array; explode it for one row a link."""
    return _batched(lambda p: [dict(zip(("pos", "href", "text", "classes", "context"), x, strict=True)) for x in links_of(p)], "array<struct<pos:int,href:string,text:string,classes:array<string>,context:string>>")(page)


def page_title(page: Column | str) -> Column:
    return _batched(title_of, "string")(page)


def article_html(page: Column | str) -> Column:
    return _batched(article_of, "string")(page)


def clean_html(page: Column | str) -> Column:
    return _batched(clean_of, "string")(page)


def html_to_markdown(page: Column | str) -> Column:
    return _batched(markdown_of, "string")(page)


def strip_html_text(value: Column | str) -> Column:
    return _batched(plain_of, "string")(value)


def detail_number(page: Column | str) -> Column:
    """`n/yyyy` where the block under the title gives year and number in both orders alike, or null."""
    block = _batched(number_block_of, "string")(page)
    pattern = r"\b(20[0-9]{2})/([0-9]{1,4})\b\s+\b([0-9]{1,4})/(20[0-9]{2})\b"
    part = lambda i: F.regexp_extract(block, pattern, i)
    agree = (part(1) != "") & (part(1) == part(4)) & (part(2) == part(3))
    return F.when(agree, F.concat_ws("/", F.regexp_replace(part(3), "^0+(?=[0-9])", ""), part(4)))


def english_link(links: Column, site: Site = Site()) -> Column:
    """Of a page's links (hrefs absolute): the first to a translation host that says so by class or text, else the first to such a host."""
    there = F.filter(links, lambda x: urls.host(x.href).isin(*site.translation_hosts))
    said = F.filter(there, lambda x: F.array_contains(x.classes, "decree-link") | F.lower(x.text).contains("english"))
    return F.coalesce(F.get(said, F.lit(0))["href"], F.get(there, F.lit(0))["href"])


def pdf_urls(links: Column, page: Column | str, site: Site = Site()) -> Column:
    """PDF links of a page to the data host, then further such addresses anywhere in its source."""
    named = F.transform(F.filter(links, lambda x: F.lower(x.href).endswith(".pdf") & x.href.contains(site.data_host)), lambda x: x.href)
    pattern = "(?i)https?://" + re.escape(site.data_host) + r"/[^\s\"']+?\.pdf"
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(page) if isinstance(page, str) else page, F.lit("")), F.lit(pattern), F.lit(0)))
    return F.concat(named, F.array_except(found, named))


def absolute_links(df, page: str, keep: tuple[str, ...], site: Site = Site()):
    """(keep..., pos, url, text, classes, context) of each link, with URLs against the site's base."""
    rows = df.select(*keep, F.explode(page_links(page)).alias("x")).select(*keep, "x.*")
    return rows.withColumn("url", urls.absolute_url(F.lit(site.base_url), F.col("href"))).drop("href")


def cross_references(df, page: str, source_slug: str, site: Site = Site()):
    """Links to other documents of the corpus: the first of each (source, target, relation), by place."""
    links = absolute_links(df, page, (source_slug,), site).withColumnRenamed(source_slug, "source_slug")
    links = links.where(urls.is_corpus_url("url", site)).withColumn("target_slug", urls.slug_of("url")).withColumn("rel_type", relation_of("context"))
    links = links.where("target_slug IS NOT NULL AND target_slug <> source_slug")
    first = links.groupBy("source_slug", "target_slug", "rel_type").agg(F.min_by(F.struct("pos", F.col("url").alias("target_url"), F.col("text").alias("anchor_text"), "context"), "pos").alias("f"))
    return first.select("source_slug", "target_slug", "rel_type", "f.target_url", "f.anchor_text", "f.context", "f.pos")


def corpus_links(df, page: str, key: str, site: Site = Site()):
    """(key, url, pos) of the different addresses of corpus documents on each page, where each is first."""
    links = absolute_links(df, page, (key,), site).where(urls.is_corpus_url("url", site))
    return links.groupBy(key, "url").agg(F.min("pos").alias("pos"))
