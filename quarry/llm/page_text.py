"""Main text of web pages by site template removal.

A page is read once into nested blocks. Every block element gets a hash of its
whole subtree, Spark counts per host in how many different pages each subtree
stands, and subtrees that stand in at least ``LEAST_PAGES`` of them are deleted,
on hosts of any size. Articles too have sentences in common (quotations, license
lines, one-word list items), so a paragraph, heading, item or cell inside the main
article goes only if it stands in ``INNER_SHARE`` of the host's pages besides.
Pages count as different by the text that would remain, so copies of an article do
not make it a template; the article itself is never a candidate.

Boilerplate that differs from page to page (adverts, comments) is known by its
element, role, class or id. A class or id counts only as a whole token made of
such words (``site-footer``, ``comment-list``), not where a word stands beside
others (``has-sidebar``). Nothing that holds the main article goes by its name:
that is the longest ``article`` (else ``main``) if it holds at least
``MAIN_SHARE`` of the page's text; those of comments and related pages are none.

Inside what remains, the article is the ``article`` elements, else ``main``, if
they hold that share of it, else the body. Character references are decoded,
white space inside a block becomes one space, and blocks are joined by one
space in page order.

Templates are sent to the tasks up to a counted number, as sorted 64-bit hashes
of host and subtree; beyond it each page is joined with those of its own
subtrees that are templates.

Reading is linear in the length of a page, however broken: a tag ends at the
next ``<`` at the latest, apart from quoted values up to ``QUOTED`` characters.

Defined cases: null html counts as empty and gives ''; a page without a host is
never matched against templates; broken pages (open tags, cut ends, stray end
tags) are read as far as they go; repeated rows are handled one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from quarry.llm.common import cut, pick, whole_text

LEAST_PAGES = 5
INNER_SHARE = 0.5
MAIN_SHARE = 0.3
TEMPLATES_SENT = 1_000_000  # 8 bytes each
QUOTED = 4096

_ATTRIBUTES = rf"""(?:[^'"<>]|"[^"<]*+"|'[^'<]*+'|"[^"]{{0,{QUOTED}}}+"|'[^']{{0,{QUOTED}}}+')*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|object)\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRIBUTES}(?=>)|[^<>]*+)(?:>|(?=<)|\Z)"
    rf"|<[!?][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""", re.I)

#: Words by which boilerplate names itself, also beside ``article`` or ``post``.
STRONG = frozenset("ad ads advert adverts advertisement advertising adbox sponsor sponsored sponsors promo promos promotion sidebar "
                   "breadcrumb breadcrumbs cookie cookies consent gdpr newsletter subscribe subscription share sharing social "
                   "related recommended recommendations comment comments commentlist disqus replies pagination".split())
#: The same, but ``article-header`` and the like are parts of an article.
WEAK = frozenset("banner menu menus nav navbar navigation header masthead footer notice notices alert popup modal overlay login "
                 "signup search widget widgets toolbar contentinfo complementary".split())
#: Words that say where or how such a part stands.
PLACE = frozenset("site page main top bottom left right box bar list wrapper wrap container inner outer block area section item "
                  "items link links button buttons icon icons primary secondary global mobile desktop sticky fixed slot unit "
                  "form panel group region thread body posts articles stories".split())
OF_ARTICLE = frozenset("article post entry".split())
#: What holds articles of its own that are not the page's.
OTHERS = frozenset("comment comments commentlist disqus replies related recommended recommendations ad ads advert adverts".split())
SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head button select dialog menu audio video canvas".split())
NAMED_ELEMENTS = frozenset("nav aside footer form".split())
ARTICLE = ("article", "main")
BLOCKS = DROPPED | NAMED_ELEMENTS | frozenset(ARTICLE) | frozenset(
    "html body div section header ul ol dl table figure center details p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot "
    "caption blockquote pre address fieldset hgroup figcaption summary".split())
NO_CANDIDATES = DROPPED | frozenset(("html", "body", *ARTICLE))
#: Small blocks, of which articles may have some in common.
SMALL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption blockquote pre address figcaption summary".split())
ENDS_PARAGRAPH = BLOCKS - {"html", "body"}
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}


def names_boilerplate(value: str) -> tuple[bool, bool]:
    """Does a class, id or role hold a token that is made of such words alone,
    and of one that is for other articles?"""
    for token in value.split():
        words = [w.lower() for w in SPLIT.split(token) if w and not w.isdigit()]
        strong = any(w in STRONG for w in words)
        if (strong or any(w in WEAK for w in words)) and all(
                w in STRONG or w in WEAK or w in PLACE or (strong and w in OF_ARTICLE) for w in words):
            return True, any(w in OTHERS for w in words)
    return False, False


class Element:
    __slots__ = ("name", "kind", "parts", "start", "label", "named", "gone", "other")

    def __init__(self, name: str, kind: str, start: int, label: str, named: bool, gone: bool, other: bool):
        self.name, self.kind, self.start, self.label, self.named, self.gone = name, kind, start, label, named, gone
        self.other = other
        self.parts: list[bytes] = []


class Page:
    """The blocks of text of a page.

    ``blocks``: (text, kind of article around it). ``subtrees``: (first block,
    block after the last, hash, small) of the candidates. ``named``: (first, after the
    last) of what names itself boilerplate. ``articles``: (kind, first, after
    the last) of the outermost ones.
    """

    def __init__(self, source: str, host: str = ""):
        self.host = host.encode("utf-8", "surrogatepass")
        self.blocks: list[tuple[str, str]] = []
        self.subtrees: list[tuple[int, int, bytes, bool]] = []
        self.named: list[tuple[int, int]] = []
        self.articles: list[tuple[str, int, int]] = []
        self.stack: list[Element] = [Element("", "", 0, "", False, False, False)]
        self.open: Counter = Counter()
        self.text: list[str] = []
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self.text.append(source[at:m.start()])
            at = m.end()
            name = m["name"]
            if name is None:
                continue
            name = name.lower()
            if name == "br":
                self.text.append(" ")
            elif name == "hr" or name in BLOCKS:
                if m["close"]:
                    self.end(name)
                elif name == "hr":
                    self.flush()
                else:
                    self.begin(name, m["attrs"])
        self.text.append(source[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()

    def flush(self) -> None:
        """The text so far becomes a block of the innermost element."""
        if not self.text:
            return
        text = "".join(self.text)
        self.text = []
        words = (html.unescape(text) if "&" in text else text).split()
        if words:
            top = self.stack[-1]
            text = " ".join(words)
            top.parts.append(text.encode("utf-8", "surrogatepass"))
            if not top.gone:
                self.blocks.append((text, top.kind))

    def begin(self, name: str, attrs: str) -> None:
        self.flush()
        if name in ENDS_PARAGRAPH:
            self.close_open("p", ())
        if name in ITEMS:
            self.close_open(name, ITEMS[name])
        top = self.stack[-1]
        other = top.other
        label, named = "", name in NAMED_ELEMENTS or (name == "header" and top.kind == "")
        if attrs and "=" in attrs:
            values = [" ".join(v).strip() for _, *v in ATTRIBUTE.findall(attrs)]
            label = " ".join(values)
            if name not in ("html", "body", "main"):
                says = [names_boilerplate(v) for v in values]
                named, other = named or any(n for n, _ in says), other or any(o for _, o in says)
        kind = name if not other and (name == "article" or (name == "main" and top.kind != "article")) else top.kind
        self.stack.append(Element(name, kind, len(self.blocks), label, named, top.gone or name in DROPPED, other))
        self.open[name] += 1

    def close_open(self, name: str, until: tuple[str, ...]) -> None:
        """Close an open element of the name that nothing else stands around."""
        if not self.open[name]:
            return
        for element in reversed(self.stack):
            if element.name == name:
                self.end(name)
                return
            if element.name in until or element.name not in ("p", "li", "dt", "dd", "td", "th", "tr") or not until:
                return

    def end(self, name: str) -> None:
        self.flush()
        if self.open[name]:
            while self.stack[-1].name != name:
                self.pop()
            self.pop()

    def pop(self) -> None:
        self.flush()
        done = self.stack.pop()
        self.open[done.name] -= 1
        digest = xxhash.xxh64(f"{done.name} {done.label}".encode("utf-8", "surrogatepass"))
        for part in done.parts:
            digest.update(len(part).to_bytes(4, "little"))
            digest.update(part)
        tree = digest.digest()
        self.stack[-1].parts.append(tree)
        if done.gone or done.start == len(self.blocks):
            return
        if self.host and done.name not in NO_CANDIDATES:
            self.subtrees.append((done.start, len(self.blocks), tree, done.name in SMALL))
        if done.named:
            self.named.append((done.start, len(self.blocks)))
        if done.name in ARTICLE and not done.other:
            while self.articles and self.articles[-1][1] >= done.start and (done.name == "article" or self.articles[-1][0] == "main"):
                self.articles.pop()  # inner ones of the same kind
            self.articles.append((done.name, done.start, len(self.blocks)))

    def lengths(self) -> np.ndarray:
        """Characters before each block, and in all."""
        return np.cumsum([0, *(len(text) for text, _ in self.blocks)])

    def main_article(self, before: np.ndarray) -> tuple[int, int] | None:
        """The longest article, else main element, if it is a good part of the page."""
        for kind in ARTICLE:
            found = max(((before[b] - before[a], -a, b) for k, a, b in self.articles if k == kind), default=None)
            if found and found[0] >= MAIN_SHARE * before[-1]:
                return -found[1], found[2]
        return None

    def candidates(self, article: tuple[int, int] | None) -> list[tuple[int, int, int, bool]]:
        """(first block, block after the last, hash of host and subtree, inner)."""
        out = []
        for a, b, tree, small in self.subtrees:
            inner = small and article is not None and article[0] <= a and b <= article[1]
            out.append((a, b, xxhash.xxh64_intdigest(self.host + (b"\1" if inner else b"\0") + tree) - (1 << 63), inner))
        return out

    def kept(self, spans) -> np.ndarray:
        """Which blocks stand in none of the spans."""
        change = np.zeros(len(self.blocks) + 1, np.int64)
        for a, b in spans:
            change[a] += 1
            change[b] -= 1
        return np.cumsum(change)[:-1] == 0

    def main_text(self, templates=lambda hashes: ()) -> tuple[str, int]:
        """(text, subtrees deleted because they recur); ``templates`` tells
        which of the given hashes are templates."""
        if not self.blocks:
            return "", 0
        before = self.lengths()
        article = self.main_article(before)
        spans = [(a, b) for a, b in self.named if not (article and a <= article[0] and article[1] <= b)]
        candidates = self.candidates(article)
        hashes = templates([c[2] for c in candidates]) if candidates else ()
        recurring = [(a, b) for a, b, h, _ in candidates if h in hashes]
        keep = self.kept([*spans, *recurring])
        blocks = [b for b, k in zip(self.blocks, keep) if k]
        size = sum(len(text) for text, _ in blocks)
        for kind in ARTICLE:
            of_kind = [text for text, k in blocks if k == kind]
            if of_kind and sum(map(len, of_kind)) >= MAIN_SHARE * size:
                return " ".join(of_kind), len(recurring)
        return " ".join(text for text, _ in blocks), len(recurring)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' without one."""
    text = F.coalesce(url, F.lit(""))
    found = F.regexp_extract(text, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


SEEN = StructType([StructField("outer", ArrayType(LongType())), StructField("inner", ArrayType(LongType())),
                   StructField("text_hash", LongType())])
READ = StructType([StructField("text", StringType()), StructField("n_templates", LongType())])


@F.pandas_udf(SEEN)
def subtrees(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The distinct subtree hashes of a page and a hash of its main text."""
    for pages, hosts in parts:
        read = [Page(p, h) for p, h in zip(pages, hosts)]
        found = [p.candidates(p.main_article(p.lengths())) for p in read]
        yield pd.DataFrame({
            "outer": pd.Series([list({h for *_, h, inner in c if not inner}) for c in found], dtype=object, index=pages.index),
            "inner": pd.Series([list({h for *_, h, inner in c if inner}) for c in found], dtype=object, index=pages.index),
            "text_hash": pd.Series([xxhash.xxh64_intdigest(p.main_text()[0].encode("utf-8", "surrogatepass")) - (1 << 63)
                                    for p in read], dtype="int64", index=pages.index)})


def read_with(known: np.ndarray | None):
    """The reading UDF: (html, host, own templates) -> (text, n_templates);
    ``known`` are all templates, sorted, or None where each row brings its own."""

    def among(hashes: list[int]) -> set[int]:
        values = np.array(hashes, np.int64)
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return set(values[known[at] == values].tolist())

    @F.pandas_udf(READ)
    def read(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for pages, hosts, own in parts:
            out = []
            for page, host, templates in zip(pages, hosts, own):
                if known is None:
                    held = frozenset() if templates is None else frozenset(templates)
                    out.append(Page(page, host).main_text(lambda _, held=held: held))
                else:
                    out.append(Page(page, host).main_text(among if len(known) else lambda _: ()))
            yield pd.DataFrame(out, columns=["text", "n_templates"], index=pages.index)

    return read


def seen_subtrees(pages: DataFrame) -> DataFrame:
    """(host, page, text_hash, subtree, inner) of (host, html) rows; page names
    the html; a row without a subtree stands for the page itself."""
    seen = pages.where("host <> ''").select("host", F.xxhash64("html").alias("page"), subtrees("html", "host").alias("seen")) \
        .select("host", "page", "seen.*")
    marked = lambda inner: lambda h: F.struct(h.alias("subtree"), F.lit(inner).alias("inner"))
    itself = F.array(F.lit(None).cast("long"))
    every = F.concat(F.transform(itself, marked(False)), F.transform("outer", marked(False)), F.transform("inner", marked(True)))
    return seen.select("host", "page", "text_hash", F.inline(every))


def find_templates(seen: DataFrame, least_pages: int = LEAST_PAGES, inner_share: float = INNER_SHARE) -> DataFrame:
    """The hashes that stand in enough different pages; a hash holds its host."""
    counts = cut(seen.groupBy("host", "subtree", "inner").agg(F.count_distinct("text_hash").alias("n"))
                 .where(F.col("subtree").isNull() | (F.col("n") >= least_pages)))
    hosts = counts.where("subtree is null").select("host", F.col("n").alias("of"))
    inner = counts.where("inner").join(hosts, "host").where(F.col("n") >= F.col("of") * inner_share)
    return counts.where("subtree is not null and not inner").select("subtree").unionByName(inner.select("subtree"))


def extract_text(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                 least_pages: int = LEAST_PAGES, inner_share: float = INNER_SHARE, templates_sent: int = TEMPLATES_SENT) -> DataFrame:
    """(page_id, url, text, n_chars, n_templates) for every row; n_templates is
    the number of subtrees of the page that went because they recur."""
    rows = pick(df, page_id=id_column, url=url_column, html=html_column) \
        .withColumn("html", whole_text("html")).withColumn("host", host_of(F.col("url")))
    seen = seen_subtrees(rows.select("host", "html"))
    templates = cut(find_templates(seen, least_pages, inner_share))
    none = F.lit(None).cast("array<bigint>")
    if templates.count() <= templates_sent:
        known = np.sort(np.array([r.subtree for r in templates.collect()], np.int64))
        read = rows.select("page_id", "url", read_with(known)("html", "host", none).alias("read"))
    else:
        own = seen.select("host", "page", "subtree").join(templates, "subtree").groupBy("host", "page") \
            .agg(F.collect_set("subtree").alias("own"))
        read = rows.withColumn("page", F.xxhash64("html")).join(own, ["host", "page"], "left") \
            .select("page_id", "url", read_with(None)("html", "host", "own").alias("read"))
    return read.select("page_id", "url", "read.text", F.length("read.text").cast("long").alias("n_chars"), "read.n_templates")
