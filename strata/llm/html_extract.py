"""HTML extraction: site template removal.

Every element subtree is hashed, and Spark counts the hashes per host over pages with different texts (copies of a page
count once). A subtree outside the article that recurs on ``min_pages`` such pages, however large the host, is template
and is deleted. Pages of a host may well carry the same article or passages of it, so inside an article only boxes
(``BOXES``: adverts, share bars, link lists) count, and only those on at least ``INSIDE_PAGES`` pages and on
``INSIDE_SHARE`` of all different pages of the host are template. What HTML itself marks as not the article
(navigation, asides, forms, scripts, comment and related sections and the like) is deleted too, and the text of the
rest is joined block by block. When a page names its article (``article`` or ``main``), only that is text. Articles
inside a section of comments or related stories are not the page's, unless it has no other.

Subtrees are joined to the template by (host, hash), and a page gets those of its own subtrees that are template, so
nothing grows with the number of a host's pages or templates. A task sends a subtree outside the article with
``min_pages`` different texts at most, where the page can't delete it, as more make no difference.

Defined cases: a null or empty page gives an empty text; null urls are one host with an empty name; repeated rows count
as pages of their own and have equal texts; unclosed and stray tags are read as browsers read the common cases; an
unclosed comment or script runs to the end. Pages are read whole, however long. Empty tables give empty results. Other
columns pass through as they came; only one named like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .tokens import text_column
from .url_filter import with_host_path

# Element and class names that say what a part of a page is.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
             "table tbody td tfoot th thead tr ul".split())
NOT_TEXT = set("head script style noscript template nav footer aside form button select textarea iframe svg canvas "
               "object embed dialog menu audio video map title xmp noembed noframes input".split())
NOT_TEXT_ROLES = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar "
                     "toolbar".split())
# Whole class names and ids; what else recurs is left to the counts. Never of an article, a heading or around an article.
NOT_TEXT_NAMES = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comments "
                     "comment-list comments-area consent cookie-banner cookie-consent cookie-notice cookies disqus "
                     "disqus_thread footer gdpr menu modal nav navbar navigation newsletter popup promo promotion "
                     "related-posts respond share-buttons sharing sidebar site-footer social-links social-share "
                     "sponsor sponsored subscribe toolbar".split())
# Sections of readers' comments or of other stories: their articles are not the page's.
SECTION_NAMES = set("comments comment-list commentlist comments-area comments-section comment-section disqus "
                    "disqus_thread respond replies responses related related-posts related-articles related-stories "
                    "recommended recommendations more-stories read-more".split())
COMMENT_NAMES = set("comment comment-body comment-content comment-item reply".split())  # of an article that is a comment
HEADER_NAMES = {"header", "masthead", "site-header"}  # as a header element: not text outside an article
NAMES = NOT_TEXT_NAMES | SECTION_NAMES | COMMENT_NAMES | HEADER_NAMES
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
BOXES = set("aside details div dl figure footer form header menu nav ol section table ul".split())
INSIDE_PAGES, INSIDE_SHARE = 10, 0.5
CLOSES = {  # a start tag that ends an open element of these kinds
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
KEEPS_OPEN = set("ul ol dl table div section article main aside nav header footer body form td th button".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Page:
    """Elements of a page in document order: tag, parent, whether HTML marks it as not text, and its content."""

    def __init__(self, source: str):
        self.tag, self.parent, self.marked, self.header = ["#page"], [-1], [False], [False]
        self.content: list[list] = [[]]  # of each element: texts, and numbers of child elements
        self.named: list[tuple[int, set[str]]] = []  # elements with such names
        self._read(source)
        self._mark_named()

    def _mark_named(self) -> None:
        """Marks elements by their names; those around the page's articles only if they are sections of others."""
        n = len(self.tag)
        section = [False] * n  # comments or other stories
        for i, names in self.named:
            article = self.tag[i] in ARTICLE
            section[i] = not names.isdisjoint(COMMENT_NAMES if article else SECTION_NAMES)
        inside = [False] * n
        for i in range(1, n):
            inside[i] = section[i] or inside[self.parent[i]]
        articles = [i for i in range(1, n) if self.tag[i] in ARTICLE]
        own = [i for i in articles if not inside[i]]
        if articles and not own:  # nothing but such articles: the longest is the page's
            own = [max(articles, key=self._letters().__getitem__)]
        around = {0}  # an article of the page, or an ancestor of one
        for i in own:
            while i not in around:
                around.add(i)
                i = self.parent[i]
        for i, names in self.named:
            if i not in around:
                by_name = NOT_TEXT_NAMES if self.tag[i] not in ARTICLE else frozenset()
                self.marked[i] |= section[i] or not names.isdisjoint(by_name)
                self.header[i] |= not names.isdisjoint(HEADER_NAMES)

    def _letters(self) -> list[int]:
        """Characters of text in each element."""
        size = [0] * len(self.tag)
        for i in range(len(self.tag) - 1, -1, -1):
            size[i] = sum(size[c] if isinstance(c, int) else len(c.strip()) for c in self.content[i])
        return size

    def _read(self, s: str) -> None:
        stack, pos, n = [0], 0, len(s)
        tag, parent, marked, content = self.tag, self.parent, self.marked, self.content
        while pos < n:
            lt = s.find("<", pos)
            if lt < 0:
                lt = n
            if lt > pos:
                content[stack[-1]].append(s[pos:lt])
            if lt == n:
                break
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                pos = n if end < 0 else end + 3
                continue
            after = s[lt + 1:lt + 2]
            if after in ("!", "?"):
                end = s.find(">", lt)
                pos = n if end < 0 else end + 1
                continue
            m = _TAG.match(s, lt)
            if not m:
                if after.isalpha() or after == "/":
                    end = s.find(">", lt)
                    pos = n if end < 0 else end + 1
                else:
                    content[stack[-1]].append("<")
                    pos = lt + 1
                continue
            pos = m.end()
            closing, name, attrs = m[1], m[2].lower(), m[3]
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if tag[stack[i]] == name:
                        del stack[i:]
                        break
                    if name not in BLOCKS and tag[stack[i]] in KEEPS_OPEN:
                        break
                continue
            ends = CLOSES.get(name, ())
            if ends or name in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    t = tag[stack[i]]
                    if t in ends or (t == "p" and name in BLOCKS):
                        del stack[i:]
                    elif t in KEEPS_OPEN and not (ends and t in ("td", "th")):
                        break
            me = len(tag)
            tag.append(name)
            parent.append(stack[-1])
            frame = name in ("html", "body")
            marked.append(name in NOT_TEXT or not frame and self._not_text(attrs))
            self.header.append(name == "header")
            if attrs and not (frame or name in HEADINGS or NAMES.isdisjoint(names := self._names(attrs))):
                self.named.append((me, names))
            content.append([])
            content[stack[-1]].append(me)
            if name in RAW:
                end = _RAW_END[name].search(s, pos)
                content[me].append(s[pos:end.start()] if end else s[pos:])
                pos = n if not end else (s.find(">", end.end()) + 1 or n)
            elif name not in VOID and not attrs.endswith("/"):
                stack.append(me)

    @staticmethod
    def _not_text(attrs: str) -> bool:
        for key, a, b, c in _ATTR.findall(attrs) if attrs else ():
            key, value = key.lower(), (a or b or c).lower()
            if key == "hidden" or key == "role" and value in NOT_TEXT_ROLES:
                return True
        return False

    @staticmethod
    def _names(attrs: str) -> set[str]:
        """Class names and id."""
        return {x for key, a, b, c in _ATTR.findall(attrs) if key.lower() in ("class", "id")
                for x in (a or b or c).lower().split()}

    def articles(self, removed: list[bool]) -> list[int]:
        """Outermost article elements; the page itself if it names none."""
        found, under = [], set()
        for i in range(1, len(self.tag)):
            if self.parent[i] in under:
                under.add(i)
            elif self.tag[i] in ARTICLE and not removed[i]:
                found.append(i)
                under.add(i)
        return found or [0]

    def off(self, more: set[int] = frozenset()) -> list[bool]:
        """Of each element whether it or an ancestor is marked, a header outside an article, or in ``more``."""
        gone, inside = [False] * len(self.tag), [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            p = self.parent[i]
            inside[i] = inside[p] or self.tag[i] in ARTICLE
            gone[i] = gone[p] or self.marked[i] or i in more or (self.header[i] and not inside[i])
        return gone

    def hashes(self) -> tuple[dict[int, int], dict[int, int]]:
        """Hashes of the subtrees with text that may be template: those outside the article, and boxes inside it.

        The page's frame, and what holds an article, is none; nor is what is marked anyway inside an article.
        """
        n = len(self.tag)
        digest, text, frame, inside = [b""] * n, [False] * n, [False] * n, [False] * n
        off = self.off()
        for i in range(1, n):
            inside[i] = inside[self.parent[i]] or (self.tag[i] in ARTICLE and not self.marked[i])
        for i in range(n - 1, 0, -1):
            h = blake2b(self.tag[i].encode(), digest_size=8)
            for c in self.content[i]:
                if isinstance(c, int):
                    h.update(b"<" + digest[c])
                    text[i] |= text[c]
                    frame[i] |= frame[c]
                elif c := " ".join(c.split()):
                    h.update(b">" + c.encode("utf-8", "surrogatepass"))
                    text[i] = True
            frame[i] |= self.tag[i] in ("html", "body", "head") or (self.tag[i] in ARTICLE and not self.marked[i])
            digest[i] = h.digest()
        of = {i: int.from_bytes(digest[i], "little", signed=True) for i in range(1, n)
              if text[i] and not frame[i] and self.tag[i] not in RAW}
        return ({i: h for i, h in of.items() if not inside[i]},
                {i: h for i, h in of.items() if inside[i] and self.tag[i] in BOXES and not off[i]})

    def text(self, template: set[int] = frozenset()) -> str:
        gone = self.off(template)
        blocks: list[str] = []
        parts: list[str] = []

        def flush():
            if b := " ".join("".join(parts).split()):
                blocks.append(b)
            parts.clear()

        todo: list = [x for a in reversed(self.articles(gone)) for x in (None, a)]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                parts.append(unescape(x))
            elif gone[x]:
                parts.append(" ")
            elif self.tag[x] == "br":
                parts.append(" ")
            else:
                block = self.tag[x] in BLOCKS
                if block:
                    flush()
                    todo.append(None)
                todo.extend(reversed(self.content[x]))
        flush()
        return "\n".join(blocks)


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def occurrences(pages: DataFrame, min_pages: int) -> DataFrame:
    """(host, subtree, inside, text, page): subtrees with the hash of a page's text before deletion.

    ``page`` is there only where the page can delete the subtree: inside its article, or if it names no article. One
    row a page has no subtree: it counts the host's different pages.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple, set[int]] = {}
            rows = []
            for host, source, number in zip(*(text_column(batch, c).to_pylist() for c in ("host", "html", "page"))):
                page = Page(source)
                text = _digest(page.text())
                whole = page.articles(page.off()) == [0]
                outer, inner = page.hashes()
                every = known.setdefault((host, None), set())
                if text not in every:
                    every.add(text)
                    rows.append((host, None, False, text, None))
                for d in sorted(set(outer.values())):
                    texts = known.setdefault((host, d), set())
                    if whole or (len(texts) < min_pages and text not in texts):
                        rows.append((host, d, False, text, number if whole else None))
                        texts.add(text)
                rows += [(host, d, True, text, number) for d in sorted(set(inner.values()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((),) * 5, _OCCURRENCE)],
                names=["host", "subtree", "inside", "text", "page"])

    return pages.mapInArrow(run, "host string, subtree long, inside boolean, text long, page long")


_OCCURRENCE = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())


def page_templates(pages: DataFrame, min_pages: int) -> DataFrame:
    """(host, page, template): of each page of (host, html, page) its subtrees that are its host's template."""
    seen = store(occurrences(pages, min_pages), "html-subtrees")
    counts = seen.select("host", "subtree", "inside", "text").distinct().groupBy("host", "subtree", "inside") \
        .agg(F.count("*").alias("n"))
    hosts = counts.where("subtree is null").select("host", F.col("n").alias("pages"))
    outer = counts.where((F.col("n") >= min_pages) & ~F.col("inside") & F.col("subtree").isNotNull()).drop("n")
    inner = counts.where((F.col("n") >= max(min_pages, INSIDE_PAGES)) & F.col("inside")).join(hosts, "host") \
        .where(F.col("n") >= F.lit(INSIDE_SHARE) * F.col("pages")).drop("n", "pages")
    return seen.where("page is not null").select("host", "subtree", "inside", "page") \
        .join(outer.unionByName(inner), ["host", "subtree", "inside"]).groupBy("host", "page") \
        .agg(F.sort_array(F.collect_set(F.when(~F.col("inside"), F.col("subtree")))).alias("outer"),
             F.sort_array(F.collect_set(F.when(F.col("inside"), F.col("subtree")))).alias("inner"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text", min_pages: int = 3) -> DataFrame:
    """Adds the main text of every page; the raw html goes."""
    rest = [c for c in pages.columns if c not in (html, out)]
    df = with_host_path(pages, url, "__host", "__path").withColumn("__html", F.coalesce(F.col(html), F.lit(""))) \
        .withColumn("__page", F.xxhash64("__html"))
    names = {"__host": "host", "__html": "html", "__page": "page"}
    template = store(page_templates(df.select(*names).withColumnsRenamed(names), min_pages), "html-templates")
    template = template.select(F.col("host").alias("__host"), F.col("page").alias("__page"),
                               F.col("outer").alias("__outer"), F.col("inner").alias("__inner"))
    df = df.select(*rest, "__host", "__html", "__page").join(template, ["__host", "__page"], "left") \
        .select(*rest, "__html", "__outer", "__inner")
    schema = df.select(*rest).withColumn(out, F.lit("")).schema

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for source, *known in zip(*(text_column(batch, c).to_pylist() for c in ("__html", "__outer", "__inner"))):
                page, known = Page(source), [set(x or ()) for x in known]
                gone = {i for subtrees, hashes in zip(known, page.hashes()) if subtrees
                        for i, h in hashes.items() if h in subtrees} if any(known) else frozenset()
                found.append(page.text(gone))
            yield pa.RecordBatch.from_arrays(batch.columns[:-3] + [pa.array(found, pa.string())], names=schema.names)

    return df.mapInArrow(texts, schema)
