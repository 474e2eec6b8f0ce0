"""Main text of web pages, by templates deduced from pages of one host.

Pages of a host share a template. Its tokens are element paths and text blocks; tokens that occur equally often on each
page of the host have the same occurrence vector and form an equivalence class. Classes that are large and frequent
enough, and whose tokens lie inside elements of a class on at least the same pages, nest into the template.
Text blocks of the template are the same on page after page and are no content; what is left are its slots.

An occurrence vector is kept as the exclusive or of a hash for each page and count, so that it is put together
from parts in any order and no host's pages are ever brought together. The text of a page is that of its slots within
the article or main element, or within the body where it has neither. Elements that are no content by their kind or class
are left out besides.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .text import texts

LEAST_PAGES, LEAST_SHARE, LEAST_TOKENS = 3, 0.5, 2

# Kinds of elements.
RAW = frozenset("script style noscript template textarea iframe svg math title xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
).split())
NO_CONTENT = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split())
CLOSES_P = BLOCKS - {"body", "html"}
# An element that starts ends an open one of these, up to the boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id or role that mark what is no content.
NO_CONTENT_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup paywall sidebar "
    "sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist disqus respond replies "
    "related recommended recommendations share sharing social widget widgets toolbar pagination pager search login complementary "
    "contentinfo alert alertdialog skip"
).split())
HEADER_WORDS = frozenset("header masthead topbar".split())
# Of those, words that stand for content as well within an article, where the template decides; and those of readers' comments,
# which are often articles themselves.
ARTICLE_WORDS = frozenset("alert notice notices notification notifications".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
# Words that say nothing of their own: a name counts if all its other words are marks, so cookie-notice does and share-price not.
PLAIN_WORDS = frozenset((
    "left right top bottom box bar area list item items slot link links button buttons container wrapper wrap block section unit "
    "posts form"
).split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_NAME_PART = re.compile(r"[^a-z0-9]+")
_ENDS_RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}


def _marks(attributes: str) -> tuple[set[str], str, bool]:
    """(words of the names in class, id and role that are marks as a whole, the class attribute, hidden)."""
    words, name, hidden = set(), "", False
    for key, value, flag in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if flag:
            hidden = True
        elif key in ("class", "id", "role"):
            for parts in (set(filter(None, _NAME_PART.split(v))) for v in value.split()):
                marks = parts & (NO_CONTENT_WORDS | HEADER_WORDS | {"main"})
                if all(p in marks or p in PLAIN_WORDS or p.isdigit() for p in parts):
                    words.update(marks)
            name = value if key == "class" else name
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return words, name, hidden


def blocks_of(html: str) -> list[tuple[str, str, bool, bool]]:
    """Text blocks of a page in order: (element path, text, inside article or main, no content by its kind)."""
    found: list[tuple[str, str, bool, bool]] = []
    # Open elements: (tag, path, inside article or main, no content, only by a class that article or main ends).
    stack = [("", "", False, False, False)]
    parts: list[str] = []
    place, shown = 0, stack[0]

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append((shown[1], text, shown[2], shown[3]))
            parts.clear()

    def close_to(k: int) -> None:
        if any(e[0] in BLOCKS or e[3] != stack[k - 1][3] for e in stack[k:]):
            flush()
        del stack[k:]

    while place < len(html):
        match = _TOKEN.search(html, place)
        end = match.start() if match else len(html)
        if end > place:
            top = stack[-1]
            if parts and (shown[2], shown[3]) != (top[2], top[3]):
                flush()
            if not parts:
                shown = top
            parts.append(unescape(html[place:end]))
        if not match:
            break
        place = match.end()
        closing, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close_to(k)
                    break
                if tag not in BLOCKS and stack[k][0] in BLOCKS:
                    break  # an inline end does not end the block around it
            continue
        if tag in RAW:
            stop = _ENDS_RAW[tag].search(html, place)
            place = stop.end() if stop else len(html)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close_to(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in ENDS:
            ended, bounds = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ended:
                    close_to(k)
                    break
                if stack[k][0] in bounds:
                    break
        if tag in BLOCKS:
            flush()
        words, name, hidden = _marks(attributes) if attributes and not attributes.isspace() else (set(), "", False)
        _, above, inside, none, weak = stack[-1]
        starts = tag in ("article", "main") or "main" in words and tag == "div" and 'role' in attributes
        main = inside or starts
        if starts and not inside and weak:
            none = weak = False
        marks = words & NO_CONTENT_WORDS - (ARTICLE_WORDS if inside else frozenset())
        if starts or tag in ("html", "body"):
            marks = marks & COMMENT_WORDS if tag == "article" else frozenset()
        firm = hidden or tag in NO_CONTENT or bool(marks & COMMENT_WORDS) or not main and tag == "header"
        if firm:
            none, weak = True, False
        elif not none and (marks or not main and tag not in ("html", "body") and words & HEADER_WORDS):
            none = weak = True
        stack.append((tag, f"{above}/{tag}.{name}" if name else f"{above}/{tag}", main, none, weak))
    flush()
    return found


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


def _page_tokens(html: str) -> tuple[Counter, dict[int, tuple[int, bool]]]:
    """Occurrences of the tokens of a page; what each is: (token of the element around it, is text)."""
    counts, about = Counter(), {}
    for path, text, _, _ in blocks_of(html):
        around = 0
        step = ""
        for part in path.split("/")[1:]:
            step += "/" + part
            token = _hash(step)
            if token not in about:
                about[token] = (around, False)
            around = token
        counts[around] += 1
        token = _hash(path, text)
        about[token] = (around, True)
        counts[token] += 1
    for token in about:
        counts[token] = counts[token] or 1
    return counts, about


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?i:(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*))", 1))


TOKEN_SCHEMA = "host string, token bigint, around bigint, is_text boolean, pages bigint, vector bigint"


def _different_pages(pages: DataFrame) -> DataFrame:
    """(host, page, html): one row of each different page of a host, so that copies of one article make no template.

    Only pages that a host has several times are brought together, one of each from a task.
    """
    rows = pages.select(_host().alias("host"), F.xxhash64("html").alias("page"), "html")
    several = rows.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("host", "page")
    several = materialize(several, "repeated-pages")
    if several.isEmpty():
        return rows
    alone = rows.join(several, ["host", "page"], "left_anti")
    return alone.unionByName(rows.join(several, ["host", "page"], "left_semi").dropDuplicates(["host", "page"]))


def _occurrences(pages: DataFrame) -> DataFrame:
    """TOKEN_SCHEMA of each host, summed over its pages; token 0 stands for the page and counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[tuple[str, int], list] = defaultdict(lambda: [0, False, 0, 0])
            rows = zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), texts(batch, "html"))
            for host, page, html in rows:
                counts, about = _page_tokens(html)
                counts[0], about[0] = 1, (0, False)
                for token, (around, is_text) in about.items():
                    total = totals[host, token]
                    total[0], total[1] = around, is_text
                    total[2] += 1
                    total[3] ^= _hash(page, counts[token])
            keys, values = list(totals), list(totals.values())
            columns = [[k[0] for k in keys], [k[1] for k in keys], *[[v[i] for v in values] for i in range(4)]]
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["host", "token", "around", "is_text", "pages", "vector"]
            )

    parts = _different_pages(pages).mapInArrow(run, TOKEN_SCHEMA)
    return parts.groupBy("host", "token").agg(
        F.min("around").alias("around"), F.max("is_text").alias("is_text"), F.sum("pages").alias("pages"),
        F.bit_xor("vector").alias("vector"),
    )


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """Template tokens of each host: host, token, around, is_text, pages, vector, around_vector.

    Tokens with one vector are an equivalence class. A class is large and frequent if it has LEAST_TOKENS tokens and is on
    least_pages pages and least_share of the host's. A token is nested validly if the element around it is on no fewer pages;
    around_vector is that element's class, which holds its own class in the template.
    """
    tokens = materialize(_occurrences(pages), "page-tokens")
    host_pages = tokens.filter("token = 0").select("host", F.col("pages").alias("host_pages"))
    frequent = tokens.filter(f"token != 0 AND pages >= {int(least_pages)}").join(host_pages, "host").filter(
        F.col("pages") >= least_share * F.col("host_pages")
    ).drop("host_pages")
    classes = frequent.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= LEAST_TOKENS)
    valid = frequent.join(classes.drop("size"), ["host", "vector"])
    outer = tokens.select(
        "host", F.col("token").alias("around"), F.col("pages").alias("around_pages"), F.col("vector").alias("around_vector")
    )
    nested = valid.join(outer, ["host", "around"]).filter(F.col("around_pages") >= F.col("pages"))
    return nested.select("host", "token", "around", "is_text", "pages", "vector", "around_vector")


def main_text(html: str, template_texts: set[int]) -> str:
    """Text of the slots within article or main, or else within the body: what is no text block of the template."""
    blocks = blocks_of(html)
    anywhere = not any(b[2] for b in blocks)
    slots = (b for b in blocks if (b[2] or anywhere) and not b[3] and _hash(b[0], b[1]) not in template_texts)
    return "\n\n".join(b[1] for b in slots)


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars.

    Blocks have single spaces and are joined by empty lines. A null or empty page, and one without content, has an
    empty text. Copies of a page count as one for the template. A page whose url is null or has no host belongs to the host without a name. Hosts of fewer than LEAST_PAGES
    pages have no template. Repeated rows are extracted each; other columns are passed over.
    """
    found = templates(pages).filter("is_text").groupBy("host").agg(F.collect_set("token").alias("template_texts"))
    # Every token is on a good part of the host's pages, so a host's list is as short as a page.
    found = materialize(found, "templates").withColumnRenamed("host", "_host")
    joined = pages.select("page_id", "url", "html", _host().alias("host")).join(found, F.col("host") == F.col("_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("template_texts").to_pylist()
            out = [main_text(h, set(k or ())) for h, k in zip(texts(batch, "html"), known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    typed = joined.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", "template_texts")
    return typed.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
