"""Resource catalogue: headings of HTML pages, parsed titles, load summary."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TITLE_PATTERN, WORKBOOK_SUFFIX
from ..functions import title_service, title_year


# Character references: by number, or by one of the names that stand for a single character.
_REFERENCE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"


def decoded(text: Column) -> Column:
    """Text with its character references decoded; unknown ones stay as they are."""
    known = {**name2codepoint, "apos": ord("'")}
    names = F.create_map(*[F.lit(x) for name, code in sorted(known.items()) for x in (name, chr(code))])

    def character(reference: Column) -> Column:
        body = F.substring(reference, F.lit(2), F.length(reference) - 2)
        code = F.when(F.lower(body).startswith("#x"), F.conv(F.substring(body, 3, 6), 16, 10)).when(
            body.startswith("#"), F.substring(body, 2, 7)
        ).cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(number, F.try_element_at(names, body), reference)

    between = F.split(text, _REFERENCE)
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    return F.array_join(
        F.zip_with(between, found, lambda t, r: F.concat(t, F.coalesce(character(r), F.lit("")))), ""
    )


# Inside a tag, quotes hold a > only as a value, after =. A tag or value that is not closed, like a comment, runs to the end of the page.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+>"""
# Elements whose content is no markup, with their content.
_RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
# A page as tokens, each character in one: comments, raw elements, tags, declarations, text, and a < that opens nothing.
_TOKEN = (
    rf"(?is)<!--.*?(?:-->|\z)|<({_RAW})(?=[\s/>]){_ATTRIBUTES}.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\z)|\z)"
    rf"|</?[a-z]{_ATTRIBUTES}|</?[a-z].*+|<[!?/][^>]*+(?:>|\z)|[^<]++|<"
)
# Stand for the start and the end of a heading among the text; no page shows these characters.
_OPEN, _CLOSE = "\x01", "\x02"


def headings(pages: DataFrame, *keys: str, html: str = "html", level: int = 4) -> DataFrame:
    """One row per heading of the level, in page order: (keys, pos, titulo).

    The title is as a page shows it: without inner tags, comments and scripts, references decoded, blanks of any kind and line
    breaks as single spaces. What stands in comments, scripts and other raw text is no heading. A heading ends
    at the next tag of a heading of any level, or with the page. A null page has none.

    The page is cut into tokens once, each token is replaced by what it shows, and titles are cut from what they are joined to; each
    step goes over the page once, whatever the number of tokens.
    """
    def shown(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, "^<(/?[a-zA-Z][^\\s/>]*)", 1))
        # A tag that the page ends in is none.
        opens = (name == f"h{level}") & token.rlike(f"(?is)^<{_ATTRIBUTES}$")
        mark = F.when(opens, _OPEN).when(name.rlike("^/?h[1-6]$"), _CLOSE).when(name == "br", " ").otherwise("")
        tag = token.startswith("<") & (F.length(token) > 1)
        return F.when(tag, mark).otherwise(F.translate(token, _OPEN + _CLOSE, ""))

    text = F.array_join(F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), shown), "")
    found = F.regexp_extract_all(text, F.lit(f"{_OPEN}([^{_OPEN}{_CLOSE}]*+)"), F.lit(1))
    return pages.select(*keys, F.posexplode(found).alias("pos", "bruto")).select(
        *keys, "pos", F.trim(F.regexp_replace(decoded(F.col("bruto")), r"[\s\u00a0]+", " ")).alias("titulo")
    )


def resource_catalog(
    titles: DataFrame,
    title: str | Column = "titulo",
    pattern: str = TITLE_PATTERN,
    suffix: str = WORKBOOK_SUFFIX,
) -> DataFrame:
    """Titles whose service and year are both recognised, with the file name they stand for."""
    text = F.col(title) if isinstance(title, str) else title
    return (
        titles.withColumn("servico", title_service(text, pattern))
        .withColumn("ano", title_year(text, pattern))
        .filter(F.col("servico").isNotNull() & F.col("ano").isNotNull())
        .withColumn("filename", F.concat("servico", F.col("ano").cast("string"), F.lit(suffix)))
    )


def load_summary(files: DataFrame, ok: Column) -> DataFrame:
    """How many files were accepted out of how many listed: (ok, total)."""
    return files.agg(
        F.count_if(F.coalesce(ok, F.lit(False))).alias("ok"), F.count(F.lit(1)).alias("total")
    )
