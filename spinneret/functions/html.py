"""Regular-expression extraction from HTML and other markup."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.functions.binding import let
from spinneret.functions.urls import base_parts, canonical_url, resolve_against

# The anchor and title patterns (case-insensitive, dot matches
# newline) and the characters a text strip removes. Where no anchor begins, the
# second branch takes the rest of the tag, which cannot hold another one; its
# groups stay empty. The title is tried at its first tag only: where that one
# fails, all later ones do. So both are linear in any text.
ANCHOR_PATTERN = r"""(?is)<a(?:[^>]*?href=['"]?([^> '"]+)[^>]*+>(.*?)</a>|[^>]*+(?:>|$))"""
CLOSINGS = ("</a>", "</A>")
TITLE_PATTERN = r"(?is)^(?>.*?<title)[^>]*+>(.*?)</title>"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def clean_links(links: Column) -> Column:
    """Trim every element and drop the empty ones."""
    return F.filter(F.transform(links, clean_text), lambda link: link != "")


def up_to_last_close(html: Column) -> Column:
    """The text up to its last closing anchor, found from the end; empty without one."""
    rest = F.least(*[F.length(F.substring_index(html, tag, -1)) for tag in CLOSINGS])
    return F.substring(html, F.lit(1), F.length(html) - rest)


def anchor_hrefs(html: Column) -> Column:
    """All ``href`` values of closed anchors, in document order.

    Nothing behind the last closing tag can match. Cutting it off keeps pages
    with many unclosed anchors from being scanned to the end for each of them.
    """
    found = F.regexp_extract_all(up_to_last_close(html), F.lit(ANCHOR_PATTERN), F.lit(1))
    return F.filter(found, lambda href: href != "")


def page_link_set(url: Column, html: Column) -> Column:
    """Distinct canonical absolute links of one page, as an array.

    The set is built inside the row, so a page graph needs no shuffle.
    """
    def absolute(parts):
        hrefs = clean_links(F.array_distinct(anchor_hrefs(html)))
        links = F.transform(hrefs, lambda link: resolve_against(url, parts, link))
        canonical = F.transform(links, canonical_url)
        return F.array_distinct(F.filter(canonical, lambda link: link != ""))

    return let(base_parts(url), absolute)


def match_pairs(
    df: DataFrame,
    text: str,
    pattern: str,
    names: tuple[str, str],
    flags: str = "",
    start: int = 0,
) -> DataFrame:
    """One row per match, with two capture groups as columns.

    ``flags`` are inline letters such as ``is``; ``start`` is a character
    offset into the text. ``pos`` numbers the matches of a row from 0.
    """
    source = F.substring(F.col(text), start + 1, 2**31 - 1) if start else F.col(text)
    regex = F.lit(f"(?{flags}){pattern}" if flags else pattern)
    first, second = names
    zipped = F.arrays_zip(
        F.regexp_extract_all(source, regex, F.lit(1)).alias(first),
        F.regexp_extract_all(source, regex, F.lit(2)).alias(second),
    )
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.posexplode(zipped).alias("pos", "pair")).select(
        *kept, "pos", F.col(f"pair.{first}").alias(first), F.col(f"pair.{second}").alias(second)
    )


def anchor_pairs(df: DataFrame, html: str, names: tuple[str, str] = ("href", "label")) -> DataFrame:
    """One row per closed anchor with its ``href`` and inner text, numbered from 0."""
    closed = up_to_last_close(F.col(html))
    href, label = names
    pairs = F.arrays_zip(
        *[F.regexp_extract_all(closed, F.lit(ANCHOR_PATTERN), F.lit(i + 1)).alias(n)
          for i, n in enumerate(names)]
    )
    kept = [c for c in df.columns if c != html]
    found = F.filter(pairs, lambda pair: pair[href] != "")
    return df.select(*kept, F.posexplode(found).alias("pos", "pair")).select(
        *kept, "pos", F.col(f"pair.{href}").alias(href), F.col(f"pair.{label}").alias(label)
    )


def first_regex(text: Column, pattern: str, before: str = "", after: str = "") -> Column:
    """First capture, wrapped again; NULL when nothing matches.

    The capture is read from the matched part alone, so the text is searched once.
    """
    matched = F.regexp_substr(text, F.lit(pattern))
    return F.concat(F.lit(before), F.regexp_extract(matched, pattern, 1), F.lit(after))


def title_token(html: Column) -> Column:
    """First blank-separated token of the page title, entities as written."""
    return F.substring_index(F.regexp_extract(html, TITLE_PATTERN, 1), " ", 1)
