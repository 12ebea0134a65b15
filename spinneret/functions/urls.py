"""URLs: authority, canonical form, relative resolution.

Every function maps Columns to a Column. Rewrites are chains in which each step
uses its input once, so expressions stay small when the optimizer moves them.
Parts are read the way the standard library's ``urllib.parse`` reads them, which
the tests use as the yardstick.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinneret.functions.binding import let, record

# What the crawl treats as binary content, as a static page with
# a meaningless query, and as a traffic-source parameter.
BINARY_SUFFIXES = (
    "exe", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "pdf",
    "jpg", "png", "bmp", "jpeg", "gif",
    "zip", "rar", "tar", "bz2", "7z", "gz",
    "flv", "mp4", "avi", "wmv", "mkv", "apk",
)
STATIC_PAGE_MARKERS = (".html?", ".htm?", ".shtml?", ".shtm?")
TRACKING_KEY_PREFIXES = ("spm", "utm_")

SCHEME = r"[a-zA-Z][a-zA-Z0-9+.\-]*:"
NETLOC_PATTERN = rf"^(?:{SCHEME})?//([^/?#]*)"
LEADING_CONTROLS = "".join(map(chr, range(0x21)))

# Only web URLs have ``;`` parameters, in the last path segment.
WEB_START = rf"(?:(?i:https?):|(?!{SCHEME}))"
NO_PATH = r"//[^/?#]*(?:[?#]|\z)"
EMPTY_PARAMS = rf"^({WEB_START}(?!{NO_PATH})(?:[^?#]*/)?[^/;?#]*);(?=[?#]|\z)"
BINARY_PATH = (
    rf"(?i)^(?:{WEB_START}(?://[^/?]*+)?+(?:(?:[^?]*/)?[^/?;]*\.|(?<=:))"
    rf"(?:{'|'.join(BINARY_SUFFIXES)})(?:;[^/?]*)?"
    rf"|(?!https?:){SCHEME}(?://[^/?]*+)?+(?:[^?]*\.|(?<=:))(?:{'|'.join(BINARY_SUFFIXES)}))(?:\?|\z)"
)
UNWANTED_PART = rf"&(?:(?:{'|'.join(TRACKING_KEY_PREFIXES)})[^&]*|[^&=]*)(?=&|\z)"

MIXED_SCHEME = r"^[a-z0-9+.\-]*[A-Z][a-zA-Z0-9+.\-]*:"

# URLs without anything to rewrite, and links that only need the site in front.
PLAIN_URL = r"^https?://[^/?#;\t\r\n]+(?:/[^?#;\t\r\n]*)?\z"
PLAIN_PAGE = r"^https?://[^/?#;\t\r\n]+/[^?#;\t\r\n]*\z"
PLAIN_ROOTED = r"^(?!.*/[/.])/[^?#;\t\r\n]*\z"


def netloc(url: Column) -> Column:
    """Authority with port and user info; empty when there is none."""
    return F.regexp_extract(url, NETLOC_PATTERN, 1)


def valid_host(url: Column) -> Column:
    return netloc(url).contains(".")


def site_key(url: Column) -> Column:
    """Third slash-separated piece; NULL when there are fewer."""
    return F.get(F.split(url, "/"), F.lit(2))


def base_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def origin_cut(url: Column, mark: str = ".com") -> Column:
    """Text up to and including the first ``mark`` (appended when absent)."""
    return F.concat(F.substring_index(url, mark, 1), F.lit(mark))


def url_key(url: Column) -> Column:
    """Fixed-width lookup key; compare the full URL as well on a match."""
    return F.sha2(url, 256)


def http_only(url: Column) -> Column:
    return url.startswith("http")


def has_static_marker(url: Column) -> Column:
    found = F.lit(False)
    for marker in STATIC_PAGE_MARKERS:
        found = found | url.contains(marker)
    return found


def static_page_trim(url: Column) -> Column:
    """Cut at the first ``?`` when a static-page marker occurs anywhere."""
    return F.when(has_static_marker(url), F.substring_index(url, "?", 1)).otherwise(url)


def _without_controls(url: Column) -> Column:
    return F.translate(F.ltrim(url, F.lit(LEADING_CONTROLS)), "\t\r\n", "")


def _without_fragment(url: Column) -> Column:
    return F.substring_index(_without_controls(url), "#", 1)


def _from(text: Column, start: Column) -> Column:
    return F.substring(text, start, F.length(text))


def _lower_scheme(url: Column) -> Column:
    def lowered(u):
        scheme = F.substring_index(u, ":", 1)
        return F.when(
            u.rlike(MIXED_SCHEME), F.concat(F.lower(scheme), _from(u, F.length(scheme) + 1))
        ).otherwise(u)

    return let(url, lowered)


def _without_empty_params(url: Column) -> Column:
    return F.when(url.contains(";"), F.regexp_replace(url, EMPTY_PARAMS, "$1")).otherwise(url)


def _has_binary_path(url: Column) -> Column:
    """For a URL without fragment."""
    return url.rlike(BINARY_PATH)


def _wanted_query(url: Column) -> Column:
    """Query with its ``?``, without tracking and valueless parts, or nothing."""
    parts = F.regexp_replace(url, r"^[^?]*\?", "&")
    kept = F.regexp_replace(parts, UNWANTED_PART, "")
    return F.when(url.contains("?"), F.regexp_replace(kept, "^&", "?")).otherwise("")


def drop_binary(url: Column) -> Column:
    """The URL, or an empty string when its path has a binary suffix."""
    return F.when(_has_binary_path(_without_fragment(url)), "").otherwise(url)


def strip_tracking(url: Column) -> Column:
    """Drop tracking parameters and parts without ``=``; keep the order."""
    def stripped(text):
        body = F.substring_index(text, "#", 1)
        return F.concat(
            let(F.substring_index(body, "?", 1), _without_empty_params),
            _wanted_query(body),
            F.regexp_replace(_from(text, F.length(body) + 1), r"^#\z", ""),
        )

    return let(_lower_scheme(_without_controls(url)), stripped)


def drop_fragment(url: Column) -> Column:
    spelled = let(_lower_scheme(_without_fragment(url)), _without_empty_params)
    return F.regexp_replace(spelled, r"^([^?]*)\?\z", "$1")


def canonical_url(url: Column) -> Column:
    """One spelling per page; an empty string means the URL is rejected.

    Not HTTP -> rejected; static pages lose their query; binary suffixes are
    rejected; tracking parameters and the fragment go; an empty path is ``/``.
    Plain URLs, the common case, only have their suffix looked at.
    """
    suffix = F.lower(F.substring_index(url, ".", -1))
    return (
        F.when(url.rlike(PLAIN_PAGE), F.when(suffix.isin(*BINARY_SUFFIXES), "").otherwise(url))
        .when(~http_only(url), "")
        .when(has_static_marker(url), F.substring_index(url, "?", 1))
        .when(url.isNotNull(), let(_lower_scheme(_without_fragment(url)), _canonical_body))
    )


def _canonical_body(body: Column) -> Column:
    head = F.substring_index(body, "?", 1)
    usual = F.regexp_replace(head, rf"^({SCHEME}//[^/]*)\z", "$1/")
    # Without an authority only web schemes keep their two slashes.
    bare = F.regexp_replace(head, rf"^((?!https?:){SCHEME})//(?=/(?!/)|\z)", "$1")
    slashed = F.regexp_replace(bare, r"^(https?:)(?=/(?!/)|;[^/]*\z|\z)", "$1//")
    odd = F.regexp_replace(slashed, rf"^(https?://(?=;[^/]*\z)|{SCHEME}(?://)?(?=\z))", "$1/")
    with_path = F.when(body.rlike(f"^{SCHEME}//[^/?]"), usual).otherwise(odd)
    return F.when(_has_binary_path(body), "").otherwise(
        F.concat(let(with_path, _without_empty_params), _wanted_query(body))
    )


def base_parts(base: Column) -> Column:
    """What resolution needs of a page URL: STRUCT<scheme, site, path, query>.

    ``path`` keeps its parameters, ``query`` its question mark.
    """
    text = _without_controls(base)
    path = F.regexp_extract(text, rf"^(?:{SCHEME})?(?://[^/?#]*)?([^?#]*)", 1)
    scheme = F.lower(F.regexp_extract(text, rf"^({SCHEME})", 1))
    return record(
        scheme=scheme,
        site=F.concat(scheme, F.lit("//"), netloc(text)),
        path=F.regexp_replace(path, r"^((?:.*/)?[^/;]*);\z", "$1"),
        query=F.regexp_extract(text, r"^[^?#]*(\?[^#]+)", 1),
    )


def _drop_dot_segments(path: Column) -> Column:
    """Collapse ``.`` and ``..`` of a rooted path; it stays rooted."""
    none = F.array().cast("array<string>")

    def step(kept, segment):
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    def collapse(segments):
        ends_in_dots = F.element_at(segments, -1).isin(".", "..")
        tail = F.when(ends_in_dots, F.array(F.lit(""))).otherwise(none)
        joined = F.concat_ws("/", F.concat(F.aggregate(segments, none, step), tail))
        return F.regexp_replace(joined, "^(?!/)", "/")

    dotted = path.rlike(r"/\.\.?(?:/|\z)")
    return F.when(dotted, let(F.split(path, "/"), collapse)).otherwise(path)


def _below(base_path: Column, path: Column) -> Column:
    """A relative path in the directory of the base path.

    Blank segments vanish, except the first and the last.
    """
    file_name = F.length(F.substring_index(base_path, "/", -1))
    # The parameters of the base belong to its file name.
    directory = F.substring(base_path, F.lit(1), F.length(base_path) - file_name)
    joined = F.concat(F.when(base_path == "", "/").otherwise(directory), path)
    return F.regexp_replace(joined, "/{2,}", "/")


def resolve_against(base: Column, parts: Column, link: Column) -> Column:
    """``link`` made absolute; ``parts`` is ``base_parts(base)``.

    A base that is no web URL, and a link with another scheme, leave the link
    as it is.
    """
    def cut(reference):
        head = F.regexp_extract(reference, r"^[^?#]*", 0)
        tail = F.regexp_replace(_from(reference, F.length(head) + 1), r"^\?(?=#|\z)", "")
        return record(
            alone=reference.rlike("^//[^/?#]"),
            head=F.regexp_replace(head, r"^//(?=/|\z)", ""),
            tail=F.regexp_replace(tail, r"^([^#]*)#\z", "$1"),
        )

    def cut_params(r):
        pattern = r"(?s)^((?:.*/)?[^/;]*)(;.*)?\z"
        return record(
            alone=r.alone,
            head=r.head,
            path=F.regexp_extract(r.head, pattern, 1),
            params=F.regexp_replace(F.regexp_extract(r.head, pattern, 2), r"^;\z", ""),
            tail=r.tail,
        )

    def place(r):
        own_query = r.tail.startswith("?")
        here = F.concat(
            parts.site, parts.path, F.when(own_query, "").otherwise(parts.query), r.tail
        )
        path = F.when(r.path.startswith("/"), _drop_dot_segments(r.path)).otherwise(
            let(_below(parts.path, r.path), _drop_dot_segments)
        )
        return (
            F.when(r.alone, F.concat(parts.scheme, _without_empty_params(r.head), r.tail))
            .when((r.path == "") & (r.params == ""), here)
            .otherwise(F.concat(parts.site, path, r.params, r.tail))
        )

    def unless_foreign(u):
        foreign = (u.scheme != "") & (u.scheme != parts.scheme)
        reference = _from(u.text, F.length(u.scheme) + 1)
        placed = let(reference, lambda text: let(cut(text), lambda r: let(cut_params(r), place)))
        return F.when(foreign, link).otherwise(placed)

    def with_scheme(text):
        scheme = F.lower(F.regexp_extract(text, rf"^({SCHEME})", 1))
        return let(record(text=text, scheme=scheme), unless_foreign)

    return (
        F.when(base == "", link)
        .when(link == "", base)
        .when(~parts.scheme.isin("http:", "https:"), link)
        .when(link.rlike(PLAIN_ROOTED), F.concat(parts.site, link))
        .when(link.rlike(PLAIN_URL), link)
        .when(base.isNotNull() & link.isNotNull(), let(_without_controls(link), with_scheme))
    )


def resolve_link(base: Column, link: Column) -> Column:
    """Resolve one link against the URL its page was served from.

    The base is a page URL, so it has an authority.
    """
    return let(base_parts(base), lambda parts: resolve_against(base, parts, link))
