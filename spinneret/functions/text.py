"""Text, date, array, map and JSON columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinneret.functions.charsets import CODECS, decode_pairs
from spinneret.functions.html import clean_text

REPLACEMENT_CHARACTER = "\ufffd"
#: A sequence of noncharacters, which no text holds.
STAND_IN = "\ufdd0\ufdd1\ufdd0"


def manifest_entries(text: Column) -> Column:
    """Segment lines of a manifest: no ``#`` lines, trimmed, last one dropped."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~line.startswith("#"))
    return F.slice(
        F.transform(lines, clean_text), F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0))
    )


def line_at(text: Column, position: int = -2) -> Column:
    """A line counted from either end; NULL when the text has too few."""
    return F.try_element_at(F.split(text, "\n"), F.lit(position))


def prefix_all(values: Column, prefix: str) -> Column:
    return F.transform(values, lambda value: F.concat(F.lit(prefix), value))


def date_tag(day: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.date_format(day, "yyyyMMdd"))


def local_time(moment: Column, zone: str = "Asia/Shanghai") -> Column:
    """Wall-clock time in ``zone`` of a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), moment)


def elapsed_micros(start: Column, end: Column) -> Column:
    """Microseconds between two timestamps, -1 when either is missing."""
    gap = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.coalesce(gap, F.lit(-1).cast("bigint"))


def keywords(text: Column, separator: str = " ") -> Column:
    """Non-empty pieces of a text, as an array."""
    return F.filter(F.split(text, separator), lambda piece: piece != "")


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps; the right side wins, also with a NULL value."""
    kept = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(kept, right)


def json_field(document: Column, path: str) -> Column:
    return F.get_json_object(document, path)


def decode_body(body: Column, charset: Column, codecs: tuple[str, ...] = ("GB18030", "GBK", "GB2312")) -> Column:
    """Bytes to text in a known charset; undecodable bytes are dropped.

    UTF-8 (also meant by a NULL charset) is repaired natively and keeps the
    replacement characters that the text itself holds. ``codecs`` names the code pages
    that are decoded by tables (those of ``charsets.CODECS``). Any other charset goes
    through ``decode``: Spark knows ASCII, Latin-1 and UTF-16 by itself.
    """
    name = F.upper(charset)
    is_utf8 = F.coalesce(name, F.lit("UTF-8")).isin("UTF-8", "UTF8")
    raw = body.cast("string")
    # Replacement characters of a broken text are set aside before it is repaired.
    apart = F.replace(raw, F.lit(REPLACEMENT_CHARACTER), F.lit(STAND_IN))
    repaired = F.replace(F.make_valid_utf8(apart), F.lit(REPLACEMENT_CHARACTER), F.lit(""))
    utf8 = F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.replace(repaired, F.lit(STAND_IN), F.lit(REPLACEMENT_CHARACTER))
    )
    other = F.replace(
        F.call_function("decode", body, charset), F.lit(REPLACEMENT_CHARACTER), F.lit("")
    )
    text = F.when(is_utf8, utf8)
    for codec in codecs:
        text = text.when(name == codec, decode_pairs(body, CODECS[codec]))
    return text.otherwise(other)
