"""Decoding of double-byte code pages by column expressions.

The bytes of a page are read as hexadecimal digits and cut into runs of ASCII, mapped
characters and single bytes that decode to nothing; a table looked up by place turns
characters into text. Tables and the pattern of what is mapped are taken from the
codec of that name, so nothing depends on settings of the session.
"""

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from spinneret.functions.binding import let

#: Charset names, in capitals, and the codec that decodes them.
CODECS = {"GB18030": "gb18030", "GBK": "gbk", "CP936": "gbk", "GB2312": "gb2312", "BIG5": "big5", "EUC-KR": "euc_kr"}
FIRST_LEAD, FIRST_TRAIL = 0x81, 0x30
TRAILS = 0x100 - FIRST_TRAIL
#: Four-byte forms of GB 18030: those of the basic plane, and where the others begin.
BASIC_QUADS, OTHER_QUADS, ALL_QUADS = 39420, 189000, 189000 + (1 << 20)
THIRD = "(?:8[1-9A-F]|[9A-E].|F[0-9A-E])3[0-9]"
#: The four-byte codes from 81308130 to 8431A439, and from 90308130 to E3329A35.
QUADS = (
    f"8[1-3]3[0-9]{THIRD}|8430{THIRD}|8431(?:8[1-9A-F]|9.|A[0-4])3[0-9]|"
    f"(?:9.|[A-D].|E[0-2])3[0-9]{THIRD}|E33[01]{THIRD}|E332(?:8[1-9A-F]|9[0-9])3[0-9]|E3329A3[0-5]"
)


def _one(codec: str, data: bytes) -> str:
    try:
        text = data.decode(codec)
    except UnicodeDecodeError:
        return ""
    return text if len(text) == 1 else ""


@lru_cache
def pairs(codec: str) -> tuple[str, ...]:
    """The characters of all two-byte codes, by lead and trail; empty where there is none."""
    return tuple(
        _one(codec, bytes([lead, trail])) for lead in range(FIRST_LEAD, 256) for trail in range(FIRST_TRAIL, 256)
    )


def quad_bytes(number: int) -> bytes:
    """The four-byte code with a linear number."""
    number, d = divmod(number, 10)
    number, c = divmod(number, 126)
    a, b = divmod(number, 10)
    return bytes([0x81 + a, 0x30 + b, 0x81 + c, 0x30 + d])


@lru_cache
def basic_quads(codec: str) -> tuple[str, ...]:
    return tuple(_one(codec, quad_bytes(n)) for n in range(BASIC_QUADS))


def _byte_class(values: list[int]) -> str:
    """A pattern of two hexadecimal digits for a set of bytes."""
    rows: dict[str, str] = {}
    for value in values:
        high, low = f"{value:02X}"
        rows[high] = rows.get(high, "") + low
    same: dict[str, str] = {}
    for high, lows in rows.items():
        same[lows] = same.get(lows, "") + high
    return "(?:" + "|".join(f"[{highs}][{lows}]" for lows, highs in same.items()) + ")"


@lru_cache
def token_pattern(codec: str) -> str:
    """Runs of ASCII, mapped characters, and any other byte, in hexadecimal digits."""
    table = pairs(codec)
    leads: dict[tuple[int, ...], list[int]] = {}
    for lead in range(FIRST_LEAD, 256):
        start = (lead - FIRST_LEAD) * TRAILS
        trails = tuple(FIRST_TRAIL + i for i in range(TRAILS) if table[start + i])
        if trails:
            leads.setdefault(trails, []).append(lead)
    mapped = "|".join(_byte_class(those) + _byte_class(list(trails)) for trails, those in leads.items())
    # A four-byte form that the end cuts off is dropped whole.
    quads = f"|{QUADS}|[89A-F].3[0-9](?:..)?$" if codec == "gb18030" else ""
    return f"(?:[0-7][0-9A-F])++|{mapped}{quads}|[0-9A-F]{{2}}"


def _array(table: tuple[str, ...]) -> Column:
    """A constant array, folded once when the query is planned."""
    return F.split(F.lit("\n".join(table)), "\n", -1)


def _value(token: Column, first: int, low: int) -> Column:
    """A byte of a token as its distance from ``low``."""
    digits = F.lit("0123456789ABCDEF")
    at = lambda place: F.instr(digits, F.substring(token, place, 1)) - 1
    return at(first) * 16 + at(first + 1) - low


def _quad(token: Column, codec: str) -> Column:
    number = (
        (_value(token, 1, 0x81) * 10 + _value(token, 3, 0x30)) * 126 + _value(token, 5, 0x81)
    ) * 10 + _value(token, 7, 0x30)

    def character(n: Column) -> Column:
        code = n - OTHER_QUADS + 0x10000
        octets = [
            F.shiftright(code, 18) + 0xF0, F.shiftright(code, 12).bitwiseAND(63) + 0x80,
            F.shiftright(code, 6).bitwiseAND(63) + 0x80, code.bitwiseAND(63) + 0x80,
        ]
        other = F.unhex(F.concat(*[F.hex(o.cast("bigint")) for o in octets])).cast("string")
        return F.when(n < BASIC_QUADS, F.element_at(_array(basic_quads(codec)), n + 1)).when(
            (n >= OTHER_QUADS) & (n < ALL_QUADS), other
        ).otherwise(F.lit(""))

    return let(number, character)


def decode_pairs(body: Column, codec: str) -> Column:
    """Bytes to text; bytes that the codec has no character for are dropped.

    A byte that begins no mapped character is dropped by itself, and what follows is
    read anew. NULL stays NULL, no bytes are the empty text.
    """
    table = pairs(codec)

    def text(token: Column) -> Column:
        place = _value(token, 1, FIRST_LEAD) * TRAILS + _value(token, 3, FIRST_TRAIL) + 1
        found = F.when(F.substring(token, 1, 1) < "8", F.unhex(token).cast("string")).when(
            (F.length(token) == 4) & (F.substring(token, 3, 1) > "3"), F.element_at(_array(table), place)
        )
        if codec == "gb18030":
            found = found.when(F.length(token) == 8, _quad(token, codec))
        return found.otherwise(F.lit(""))

    tokens = F.regexp_extract_all(F.hex(body), F.lit(token_pattern(codec)), F.lit(0))
    return F.array_join(F.transform(tokens, text), "")
