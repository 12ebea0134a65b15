"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs (lines, empty ones included). Each
paragraph is hashed to a wide vector, and the document's fingerprint is the sum
of the vectors, every lane modulo a power of two: four lanes modulo 2^62 and 128
lanes modulo 2^16. Sums do not depend on the order, and a paragraph can be added
or taken away without the document.

The wide lanes settle equality. The narrow lanes count, per lane, the pieces of
the paragraphs whose hash has that bit set, so the difference of two
fingerprints tells how many pieces differ: its mean square is an unbiased
estimate of the size of the difference.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, text_key
from spinneret.operators.ordering import number_rows

WIDE = 4
WORDS_A_PIECE = 12
#: Four 16-bit lanes in a 64-bit integer; adding keeps them apart once carries are cut.
LANES = 0x0001000100010001
LOW_LANES = 0x0000FFFF0000FFFF
PACKED = 32
#: So many pieces can be counted in packed lanes before a carry is possible.
UNTIL_CARRY = (1 << 15) - 1
WIDE_MASK = (1 << 62) - 1


#: Runs of up to so many words, begun anew at each line.
PIECE = rf"(?:[^\n ]++ *+){{1,{WORDS_A_PIECE}}}"


def _add_lanes(a: str, b: str) -> str:
    """Lane-wise sum modulo 2^16 of four packed lanes: even and odd lanes apart."""
    even = f"((({a}) & {LOW_LANES}) + (({b}) & {LOW_LANES})) & {LOW_LANES}"
    odd = (
        f"((shiftrightunsigned({a}, 16) & {LOW_LANES}) + (shiftrightunsigned({b}, 16) & {LOW_LANES}))"
        f" & {LOW_LANES}"
    )
    return f"(({even}) | shiftleft({odd}, 16))"


def _add_wide(a: str, b: str) -> str:
    """Sum modulo 2^62."""
    return f"(((({a}) & {WIDE_MASK}) + (({b}) & {WIDE_MASK})) & {WIDE_MASK})"


def vector(text: str) -> Column:
    """``[wide lanes..., packed narrow lanes..., number of pieces]`` of a text column.

    All are 64-bit integers. Adding two vectors with ``combine`` gives the vector
    of both texts' paragraphs.
    """
    paragraphs = f"split({text}, '\\n', -1)"
    pieces = f"transform(regexp_extract_all({text}, r'{PIECE}', 0), p -> rtrim(p))"
    wide = [
        f"aggregate({paragraphs}, 0L, (t, p) -> {_add_wide('t', f'xxhash64({lane}, p)')})"
        for lane in range(WIDE)
    ]

    def packed(hashes: str, shift: int) -> str:
        def count(some: str) -> str:
            return f"aggregate({some}, 0L, (t, h) -> t + (shiftrightunsigned(h, {shift}) & {LANES}))"

        starts = f"sequence(1, greatest(size({hashes}), 1), {UNTIL_CARRY})"
        parts = f"transform({starts}, i -> {count(f'slice({hashes}, i, {UNTIL_CARRY})')})"
        return (
            f"if(size({hashes}) <= {UNTIL_CARRY}, {count(hashes)},"
            f" aggregate({parts}, 0L, (t, h) -> {_add_lanes('t', 'h')}))"
        )

    narrow = [
        packed(f"element_at(s, 1).{name}", shift) for name in ("a", "b") for shift in range(16)
    ]
    hashes = (
        f"transform(array({pieces}), x -> named_struct("
        f"'a', transform(x, p -> xxhash64({WIDE}, p)), 'b', transform(x, p -> xxhash64({WIDE + 1}, p))))"
    )
    lanes = ", ".join([*wide, *narrow, "cast(size(element_at(s, 1).a) as bigint)"])
    return F.expr(f"element_at(transform(array({hashes}), s -> array({lanes})), 1)")


def combine(a: str, b: str, sign: int = 1) -> Column:
    """Vector of column ``a`` with the paragraphs of ``b`` added, or taken away (``sign`` -1)."""
    def lane(i: int) -> str:
        x, y = f"get({a}, {i})", f"get({b}, {i})"
        if i == WIDE + PACKED:
            return f"{x} + {y}" if sign > 0 else f"{x} - {y}"
        if i < WIDE:
            return _add_wide(x, y if sign > 0 else f"{WIDE_MASK} + 1 - ({y} & {WIDE_MASK})")
        # Negative: the two's complement of every lane.
        return _add_lanes(x, y if sign > 0 else f"({_add_lanes(f'~{y}', str(LANES))})")

    return F.expr(f"array({', '.join(lane(i) for i in range(WIDE + PACKED + 1))})")


def digits(v: str) -> Column:
    """The vector as text: 16 hexadecimal digits for each integer."""
    return F.expr(f"array_join(transform({v}, x -> lpad(hex(x), 16, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Estimated share of pieces that two vector columns have in common, from 0 to 1.

    1 for equal vectors; otherwise 1 less the estimated size of the difference
    over the number of pieces of both, at least 0. The standard error is about
    an eighth of the difference (128 lanes).
    """
    def balance(v: str, x: str, s: str) -> str:  # pieces with the bit set less pieces without
        twice = f"2 * (shiftrightunsigned({x}, {s}) & 65535) - get({v}, {WIDE + PACKED})"
        return f"(({twice} + 32768) & 65535) - 32768"

    apart = f"(({balance(a, 'x', 's')}) - ({balance(b, 'y', 's')}))"
    packed = ", ".join(f"slice({v}, {WIDE + 1}, {PACKED})" for v in (a, b))
    squares = (
        f"zip_with({packed}, (x, y) -> aggregate(array(0, 16, 32, 48), 0D, (t, s) -> "
        f"t + cast({apart} * {apart} as double)))"
    )
    difference = f"aggregate({squares}, 0D, (t, d) -> t + d) / {4 * PACKED}"
    pieces = f"(get({a}, {WIDE + PACKED}) + get({b}, {WIDE + PACKED}))"
    return F.expr(
        f"case when {a} = {b} then 1D when {pieces} = 0 then 0D "
        f"else greatest(0D, least(1D, 1D - {difference} / {pieces})) end"
    )


def with_following(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id, content, own, head, following``: every document and its vector, with
    the start and the vector of the next one in ascending ``doc_id`` order (after the
    last: the first).

    Only ids, sizes and hashes are sorted. Texts are shuffled once, by row key;
    from there each document sends its successor's request what it asks for.
    NULL ids come first; documents that share an id are ordered by a hash of
    their text, and equal rows are one place in the order.
    """
    missing = F.lit(-(1 << 63))  # stands for NULL, so a join needs no second column
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), missing).alias("id"),
        text_key(text).alias("key"),
        body(text).alias("content"),
    )
    places = number_rows(
        keyed.groupBy("id", "key").agg(F.max(F.length("content")).alias("n_chars")),
        [F.col("id"), F.col("key")], "place",
    )
    total = places.agg(F.count("*")).first()[0]
    asking = places.select(
        F.pmod(F.col("place") + 1, F.lit(max(total, 1))).alias("place"),
        F.col("id").alias("to_id"), F.col("key").alias("to_key"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("length"),
    )
    requests = places.select("place", "id", "key").join(asking, "place").drop("place")

    # Both joins below read the same columns of this, so they share one exchange.
    full = keyed.withColumn("own", vector("content")).repartition("id", "key")
    sent = (
        full.join(requests, ["id", "key"])
        .groupBy(F.col("to_id").alias("id"), F.col("to_key").alias("key"))
        .agg(F.first(F.struct(F.expr("left(content, length)").alias("head"), F.col("own").alias("own"))).alias("next"))
    )
    return full.join(sent, ["id", "key"]).select(
        F.nullif("id", missing).alias("doc_id"),
        "content", "own", F.col("next.head").alias("head"), F.col("next.own").alias("following")
    )


def fingerprint_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    A NULL text is an empty one; both have the fingerprint of one empty
    paragraph. A repeated row stays, with the same result. A table of one row
    is its own next document.
    """
    edited = "concat(left(content, length(content) - cast(floor(length(content) / 2) as int)), head)"
    return (
        with_following(docs, text)
        .withColumn("edited", F.expr(edited))
        .withColumn("changed", vector("edited"))
        .select(
            "doc_id", F.length("content").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            digits("own").alias("fingerprint"),
            digits("changed").alias("edited_fingerprint"),
            likeness("own", "changed").alias("near_edited"),
            likeness("own", "following").alias("near_next"),
        )
    )
