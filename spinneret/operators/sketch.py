"""A mergeable membership sketch: which keys of a large set may be known.

A blocked Bloom filter as a table of bitmap pages. All bits of a key lie in one
64-bit word, so one page row tells about a key; pages of several batches are merged
by OR. A key that is in the set is always found, another one with a small chance,
which the caller settles by looking.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.operators.joins import fits_broadcast, lookup_join
from spinneret.operators.scratch import settle

#: Bits of a page, as Spark's bitmap functions have them.
PAGE_BITS = 15
#: 2^n bits in all: 16 for each of 8 million keys. The size is fixed for all batches.
SKETCH_BITS = 27
HASHES = 4


def _places(key: Column, bits: int) -> tuple[Column, Column, list[Column]]:
    """Page, word in the page, and the bits of the word."""
    first, second = F.xxhash64(key), F.xxhash64(F.lit(1), key)
    page = F.shiftrightunsigned(first, 64 - (bits - PAGE_BITS)) if bits > PAGE_BITS else F.lit(0).cast("bigint")
    word = first.bitwiseAND((1 << (PAGE_BITS - 6)) - 1)
    return page, word, [F.shiftrightunsigned(second, 6 * i).bitwiseAND(63).cast("int") for i in range(HASHES)]


def key_sketch(keys: DataFrame, key: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``page, bits`` of the keys of a frame; NULL keys and repeated ones add nothing.

    Bits of a page are set before and after the shuffle, which moves at most a page
    for each page number and task.
    """
    page, word, places = _places(F.col(key), bits)
    # A word read as a big-endian long has its highest bits in the first byte.
    at = [word * 64 + (7 - F.shiftright(p, 3)) * 8 + p.bitwiseAND(7) for p in places]
    return (
        keys.where(F.col(key).isNotNull())
        .select(page.alias("page"), F.explode(F.array(*at)).alias("at"))
        .groupBy("page").agg(F.bitmap_construct_agg("at").alias("bits"))
    )


def merged_sketch(sketches: DataFrame) -> DataFrame:
    """One row per page out of the pages of many batches."""
    return sketches.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def with_possible(candidates: DataFrame, sketch: DataFrame, key: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``candidates`` with ``_possible``: false when the key is certainly not in the sketch.

    The sketch has one row per page; it is broadcast where it is counted to be
    small, else candidates are dealt by page, which are hashes and so even.
    """
    page, word, places = _places(F.col(key), bits)
    mask = F.lit(0).cast("bigint")
    for place in places:
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    held = F.conv(F.hex(F.substring(F.col("_bits"), (word * 8 + 1).cast("int"), F.lit(8))), 16, -10).cast("bigint")
    joined = lookup_join(
        candidates.withColumn("_page", page), sketch.selectExpr("page AS _page", "bits AS _bits"), "_page", "left"
    )
    hit = F.coalesce(held.bitwiseAND(mask) == mask, F.lit(False))
    return joined.select(*candidates.columns, hit.alias("_possible"))


def without_known(candidates: DataFrame, known: DataFrame, sketch: DataFrame, key: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``candidates`` whose key is not in ``known``, of which ``sketch`` is a sketch.

    Candidates with a new key never meet ``known``: it is only read for the possible
    ones, and not at all when there are none. Few of those are broadcast, so that
    ``known`` is filtered where it lies. A NULL key is not known.
    """
    tested = settle(with_possible(candidates, sketch, key, bits))
    fresh = tested.where(~F.col("_possible")).drop("_possible")
    possible = tested.where("_possible").drop("_possible")
    wanted = possible.select(key).distinct()
    if wanted.isEmpty():
        return fresh
    if fits_broadcast(wanted):
        found = known.select(key).join(F.broadcast(wanted), key, "left_semi")
    else:
        found = known.select(key)
    return fresh.unionByName(possible.join(found.distinct(), key, "left_anti"))
