"""Near-duplicates by SimHash and an inverted index of byte positions.

Documents with equal fingerprints are one class; classes are posted under keys, and
those that share a key meet in a bucket. Pairs that meet are filtered by a tally of
their equal bytes, and verified. Within 3 differing bits at least 5 of the 8 bytes
are equal, so 3 equal bytes exist among any 6 positions and nothing is lost.
"""

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, same_row, small, text_key
from spinneret.llm.components import components
from spinneret.operators.scratch import settle

SEED = 42
#: A bucket up to this size compares all its pairs, a larger one goes around a centre.
BUCKET = 64
HASHES_AT_ONCE = 1 << 16


# Shingles and signatures

def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` words, repeats included.

    A-Z is lower-cased; words stand between ASCII white space. With fewer words
    the whole sequence is one shingle, without any there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    stops = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=len(stops)
    )


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set when over half of the hashes have it set."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        octets = hashes[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _mapped(docs: DataFrame, text: str, make: Callable, schema: str, rows: int = 200) -> DataFrame:
    """``doc_id, key`` and what ``make(texts)`` gives, batch by batch."""
    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for at in range(0, batch.num_rows, rows):
                some = batch.slice(at, rows)
                made = make(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("key"), *made.values()],
                    names=["doc_id", "key", *made],
                )

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(text).alias("key"), body(text).alias("text"))
    return kept.mapInArrow(batches, f"doc_id bigint, key bigint, {schema}")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """``doc_id, key, node, s0``: the 64-bit SimHash of every row, as class and as bytes.

    A text without words, NULL included, has fingerprint zero.
    """
    def make(texts):
        made = np.array([simhash(shingle_hashes(t, shingle)) for t in texts], dtype=np.uint64)
        return {"node": pa.array(made.view(np.int64)), "s0": pa.array(made.view(np.int64))}

    return _mapped(docs, text, make, "node bigint, s0 bigint")


# Byte-position index

def _byte(place: int, of: str = "") -> str:
    return f"(shiftrightunsigned({of}s{place // 8}, {8 * (place % 8)}) & 255)"


def shared_bytes(longs: int, a: str = "a", b: str = "b") -> Column:
    """Tally of the positions at which two signatures have the same byte."""
    equal = [
        f"if((shiftrightunsigned({a}.s{i} ^ {b}.s{i}, {8 * j}) & 255) = 0, 1, 0)"
        for i in range(longs) for j in range(8)
    ]
    return F.expr(" + ".join(equal))


def postings(classes: DataFrame, places: list[tuple[int, ...]]) -> DataFrame:
    """``bucket, node``: every class under each combination of byte places."""
    keys = []
    for number, combination in enumerate(places):
        key = str(number)
        for place in combination:
            key = f"(({key}) * 256L + {_byte(place)})"
        keys.append(key)
    return classes.select(F.explode(F.expr(f"array({', '.join(keys)})")).alias("bucket"), "node")


def linked_pairs(
    classes: DataFrame,
    places: list[tuple[int, ...]],
    longs: int,
    least_shared: int,
    verify: Callable[[DataFrame], DataFrame],
    bucket: int = BUCKET,
) -> DataFrame:
    """``a, b`` edges that connect all classes whose pairs share a combination of
    bytes, tally at least ``least_shared`` equal bytes and verify.

    ``verify`` keeps the right ones of candidate pairs ``a, b`` with their
    signatures.
    """
    carried = [f"s{i}" for i in range(longs)]
    enough = shared_bytes(longs) >= least_shared
    return linked_in_buckets(postings(classes, places), classes, enough, verify, carried, bucket)


def linked_in_buckets(
    posted: DataFrame,
    classes: DataFrame,
    enough: Column,
    verify: Callable[[DataFrame], DataFrame],
    carried: list[str],
    bucket: int = BUCKET,
) -> DataFrame:
    """``a, b`` edges that connect all classes that meet in a bucket and verify.

    ``enough`` is the condition under which classes ``a`` and ``b`` of a bucket are
    candidates; ``verify`` gets their pairs with the ``carried`` columns as ``x0..``
    and ``y0..``. A bucket of up to ``bucket`` classes gives all its pairs. In a
    larger one every class is first compared with the smallest; then every class that
    is not connected to the bucket's largest component so far is compared with all
    classes of other components. What is left out are only pairs already connected, so
    components come out as if all pairs had been compared, without the square of a
    group of near copies.
    """
    held = posted.groupBy("bucket").agg(F.count("*").alias("held")).where(F.col("held") > 1)
    met = settle(settle(posted.join(held, "bucket")).join(classes, "node"))
    columns = ["node", *[c for c in met.columns if c not in ("bucket", "held", "node")]]

    def pairs(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
        joined = left.alias("a").join(
            right.alias("b"), (F.col("a.bucket") == F.col("b.bucket")) & condition & enough
        )
        return joined.select(
            F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b"),
            *[
                F.when(F.col("a.node") < F.col("b.node"), F.col(f"{x}.{c}"))
                .otherwise(F.col(f"{y}.{c}")).alias(f"{side}{i}")
                for side, x, y in (("x", "a", "b"), ("y", "b", "a")) for i, c in enumerate(carried)
            ],
        ).dropDuplicates(["a", "b"])

    few, many = met.where(F.col("held") <= bucket), met.where(F.col("held") > bucket)
    first = pairs(few, few, F.col("a.node") < F.col("b.node"))
    if many.isEmpty():
        return settle(verify(first).select("a", "b"))
    centre = many.groupBy("bucket").agg(F.min(F.struct(*columns)).alias("c")).select("bucket", "c.*")
    around = pairs(centre, many, F.col("a.node") != F.col("b.node"))
    met_first = first.unionByName(around).dropDuplicates(["a", "b"]) if bucket > 1 else around
    known = settle(verify(met_first).select("a", "b"))

    # The centre of two has met the other.
    labelled = settle(
        many.where(F.col("held") > 2).join(components(known), "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
    )
    largest = (
        labelled.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        .groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    )
    outside = labelled.join(largest, "bucket").where(F.col("component") != F.col("largest"))
    rest = pairs(outside, labelled, F.col("a.component") != F.col("b.component"))
    return known.unionByName(verify(rest).select("a", "b"))


# 64-bit fingerprints within a number of bits

def close_groups(rows: DataFrame, bits: int = 3) -> tuple[DataFrame, DataFrame]:
    """``rows`` of ``fingerprints``, settled, and ``node, component, least, n_equal`` of
    every fingerprint: those within ``bits`` differing bits are in one component."""
    rows = settle(rows)
    classes = rows.groupBy("node", "s0").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n_equal")
    )
    total = classes.count()
    # More bytes per key keep buckets small when there are more fingerprints.
    agree = next(k for k in range(1, 9 - bits) if total < 1 << (8 * k) or k == 8 - bits)
    agree = max(min(3, 8 - bits), agree)
    places = list(combinations(range(agree + bits), agree))

    def verify(pairs: DataFrame) -> DataFrame:
        return pairs.where(F.bit_count(F.col("x0").bitwiseXOR(F.col("y0"))) <= bits)

    edges = linked_pairs(classes.select("node", "s0"), places, 1, 8 - bits, verify)
    labels = components(edges)
    placed = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return rows, placed


def close_components(rows: DataFrame, bits: int = 3) -> DataFrame:
    """``rows`` of ``fingerprints`` with ``component_id`` and ``n_equal``.

    Fingerprints link at ``bits`` or fewer differing bits. ``component_id`` is the
    smallest ``doc_id`` reachable over links, NULL where no reachable row has one.
    ``n_equal`` counts the rows with the same fingerprint. Rows are all kept.
    """
    rows, placed = close_groups(rows, bits)
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(smallest, "component").select("node", "component_id", "n_equal")
    return rows.join(named, "node")


def one_of_each(docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text") -> DataFrame:
    """One document of every group of ``close_components``, with its columns.

    The one with the smallest ``doc_id`` stays (NULL ids last, ties by a hash of the
    text); of equal rows one stays. Texts without words, NULL included, share
    fingerprint zero and its group. An empty table stays empty.
    """
    rows, classes = close_groups(fingerprints(docs, shingle, text), bits)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    least = rows.groupBy("node").agg(F.min(order).alias("first"))
    grouped = least.join(classes.select("node", "component"), "node")
    kept = grouped.groupBy("component").agg(F.min("first").alias("keeper"))
    keepers = grouped.join(kept, "component").select("node", "keeper")
    same = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("key") == F.col("keeper.key"))
    dropped = settle(rows.join(keepers, "node").where(~same).select("doc_id", "key").distinct())
    left = docs.alias("d").join(small(dropped).alias("x"), same_row("d", "x", text), "left_anti")

    repeated = settle(rows.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1))
    if repeated.isEmpty():
        return left
    again = small(repeated).alias("x")
    several = left.alias("d").join(again, same_row("d", "x", text), "left_semi")
    single = left.alias("d").join(again, same_row("d", "x", text), "left_anti")
    return single.unionByName(several.dropDuplicates(["doc_id", text]))
