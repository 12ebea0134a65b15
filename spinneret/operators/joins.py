"""Joins whose small side is measured and whose hot keys are split.

In both forms the second frame holds each key at most once.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.operators.scratch import settle

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 200
MOST_SALTS = 1000


def _row_bytes(df: DataFrame) -> Column:
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            size = F.octet_length(field.name)
        elif kind in ("array", "map", "struct", "variant"):
            size = F.octet_length(F.to_json(F.struct(field.name)))
        else:
            size = F.lit(8)
        width = width + F.coalesce(size, F.lit(0)) + 16
    return width


def fits_broadcast(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Count rows and bytes in one distributed aggregate."""
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("size")
    ).first()
    return seen["rows"] <= rows and seen["size"] <= size


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: str, how: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``facts`` to a unique-keyed lookup.

    The lookup is broadcast when it is counted to be small. Beyond that the
    facts are salted, so a key that holds a large share of them is spread over as
    many tasks as there are shuffle partitions (at most ``MOST_SALTS``); the lookup
    is repeated once per salt.
    """
    if fits_broadcast(lookup, rows):
        return facts.join(F.broadcast(lookup), on, how)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    salts = min(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SALTS)
    mixed = F.shiftrightunsigned(content, 1) + F.spark_partition_id()
    salt = F.pmod(mixed, F.lit(salts).cast("bigint"))
    spread = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return facts.withColumn("_salt", salt).join(spread, [on, "_salt"], how).drop("_salt")


def hot_split_join(facts: DataFrame, other: DataFrame, on: str, how: str) -> DataFrame:
    """Join ``facts`` to a large unique-keyed frame, hot keys apart.

    Keys with more than 1/``HOT_SHARE`` of the facts number fewer than
    ``HOT_SHARE``, so they and their partner rows are broadcast; the rest is
    shuffled on the key. The facts are evaluated once and settled; counting them and
    their keys reads the key column of what was settled.
    """
    facts = settle(facts)
    total = facts.count()
    hot = (
        facts.where(F.col(on).isNotNull())
        .groupBy(on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") * HOT_SHARE > total)
        .select(on)
    )
    hot_keys = [row[0] for row in hot.collect()]
    if not hot_keys:
        return facts.join(other, on, how)
    is_hot = F.coalesce(F.col(on).isin(hot_keys), F.lit(False))
    apart = facts.where(is_hot).join(F.broadcast(other.where(is_hot)), on, how)
    return apart.unionByName(facts.where(~is_hot).join(other.where(~is_hot), on, how))
