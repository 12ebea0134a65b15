"""Long objects out of ordered segments, assembled by many tasks.

The place of a segment in its object is the sum of the byte lengths before it. Those
sums come from a range sort by object and order: a running sum within each
partition, and the totals of the partitions before. Ranges of places are parts, and
a part is what one row, one file or one task has to hold.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spinneret.operators.scratch import settle

PART_BYTES = 64 * 1024 * 1024


def segment_offsets(
    df: DataFrame, keys: list[str], order: list[str], text: str, separator: str = ""
) -> DataFrame:
    """``keys, order, text`` with ``offset`` and ``size``: the bytes of each segment in its object.

    ``size`` counts the separator behind the segment. ``order`` is unique within an
    object; an object may have any share of the rows. A NULL text has no bytes but
    the separator's.
    """
    size = F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))) + len(separator.encode())
    along = [*keys, *order]
    placed = settle(
        df.select(*along, text).repartitionByRange(*along).sortWithinPartitions(*along)
        .withColumn("size", size.cast("bigint")).withColumn("_part", F.spark_partition_id())
    )
    # One row per object and partition that holds some of it.
    totals = placed.groupBy(*keys, "_part").agg(F.sum("size").alias("_held"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_start", F.coalesce(F.sum("_held").over(earlier), F.lit(0))).drop("_held")
    within = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("r._part") == F.col("s._part")
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}"))
    return running.alias("r").join(starts.alias("s"), same).select(
        *[F.col(f"r.{c}") for c in (*along, text)],
        (F.col("_start") + F.col("_before")).alias("offset"), "size",
    )


def object_parts(
    df: DataFrame, keys: list[str], order: list[str], text: str, separator: str = "",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``keys, part, offset, length, segments, body``: every object in parts, numbered from 0.

    A segment belongs to the part in which it begins, so a part is at most ``part_bytes``
    and one segment long, and put end to end the bodies are the object. Parts in which
    nothing begins do not appear; the separator also stands behind the last segment.
    """
    placed = segment_offsets(df, keys, order, text, separator)
    part = F.floor(F.col("offset") / F.lit(part_bytes)).cast("bigint").alias("part")
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ordered = F.array_sort(F.collect_list(F.struct("offset", "_n", content.alias("text"))))
    # Segments without a byte share their offset with the next one.
    numbered = placed.withColumn("_n", F.struct(*order))
    joined = F.transform(ordered, lambda s: F.concat(s["text"], F.lit(separator)))
    return numbered.groupBy(*keys, part).agg(
        F.min("offset").alias("offset"), F.sum("size").alias("length"),
        F.count(F.lit(1)).alias("segments"), F.array_join(joined, "").alias("body"),
    )


def write_object_parts(parts: DataFrame, keys: list[str], path: str) -> None:
    """The parts as files below ``path/data``, several to a file, and a manifest without bodies.

    ``crc`` in the manifest is the CRC-32 of a body.
    """
    parts.write.parquet(f"{path}/data", compression="zstd")
    written = parts.sparkSession.read.schema(parts.schema).parquet(f"{path}/data")
    crc = F.crc32(F.col("body").cast("binary")).alias("crc")
    written.select(*keys, "part", "offset", "length", "segments", crc).write.parquet(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def checked_parts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """``keys, part, body`` of the parts whose length and CRC-32 are those of the manifest."""
    found = spark.read.parquet(f"{path}/data").alias("d")
    listed = read_manifest(spark, path).alias("m")
    same: Column = F.col("d.part") == F.col("m.part")
    for key in keys:
        same = same & F.col(f"d.{key}").eqNullSafe(F.col(f"m.{key}"))
    right = (F.octet_length("d.body") == F.col("m.length")) & (
        F.crc32(F.col("d.body").cast("binary")) == F.col("m.crc")
    )
    return found.join(listed, same & right, "left_semi").select(*keys, "part", "body")
