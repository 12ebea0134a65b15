"""Latest row per key, and dense numbering of a global order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinneret.operators.scratch import settle


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of every key.

    Spark cuts each map task down to one row per key before the shuffle
    (window group limit), so a hot key stays cheap.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def number_rows(df: DataFrame, order: list[Column], name: str, start: Column | int = 0) -> DataFrame:
    """Dense numbers along a total order, without a single-task window.

    ``order`` ends in a unique column, so a value that many rows share is split
    as well. A range sort fixes partition and place of every row; the result is
    settled so both stay fixed. The number is the place plus the size of all
    earlier partitions, of which there are only as many as shuffle partitions.
    """
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_place") + first).cast("bigint"))
        .drop("_part", "_place", "_offset")
    )
