"""Source lists: transpose, union, dedupe, latency ranking, coverage."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.operators.ordering import number_rows

DEAD = -1


def zip_columns(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Parallel arrays to rows; shorter arrays are padded with NULL."""
    zipped = F.arrays_zip(*[F.col(c) for c in columns])
    return df.select(*keys, F.posexplode(zipped).alias("pos", "row")).select(
        *keys, "pos", *[F.col(f"row.{c}").alias(c) for c in columns]
    )


def dedupe(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Drop equal rows, or rows equal in ``by``."""
    return df.dropDuplicates(by) if by else df.distinct()


def dedupe_within(df: DataFrame, page: str, by: list[str]) -> DataFrame:
    return df.dropDuplicates([page, *by])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_indexed(order: list[str], *frames: DataFrame) -> DataFrame:
    """All rows, numbered anew from 0: frame by frame, each by its ``order``."""
    tagged = union_all(*[f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)])
    numbered = number_rows(tagged, [F.col("_frame"), *[F.col(c) for c in order]], "index")
    return numbered.drop("_frame")


def union_set(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def live_only(df: DataFrame, latency: str = "ping") -> DataFrame:
    """Rows that are not marked dead; a missing latency does not mark a row."""
    return df.where((F.col(latency) != DEAD) | F.col(latency).isNull())


def latency_rank(
    df: DataFrame, latency: str, tie_break: list[str], top: int | None = None
) -> DataFrame:
    """Distinct live rows numbered from 0 by rising latency, missing ones last.

    ``tie_break`` makes the order total. With ``top`` only the first rows are
    sorted out; without, a range sort spreads the whole order.
    """
    live = live_only(dedupe(df), latency)
    order = [F.col(latency).asc_nulls_last(), *[F.col(c) for c in tie_break]]
    if top is not None:
        live = live.orderBy(*order).limit(top)
    return number_rows(live, order, "rank")


def source_coverage(df: DataFrame, source: str, top: int | None = None) -> DataFrame:
    """Items per source, most first."""
    counted = df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.orderBy(F.desc("n"), source)
    return ranked if top is None else ranked.limit(top)
