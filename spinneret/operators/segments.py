"""Ordered segments: manifests to rows, rows to assembled objects."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.functions.text import manifest_entries


def segment_rows(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per manifest entry, numbered from 0."""
    return df.select(
        *keys, F.posexplode(manifest_entries(F.col(text))).alias("pos", "segment")
    )


def segment_number(df: DataFrame, values: str, keys: list[str], width: int = 9,
                   suffix: str = ".ts") -> DataFrame:
    """Name the items of a list by their zero-padded place.

    A place with more digits than ``width`` is kept whole.
    """
    place = F.col("pos").cast("string")
    padded = F.when(F.length(place) > width, place).otherwise(F.lpad(place, width, "0"))
    return df.select(*keys, F.posexplode(values).alias("pos", "segment")).select(
        *keys, "pos", "segment", F.concat(padded, F.lit(suffix)).alias("name")
    )


def ordered_merge(
    df: DataFrame, keys: list[str], pos: str, text: str, separator: str = ""
) -> DataFrame:
    """One row per object: its segments concatenated by place (NULL first).

    For many objects that each fit a row; ``assembly.object_parts`` takes any length.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos), F.col(text))))
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(ordered, lambda s: s[text]), separator).alias("body"),
        F.count(F.lit(1)).alias("segments"),
    )


def crawl_rate(tasks: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Tasks per second in aligned windows, rounded to two decimals."""
    issued = tasks.groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("tasks")
    )
    per_second = F.col("tasks").cast("decimal(20,0)") / F.lit(seconds).cast("decimal(10,0)")
    return issued.select(
        F.col("w.start").alias("window_start"),
        "tasks",
        F.round(per_second, 2).cast("double").alias("per_second"),
    )
