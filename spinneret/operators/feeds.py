"""JSON feeds flattened to items."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the feed and of the items.
FEED_SCHEMA = (
    "contList array<struct<userInfo: struct<name: string>, title: string, "
    "complaintObject: string, description: string, responseObject: string, response: string>>"
)
ITEM_FIELDS = (
    "name", "title", "complaintObject", "description", "responseObject", "response",
)


def feed_items(raw: DataFrame, json: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of ``contList``, with its place and six fields.

    A field the element lacks is NULL; a document without the list has no rows.
    """
    entries = F.from_json(F.col(json), FEED_SCHEMA).getField("contList")
    rows = raw.select(*keys, F.posexplode(entries).alias("pos", "entry"))
    return rows.select(
        *keys,
        "pos",
        F.col("entry.userInfo.name").alias("name"),
        *[F.col(f"entry.{field}").alias(field) for field in ITEM_FIELDS[1:]],
    )


def apply_steps(
    items: DataFrame, steps: list[tuple[int, Callable[[DataFrame], DataFrame]]]
) -> DataFrame:
    """Run (priority, step) pairs over the items, lowest priority first."""
    for _, step in sorted(steps, key=lambda entry: entry[0]):
        items = items.transform(step)
    return items
