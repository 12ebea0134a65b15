"""Tables kept in buckets of a key, which join on that key without being moved.

Where a store is looked up pass after pass, its large side is dealt into buckets once,
when it is written; a join then only deals the other side. The session catalog holds
the table, its files lie below a path and can be declared again in another session.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession


def kept(df: DataFrame, path: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """Write ``df`` in ``buckets`` of ``key``, one sorted file each, and read it as such.

    ``buckets`` is chosen for the store to come: a bucket is read by one task.
    """
    name = name or f"kept_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def add(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Append rows to a kept table; they go to the buckets of their keys."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("append").saveAsTable(name)


def declare(spark: SparkSession, path: str, schema: str, key: str, buckets: int, name: str) -> DataFrame:
    """Name files that ``kept`` wrote, maybe in another session."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
