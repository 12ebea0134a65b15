"""Where intermediate results are kept, and how lineage is cut."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="spinneret-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch root; nothing exists there yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once into a Parquet table of the scratch folder and read that.

    Cuts the lineage; a lost executor costs nothing, and later steps read only
    the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
