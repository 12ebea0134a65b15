"""Item files: CSV in and out, export formats, binary assets."""

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spinneret.operators.feeds import ITEM_FIELDS
from spinneret.operators.ordering import number_rows
from spinneret.operators.scratch import settle

ITEM_CSV_SCHEMA = ", ".join(f"`{f}` string" for f in (*ITEM_FIELDS, "overflow"))
# Small enough for the thousands of rows that a Parquet reader takes at once.
CHUNK_BYTES = 1 << 14
CHUNK_SCHEMA = "file string, block bigint, seq bigint, before bigint, after bigint, text string"
# A larger file is read in parts; a task takes about so many.
WHOLE_BYTES, PART_BYTES, TASK_PARTS = 1 << 26, 1 << 23, 16
PART_SCHEMA = "path string, length bigint, at bigint, content binary"
# Stands before what takes the place of another character; itself it becomes ``MARK + "e"``.
MARK = "\x1b"
ODD_BREAK = MARK + "n"


def write_items_csv(df: DataFrame, path: str, quote: bool = True) -> None:
    """Six item fields, no header, overwriting the target.

    Unquoted output is the plain comma-joined line, which a comma in a field
    shifts; ``read_items_csv`` flags such rows.
    """
    items = df.select(*ITEM_FIELDS)
    if quote:
        items.write.mode("overwrite").csv(path, quoteAll=True, escape='"')
    else:
        line = F.concat_ws(",", *[F.coalesce(F.col(f), F.lit("None")) for f in ITEM_FIELDS])
        items.select(line.alias("value")).write.mode("overwrite").text(path)


def read_items_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Item CSV with a possible byte-order mark and CRLF line ends.

    ``shifted`` marks rows that a comma in the text moved into a 7th column.
    ``multi_line`` accepts quoted line breaks, see ``csv_records``.
    """
    if multi_line:
        record = F.from_csv("record", ITEM_CSV_SCHEMA, {"escape": '"'})
        rows = csv_records(spark, path).select(record.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(ITEM_CSV_SCHEMA).csv(path, escape='"')
    return rows.withColumn("shifted", F.col("overflow").isNotNull())


def csv_records(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``record``: the records of CSV files, quoted line breaks included, in many tasks a file.

    A line break ends a record when the quotes before it in the file are even in number.
    Files are read in blocks, and their lines kept as chunks of some kilobytes in which a
    line break tells the parity of the quotes before it in its block; the parity of each
    block, one row, is summed along its file and tells which breaks end records. Every chunk
    is then cut by itself, and only what runs over the ends of chunks is sorted and joined,
    so a task holds a few chunks however large the file is.
    Empty lines between records are left out, as Spark's reader does.
    """
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    chunks = settle(raw.mapInArrow(lambda batches: _chunks(batches, chunk_bytes), CHUNK_SCHEMA))
    blocks = chunks.groupBy("file", "block").agg(F.max_by("after", "seq").alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.select("file", "block", F.sum("odd").over(earlier).bitwiseAND(1).alias("opened"))
    # Only blocks that begin inside quotes are listed, so a row per block at most.
    placed = chunks.join(F.broadcast(opened.where(F.col("opened") == 1)), ["file", "block"], "left")
    listed = F.col("opened").isNotNull()
    cut = placed.select(
        "file", "block", "seq", ((F.col("before") == 1) != listed).alias("inside"),
        ((F.col("after") == 1) != listed).alias("open"),
        F.when(listed, F.split("text", ODD_BREAK)).otherwise(F.split("text", "\n")).alias("pieces"),
    )
    found = cut.select("*", F.size("pieces").alias("n"), F.posexplode("pieces").alias("i", "piece"))
    begins, ends = (F.col("i") > 0) | ~F.col("inside"), (F.col("i") < F.col("n") - 1) | ~F.col("open")
    line = F.replace(F.replace("piece", F.lit(ODD_BREAK), F.lit("\n")), F.lit(MARK + "e"), F.lit(MARK))
    trimmed = F.regexp_replace(line, "\r$", "")
    whole = found.where(begins & ends).select(trimmed.alias("record")).where("record != ''")

    # Of records over several chunks: the chunk that begins one, in this block or an earlier one.
    parts = settle(
        found.where(~(begins & ends)).select("file", "block", "seq", "i", begins.alias("begins"), line.alias("text"))
    )
    start = F.when(F.col("begins"), F.struct("block", "seq"))
    last = parts.groupBy("file", "block").agg(F.max(start).alias("last"))
    carried = last.select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    up_to = Window.partitionBy("file", "block").orderBy("seq", "i")
    owned = parts.withColumn("_own", F.last(start, ignorenulls=True).over(up_to))
    joined = (
        owned.join(F.broadcast(carried.where(F.col("carried").isNotNull())), ["file", "block"], "left")
        .groupBy("file", F.coalesce("_own", "carried").alias("record_at"))
        .agg(F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("parts"))
    )
    text = F.array_join(F.transform("parts", lambda x: x["text"]), "\n")
    return whole.unionByName(joined.select(F.regexp_replace(text, "\r$", "").alias("record")))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Lines of a block put together to chunks, ascending by ``seq``.

    ``before`` and ``after`` are the parity of the quotes of the block up to the begin and the
    end of a chunk. Where it is odd, lines are put together by ``ODD_BREAK``.
    """
    breaks = pa.array(["\n", ODD_BREAK, ""])
    last, parity, seq = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, lines = batch.columns
        places, quotes = block.to_numpy(), pc.count_substring(lines, '"').to_numpy().astype("int64")
        filled = np.cumsum(pc.binary_length(lines).to_numpy().astype("int64") + 1) // chunk_bytes
        other = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (places[1:] != places[:-1])
        fresh = np.append((file[0].as_py(), places[0]) != last, other)
        starts = np.flatnonzero(fresh | np.append(True, filled[1:] != filled[:-1]))
        ends = np.append(starts[1:], len(places)) - 1

        after = np.cumsum(quotes)
        before = after - quotes
        base = np.maximum.accumulate(np.where(fresh, before, -parity))
        before, after = (before - base) & 1, (after - base) & 1
        kinds = after.copy()
        kinds[ends] = 2
        kept = pc.replace_substring(lines, MARK, MARK + "e")
        broken = pc.binary_join_element_wise(kept, breaks.take(pa.array(kinds)), "")
        yield pa.RecordBatch.from_arrays([
            file.take(pa.array(starts)), pa.array(places[starts]), pa.array(seq + np.arange(len(starts))),
            pa.array(before[starts]), pa.array(after[ends]),
            pc.binary_join(pa.ListArray.from_arrays(pa.array([*starts, len(places)], "int32"), broken), ""),
        ], names=["file", "block", "seq", "before", "after", "text"])
        last, parity, seq = (file[-1].as_py(), places[-1]), int(after[-1]), seq + len(starts)


def write_rank_csv(df: DataFrame, path: str) -> None:
    """Header, no index; nested columns are written as JSON text."""
    nested = ("array", "map", "struct")
    flat = [
        F.to_json(f.name).alias(f.name) if f.dataType.typeName() in nested else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, escape='"')


EXPORTS = {
    "json": ("text", {}),
    "jsonlines": ("json", {}),
    "csv": ("csv", {"header": "true", "escape": '"'}),
    "xml": ("xml", {"rowTag": "item", "rootTag": "items"}),
}


def item_export(df: DataFrame, path: str, kind: str, order: list[str] | None = None) -> None:
    """Write items as json, jsonlines, csv or xml.

    ``json`` is one array over all parts, see ``write_json_array``; ``jsonlines`` holds
    an object per line.
    """
    if kind == "json":
        write_json_array(df, path, order)
        return
    name, options = EXPORTS[kind]
    df.write.mode("overwrite").format(name).options(**options).save(path)


def write_json_array(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One JSON array of the rows, in ``order`` (all columns by default), over many parts.

    The parts put end to end by their names are the array: its brackets stand in the
    first and the last line only, and every other line begins with a comma. Rows are
    numbered by a range sort and written along their numbers, so no task holds them all.
    """
    spark = df.sparkSession
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("_json")
    by = order or df.columns
    numbered = number_rows(df.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(by)], line),
                           [*[F.col(f"_o{i}") for i in range(len(by))], F.col("_json")], "_n")
    last = numbered.agg(F.max("_n")).first()[0]
    if last is None:
        spark.range(1).select(F.lit("[]").alias("value")).write.mode("overwrite").text(path)
        return
    value = F.concat(
        F.when(F.col("_n") == 0, "[").otherwise(","), "_json", F.when(F.col("_n") == last, "]").otherwise("")
    )
    numbered.repartitionByRange("_n").sortWithinPartitions("_n").select(value.alias("value")).write.mode(
        "overwrite"
    ).text(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of ``write_json_array``; each line is read by itself, so files are split."""
    line = F.regexp_replace("value", r"^[\[,]|\]$", "")
    rows = spark.read.text(path).select(line.alias("line")).where(F.col("line") != "")
    return rows.select(F.from_json("line", schema).alias("row")).select("row.*")


def read_assets(
    spark: SparkSession, path: str, pattern: str = "*", whole: int = WHOLE_BYTES, part: int = PART_BYTES
) -> DataFrame:
    """Bytes of every file below ``path``, named by its last path segment.

    A file of up to ``whole`` bytes is one row. A larger one, which may exceed what a cell can
    hold, comes in rows of ``part`` bytes that begin at byte ``at``; its last row has the rest,
    too, so no row of it is shorter. These are read by many tasks through Arrow's file systems.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    )
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    small = files.where(F.col("length") <= whole).select("path", "length", F.lit(0).cast("bigint").alias("at"), "content")
    large = files.where(F.col("length") > whole).select("path", "length", F.expr(f"length DIV {part}").alias("n"))
    parts = large.agg(F.sum("n")).first()[0]
    if parts:
        places = large.select(
            "path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("i"),
        ).select("path", "length", (F.col("i") * part).alias("at"))
        tasks = min(parts, max(-(-parts // TASK_PARTS), spark.sparkContext.defaultParallelism))
        dealt = places.repartition(tasks)
        small = small.unionByName(dealt.mapInArrow(lambda batches: _parts(batches, part), PART_SCHEMA))
    return small.select(name, "length", "content", "path", "at")


def _parts(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            size = row["length"] - row["at"]
            size = part if size >= 2 * part else size
            store, place = _place(row["path"])
            with store.open_input_file(place) as file:
                content = file.read_at(size, row["at"])
            if len(content) != size:
                raise OSError(f"{row['path']} has changed while it was read")
            yield pa.RecordBatch.from_pylist([row | {"content": content}], batch.schema.append(pa.field("content", pa.binary())))


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a path as Spark tells it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + quote(rest, safe="/:@"))
