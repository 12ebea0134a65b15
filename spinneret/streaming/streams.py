"""The crawl loop as Structured Streaming queries.

What a stream has to remember of a URL is a small value in the state store, which
goes when it is of no more use. What it has found lies in kept tables, to which each
micro-batch adds one batch under its own number: a replayed micro-batch writes the
same again. A stream keeps one folder for one checkpoint.
"""

from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spinneret.operators.frontier import SUCCESS, WAITING, mark_pended
from spinneret.operators.links import hub_hosts, link_set, on_site_links, page_links
from spinneret.operators.scratch import settle
from spinneret.operators.segments import crawl_rate
from spinneret.operators.sketch import without_known
from spinneret.plans.lifecycles import CrawlSettings, crawl_pass, next_batch
from spinneret.sources.tables import (
    append,
    load_frontier,
    load_sketch,
    read_table,
    save_frontier,
    stored_urls,
    write_pages,
    write_sketch,
    write_status,
)
from spinneret.streaming.state import OUTCOME_SCHEMA, SIGHTING_SCHEMA, outcome_states, recent_sightings


def read_stream(spark: SparkSession, folder: str, table: str, schema: Any) -> DataFrame:
    """A Parquet table of a folder, one file or a folder of files, as a stream of files."""
    # A pattern that only this name meets: a stream takes a plain path for a folder.
    return (
        spark.readStream.schema(schema)
        .option("basePath", folder)
        .parquet(f"{folder}/{table}.parque[t]")
    )


def drain(writer: Any) -> None:
    """Process everything available now, then stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def _each_batch(stream: DataFrame, checkpoint: str, work: Any):
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(work)


def outcome_stream(
    attempts: DataFrame, frontier: DataFrame, root: str, checkpoint: str, threshold: int = 3,
    strict: bool = False, pend_span: float | None = None, store: str | None = None,
):
    """Fold attempts ``url, code, ts, id`` into the state of the URLs of ``frontier``.

    Attempts of a micro-batch count in order of ``ts, id``, those of later ones after
    them. A URL that leaves is forgotten; attempts on URLs without a state are ignored.
    Outcomes are appended to the table ``outcomes`` below ``root`` and, with ``store``, the
    URLs that left are noted in that page store: ``1`` success, ``0`` failure. With
    ``pend_span`` a NULL code says that the URL was picked, and a picked URL without an
    attempt for so many seconds comes out as waiting; ``attempts`` then has a watermark.
    """
    def keep(batch: DataFrame, number: int) -> None:
        append(batch, root, "outcomes", number)
        if store is not None:
            done = read_table(batch.sparkSession, root, "outcomes", OUTCOME_SCHEMA, number + 1, number).where(
                F.col("state") != WAITING
            )
            status = F.when(F.col("state") == SUCCESS, "1").otherwise("0").alias("status")
            write_status(done.select("url", status, "batch"), store, ["batch"], number)

    states = outcome_states(attempts, frontier, threshold, strict, pend_span)
    return _each_batch(states, checkpoint, keep).outputMode("update")


def latest_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """Newest state per URL out of the kept micro-batches."""
    kept = read_table(spark, root, "outcomes", OUTCOME_SCHEMA)
    return (
        kept.groupBy("url")
        .agg(F.max_by(F.struct("mode", "state", "failure"), "batch").alias("last"))
        .select("url", "last.mode", "last.state", "last.failure")
    )


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update"):
    """Keep each micro-batch under its own number; a replay overwrites itself."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(keep)


def dedupe_stream(urls: DataFrame, ts: str, root: str, checkpoint: str, keep_seconds: float = 3600.0):
    """Append the first sighting of each URL to the table ``seen`` below ``root``.

    URLs of the last ``keep_seconds`` are turned away by the state store, before
    anything is read. What passes is tested against the merged sketch of all batches, and only
    possible repeats against the URLs themselves. A URL is found once however late
    or long ago it was seen; its ``ts`` is the earliest one in the micro-batch that found it.
    The tables ``seen`` and ``sketch`` must have been created.
    """
    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = read_table(spark, root, "seen", SIGHTING_SCHEMA, before=number)
        fresh = without_known(batch, known.select("url"), load_sketch(spark, root, before=number), "url")
        append(fresh, root, "seen", number)
        write_sketch(read_table(spark, root, "seen", SIGHTING_SCHEMA, number + 1, number), root, number)

    return _each_batch(recent_sightings(urls, ts, keep_seconds), checkpoint, keep).outputMode("update")


def rate_stream(tasks: DataFrame, ts: str, seconds: int, delay: str) -> DataFrame:
    """Tasks per second of each closed window."""
    timed = tasks.select(F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", delay)
    return crawl_rate(timed, "ts", seconds)


def upsert_stream(pages: DataFrame, root: str, order: list[str], checkpoint: str):
    """Append each micro-batch of ``url, html`` to the page store once."""
    return _each_batch(pages, checkpoint, lambda batch, number: write_pages(batch, root, order, number))


def crawl_stream(
    fetches: DataFrame, root: str, hosts: DataFrame, settings: CrawlSettings, checkpoint: str,
    pick: bool = True, clock: Callable[[int], float] | None = None,
):
    """One crawl pass per micro-batch of fetches, on the frontier and store kept in ``root``.

    The fetches settle the frontier, their links are admitted, and with ``pick`` the
    next batch of URLs is chosen and stamped at ``clock(number)`` (``settings.now``
    without one). A pass writes pages, status and the sketch of its URLs, then the
    frontier with its picks as one table, whose pass row makes it count; it reads what
    older passes kept, so a pass that is cut off and run again gives the same.
    """
    def run(batch: DataFrame, number: int) -> None:
        run_pass(batch, number, root, hosts, settings, pick, clock)

    return _each_batch(fetches, checkpoint, run)


def run_pass(
    fetches: DataFrame, number: int, root: str, hosts: DataFrame, settings: CrawlSettings,
    pick: bool = True, clock: Callable[[int], float] | None = None,
) -> None:
    """Pass ``number`` of ``crawl_stream`` on a table of fetches."""
    spark = fetches.sparkSession
    now = settings if clock is None else replace(settings, now=clock(number))
    done = crawl_pass(
        load_frontier(spark, root, before=number), stored_urls(spark, root, before=number),
        settle(fetches), hosts, now, load_sketch(spark, root, before=number),
    )
    append(done.ended(), root, "status", number)
    append(done.bodies(), root, "pages", number)
    added = stored_urls(spark, root, before=number + 1, since=number)
    write_sketch(added, root, number)
    after = done.frontier()
    if pick:
        after = settle(after)
        picked = settle(next_batch(after, now))
        stamped = mark_pended(after, picked, now.now, now.batch)
        after = stamped.join(F.broadcast(picked.select("seq", "ishub")), "seq", "left")
    save_frontier(after, root, number)


def on_site_stream(pages: DataFrame, keys: list[str], hubs_path: str, path: str, checkpoint: str):
    """On-site links of ``url, html`` by a hub table each micro-batch reads afresh.

    Links are made distinct within the micro-batch, so no state grows.
    """
    found = link_set()

    def keep(batch: DataFrame, number: int) -> None:
        hosts = hub_hosts(batch.sparkSession.read.parquet(hubs_path))
        links = on_site_links(page_links(batch, keys, links=found), hosts)
        links.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
