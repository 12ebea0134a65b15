"""Link graph: links per page, links on hub sites, yield per hub."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.functions.html import page_link_set
from spinneret.functions.urls import netloc
from spinneret.operators.joins import lookup_join


def ok_fetches(fetches: DataFrame, hub_flag: str = "ishub") -> tuple[DataFrame, DataFrame]:
    """Successful fetches, as (hubs to extract links from, pages to keep)."""
    ok = fetches.where(F.col("status") == 200)
    return ok.where(F.col(hub_flag) == 1), ok.where(F.col(hub_flag) == 0)


def page_bytes(fetches: DataFrame) -> DataFrame:
    """Status, UTF-8 size of the body and final URL of every fetch."""
    return fetches.select(
        "status", F.octet_length("body").cast("bigint").alias("bytes"), "redirected_url"
    )


def page_links(
    pages: DataFrame, keys: list[str], url: str = "url", html: str = "html",
    keep_linkless: bool = False, links: Column | None = None,
) -> DataFrame:
    """One row per page and distinct link. No shuffle: the set is built in the row.

    With ``keep_linkless`` a page without links has one row with a NULL link.
    ``links`` is the expression of ``link_set``, for callers that need it often.
    """
    expand = F.explode_outer if keep_linkless else F.explode
    links = link_set(url, html) if links is None else links
    return pages.select(*keys, expand(links).alias("link"))


def link_set(url: str = "url", html: str = "html") -> Column:
    """Links of a page as a column. Putting it together costs more than planning it,
    so a stream does that once and not for every micro-batch."""
    return page_link_set(F.col(url), F.col(html))


def hub_hosts(hubs: DataFrame, url: str = "url") -> DataFrame:
    return hubs.select(netloc(F.col(url)).alias("host")).distinct()


def on_site_links(links: DataFrame, hosts: DataFrame, link: str = "link") -> DataFrame:
    """Links whose authority is exactly one of ``hosts`` (distinct)."""
    hosted = links.withColumn("host", netloc(F.col(link)))
    return lookup_join(hosted, hosts, "host", "left_semi").select(*links.columns)


def link_yield(links: DataFrame, hosts: DataFrame, keys: list[str]) -> DataFrame:
    """Kept and total links per page; pages that keep none, or have none, stay."""
    hosted = links.withColumn("host", netloc(F.col("link")))
    flagged = lookup_join(hosted, hosts.withColumn("kept", F.lit(True)), "host", "left")
    return flagged.groupBy(*keys).agg(
        F.count_if("kept").alias("good_links"), F.count("link").alias("all_links")
    )
