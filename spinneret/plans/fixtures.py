"""Inputs derived from the test tables, as Spark and as SQL common tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.functions.urls import BINARY_SUFFIXES, canonical_url, netloc
from spinneret.operators.links import page_links

NOW, SPAN, THRESHOLD = 20, 10, 3
FEED_PAGE = 50

# Endings put on every page URL, so that each canonical rule meets each page.
VARIANTS = (
    "", ".pdf", ".PDF?x=1", ".html?spm=1#z", "?utm_source=a&k=1&flag&e=&spmX=2#f",
    "/v;1/a;b.gif?q=2", "/a.zip;v=1", "?next=1.html?y", "/dir;", "?#",
)
# Link spellings tried against every page.
LINK_FORMS = ("href", "relative", "net_path", "query", "fragment", "parent", "absolute")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _head(url):
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL as it is, with every ending, and with a foreign scheme."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    spelled = F.array(
        url,
        *[F.concat(_head(url), F.lit(v)) for v in VARIANTS[1:]],
        F.concat(F.lit("ftp:"), url),
    )
    return pages.select("page_id", F.posexplode(spelled).alias("variant", "url"))


_NETLOC_SQL = "regexp_extract({u}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)"
_HEAD_SQL = "split_part(split_part({u}, '#', 1), '?', 1)"


def netloc_sql(u: str) -> str:
    return _NETLOC_SQL.format(u=u)


VARIANTS_SQL = (
    "variants AS (SELECT page_id, v.variant, CASE WHEN v.variant = 0 THEN url "
    f"WHEN v.variant = {len(VARIANTS)} THEN 'ftp:' || url "
    f"ELSE {_HEAD_SQL.format(u='url')} || v.ending END AS url FROM pages, (VALUES "
    + ", ".join(f"({i}, '{v}')" for i, v in enumerate((*VARIANTS, "")))
    + ") v(variant, ending))"
)


def canonical_sql(source: str, column: str, keep: str, name: str = "canon") -> str:
    """Common tables ending in ``<name>(<keep>, canonical)`` for absolute URLs."""
    suffixes = ", ".join(f"'{s}'" for s in BINARY_SUFFIXES)
    return f"""
    {name}_cut1 AS (SELECT {keep}, {column} AS u, split_part({column}, '#', 1) AS body FROM {source}),
    {name}_cut2 AS (SELECT *, split_part(body, '?', 1) AS head,
        regexp_extract(split_part(body, '?', 1), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*') AS site
        FROM {name}_cut1),
    {name}_cut3 AS (SELECT *, substr(head, length(site) + 1) AS whole_path,
        substr(body, length(head) + 2) AS query FROM {name}_cut2),
    {name}_cut4 AS (SELECT *, regexp_replace(whole_path, ';[^/]*$', '') AS path,
        regexp_extract(whole_path, ';[^/]*$') AS params,
        array_to_string(list_filter(string_split(query, '&'), lambda p: contains(p, '=')
            AND NOT starts_with(p, 'spm') AND NOT starts_with(p, 'utm_')), '&') AS kept
        FROM {name}_cut3),
    {name} AS (SELECT {keep}, CASE
        WHEN NOT starts_with(u, 'http') THEN ''
        WHEN contains(u, '.html?') OR contains(u, '.htm?') OR contains(u, '.shtml?')
            OR contains(u, '.shtm?') THEN split_part(u, '?', 1)
        WHEN lower(regexp_extract(path, '[^.]*$')) IN ({suffixes}) THEN ''
        ELSE site || CASE WHEN path = '' THEN '/' ELSE path END
            || CASE WHEN params = ';' THEN '' ELSE params END
            || CASE WHEN kept = '' THEN '' ELSE '?' || kept END
        END AS canonical FROM {name}_cut4)"""


ANCHOR_SQL = "<a[^>]*?href=[''\"]?([^> ''\"]+)[^>]*?>(.*?)</a>"

# Page links: every href is rooted, so the site in front of it is enough.
LINKS_SQL = f"""
    raw_links AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*') AS base,
        unnest(regexp_extract_all(html, '{ANCHOR_SQL}', 1, 'is')) AS href FROM pages),
    resolved AS (SELECT page_id, base || trim(href) AS link FROM raw_links WHERE trim(href) <> ''),
    {canonical_sql('resolved', 'link', 'page_id')},
    links AS (SELECT DISTINCT page_id, canonical AS link FROM canon WHERE canonical <> '')"""

HUBS_SQL = f"""
    host_sizes AS (SELECT {netloc_sql('url')} AS host, count(*) AS n FROM pages GROUP BY 1),
    hosts AS (SELECT host FROM host_sizes WHERE n > (SELECT avg(n) FROM host_sizes))"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"), ["page_id"])


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with more pages than the average one stand in for the hub list."""
    sizes = (
        table(spark, sf_dir, "pages")
        .groupBy(netloc(F.col("url")).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return sizes.where(F.col("n") > sizes.agg(F.avg("n")).scalar()).select("host")


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("seq"),
        netloc(F.col("url")).alias("host"),
        "url",
        F.lit("waiting").alias("status"),
        F.when(F.col("page_id") % 5 == 0, "hub").otherwise("url").alias("mode"),
        (F.col("page_id") % 17).cast("double").alias("pended_at"),
        F.lit(0).alias("failure"),
    )


FRONTIER_SQL = f"""
    frontier AS (SELECT page_id AS seq, {netloc_sql('url')} AS host, url, 'waiting' AS status,
        CASE WHEN page_id % 5 = 0 THEN 'hub' ELSE 'url' END AS mode,
        (page_id % 17)::DOUBLE AS pended_at, 0::INTEGER AS failure FROM pages)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an attempt on the URL of its user."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("url"),
        F.when(F.col("user_id") % 5 == 0, "hub").otherwise("url").alias("mode"),
        F.lit(0).alias("failure"),
        F.when(kind == "purchase", 200).when(kind == "signup", 404).otherwise(500).alias("code"),
        "ts",
        F.col("event_id").alias("id"),
    )


def tried_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frontier with failures of earlier passes."""
    return frontier(spark, sf_dir).withColumn("failure", (F.col("seq") % 4).cast("int"))


TRIED_FRONTIER_SQL = FRONTIER_SQL.replace("0::INTEGER AS failure", "(page_id % 4)::INTEGER AS failure")


def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store before a pass: a third of the pages."""
    return table(spark, sf_dir, "pages").where(F.col("page_id") % 3 == 0).select(
        "url", F.lit("1").alias("status"), F.concat(F.lit("old "), "html").alias("html")
    )


SEEN_SQL = "seen AS (SELECT url, '1' AS status, 'old ' || html AS html FROM pages WHERE page_id % 3 = 0)"


def outcome_sql(source: str, threshold: int = THRESHOLD, carried: str = "0") -> str:
    """Common tables ending in ``outcomes`` for ``source(url, mode, code, ts, id)`` and
    the failures ``carried`` from before."""
    return f"""
    folded AS (SELECT *, row_number() OVER w AS i,
        {carried} + sum(CASE WHEN code NOT IN (200, 404) THEN 1 ELSE 0 END) OVER w AS fails
        FROM {source} WINDOW w AS (PARTITION BY url ORDER BY ts, id)),
    ending AS (SELECT *, CASE WHEN code = 404 THEN 'failed'
        WHEN mode = 'url' AND code = 200 THEN 'success'
        WHEN mode = 'url' AND fails > {threshold} AND code <> 200 THEN 'failed' END AS ends FROM folded),
    ended AS (SELECT url, mode, arg_min(ends, i) FILTER (ends IS NOT NULL) AS state,
        max(fails) AS fails FROM ending GROUP BY url, mode),
    outcomes AS (SELECT url, mode, coalesce(state, 'waiting') AS state,
        CASE WHEN state IS NULL THEN fails::INTEGER END AS failure FROM ended)"""


ATTEMPTS_SQL = """
    attempts AS (SELECT user_id::VARCHAR AS url,
        CASE WHEN user_id % 5 = 0 THEN 'hub' ELSE 'url' END AS mode,
        CASE event_type WHEN 'purchase' THEN 200 WHEN 'signup' THEN 404 ELSE 500 END AS code,
        ts, event_id AS id FROM events)"""


def served_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the canonical form of their URL."""
    return table(spark, sf_dir, "pages").withColumn("canonical", canonical_url(F.col("url")))


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as one fetch, redirected to its canonical URL."""
    return fetches_of(served_pages(spark, sf_dir))


def fetches_of(served: DataFrame) -> DataFrame:
    page = F.col("page_id")
    return served.select(
        page.alias("id"),
        "url",
        F.when(page % 7 == 0, 404).when(page % 11 == 0, 0).otherwise(200).alias("status"),
        F.col("html").alias("body"),
        F.col("canonical").alias("redirected_url"),
        page.alias("ts"),
        F.when(page % 5 == 0, 1).otherwise(0).alias("ishub"),
    )


FETCHES_SQL = f"""
    {canonical_sql('pages', 'url', 'page_id, url, html', 'served')},
    fetches AS (SELECT page_id AS id, url,
        CASE WHEN page_id % 7 = 0 THEN 404 WHEN page_id % 11 = 0 THEN 0 ELSE 200 END AS status,
        html AS body, canonical AS redirected_url, page_id AS ts,
        CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS ishub FROM served),
    folded_fetches AS (SELECT id, url, status AS code, ts FROM fetches UNION ALL
        SELECT id, redirected_url, status, ts FROM fetches WHERE redirected_url <> url)"""


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", -1.0).otherwise(F.col("value")).alias("ping"),
    )


LATENCY_SQL = """
    latency AS (SELECT event_id, user_id,
        CASE WHEN event_type = 'error' THEN -1.0 ELSE value END::DOUBLE AS ping FROM events)"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per conversation and feed page of ``FEED_PAGE`` turns."""
    turns = table(spark, sf_dir, "conversations")
    entry = F.struct(
        "turn",
        F.struct(
            F.struct(F.col("role").alias("name")).alias("userInfo"),
            F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("title"),
            F.col("conv_id").cast("string").alias("complaintObject"),
            F.col("text").alias("description"),
            F.col("role").alias("responseObject"),
        ).alias("entry"),
    )
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.entry)
    return turns.groupBy(
        "conv_id", F.floor(F.col("turn") / FEED_PAGE).cast("bigint").alias("feed_page")
    ).agg(F.to_json(F.struct(ordered.alias("contList"))).alias("json"))


ITEMS_SQL = f"""
    items AS (SELECT conv_id, turn // {FEED_PAGE} AS feed_page,
        (row_number() OVER (PARTITION BY conv_id, turn // {FEED_PAGE} ORDER BY turn) - 1)::INTEGER
            AS pos,
        role AS name, 'turn ' || turn AS title, conv_id::VARCHAR AS "complaintObject",
        text AS description, role AS "responseObject", NULL::VARCHAR AS response
        FROM conversations)"""
ITEM_COLUMNS_SQL = 'name, title, "complaintObject", description, "responseObject", response'
