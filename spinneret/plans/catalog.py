"""Every operator as a query on the test tables, next to its SQL twin.

Each entry reads whole tables. ``QUERIES`` maps a name to a function of
(session, folder); ``ORACLES`` maps it to SQL where SQL can say the same.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.functions import html as hx
from spinneret.functions import text as tx
from spinneret.functions import urls as ux
from spinneret.operators import assembly, expand, feeds, rank, segments
from spinneret.operators import frontier as fr
from spinneret.operators import links as lk
from spinneret.operators import store as st
from spinneret.operators.scratch import scratch_path
from spinneret.operators.sketch import key_sketch
from spinneret.plans import fixtures as fx
from spinneret.plans import lifecycles as lc
from spinneret.plans.fixtures import table
from spinneret.sources import buckets, files, tables
from spinneret.streaming import streams
from spinneret.streaming.state import SIGHTING_SCHEMA

#: Of the bucketed queries; a deployment takes as many as its store has tasks.
BUCKETS = 8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def scalar(name, source, column, keys, sql):
    """A query that is one column over a table; ``keys`` identify the row."""
    @query(name, f"SELECT {', '.join(keys)}, {sql} AS out FROM {source}")
    def run(spark, sf_dir):
        return table(spark, sf_dir, source).select(*keys, column().alias("out"))


FRONT = f"WITH {fx.FRONTIER_SQL}"
FRONT_COLUMNS = "seq, host, url, status, mode, pended_at, failure"
DUE = f"""{fx.NOW} - pended_at > {fx.SPAN}"""


# URL columns

scalar("url_netloc", "pages", lambda: ux.netloc(F.col("url")), ["page_id"], fx.netloc_sql("url"))
scalar("site_key", "pages", lambda: ux.site_key(F.col("url")), ["page_id"],
       "string_split(url, '/')[3]")
scalar("base_name", "pages", lambda: ux.base_name(F.col("url")), ["page_id"],
       "regexp_extract(url, '[^/]*$')")
scalar("origin_cut", "pages", lambda: ux.origin_cut(F.col("url")), ["page_id"],
       "split_part(url, '.com', 1) || '.com'")
scalar("url_hash_key", "pages", lambda: ux.url_key(F.col("url")), ["page_id"], "sha256(url)")


@query("valid_host", f"""SELECT page_id, url FROM pages
    WHERE contains({fx.netloc_sql('url')}, '.')""")
def valid_host(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(ux.valid_host(F.col("url")))


def variant_query(name, function, sql, web_only=False):
    """A URL rule over all variants. Rules that follow the HTTP test in the
    canonical form see web URLs only."""
    @query(name, sql)
    def run(spark, sf_dir):
        variants = fx.url_variants(spark, sf_dir)
        if web_only:
            variants = variants.where(ux.http_only(F.col("url")))
        return variants.select("page_id", "variant", function(F.col("url")).alias("out"))


VARIANT_CANON = f"WITH {fx.VARIANTS_SQL}, {fx.canonical_sql('variants', 'url', 'page_id, variant')}"
PARTS = f"{VARIANT_CANON} SELECT page_id, variant"
RAW_PARAMS = "CASE WHEN params = ';' THEN '' ELSE params END"
RAW_QUERY = "CASE WHEN query = '' THEN '' ELSE '?' || query END"
FRAGMENT = "CASE WHEN length(u) > length(body) + 1 THEN substr(u, length(body) + 1) ELSE '' END"

WEB_VARIANTS = "FROM canon_cut4 WHERE starts_with(u, 'http')"
SUFFIX_LIST = ", ".join(f"'{s}'" for s in ux.BINARY_SUFFIXES)

variant_query("canonical_url", ux.canonical_url, f"{PARTS}, canonical AS out FROM canon")
variant_query("http_only", ux.http_only,
              f"WITH {fx.VARIANTS_SQL} SELECT page_id, variant, starts_with(url, 'http') AS out "
              "FROM variants")
variant_query("static_page_trim", ux.static_page_trim,
              f"WITH {fx.VARIANTS_SQL} SELECT page_id, variant, CASE WHEN "
              "regexp_matches(url, '\\.s?html?\\?') THEN split_part(url, '?', 1) ELSE url END "
              "AS out FROM variants")
variant_query("drop_binary", ux.drop_binary,
              f"{PARTS}, CASE WHEN lower(regexp_extract(path, '[^.]*$')) IN ({SUFFIX_LIST}) "
              f"THEN '' ELSE u END AS out {WEB_VARIANTS}", web_only=True)
variant_query("strip_tracking", ux.strip_tracking,
              f"{PARTS}, site || path || {RAW_PARAMS} || CASE WHEN kept = '' THEN '' "
              f"ELSE '?' || kept END || {FRAGMENT} AS out {WEB_VARIANTS}", web_only=True)
variant_query("drop_fragment", ux.drop_fragment,
              f"{PARTS}, site || path || {RAW_PARAMS} || {RAW_QUERY} AS out {WEB_VARIANTS}",
              web_only=True)


@query("resolve_link", f"""
    WITH refs AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is'))
        AS href FROM pages),
    parts AS (SELECT DISTINCT page_id, url, href, regexp_extract(url, '^[a-z]+://[^/]*') AS site,
        split_part(split_part(url, '#', 1), '?', 1) AS head FROM refs),
    dirs AS (SELECT *, regexp_replace(head, '[^/]*$', '') AS dir FROM parts)
    SELECT page_id, f.form, CASE f.form
        WHEN 'href' THEN href
        WHEN 'relative' THEN substr(href, 2)
        WHEN 'net_path' THEN '//other.example.org' || href
        WHEN 'query' THEN '?of=' || href
        WHEN 'fragment' THEN '#' || href
        WHEN 'parent' THEN '../' || substr(href, 2)
        WHEN 'absolute' THEN 'https://other.example.org' || href END AS link,
      CASE f.form
        WHEN 'href' THEN site || href
        WHEN 'relative' THEN dir || substr(href, 2)
        WHEN 'net_path' THEN split_part(url, '//', 1) || '//other.example.org' || href
        WHEN 'query' THEN head || '?of=' || href
        WHEN 'fragment' THEN split_part(url, '#', 1) || '#' || href
        WHEN 'parent' THEN CASE WHEN regexp_matches(dir, '^[a-z]+://[^/]*/$') THEN dir
            ELSE regexp_replace(dir, '[^/]+/$', '') END || substr(href, 2)
        WHEN 'absolute' THEN 'https://other.example.org' || href END AS out
    FROM dirs, (VALUES {', '.join(f"('{f}')" for f in fx.LINK_FORMS)}) f(form)""")
def resolve_link(spark, sf_dir):
    """Each distinct href of a page in several spellings."""
    refs = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.explode(F.array_distinct(hx.anchor_hrefs(F.col("html")))).alias("href")
    )
    href, tail = F.col("href"), F.substring("href", 2, 2**31 - 1)
    spelled = {
        "href": href,
        "relative": tail,
        "net_path": F.concat(F.lit("//other.example.org"), href),
        "query": F.concat(F.lit("?of="), href),
        "fragment": F.concat(F.lit("#"), href),
        "parent": F.concat(F.lit("../"), tail),
        "absolute": F.concat(F.lit("https://other.example.org"), href),
    }
    forms = F.array(
        *[F.struct(F.lit(name).alias("form"), link.alias("link")) for name, link in spelled.items()]
    )
    rows = refs.select("page_id", "url", F.explode(forms).alias("f")).select(
        "page_id", "url", "f.form", "f.link"
    )
    return rows.select(
        "page_id", "form", "link", ux.resolve_link(F.col("url"), F.col("link")).alias("out")
    )


# Extraction from pages

@query("anchor_hrefs", f"""SELECT page_id, pos - 1 AS pos, href FROM (
    SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS pos FROM (
        SELECT page_id, regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is') AS hrefs FROM pages))""")
def anchor_hrefs(spark, sf_dir):
    hrefs = F.posexplode(hx.anchor_hrefs(F.col("html"))).alias("pos", "href")
    return table(spark, sf_dir, "pages").select("page_id", hrefs).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query("link_trim", f"""SELECT page_id, trim(href) AS link FROM (SELECT page_id,
    unnest(regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is')) AS href FROM pages)
    WHERE trim(href) <> ''""")
def link_trim(spark, sf_dir):
    """Padded and partly blanked hrefs come out clean."""
    padded = F.transform(
        hx.anchor_hrefs(F.col("html")), lambda h: F.concat(F.lit("\t\n "), h, F.lit(" \r\n"))
    )
    with_blanks = F.concat(padded, F.array(F.lit(" \n"), F.lit("")))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.explode(hx.clean_links(with_blanks)).alias("link")
    )


@query("anchor_pairs", f"""SELECT page_id, (pos - 1)::INTEGER AS pos, href, label FROM (
    SELECT page_id, unnest(hrefs) AS href, unnest(labels) AS label,
        generate_subscripts(hrefs, 1) AS pos FROM (
        SELECT page_id, regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is') AS hrefs,
            regexp_extract_all(html, '{fx.ANCHOR_SQL}', 2, 'is') AS labels FROM pages))""")
def anchor_pairs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return hx.anchor_pairs(pages, "html")


scalar("first_regex", "pages",
       lambda: hx.first_regex(F.col("html"), hx.TITLE_PATTERN, "<", ">"), ["page_id"],
       "'<' || regexp_extract(html, '(?is)<title>(.*?)</title>', 1) || '>'")
scalar("title_token", "pages", lambda: hx.title_token(F.col("html")), ["page_id"],
       "split_part(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), ' ', 1)")


# Link graph

@query("page_links", f"WITH {fx.LINKS_SQL} SELECT page_id, link FROM links")
def page_links(spark, sf_dir):
    return lk.page_links(table(spark, sf_dir, "pages"), ["page_id"])


@query("on_site_links", f"""WITH {fx.LINKS_SQL}, {fx.HUBS_SQL} SELECT page_id, link FROM links
    WHERE {fx.netloc_sql('link')} IN (SELECT host FROM hosts)""")
def on_site_links(spark, sf_dir):
    return lk.on_site_links(fx.links(spark, sf_dir), fx.hosts(spark, sf_dir))


@query("link_yield", f"""WITH {fx.LINKS_SQL}, {fx.HUBS_SQL}
    SELECT p.page_id, count(hosts.host) AS good_links, count(link) AS all_links
    FROM pages p LEFT JOIN links USING (page_id)
    LEFT JOIN hosts ON hosts.host = {fx.netloc_sql('link')} GROUP BY p.page_id""")
def link_yield(spark, sf_dir):
    graph = lk.page_links(table(spark, sf_dir, "pages"), ["page_id"], keep_linkless=True)
    return lk.link_yield(graph, fx.hosts(spark, sf_dir), ["page_id"])


@query("ok_fetches", f"""WITH {fx.FETCHES_SQL}
    SELECT id, url, CASE WHEN ishub = 1 THEN 'extract' ELSE 'keep' END AS task
    FROM fetches WHERE status = 200""")
def ok_fetches(spark, sf_dir):
    hubs, pages = lk.ok_fetches(fx.fetches(spark, sf_dir).select("id", "url", "status", "ishub"))
    return rank.union_all(
        hubs.select("id", "url", F.lit("extract").alias("task")),
        pages.select("id", "url", F.lit("keep").alias("task")),
    )


@query("page_bytes", f"""WITH {fx.FETCHES_SQL}
    SELECT status, strlen(body)::BIGINT AS bytes, redirected_url FROM fetches""")
def page_bytes(spark, sf_dir):
    return lk.page_bytes(fx.fetches(spark, sf_dir))


@query("redirect_fold", f"WITH {fx.FETCHES_SQL} SELECT id, url, code FROM folded_fetches")
def redirect_fold(spark, sf_dir):
    return fr.redirect_fold(
        fx.fetches(spark, sf_dir).select(
            "id", "url", "redirected_url", F.col("status").alias("code")
        )
    )


# Frontier

@query("unseen_urls", f"""WITH {fx.LINKS_SQL},
    {fx.canonical_sql('pages', 'url', 'page_id', 'served')},
    found AS (SELECT link AS url, CASE WHEN page_id % 5 = 0 THEN 'hub' ELSE 'url' END AS mode
        FROM links UNION ALL
        SELECT canonical, CASE WHEN page_id % 5 = 0 THEN 'hub' ELSE 'url' END FROM served)
    SELECT DISTINCT url, mode FROM found
    WHERE mode = 'hub' OR url NOT IN (SELECT url FROM pages)""")
def unseen_urls(spark, sf_dir):
    return fr.unseen_urls(*unseen_inputs(spark, sf_dir))


def unseen_inputs(spark, sf_dir):
    """Links and canonical page URLs, and all stored page URLs."""
    mode = F.when(F.col("page_id") % 5 == 0, "hub").otherwise("url").alias("mode")
    found = rank.union_all(
        fx.links(spark, sf_dir).select(F.col("link").alias("url"), mode),
        fx.served_pages(spark, sf_dir).select(F.col("canonical").alias("url"), mode),
    )
    return found, table(spark, sf_dir, "pages")


CANDIDATES_SQL = f"""{fx.LINKS_SQL}, {fx.canonical_sql('pages', 'url', 'page_id', 'served')},
    found AS (SELECT link AS url, page_id FROM links UNION ALL
        SELECT canonical, page_id FROM served),
    candidates AS (SELECT url, min(page_id) AS rank FROM found GROUP BY url)"""


def candidates(spark, sf_dir):
    page = F.col("page_id")
    return rank.union_all(
        fx.links(spark, sf_dir).select(F.col("link").alias("url"), page.alias("rank")),
        fx.served_pages(spark, sf_dir).select(F.col("canonical").alias("url"), page.alias("rank")),
    )


def admit_sql(mode):
    return f"""WITH {fx.FRONTIER_SQL}, {CANDIDATES_SQL},
    fresh AS (SELECT c.url, (SELECT max(seq) FROM frontier)
            + row_number() OVER (ORDER BY rank, c.url) AS seq
        FROM candidates c WHERE c.url NOT IN (SELECT url FROM frontier)
        AND contains({fx.netloc_sql('c.url')}, '.'))
    SELECT f.seq, f.host, f.url, f.status, f.mode,
        CASE WHEN c.url IS NOT NULL AND {DUE} THEN 0.0 ELSE f.pended_at END::DOUBLE AS pended_at,
        f.failure
    FROM frontier f LEFT JOIN candidates c ON c.url = f.url
    UNION ALL
    SELECT seq, {fx.netloc_sql('url')}, url, 'waiting', '{mode}', 0.0::DOUBLE, 0::INTEGER
    FROM fresh"""


@query("unseen_by_sketch", ORACLES["unseen_urls"])
def unseen_by_sketch(spark, sf_dir):
    """The same test, with a sketch of the stored URLs in front of them."""
    found, store = unseen_inputs(spark, sf_dir)
    return fr.unseen_urls(found, store, key_sketch(store, "url")).select("url", "mode")


@query("unseen_bucketed", ORACLES["unseen_urls"])
def unseen_bucketed(spark, sf_dir):
    """The same test against stored URLs that are kept in buckets."""
    found, store = unseen_inputs(spark, sf_dir)
    stored = buckets.kept(store.select("url"), scratch_path(spark, "buckets"), "url", BUCKETS)
    return fr.unseen_urls(found, stored)


@query("frontier_admit", admit_sql("url"))
def frontier_admit(spark, sf_dir):
    found = candidates(spark, sf_dir).withColumn("mode", F.lit("url"))
    return fr.frontier_admit(fx.frontier(spark, sf_dir), found, fx.NOW, fx.SPAN)


@query("seed_hubs", admit_sql("hub"))
def seed_hubs(spark, sf_dir):
    return fr.seed_hubs(
        fx.frontier(spark, sf_dir), candidates(spark, sf_dir), fx.NOW, fx.SPAN
    )


@query("hub_hosts", f"SELECT DISTINCT {fx.netloc_sql('url')} AS host FROM pages")
def hub_hosts(spark, sf_dir):
    return lk.hub_hosts(table(spark, sf_dir, "pages"))


@query("frontier_size", "SELECT count(*) AS size FROM pages")
def frontier_size(spark, sf_dir):
    return fr.frontier_size(fx.frontier(spark, sf_dir))


@query("attempt_join", f"""WITH {fx.FETCHES_SQL}, {fx.FRONTIER_SQL}
    SELECT id, f.url, code, mode, failure FROM folded_fetches f JOIN frontier USING (url)""")
def attempt_join(spark, sf_dir):
    return fr.attempt_join(folded_fetches(spark, sf_dir), fx.frontier(spark, sf_dir))


def folded_fetches(spark, sf_dir):
    return fr.redirect_fold(
        fx.fetches(spark, sf_dir).select(
            "id", "url", "redirected_url", F.col("status").alias("code")
        )
    )


@query("attempt_join_bucketed", ORACLES["attempt_join"])
def attempt_join_bucketed(spark, sf_dir):
    """Attempts meet a frontier kept in buckets, which is not moved."""
    pool = fx.frontier(spark, sf_dir).select("url", "mode", "failure")
    kept = buckets.kept(pool, scratch_path(spark, "buckets"), "url", BUCKETS)
    return folded_fetches(spark, sf_dir).join(kept, "url").select("id", "url", "code", "mode", "failure")


OUTCOMES = f"WITH {fx.ATTEMPTS_SQL}, {fx.outcome_sql('attempts')}"


@query("url_outcome", f"{OUTCOMES} SELECT url, mode, state, failure FROM outcomes")
def url_outcome(spark, sf_dir):
    return fr.url_outcome(fx.attempts(spark, sf_dir), fx.THRESHOLD)


@query("outcome_totals", f"{OUTCOMES} SELECT state, count(*) AS n FROM outcomes GROUP BY state")
def outcome_totals(spark, sf_dir):
    return fr.outcome_totals(fr.url_outcome(fx.attempts(spark, sf_dir), fx.THRESHOLD))


FETCH_OUTCOMES = f"""{fx.FETCHES_SQL}, {fx.FRONTIER_SQL},
    tried AS (SELECT t.url, mode, code, ts, id FROM folded_fetches t JOIN frontier USING (url)),
    {fx.outcome_sql('tried')}"""


PASS_OUTCOMES = f"""{fx.FETCHES_SQL}, {fx.TRIED_FRONTIER_SQL},
    tried AS (SELECT t.url, mode, failure, code, ts, id FROM folded_fetches t JOIN frontier USING (url)),
    {fx.outcome_sql('tried', carried='failure')}"""


@query("frontier_after_outcomes", f"""WITH {FETCH_OUTCOMES}
    SELECT f.seq, f.host, f.url, f.status, f.mode, f.pended_at,
        coalesce(o.failure, f.failure) AS failure
    FROM frontier f LEFT JOIN outcomes o ON o.url = f.url
    WHERE o.state IS NULL OR o.state = 'waiting'""")
def frontier_after_outcomes(spark, sf_dir):
    pool = fx.frontier(spark, sf_dir)
    attempts = fr.redirect_fold(
        fx.fetches(spark, sf_dir).select(
            "id", "ts", "url", "redirected_url", F.col("status").alias("code")
        )
    )
    return fr.apply_outcomes(pool, fr.frontier_outcomes(attempts, pool, fx.THRESHOLD))


@query("due_filter", f"{FRONT} SELECT {FRONT_COLUMNS} FROM frontier WHERE {DUE}")
def due_filter(spark, sf_dir):
    return fr.due_filter(fx.frontier(spark, sf_dir), fx.NOW, fx.SPAN, fx.SPAN)


BATCH = 30


def walk_sql(frontier):
    """The batch picked one by one out of the rows of ``frontier``."""
    return f"""WITH RECURSIVE {frontier},
    due AS (SELECT *, row_number() OVER (ORDER BY seq) AS i FROM frontier WHERE {DUE}),
    walk AS (
        SELECT 0::BIGINT AS i, 0 AS h, 0 AS u, []::VARCHAR[] AS hosts, NULL::BIGINT AS seq,
            NULL::VARCHAR AS url, NULL::INTEGER AS ishub
        UNION ALL
        SELECT i, h + CASE WHEN take AND mode = 'hub' THEN 1 ELSE 0 END,
            u + CASE WHEN take AND mode = 'url' THEN 1 ELSE 0 END,
            CASE WHEN take THEN list_append(hosts, host) ELSE hosts END,
            CASE WHEN take THEN seq END, url, CASE WHEN mode = 'hub' THEN 1 ELSE 0 END
        FROM (SELECT d.i, w.h, w.u, w.hosts, d.host, d.seq, d.url, d.mode,
                NOT list_contains(w.hosts, d.host) AND
                CASE WHEN d.mode = 'hub' THEN w.h ELSE w.u END < {BATCH // 2} AS take
            FROM walk w JOIN due d ON d.i = w.i + 1)),
    picked AS (SELECT seq, url, ishub FROM walk WHERE seq IS NOT NULL)"""


WALK = walk_sql(fx.FRONTIER_SQL)


def pick(spark, sf_dir, **options):
    return fr.batch_pick(
        fx.frontier(spark, sf_dir), BATCH, fx.NOW, fx.SPAN, fx.SPAN, **options
    )


@query("batch_pick", f"{WALK} SELECT seq, url, ishub FROM picked")
def batch_pick(spark, sf_dir):
    return pick(spark, sf_dir)


@query("batch_pick_nolimit", f"""{FRONT},
    placed AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY seq) AS place
        FROM frontier WHERE {DUE})
    SELECT seq, url, CASE WHEN mode = 'hub' THEN 1 ELSE 0 END AS ishub
    FROM placed WHERE place <= {BATCH // 2}""")
def batch_pick_nolimit(spark, sf_dir):
    return pick(spark, sf_dir, limit=False)


@query("mark_pended", f"""{WALK} SELECT seq, host, url, status, mode,
    CASE WHEN seq IN (SELECT seq FROM picked) THEN {fx.NOW} ELSE pended_at END::DOUBLE AS pended_at,
    failure FROM frontier""")
def mark_pended(spark, sf_dir):
    return fr.mark_pended(fx.frontier(spark, sf_dir), pick(spark, sf_dir), fx.NOW, BATCH)


@query("frontier_snapshot", f"{FRONT} SELECT {FRONT_COLUMNS} FROM frontier")
def frontier_snapshot(spark, sf_dir):
    root = scratch_path(spark, "frontier")
    tables.create(spark, root, {"frontier": tables.PICKED_SCHEMA, "passes": tables.PASS_SCHEMA})
    tables.save_frontier(fx.frontier(spark, sf_dir), root, 0)
    return tables.load_frontier(spark, root)


# Page store

@query("page_store_scan", """SELECT doc_id, source, n_chars FROM documents
    WHERE lang = 'en' AND n_chars > 1000""")
def page_store_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return st.page_store_scan(documents, {"lang": "en", "n_chars": {"$gt": 1000}}).select(
        "doc_id", "source", "n_chars"
    )


@query("query_predicate", """SELECT item_id, label FROM (
    SELECT doc_id AS item_id, quality AS label, toxic FROM labels) WHERE label = 1 AND toxic = 0""")
def query_predicate(spark, sf_dir):
    return (
        table(spark, sf_dir, "labels")
        .where(st.query_predicate({"quality": 1, "toxic": 0}))
        .select(F.col("doc_id").alias("item_id"), F.col("quality").alias("label"))
    )


@query("first_match", """SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'de'
    ORDER BY n_chars DESC, doc_id LIMIT 1""")
def first_match(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return st.first_match(documents, {"lang": "de"}, [F.desc("n_chars"), "doc_id"])


@query("limited_scan", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 20")
def limited_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return st.limited_scan(documents, 20, ["doc_id"])


def stored_pages(spark, sf_dir):
    """All pages as store rows, with the status the URL pool would have set."""
    page = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        "url", F.when(page % 2 == 0, "1").alias("status"), "html"
    )


STORED = "SELECT url, CASE WHEN page_id % 2 = 0 THEN '1' END AS status, html FROM pages"
SERVED = fx.canonical_sql("pages", "url", "page_id, html", "served")


def incoming_pages(spark, sf_dir):
    """Every page again, under its canonical URL and with a changed body."""
    body = F.concat("html", F.lit("<!-- again -->"))
    return fx.served_pages(spark, sf_dir).select(
        F.col("canonical").alias("url"), body.alias("html"), "page_id"
    )


UPSERT_SQL = f"""WITH {SERVED}, stored AS ({STORED}),
    incoming AS (SELECT canonical AS url, arg_max(html || '<!-- again -->', page_id) AS html
        FROM served GROUP BY 1)
    SELECT coalesce(s.url, i.url) AS url, s.status, coalesce(i.html, s.html) AS html
    FROM stored s FULL JOIN incoming i ON s.url = i.url"""


@query("page_store_upsert", UPSERT_SQL)
def page_store_upsert(spark, sf_dir):
    return st.upsert_pages(
        stored_pages(spark, sf_dir), incoming_pages(spark, sf_dir), ["page_id"]
    )


@query("page_store_bucketed", UPSERT_SQL)
def page_store_bucketed(spark, sf_dir):
    """The same upsert on a store kept in buckets: its bodies stay where they are."""
    store = buckets.kept(stored_pages(spark, sf_dir), scratch_path(spark, "buckets"), "url", BUCKETS)
    return st.merge_all(store, incoming_pages(spark, sf_dir).select("url", "html", "page_id"), "url", ["page_id"])


@query("page_store_merge", UPSERT_SQL)
def page_store_merge(spark, sf_dir):
    """The same upsert, on the kept store."""
    root = scratch_path(spark, "pages")
    keep_store(stored_pages(spark, sf_dir), root)
    tables.write_pages(incoming_pages(spark, sf_dir), root, ["page_id"], batch=1)
    return tables.read_page_store(spark, root)


def keep_store(store, root):
    tables.create(store.sparkSession, root, tables.STORE_TABLES)
    tables.insert_kept(store, root, ["status"], batch=0)


STORED_TITLE = "status = '1' AND length(html) % 2 = 0"
FIRST_STORED = f"(SELECT min(url) FROM stored WHERE {STORED_TITLE})"


@query("store_insert_kept", f"""WITH stored AS ({STORED}) SELECT url, status, html FROM stored
    UNION ALL SELECT url || '#new', 'x', html FROM stored""")
def store_insert_kept(spark, sf_dir):
    root = scratch_path(spark, "inserted")
    stored = stored_pages(spark, sf_dir)
    keep_store(stored, root)
    new = stored.select(F.concat("url", F.lit("#new")).alias("url"), F.lit("x").alias("status"), "html")
    tables.insert_kept(new, root, ["status"], batch=1)
    return tables.read_page_store(spark, root)


@query("store_delete_kept", f"""WITH stored AS ({STORED}), one AS (SELECT {FIRST_STORED} AS url)
    SELECT url, status, html FROM stored WHERE NOT coalesce(url LIKE '%.html', false)
        AND url NOT IN (SELECT url FROM one WHERE url IS NOT NULL)""")
def store_delete_kept(spark, sf_dir):
    """The first match of one query and all of another, deleted in the kept store."""
    root = scratch_path(spark, "deleted")
    keep_store(stored_pages(spark, sf_dir), root)
    tables.delete_kept(spark, root, F.expr(STORED_TITLE), batch=1)
    tables.delete_kept(spark, root, F.expr("url LIKE '%.html'"), batch=2, many=True)
    return tables.read_page_store(spark, root)


@query("store_update_kept", f"""WITH stored AS ({STORED})
    SELECT url, CASE WHEN url LIKE '%.html' THEN 'page' ELSE status END AS status,
        CASE WHEN url = {FIRST_STORED} THEN upper(html) ELSE html END AS html FROM stored""")
def store_update_kept(spark, sf_dir):
    root = scratch_path(spark, "updated")
    keep_store(stored_pages(spark, sf_dir), root)
    tables.update_kept(spark, root, F.expr(STORED_TITLE), {"html": F.upper("html")}, batch=1)
    tables.update_kept(spark, root, F.expr("url LIKE '%.html'"), {"status": F.lit("page")}, batch=2, many=True)
    return tables.read_page_store(spark, root)


@query("status_upsert", """WITH stored AS (SELECT DISTINCT user_id::VARCHAR AS url FROM events
        WHERE event_type = 'view'),
    last AS (SELECT user_id::VARCHAR AS url, arg_max(CASE event_type WHEN 'purchase' THEN '1'
        ELSE '0' END, (ts, event_id)) AS status FROM events GROUP BY 1)
    SELECT coalesce(s.url, l.url) AS url, coalesce(l.status, '0') AS status,
        CASE WHEN s.url IS NOT NULL THEN 'page of ' || s.url END AS html
    FROM stored s FULL JOIN last l ON s.url = l.url""")
def status_upsert(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    url = F.col("user_id").cast("string")
    stored = (
        events.where(F.col("event_type") == "view")
        .select(url.alias("url"))
        .distinct()
        .select("url", F.lit("0").alias("status"), F.concat(F.lit("page of "), "url").alias("html"))
    )
    outcomes = events.select(
        url.alias("url"),
        F.when(F.col("event_type") == "purchase", "1").otherwise("0").alias("status"),
        "ts",
        "event_id",
    )
    return st.upsert_status(stored, outcomes, ["ts", "event_id"])


@query("store_insert", """SELECT page_id, url, NULL::BIGINT AS size FROM pages
    UNION ALL SELECT page_id, NULL, length(html)::BIGINT FROM pages""")
def store_insert(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return st.store_insert(
        pages.select("page_id", "url"),
        pages.select("page_id", F.length("html").cast("bigint").alias("size")),
    )


LONG_ENGLISH = {"lang": "en", "n_chars": {"$gt": 1000}}
LONG_ENGLISH_SQL = "lang = 'en' AND n_chars > 1000"
FIRST_LONG = f"(SELECT min(doc_id) FROM documents WHERE {LONG_ENGLISH_SQL})"


def documents_meta(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


@query("store_delete", f"""SELECT doc_id, lang, source, n_chars FROM documents
    WHERE NOT ({LONG_ENGLISH_SQL})""")
def store_delete(spark, sf_dir):
    predicate = st.query_predicate(LONG_ENGLISH)
    return st.store_delete(documents_meta(spark, sf_dir), predicate, "doc_id", many=True)


@query("store_delete_first", f"""SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id <> {FIRST_LONG}""")
def store_delete_first(spark, sf_dir):
    predicate = st.query_predicate(LONG_ENGLISH)
    return st.store_delete(documents_meta(spark, sf_dir), predicate, "doc_id")


@query("store_update", f"""SELECT doc_id, lang, n_chars, CASE WHEN {LONG_ENGLISH_SQL}
    THEN 'long' ELSE source END AS source FROM documents""")
def store_update(spark, sf_dir):
    predicate = st.query_predicate(LONG_ENGLISH)
    return st.store_update(
        documents_meta(spark, sf_dir), predicate, {"source": "long"}, "doc_id", many=True
    )


@query("store_update_first", f"""SELECT doc_id, lang, n_chars, CASE WHEN doc_id = {FIRST_LONG}
    THEN 'long' ELSE source END AS source FROM documents""")
def store_update_first(spark, sf_dir):
    predicate = st.query_predicate(LONG_ENGLISH)
    return st.store_update(
        documents_meta(spark, sf_dir), predicate, {"source": "long"}, "doc_id"
    )


# Feeds and files

@query("feed_items", f"""WITH {fx.ITEMS_SQL}
    SELECT conv_id, feed_page, pos, {fx.ITEM_COLUMNS_SQL} FROM items""")
def feed_items(spark, sf_dir):
    return feeds.feed_items(fx.feed(spark, sf_dir), "json", ("conv_id", "feed_page"))


@query("item_steps", f"""WITH {fx.ITEMS_SQL} SELECT conv_id, feed_page, pos,
    name || ': ' || upper(title) AS title FROM items""")
def item_steps(spark, sf_dir):
    """Two item steps, given out of order, run by their priority."""
    items = feeds.feed_items(fx.feed(spark, sf_dir), "json", ("conv_id", "feed_page"))
    upper = (100, lambda df: df.withColumn("title", F.upper("title")))
    signed = (300, lambda df: df.withColumn("title", F.concat("name", F.lit(": "), "title")))
    return feeds.apply_steps(items, [signed, upper]).select("conv_id", "feed_page", "pos", "title")


ITEMS_ONLY = f"WITH {fx.ITEMS_SQL} SELECT {fx.ITEM_COLUMNS_SQL} FROM items"


@query("write_items_csv", ITEMS_ONLY)
def write_items_csv(spark, sf_dir):
    """Feed to CSV and back; the texts hold commas, quotes and line breaks."""
    path = scratch_path(spark, "items")
    lc.complaint_feed(fx.feed(spark, sf_dir), "json", path)
    return files.read_items_csv(spark, path, multi_line=True).drop("overflow", "shifted")


@query("read_items_csv", """SELECT c_name AS name, 'balance ' || c_custkey AS title,
    c_mktsegment AS "complaintObject", 'part one' AS description,
    CASE WHEN c_acctbal < 0 THEN ' part two' ELSE c_name END AS "responseObject",
    CASE WHEN c_acctbal < 0 THEN c_name ELSE 'None' END AS response,
    CASE WHEN c_acctbal < 0 THEN 'None' END AS overflow, c_acctbal < 0 AS shifted
    FROM customer""")
def read_items_csv(spark, sf_dir):
    """Unquoted lines in which a comma in the text shifts some rows."""
    path = scratch_path(spark, "shifted")
    text = F.when(F.col("c_acctbal") < 0, "part one, part two").otherwise("part one")
    items = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.concat(F.lit("balance "), F.col("c_custkey").cast("string")).alias("title"),
        F.col("c_mktsegment").alias("complaintObject"),
        text.alias("description"),
        F.col("c_name").alias("responseObject"),
        F.lit(None).cast("string").alias("response"),
    )
    files.write_items_csv(items, path, quote=False)
    return files.read_items_csv(spark, path)


@query("write_rank_csv", """SELECT p_partkey, p_retailprice,
    '["' || replace(p_name, ' ', '","') || '"]' AS keywords FROM part""")
def write_rank_csv(spark, sf_dir):
    path = scratch_path(spark, "rank")
    files.write_rank_csv(
        table(spark, sf_dir, "part").select(
            "p_partkey", "p_retailprice", tx.keywords(F.col("p_name")).alias("keywords")
        ),
        path,
    )
    schema = "p_partkey bigint, p_retailprice double, keywords string"
    return spark.read.schema(schema).csv(path, header=True, escape='"')


@query("item_export", f"""WITH {fx.ITEMS_SQL}
    SELECT kind, {fx.ITEM_COLUMNS_SQL} FROM items,
        (VALUES ('json'), ('jsonlines'), ('csv'), ('xml')) k(kind)""")
def item_export(spark, sf_dir):
    """Items written and read back in every export format."""
    items = feeds.feed_items(fx.feed(spark, sf_dir), "json").select(*feeds.ITEM_FIELDS)
    schema = ", ".join(f"`{f}` string" for f in feeds.ITEM_FIELDS)
    back = []
    for kind, (name, options) in files.EXPORTS.items():
        path = scratch_path(spark, kind)
        files.item_export(items, path, kind)
        if kind == "json":
            back.append(files.read_json_array(spark, path, schema).select(F.lit(kind).alias("kind"), "*"))
            continue
        reader = spark.read.schema(schema).format(name).options(**options)
        if name == "csv":
            reader = reader.option("multiLine", True)
        back.append(reader.load(path).select(F.lit(kind).alias("kind"), *feeds.ITEM_FIELDS))
    return rank.union_all(*back)


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query("binary_assets", "SELECT name, 'PAR1' AS head, 'PAR1' AS tail FROM (VALUES "
       + ", ".join(f"('{t}.parquet')" for t in TABLES) + ") t(name)")
def binary_assets(spark, sf_dir):
    """The tables with the bytes at both ends of their content: of a file, or of the files of a folder in turn."""
    def ends(start):
        return F.substring("content", start, 4).cast("string")

    # A folder of files, dealt by values perhaps, that has the name of a table.
    owner = F.regexp_extract("path", r"^(.*/[^/]+\.parquet)/([^/]+=[^/]*/)*[^/]+$", 1)
    asset, turn = F.when(owner == "", F.col("path")).otherwise(owner), F.struct("path", "at")
    parts = files.read_assets(spark, sf_dir, "*.parquet").select(
        asset.alias("asset"), turn.alias("turn"), ends(1).alias("head"), ends(-4).alias("tail")
    )
    whole = parts.groupBy("asset").agg(F.min_by("head", "turn").alias("head"), F.max_by("tail", "turn").alias("tail"))
    return whole.select(F.element_at(F.split("asset", "/"), -1).alias("name"), "head", "tail")


# Source ranking

@query("dedupe_within", "SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem")
def dedupe_within(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    return rank.dedupe_within(rows, "l_orderkey", ["l_partkey", "l_returnflag"])


@query("dedupe_global", "SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem")
def dedupe_global(spark, sf_dir):
    return rank.dedupe(table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity"))


@query("live_only", f"WITH {fx.LATENCY_SQL} SELECT event_id, ping FROM latency WHERE ping <> -1")
def live_only(spark, sf_dir):
    return rank.live_only(fx.latency(spark, sf_dir).select("event_id", "ping"))


@query("latency_rank", f"""WITH {fx.LATENCY_SQL} SELECT event_id, user_id, ping,
    row_number() OVER (ORDER BY ping, event_id) - 1 AS rank FROM latency WHERE ping <> -1""")
def latency_rank(spark, sf_dir):
    return rank.latency_rank(fx.latency(spark, sf_dir), "ping", ["event_id"])


@query("latency_rank_top", f"""WITH {fx.LATENCY_SQL} SELECT event_id, user_id, ping,
    row_number() OVER (ORDER BY ping, event_id) - 1 AS rank FROM latency WHERE ping <> -1
    QUALIFY rank < 50""")
def latency_rank_top(spark, sf_dir):
    return rank.latency_rank(fx.latency(spark, sf_dir), "ping", ["event_id"], top=50)


LISTING_PAGE = 100


def listings(spark, sf_dir):
    """Documents as parallel arrays, one row per source and page of ids."""
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "lang", "n_chars")))
    return (
        table(spark, sf_dir, "documents")
        .groupBy("source", F.floor(F.col("doc_id") / LISTING_PAGE).alias("page"))
        .agg(ordered.alias("rows"))
        .select(
            "source",
            "page",
            F.col("rows.doc_id").alias("doc_id"),
            F.col("rows.lang").alias("lang"),
            F.col("rows.n_chars").alias("n_chars"),
        )
    )


@query("zip_columns", f"""SELECT source, doc_id // {LISTING_PAGE} AS page,
    (row_number() OVER (PARTITION BY source, doc_id // {LISTING_PAGE} ORDER BY doc_id) - 1)::INTEGER
        AS pos, doc_id, lang, n_chars FROM documents""")
def zip_columns(spark, sf_dir):
    return rank.zip_columns(
        listings(spark, sf_dir), ["doc_id", "lang", "n_chars"], ["source", "page"]
    )


@query("source_ranking", """WITH rows AS (SELECT DISTINCT lang, source,
        CASE WHEN lang = 'de' THEN -1 ELSE n_chars END AS ping FROM documents)
    SELECT lang, source, ping, row_number() OVER (ORDER BY ping, lang, source) - 1 AS rank
    FROM rows WHERE ping <> -1""")
def source_ranking(spark, sf_dir):
    """The whole chain: transpose, dedupe per page, union, dedupe, rank."""
    dead = F.when(F.col("lang") == "de", F.lit(-1)).otherwise(F.col("n_chars"))
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", "lang", "source", "ping")))
    pages = (
        table(spark, sf_dir, "documents")
        .withColumn("ping", dead.cast("bigint"))
        .groupBy(F.floor(F.col("doc_id") / LISTING_PAGE).alias("page"))
        .agg(ordered.alias("rows"))
        .select("page", *[F.col(f"rows.{c}").alias(c) for c in ("lang", "source", "ping")])
    )
    return lc.source_ranking(pages, ["lang", "source", "ping"], "page", "ping", ["lang", "source"])


@query("source_coverage", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_coverage(spark, sf_dir):
    return rank.source_coverage(table(spark, sf_dir, "documents"), "source")


@query("union_pages", """SELECT doc_id, lang, n_chars,
    row_number() OVER (ORDER BY lang <> 'en', doc_id) - 1 AS index FROM documents""")
def union_pages(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    english = F.col("lang") == "en"
    return rank.union_indexed(["doc_id"], documents.where(english), documents.where(~english))


@query("union_tagged", f"""{FRONT} SELECT seq, url,
    CASE WHEN mode = 'hub' THEN 1 ELSE 0 END AS ishub FROM frontier""")
def union_tagged(spark, sf_dir):
    pool = fx.frontier(spark, sf_dir)
    hub = F.col("mode") == "hub"
    return fr.union_tagged(
        pool.where(hub).select("seq", "url"), pool.where(~hub).select("seq", "url")
    )


@query("union_distinct", f"""WITH {fx.LINKS_SQL} SELECT url AS link FROM pages
    UNION SELECT link FROM links""")
def union_distinct(spark, sf_dir):
    return rank.union_set(
        table(spark, sf_dir, "pages").select(F.col("url").alias("link")),
        fx.links(spark, sf_dir).select("link"),
    )


# Templates and rules

TEMPLATES = ["https://mirror.example.com/open?target=", "https://reader.example.net/page#from="]
SITES = {
    "atlas": "https://atlas.example.com/find/",
    "herbarium": "https://plants.example.org/list?name=",
}


@query("template_cross", f"""SELECT page_id, url, t.no AS template_no, t.template || url AS target
    FROM pages, (VALUES {', '.join(f"({i}, '{t}')" for i, t in enumerate(TEMPLATES))})
    t(no, template)""")
def template_cross(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return expand.template_cross(pages, TEMPLATES)


@query("search_urls", f"""SELECT p_partkey, s.site, s.prefix || replace(p_name, ' ', '+')
    AS search_url FROM part,
    (VALUES {', '.join(f"('{k}', '{v}')" for k, v in SITES.items())}) s(site, prefix)""")
def search_urls(spark, sf_dir):
    terms = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return expand.search_urls(terms, SITES, "p_name").drop("p_name")


def rules(spark, sf_dir):
    """Sites with many pages are followed; sites with few are known, not followed."""
    seen = (
        table(spark, sf_dir, "pages")
        .groupBy(ux.site_key(F.col("url")).alias("site"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    follow = F.col("n") > seen.agg(F.avg("n")).scalar()
    return seen.select(
        "site",
        follow.alias("follow"),
        F.when(follow, "href").alias("pattern"),
        F.when(follow, F.concat(F.lit("https://"), "site")).alias("prefix"),
        F.when(follow, F.array(*[F.lit(t) for t in TEMPLATES])).alias("templates"),
    )


RULES_SQL = f"""sites AS (SELECT string_split(url, '/')[3] AS site, count(*) AS n FROM pages
        GROUP BY 1 HAVING count(*) > 1),
    rules AS (SELECT site, n > (SELECT avg(n) FROM sites) AS follow,
        CASE WHEN n > (SELECT avg(n) FROM sites) THEN 'https://' || site END AS prefix FROM sites)"""


@query("site_rule", f"""WITH {RULES_SQL} SELECT page_id, string_split(url, '/')[3] AS site, follow,
    prefix FROM pages LEFT JOIN rules ON rules.site = string_split(url, '/')[3]""")
def site_rule(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return expand.site_rule(pages, rules(spark, sf_dir)).select(
        "page_id", "site", "follow", "prefix"
    )


@query("rule_targets", f"""WITH {RULES_SQL}, refs AS (SELECT page_id, string_split(url, '/')[3]
        AS site, unnest(regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is')) AS href FROM pages)
    SELECT page_id, refs.site, t.no AS template_no, t.template || prefix || href AS target
    FROM refs JOIN rules ON rules.site = refs.site AND follow,
        (VALUES {', '.join(f"({i}, '{t}')" for i, t in enumerate(TEMPLATES))}) t(no, template)""")
def rule_targets(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", hx.anchor_hrefs(F.col("html")).alias("hrefs")
    )
    ruled = expand.site_rule(pages, rules(spark, sf_dir)).drop("url")
    return expand.rule_targets(ruled, "hrefs")


# Text, time, maps

LINES = "string_split(text, chr(10))"
ENTRIES = f"list_filter({LINES}, lambda l: NOT starts_with(l, '#'))"


@query("manifest_entries", f"""SELECT doc_id, (pos - 1)::INTEGER AS pos, trim(segment) AS segment
    FROM (SELECT doc_id, unnest(kept) AS segment, generate_subscripts(kept, 1) AS pos,
        len(kept) AS n FROM (SELECT doc_id, {ENTRIES} AS kept FROM documents)) WHERE pos < n""")
def manifest_entries(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return segments.segment_rows(documents, "text", ["doc_id"])


@query("segment_number", f"""SELECT doc_id, (pos - 1)::INTEGER AS pos, segment,
    lpad((pos - 1)::VARCHAR, 9, '0') || '.ts' AS name FROM (SELECT doc_id, unnest(kept) AS segment,
        generate_subscripts(kept, 1) AS pos FROM (SELECT doc_id, {LINES} AS kept FROM documents))""")
def segment_number(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return segments.segment_number(lines, "lines", ["doc_id"])


scalar("line_from_end", "documents", lambda: tx.line_at(F.col("text"), -2), ["doc_id"],
       f"{LINES}[-2]")


@query("ordered_merge", """SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS body,
    count(*) AS segments FROM conversations GROUP BY 1""")
def ordered_merge(spark, sf_dir):
    return segments.ordered_merge(
        table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", "\n"
    )


OBJECT_PART = 4096


@query("ordered_files", f"""WITH pieces AS (SELECT role, conv_id, turn, text || chr(10) AS piece FROM conversations),
    placed AS (SELECT *, coalesce(sum(strlen(piece)) OVER (PARTITION BY role ORDER BY conv_id, turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS starts FROM pieces)
    SELECT role, (starts // {OBJECT_PART})::BIGINT AS part, min(starts)::BIGINT AS "offset",
        sum(strlen(piece))::BIGINT AS length, count(*) AS segments,
        md5(string_agg(piece, '' ORDER BY starts)) AS digest FROM placed GROUP BY 1, 2""")
def ordered_files(spark, sf_dir):
    """All that each role said as one long object, in parts written, checked and read back."""
    path = scratch_path(spark, "objects")
    turns = table(spark, sf_dir, "conversations")
    parts = assembly.object_parts(turns, ["role"], ["conv_id", "turn"], "text", "\n", OBJECT_PART)
    assembly.write_object_parts(parts, ["role"], path)
    bodies = assembly.checked_parts(spark, path, ["role"]).select("role", "part", F.md5("body").alias("digest"))
    return assembly.read_manifest(spark, path).drop("crc").join(bodies, ["role", "part"])


@query("prefix_list", f"""SELECT page_id, 'https://m.example.com' || href AS link FROM (SELECT
    page_id, unnest(regexp_extract_all(html, '{fx.ANCHOR_SQL}', 1, 'is')) AS href FROM pages)""")
def prefix_list(spark, sf_dir):
    prefixed = tx.prefix_all(hx.anchor_hrefs(F.col("html")), "https://m.example.com")
    return table(spark, sf_dir, "pages").select("page_id", F.explode(prefixed).alias("link"))


scalar("date_compact", "orders", lambda: tx.date_tag(F.col("o_orderdate"), "harvest_"),
       ["o_orderkey"], "'harvest_' || strftime(o_orderdate, '%Y%m%d')")
scalar("store_time", "events",
       lambda: F.date_format(tx.local_time(F.col("ts")), "yyyy-MM-dd HH:mm:ss"), ["event_id"],
       "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')")


@query("elapsed", """SELECT event_id, CASE WHEN event_type = 'error' THEN -1
    ELSE date_diff('microsecond', started, ts) END::BIGINT AS micros
    FROM events JOIN (SELECT user_id, min(ts) AS started FROM events GROUP BY 1) USING (user_id)""")
def elapsed(spark, sf_dir):
    """Time since the user's first event; an error has no end time."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    started = events.groupBy("user_id").agg(F.min("ts").alias("started"))
    end = F.when(F.col("event_type") != "error", F.col("ts"))
    return fr.hot_split_join(events, started, "user_id", "inner").select(
        "event_id", tx.elapsed_micros(F.col("started"), end).alias("micros")
    )


@query("keyword_array", """SELECT p_partkey, (pos - 1)::INTEGER AS pos, keyword FROM (
    SELECT p_partkey, unnest(k) AS keyword, generate_subscripts(k, 1) AS pos FROM (
        SELECT p_partkey, list_filter(string_split(p_name, ' '), lambda x: x <> '') AS k
        FROM part))""")
def keyword_array(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(tx.keywords(F.col("p_name"))).alias("pos", "keyword")
    )


@query("map_update", """SELECT event_id, event_type AS kind, props->>'$.k' AS k, 'right' AS side
    FROM events""")
def map_update(spark, sf_dir):
    """Event properties merged with newer ones; the newer ``side`` wins."""
    stored = F.map_concat(
        F.from_json("props", "map<string,string>"), F.create_map(F.lit("side"), F.lit("left"))
    )
    newer = F.create_map(F.lit("side"), F.lit("right"), F.lit("kind"), F.col("event_type"))
    merged = table(spark, sf_dir, "events").select(
        "event_id", tx.merge_maps(stored, newer).alias("m")
    )
    return merged.select(
        "event_id", F.col("m.kind").alias("kind"), F.col("m.k").alias("k"),
        F.col("m.side").alias("side"),
    )


scalar("json_field", "events", lambda: tx.json_field(F.col("props"), "$.k").cast("bigint"),
       ["event_id"], "(props->>'$.k')::BIGINT")


@query("decode_body", "SELECT page_id, html AS body FROM pages")
def decode_body(spark, sf_dir):
    """Page bodies as bytes with undecodable ones at both ends."""
    broken = F.concat(F.unhex(F.lit("FF")), F.encode("html", "UTF-8"), F.unhex(F.lit("C3")))
    return table(spark, sf_dir, "pages").select(
        "page_id", tx.decode_body(broken, F.lit("utf-8")).alias("body")
    )


@query("decode_gbk", "SELECT doc_id, text AS body FROM documents WHERE text IS NOT NULL")
def decode_gbk(spark, sf_dir):
    """Texts as GB 18030 bytes, with bytes of no meaning at both ends, under default settings."""
    text = F.col("text")
    # Letters beyond ASCII get the four-byte form of their code point.
    character = lambda c: F.when(F.octet_length(c) == 1, F.hex(c)).otherwise(gb18030_hex(c))
    digits = F.array_join(F.transform(F.split(text, ""), character), "")
    broken = F.unhex(F.concat(F.lit("FF"), digits, F.lit("81")))
    return table(spark, sf_dir, "documents").where(text.isNotNull()).select(
        "doc_id", tx.decode_body(broken, F.lit("gb18030")).alias("body")
    )


def gb18030_hex(character):
    """Two or four bytes, by the codec, of the letters that the test texts use."""
    letters = [chr(c) for c in (*range(0x80, 0x250), *range(0x2010, 0x2070), 0x20AC, 0xFFFD)]
    return F.element_at(
        F.split(F.lit(" ".join(c.encode("gb18030").hex().upper() for c in letters)), " "),
        F.instr(F.lit("".join(letters)), character),
    )


@query("read_items_csv_quoted", """SELECT c_name AS name, c_comment_like AS title, NULL::VARCHAR AS "complaintObject",
    c_mktsegment AS description, c_name AS "responseObject", 'x' AS response, NULL::VARCHAR AS overflow,
    false AS shifted FROM (SELECT *, 'say ""' || c_name || chr(10) || chr(10) || ', "' || c_mktsegment AS c_comment_like
        FROM customer)""")
def read_items_csv_quoted(spark, sf_dir):
    """Quoted fields with line breaks, commas and quotes, read by several tasks a file."""
    path = scratch_path(spark, "quoted")
    title = F.concat(F.lit('say ""'), "c_name", F.lit('\n\n, "'), "c_mktsegment")
    items = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), title.alias("title"), F.lit(None).cast("string").alias("complaintObject"),
        F.col("c_mktsegment").alias("description"), F.col("c_name").alias("responseObject"), F.lit("x").alias("response"),
    )
    files.write_items_csv(items.coalesce(1), path)
    return files.read_items_csv(spark, path, multi_line=True)


RATE_SQL = """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS tasks,
    ((count(*) * 200 + 3600) // 7200) / 100.0 AS per_second FROM events GROUP BY 1"""


@query("crawl_rate", RATE_SQL)
def crawl_rate(spark, sf_dir):
    return segments.crawl_rate(table(spark, sf_dir, "events").select("ts"), "ts", 3600)


# One whole crawl pass

@query("crawl_pass_store", f"""WITH {PASS_OUTCOMES}, {fx.SEEN_SQL},
    kept AS (SELECT redirected_url AS url, arg_max(body, id) AS html FROM fetches
        WHERE status = 200 AND ishub = 0 GROUP BY 1),
    gone AS (SELECT url, CASE state WHEN 'success' THEN '1' ELSE '0' END AS status
        FROM outcomes WHERE state <> 'waiting'),
    urls AS (SELECT url FROM kept UNION SELECT url FROM gone UNION SELECT url FROM seen)
    SELECT u.url, coalesce(e.status, s.status) AS status, coalesce(k.html, s.html) AS html
    FROM urls u LEFT JOIN kept k ON k.url = u.url LEFT JOIN gone e ON e.url = u.url
    LEFT JOIN seen s ON s.url = u.url""")
def crawl_pass_store(spark, sf_dir):
    return one_pass(spark, sf_dir).store(fx.seen_store(spark, sf_dir))


@query("crawl_pass_frontier", f"""WITH {PASS_OUTCOMES}, {fx.SEEN_SQL}, {fx.HUBS_SQL},
    gone AS (SELECT url FROM outcomes WHERE state <> 'waiting'),
    kept AS (SELECT redirected_url AS url FROM fetches WHERE status = 200 AND ishub = 0),
    raw AS (SELECT id, regexp_extract(redirected_url, '^[a-z]+://[^/]*') AS base,
        unnest(regexp_extract_all(body, '{fx.ANCHOR_SQL}', 1, 'is')) AS href
        FROM fetches WHERE status = 200 AND ishub = 1),
    absolute AS (SELECT id, base || href AS link FROM raw),
    {fx.canonical_sql('absolute', 'link', 'id')},
    fresh AS (SELECT canonical AS url, min(id) AS rank FROM canon
        WHERE canonical <> '' AND {fx.netloc_sql('canonical')} IN (SELECT host FROM hosts)
        AND canonical NOT IN (SELECT url FROM gone) AND canonical NOT IN (SELECT url FROM kept)
        AND canonical NOT IN (SELECT url FROM seen) GROUP BY 1),
    pool AS (SELECT f.seq, f.host, f.url, f.status, f.mode, f.pended_at,
        coalesce(o.failure, f.failure) AS failure FROM frontier f LEFT JOIN outcomes o
        ON o.url = f.url WHERE o.state IS NULL OR o.state = 'waiting')
    SELECT f.seq, f.host, f.url, f.status, f.mode,
        CASE WHEN c.url IS NOT NULL AND {DUE} THEN 0.0 ELSE f.pended_at END::DOUBLE AS pended_at,
        f.failure
    FROM pool f LEFT JOIN fresh c ON c.url = f.url
    UNION ALL
    SELECT (SELECT max(seq) FROM pool) + row_number() OVER (ORDER BY rank, url),
        {fx.netloc_sql('url')}, url, 'waiting', 'url', 0.0::DOUBLE, 0::INTEGER
    FROM fresh WHERE url NOT IN (SELECT url FROM pool)""")
def crawl_pass_frontier(spark, sf_dir):
    return one_pass(spark, sf_dir).frontier()


def one_pass(spark, sf_dir):
    """All pages fetched once, with a third of them stored and failures carried on."""
    return lc.crawl_pass(
        fx.tried_frontier(spark, sf_dir),
        fx.seen_store(spark, sf_dir),
        fx.fetches(spark, sf_dir),
        fx.hosts(spark, sf_dir),
        lc.CrawlSettings(now=fx.NOW),
    )


# Streams, each drained and compared with its batch twin

def stream(spark, sf_dir, name):
    return streams.read_stream(spark, sf_dir, name, table(spark, sf_dir, name).schema)


def attempt_stream(spark, sf_dir):
    kind = F.col("event_type")
    return stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("url"),
        F.when(F.col("user_id") % 5 == 0, "hub").otherwise("url").alias("mode"),
        F.when(kind == "purchase", 200).when(kind == "signup", 404).otherwise(500).alias("code"),
        "ts",
        F.col("event_id").alias("id"),
    )


def tried_urls(spark, sf_dir):
    """The frontier of the attempts: every URL once, without a failure so far."""
    return fx.attempts(spark, sf_dir).groupBy("url").agg(
        F.first("mode").alias("mode"), F.first("failure").alias("failure")
    )


@query("stream_outcome", f"{OUTCOMES} SELECT url, state, failure FROM outcomes")
def stream_outcome(spark, sf_dir):
    root = scratch_path(spark, "outcomes")
    attempts = attempt_stream(spark, sf_dir)
    streams.drain(streams.outcome_stream(
        attempts, tried_urls(spark, sf_dir), root, f"{root}-checkpoint", fx.THRESHOLD
    ))
    return streams.latest_outcomes(spark, root).select("url", "state", "failure")


@query("stream_status", f"""{OUTCOMES} SELECT url, CASE state WHEN 'success' THEN '1' ELSE '0' END
    AS status, NULL::VARCHAR AS html FROM outcomes WHERE state <> 'waiting'""")
def stream_status(spark, sf_dir):
    root = scratch_path(spark, "status")
    tables.create(spark, f"{root}/store", tables.STORE_TABLES)
    streams.drain(streams.outcome_stream(
        attempt_stream(spark, sf_dir), tried_urls(spark, sf_dir), f"{root}/outcomes",
        f"{root}/checkpoint", fx.THRESHOLD, store=f"{root}/store",
    ))
    return tables.read_page_store(spark, f"{root}/store")


@query("stream_dedupe", """SELECT user_id::VARCHAR AS url, min(ts) AS ts FROM events GROUP BY 1""")
def stream_dedupe(spark, sf_dir):
    root = scratch_path(spark, "dedupe")
    tables.create(spark, root, {"seen": SIGHTING_SCHEMA, "sketch": tables.SKETCH_SCHEMA})
    urls = stream(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("url"), "ts")
    streams.drain(streams.dedupe_stream(urls, "ts", root, f"{root}-checkpoint"))
    seen = tables.read_table(spark, root, "seen", SIGHTING_SCHEMA)
    return seen.select("url", F.col("ts").cast("timestamp_ntz").alias("ts"))


def crawl_pages_stream(spark, sf_dir, pick=False):
    """A store and a frontier kept from before, and one pass over a stream of pages."""
    root = scratch_path(spark, "crawl")
    tables.create(spark, root, tables.CRAWL_TABLES)
    before = fx.seen_store(spark, sf_dir)
    tables.append(before.select("url", "html"), root, "pages", tables.FIRST)
    tables.append(before.select("url", "status"), root, "status", tables.FIRST)
    tables.write_sketch(before, root, tables.FIRST)
    tables.save_frontier(fx.tried_frontier(spark, sf_dir), root, tables.FIRST)
    pages = fx.fetches_of(
        stream(spark, sf_dir, "pages").withColumn("canonical", ux.canonical_url(F.col("url")))
    )
    streams.drain(streams.crawl_stream(
        pages, root, fx.hosts(spark, sf_dir), lc.CrawlSettings(now=fx.NOW), f"{root}-checkpoint", pick
    ))
    return root


@query("stream_crawl_pass", ORACLES["crawl_pass_frontier"])
def stream_crawl_pass(spark, sf_dir):
    return tables.load_frontier(spark, crawl_pages_stream(spark, sf_dir))


@query("stream_crawl_store", ORACLES["crawl_pass_store"])
def stream_crawl_store(spark, sf_dir):
    return tables.read_page_store(spark, crawl_pages_stream(spark, sf_dir))


@query("stream_next_batch", walk_sql(f"frontier AS ({ORACLES['crawl_pass_frontier']})")
    + " SELECT seq, url, ishub FROM picked")
def stream_next_batch(spark, sf_dir):
    """What the pass picks from the frontier that it leaves."""
    return tables.load_next_batch(spark, crawl_pages_stream(spark, sf_dir, pick=True))


@query("stream_rate", RATE_SQL)
def stream_rate(spark, sf_dir):
    """Update mode, so that the last, still open window is kept as well."""
    root = scratch_path(spark, "rate")
    rate = streams.rate_stream(stream(spark, sf_dir, "events"), "ts", 3600, "1 hour")
    streams.drain(streams.write_batches(rate, f"{root}/out", f"{root}/checkpoint", "update"))
    schema = "window_start timestamp, tasks bigint, per_second double, batch bigint"
    kept = spark.read.schema(schema).parquet(f"{root}/out")
    return (
        kept.groupBy("window_start")
        .agg(F.max_by(F.struct("tasks", "per_second"), "batch").alias("last"))
        .select(
            F.col("window_start").cast("timestamp_ntz").alias("window_start"),
            "last.tasks", "last.per_second",
        )
    )


@query("stream_upsert", f"""WITH {SERVED} SELECT canonical AS url, NULL::VARCHAR AS status,
    arg_max(html, page_id) AS html FROM served GROUP BY 1""")
def stream_upsert(spark, sf_dir):
    root = scratch_path(spark, "stream-pages")
    pages = stream(spark, sf_dir, "pages").select(
        ux.canonical_url(F.col("url")).alias("url"), "html", "page_id"
    )
    tables.create(spark, f"{root}/store", tables.STORE_TABLES)
    streams.drain(streams.upsert_stream(pages, f"{root}/store", ["page_id"], f"{root}/checkpoint"))
    return tables.read_page_store(spark, f"{root}/store")


@query("stream_hub_refresh", f"""WITH {fx.LINKS_SQL}, {fx.HUBS_SQL} SELECT page_id, link FROM links
    WHERE {fx.netloc_sql('link')} IN (SELECT host FROM hosts)""")
def stream_hub_refresh(spark, sf_dir):
    root = scratch_path(spark, "on-site")
    fx.hosts(spark, sf_dir).select(F.concat(F.lit("http://"), "host", F.lit("/")).alias("url")).write.parquet(
        f"{root}/hubs"
    )
    pages = stream(spark, sf_dir, "pages")
    streams.drain(
        streams.on_site_stream(
            pages, ["page_id"], f"{root}/hubs", f"{root}/out", f"{root}/checkpoint"
        )
    )
    return spark.read.schema("page_id bigint, link string").parquet(f"{root}/out").select(
        "page_id", "link"
    )
