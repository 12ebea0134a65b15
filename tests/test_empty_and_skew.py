"""Operators on empty tables and with NULL keys, and under one hot key."""

import re

from pyspark.sql import functions as F

from spinneret.functions import urls
from spinneret.operators import expand, feeds, links, ordering, rank, segments, store
from spinneret.operators import frontier as fr


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_empty_inputs_give_empty_results(spark):
    pages = empty(spark, "page_id bigint, url string, html string")
    hosts = empty(spark, "host string")
    pool = empty(spark, fr.FRONTIER_SCHEMA)
    attempts = empty(
        spark, "url string, mode string, failure int, code int, ts bigint, id bigint"
    )
    found = empty(spark, "url string, mode string, rank bigint")
    graph = links.page_links(pages, ["page_id"])
    results = [
        graph,
        links.on_site_links(graph, hosts),
        links.link_yield(graph, hosts, ["page_id"]),
        fr.url_outcome(attempts),
        fr.attempt_join(attempts.select("url", "code"), pool),
        fr.batch_pick(pool, 5, 20, 10, 10),
        fr.batch_pick(pool, 5, 20, 10, 10, limit=False),
        fr.frontier_admit(pool, found, 20, 10),
        fr.unseen_urls(found, pages),
        rank.latency_rank(empty(spark, "ip string, ping double"), "ping", ["ip"]),
        feeds.feed_items(empty(spark, "j string"), "j"),
        segments.segment_rows(pages, "html", ["page_id"]),
        expand.template_cross(pages, ["t"]),
        store.upsert_pages(
            empty(spark, store.STORE_SCHEMA), pages.withColumnRenamed("page_id", "ts"), ["ts"]
        ),
    ]
    assert [df.count() for df in results] == [0] * len(results)
    assert fr.frontier_size(pool).first().size == 0


def test_null_values_pass_or_vanish(spark):
    pages = spark.createDataFrame(
        [(1, None, "<a href=/x>x</a>"), (2, "http://a.cn/", None), (3, "http://a.cn/", "none")],
        "page_id bigint, url string, html string",
    )
    assert links.page_links(pages, ["page_id"]).count() == 0
    cand = spark.createDataFrame([(None, "url", 1)], "url string, mode string, rank bigint")
    assert fr.frontier_admit(empty(spark, fr.FRONTIER_SCHEMA), cand, 20, 10).count() == 0


def test_canonical_form_is_stable(spark):
    raw = ["http://a.cn", "http://a.cn/x?b=1&utm_c=2#d", "https://A.cn:8/p;q?spm=1&r=2", "http://a.cn/;"]
    df = spark.createDataFrame([(u,) for u in raw], "u string")
    once = urls.canonical_url(F.col("u"))
    got = df.select(once.alias("a")).select("a", urls.canonical_url(F.col("a")).alias("b")).collect()
    assert all(r.a == r.b != "" for r in got)


def test_filters_on_rewritten_urls_stay_cheap_to_plan(spark):
    """A filter moves below the rewriting; the expression must not explode."""
    df = spark.createDataFrame([("http://a.cn/b?c=1#d", "../e?f=2")], "u string, l string")
    out = df.select(urls.resolve_link(F.col("u"), F.col("l")).alias("x"))
    out = out.select(urls.canonical_url(F.col("x")).alias("y")).where(F.col("y") != "")
    assert [r.y for r in out.where(urls.valid_host(F.col("y"))).collect()] == ["http://a.cn/e?f=2"]


def hot_attempts(spark, n):
    """A third of all rows on one URL."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("url"),
        F.lit("url").alias("mode"),
        F.lit(0).alias("failure"),
        F.when(hot, 500).when(F.col("id") % 7 == 0, 200).otherwise(500).alias("code"),
        F.col("id").alias("ts"),
        "id",
    )


def shuffled_rows(df):
    """Rows carried by each shuffle of the executed plan."""
    df.collect()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [int(n) for n in re.findall(r"ShuffleQueryStage.*?rowCount=(\d+)", text)]


def test_a_hot_url_is_cut_down_before_the_shuffle(spark):
    attempts = hot_attempts(spark, 60000).repartition(4)
    outcomes = fr.url_outcome(attempts)
    assert outcomes.where("url = 'hot'").first().state == "failed"
    keyed = attempts.select("url", "ts")
    newest = ordering.last_per_key(keyed, ["url"], ["ts"])
    # At most one row per key and map task leaves the map side.
    assert min(shuffled_rows(newest)) <= 4 * 501
    assert newest.count() == 501


def test_hot_host_in_batch_pick(spark):
    n = 5000
    pool = spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 > 0, "hot.cn").otherwise(F.concat(F.lit("h"), F.col("id"), F.lit(".cn"))).alias("host"),
        F.lit("waiting").alias("status"),
        F.when(F.col("id") % 2 == 0, "hub").otherwise("url").alias("mode"),
        F.lit(0.0).alias("pended_at"),
        F.lit(0).alias("failure"),
    ).withColumn("url", F.concat(F.lit("http://"), "host", F.lit("/"), "seq"))
    got = fr.batch_pick(pool, 100, 20, 10, 10).collect()
    hosts = [r.url.split("/")[2] for r in got]
    assert len(got) == 100 and len(set(hosts)) == 100
    assert sum(r.ishub for r in got) == 50
