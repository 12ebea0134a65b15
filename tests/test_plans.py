"""Physical plans keep the shape that large tables need."""

import re

from pyspark.sql import functions as F

from spinneret.operators import frontier as fr
from spinneret.operators import links as lk
from spinneret.operators import store as st
from spinneret.plans import catalog
from spinneret.plans import fixtures as fx
from spinneret.sources import tables

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|single|Round)", text))


def test_link_extraction_needs_no_shuffle_and_reads_two_columns(spark, small):
    text = plan(lk.page_links(fx.table(spark, small, "pages"), ["page_id"]))
    assert exchanges(text) == 0
    assert not any(node in text for node in PYTHON)
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in text


def test_link_yield_broadcasts_the_hubs_and_shuffles_counts_only(spark, small):
    text = plan(catalog.QUERIES["link_yield"](spark, small))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_predicates_reach_the_scan(spark, small):
    text = plan(catalog.QUERIES["page_store_scan"](spark, small))
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(n_chars), EqualTo(lang,en)" in text
    assert "text" not in text.split("ReadSchema")[1]


def test_outcomes_read_their_attempts_once_and_are_aggregates(spark, small):
    """Also for a threshold that no top-k operator could bound."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    attempts = fx.attempts(spark, small)
    watched = attempts.mapInPandas(counted, attempts.schema)
    outcomes = fr.url_outcome(watched, threshold=2000)
    text = plan(outcomes)
    outcomes.collect()
    assert read.value == attempts.count()
    assert "Window" not in text and "MapInPandas" not in text


def test_admission_evaluates_frontier_and_candidates_once(spark, small):
    read = {"frontier": spark.sparkContext.accumulator(0), "found": spark.sparkContext.accumulator(0)}

    def watched(df, name):
        def counted(batches):
            for batch in batches:
                read[name].add(len(batch))
                yield batch

        return df.mapInPandas(counted, df.schema)

    pool = fx.frontier(spark, small)
    found = catalog.candidates(spark, small).withColumn("mode", F.lit("url"))
    fr.frontier_admit(watched(pool, "frontier"), watched(found, "found"), 20, 10).collect()
    assert read["frontier"].value == pool.count()
    assert read["found"].value == found.count()


def test_unseen_reads_its_pages_once(spark, small):
    text = plan(catalog.QUERIES["unseen_urls"](spark, small))
    assert text.count("regexp_extract_all") <= 1 * text.count("Generate explode")
    assert text.count("Generate explode") == 1


def test_bodies_of_the_kept_store_are_not_shuffled(spark, small, tmp_path):
    root = str(tmp_path / "store")
    catalog.keep_store(catalog.stored_pages(spark, small), root)
    tables.write_pages(catalog.incoming_pages(spark, small), root, ["page_id"], 1)
    text = plan(tables.read_page_store(spark, root))
    for line in text.split("\n"):
        if re.search(r"(?<!Broadcast)Exchange ", line):
            assert "html" not in line


def test_upsert_cuts_rows_before_its_shuffle(spark, small):
    store = catalog.stored_pages(spark, small)
    text = plan(st.upsert_pages(store, catalog.incoming_pages(spark, small), ["page_id"]))
    assert "WindowGroupLimit" in text


def test_batch_pick_aggregates_the_frontier_once(spark, small):
    picked = fr.batch_pick(fx.frontier(spark, small), 30, 20, 10, 10)
    picked.collect()
    final = plan(picked).split("== Initial Plan ==")[0]
    assert "TakeOrderedAndProject" in final
    assert exchanges(final) == 1
    assert "SortAggregate" not in final


def test_marking_a_batch_does_not_shuffle_the_frontier(spark, small):
    text = plan(catalog.QUERIES["mark_pended"](spark, small))
    assert "SortMergeJoin" not in text


def test_cross_products_are_literals(spark, small):
    for name in ("template_cross", "search_urls", "rule_targets"):
        text = plan(catalog.QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_store_delete_first_shuffles_no_document(spark, small):
    text = plan(catalog.QUERIES["store_delete_first"](spark, small))
    assert "Subquery" in text
    assert exchanges(text.split("Subquery")[0]) == 0


def test_no_query_uses_a_cross_join_or_python(spark, small):
    streaming = {name for name in catalog.QUERIES if name.startswith("stream_")}
    eager = {"crawl_pass_store", "crawl_pass_frontier", "page_store_merge", "item_export"}
    for name in sorted(set(catalog.QUERIES) - streaming - eager):
        text = plan(catalog.QUERIES[name](spark, small))
        assert "CartesianProduct" not in text, name
        assert "NestedLoop" not in text, name
        assert not any(node in text for node in PYTHON), name

