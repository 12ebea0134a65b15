import random

from pyspark.sql import functions as F

import pandas as pd
import pytest

from spinneret.operators import frontier as fr
from spinneret.operators.store import upsert_pages
from spinneret.plans import catalog
from spinneret.plans.lifecycles import CrawlSettings
from spinneret.sources import tables
from spinneret.sources.tables import load_frontier, load_next_batch, read_page_store, read_table, save_frontier
from spinneret.streaming import state, streams


def write_part(spark, rows, schema, folder, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder, schema):
    return (
        spark.readStream.schema(schema).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1).parquet(folder)
    )


def attempts_of(spark, rows):
    sql = ", ".join(f"('{u}', {c}, timestamp_ntz'2024-01-01' + make_dt_interval(0,0,{t}), {i}L)" for u, c, t, i in rows)
    return spark.sql(f"SELECT * FROM VALUES {sql} AS t(url, code, ts, id)")


def kept_states(spark, check, name="entry"):
    found = spark.read.format("statestore").option("stateVarName", name).load(check)
    return {r["key"]["url"]: r["value"] for r in found.collect()}


@pytest.mark.parametrize("threshold, strict", [(3, False), (0, True), (40, False)])
def test_outcomes_over_several_batches_and_restarts(spark, tmp_path, threshold, strict):
    """The stream equals the batch fold pass by pass, also with one very hot URL."""
    rng = random.Random(11)
    rows = []
    for i in range(900):
        url = rng.choice(["hot", "hot"] + [f"u{k}" for k in range(20)])
        url = "hub" + url if rng.random() < 0.3 else url
        rows.append((url, rng.choice([500] * 6 + [0, 200, 404]), (i * 37) % 300 + 300 * (i // 300), i))
    table = attempts_of(spark, rows)
    urls = sorted({u for u, *_ in rows})[1:] + ["idle"]  # one URL is not in the frontier
    pool = spark.createDataFrame([(u, "hub" if u.startswith("hub") else "url", k % 3) for k, u in enumerate(urls)],
                                 "url string, mode string, failure int")
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    waiting, want = pool, {}
    for part in range(3):
        some = table.where(F.floor(F.col("id") / 300) == part)
        some.coalesce(1).write.parquet(f"{folder}/p{part}")
        attempts = source(spark, folder, table.schema)
        streams.drain(streams.outcome_stream(attempts, pool, out, check, threshold, strict))
        told = fr.frontier_outcomes(some, waiting, threshold, strict=strict).collect()
        want |= {r.url: (r.mode, r.state, r.failure) for r in told}
        left = {r.url: (r.mode, r.failure) for r in waiting.collect()}
        for r in told:
            if r.state == fr.WAITING:
                left[r.url] = (r.mode, r.failure)
            else:
                del left[r.url]
        waiting = spark.createDataFrame([(u, *v) for u, v in left.items()], pool.schema)
        # What the state store holds are the waiting URLs, no more.
        assert {u: (v["mode"], v["failure"]) for u, v in kept_states(spark, check).items()} == left
    assert {r.url: (r.mode, r.state, r.failure) for r in streams.latest_outcomes(spark, out).collect()} == want
    assert urls[0] in want and "idle" not in want


def test_combined_events_are_few_and_decide_the_same(spark):
    rng = random.Random(5)
    for threshold in (0, 2, 5):
        needed = max(threshold + 1, 2)
        for _ in range(40):
            rows = [("u", rng.choice([0, 0, 0, 1, 2, 3]), rng.randrange(40), i, 1) for i in range(rng.randrange(1, 60))]
            events = pd.DataFrame(rows, columns=["url", "kind", "at", "id", "n"])
            parts = [events.iloc[:20], events.iloc[20:]] if len(events) > 20 else [events]
            few = pd.concat([state.combined_events(p, needed) for p in parts])
            few = pd.concat([few, state.combined_events(few.iloc[:0], needed)])
            assert len(few) <= len(parts) * (needed + 7) and few["n"].sum() == len(rows)
            for mode in ("url", "hub"):
                told = []
                for part in (events, few):
                    seen = state.Attempts(needed)
                    for r in part.itertuples():
                        seen.add(r.kind, r.at, r.id, r.n)
                    told.append((seen.picked, seen.state(mode, 1, threshold, True)))
                assert told[0] == told[1]


def test_a_picked_url_waits_again_after_its_span(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    pool = spark.createDataFrame([("a", "url", 1), ("b", "url", 0), ("c", "url", 0)], "url string, mode string, failure int")

    def run(name, rows):
        attempts_of(spark, rows).coalesce(1).write.parquet(f"{folder}/{name}")
        schema = spark.read.parquet(f"{folder}/{name}").schema
        events = source(spark, folder, schema).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
        streams.drain(streams.outcome_stream(events, pool, out, check, pend_span=600.0))
        return {(r.url, r.state, r.failure, r.batch) for r in read_table(spark, out, "outcomes", state.OUTCOME_SCHEMA).collect()}

    first = run("p0", [("a", "NULL", 0, 1), ("b", "NULL", 0, 2), ("b", 500, 3, 3), ("x", "NULL", 0, 4), ("x", 200, 1, 5)])
    assert {r[:3] for r in first} == {("b", "waiting", 1)}
    second = run("p1", [("c", 200, 60, 6)]) - first
    assert {r[:3] for r in second} == {("c", "success", None), ("a", "waiting", 1)}
    held = kept_states(spark, check)
    assert set(held) == {"a", "b"} and all(v["pended"] is None for v in held.values())


def test_dedupe_keeps_one_sighting(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.sql(
        "SELECT 'u' || (id % 7) url, timestamp_ntz'2024-01-01' + make_dt_interval(0, id) ts "
        "FROM range(40) UNION ALL SELECT NULL, timestamp_ntz'2024-01-01'"
    ).coalesce(1).write.parquet(f"{folder}/a")
    schema = spark.read.parquet(f"{folder}/a").schema
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    tables.create(spark, out, {"seen": state.SIGHTING_SCHEMA, "sketch": tables.SKETCH_SCHEMA})

    def run():
        streams.drain(streams.dedupe_stream(source(spark, folder, schema), "ts", out, check))
        kept = read_table(spark, out, "seen", state.SIGHTING_SCHEMA).collect()
        assert len({r.url for r in kept}) == len(kept)
        return {r.url: r.ts.isoformat() for r in kept}

    first = run()
    assert first == {f"u{i}": f"2024-01-01T0{i}:00:00" for i in range(7)}
    assert run() == first
    # A replay, a late one, one of a year ago, and years later: known URLs are not found
    # again, new ones always are.
    spark.sql(
        "SELECT 'u' || id url, timestamp_ntz'2034-01-01' ts FROM range(8) "
        "UNION ALL SELECT 'early', timestamp_ntz'2004-01-01' UNION ALL SELECT 'u1', timestamp_ntz'2024-01-01' "
        "UNION ALL SELECT 'late', timestamp_ntz'2024-01-01' UNION ALL SELECT 'u2', timestamp_ntz'2023-01-01'"
    ).coalesce(1).write.parquet(f"{folder}/b")
    second = first | {"u7": "2034-01-01T00:00:00", "early": "2004-01-01T00:00:00", "late": "2024-01-01T00:00:00"}
    assert run() == second
    spark.sql("SELECT 'early' url, timestamp_ntz'2034-01-02' ts UNION ALL SELECT 'u0', timestamp_ntz'2003-01-01'"
              ).coalesce(1).write.parquet(f"{folder}/c")
    assert run() == second
    # The state store has forgotten what lies an hour behind the watermark.
    assert set(kept_states(spark, check, "seen")) <= {f"u{i}" for i in range(8)} | {"early"}


FETCHES = "id int, url string, status int, body string, redirected_url string, ts int, ishub int"


def crawl_root(spark, tmp_path, rows):
    root = str(tmp_path / "root")
    tables.create(spark, root, tables.CRAWL_TABLES)
    save_frontier(spark.createDataFrame(rows, fr.FRONTIER_SCHEMA), root, tables.FIRST)
    return root, spark.createDataFrame([("a.cn",)], "host string")


def test_crawl_passes_are_kept_and_replayed_without_effect(spark, tmp_path):
    check = str(tmp_path / "check")
    root, hosts = crawl_root(spark, tmp_path, [
        (0, "a.cn", "http://a.cn/", "waiting", "hub", 0.0, 0), (1, "a.cn", "http://a.cn/p", "waiting", "url", 0.0, 3)])
    settings = CrawlSettings(now=20)
    folder = str(tmp_path / "in")

    def run():
        streams.drain(streams.crawl_stream(
            source(spark, folder, FETCHES), root, hosts, settings, check, clock=lambda n: 20.0 + 20 * n))
        store = {(r.url, r.status, r.html) for r in read_page_store(spark, root).collect()}
        picked = sorted((r.url, r.ishub) for r in load_next_batch(spark, root).collect())
        return {r.url: r.pended_at for r in load_frontier(spark, root).collect()}, picked, store

    hub = "<a href='/p'>p</a><a href='/q'>q</a><a href='http://b.cn/'>b</a>"
    write_part(spark, [(1, "http://a.cn/", 200, hub, "http://a.cn/", 1, 1),
                       (2, "http://a.cn/p", 500, None, "http://a.cn/p", 1, 0)], FETCHES, folder, "p0")
    # The page had failed three times before. One host, so one pick: the hub, stamped in the same table.
    want = ({"http://a.cn/": 20.0, "http://a.cn/q": 0.0}, [("http://a.cn/", 1)], {("http://a.cn/p", "0", None)})
    assert run() == want
    assert run() == want
    write_part(spark, [(3, "http://a.cn/q", 200, hub, "http://a.cn/q", 2, 0)], FETCHES, folder, "p1")
    want = ({"http://a.cn/": 40.0}, [("http://a.cn/", 1)], want[2] | {("http://a.cn/q", "1", hub)})
    assert run() == want
    # A pass that was cut off anywhere and is run again gives the same.
    again = spark.createDataFrame([(3, "http://a.cn/q", 200, hub, "http://a.cn/q", 2, 0)], FETCHES)
    streams.run_pass(again, 1, root, hosts, settings, clock=lambda n: 20.0 + 20 * n)
    assert run() == want


def test_a_cut_off_pass_is_not_seen(spark, tmp_path, monkeypatch):
    root, hosts = crawl_root(spark, tmp_path, [(0, "a.cn", "http://a.cn/", "waiting", "hub", 0.0, 0)])
    fetches = spark.createDataFrame([(1, "http://a.cn/", 200, "<a href='/q'>q</a>", "http://a.cn/", 1, 1)], FETCHES)
    before = [tuple(r) for r in load_frontier(spark, root).collect()]

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(streams, "save_frontier", broken)
        with pytest.raises(RuntimeError):
            streams.run_pass(fetches, 0, root, hosts, CrawlSettings(now=20))
    assert [tuple(r) for r in load_frontier(spark, root).collect()] == before
    assert load_next_batch(spark, root).count() == 0
    streams.run_pass(fetches, 0, root, hosts, CrawlSettings(now=20))
    assert {r.url for r in load_frontier(spark, root).collect()} == {"http://a.cn/", "http://a.cn/q"}
    assert load_next_batch(spark, root).count() == 1


def test_upserts_merge_batch_by_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "url string, html string, ts int"
    write_part(spark, [("a", "1", 1), ("b", "1", 1), ("a", "2", 2)], schema, folder, "p0")
    root, check = str(tmp_path / "store"), str(tmp_path / "check")
    tables.create(spark, root, tables.STORE_TABLES)

    def run():
        pages = source(spark, folder, schema)
        streams.drain(streams.upsert_stream(pages, root, ["ts"], check))
        return {r.url: r.html for r in read_page_store(spark, root).collect()}

    assert run() == {"a": "2", "b": "1"}
    write_part(spark, [("b", "3", 3), ("c", "3", 3)], schema, folder, "p1")
    assert run() == {"a": "2", "b": "3", "c": "3"}
    assert run() == {"a": "2", "b": "3", "c": "3"}


def test_upsert_stream_and_batch_agree(spark):
    store = spark.createDataFrame([], "url string, status string, html string")
    new = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], "url string, html string, ts int")
    assert [r.html for r in upsert_pages(store, new, ["ts"]).collect()] == ["2"]


def test_hub_list_is_read_afresh(spark, tmp_path):
    folder, hubs, out = (str(tmp_path / n) for n in ("in", "hubs", "out"))
    schema = "id int, url string, html string"
    page = "<a href='/x'>x</a><a href='http://b.cn/y'>y</a>"

    def run():
        pages = source(spark, folder, schema)
        streams.drain(streams.on_site_stream(pages, ["id"], hubs, out, str(tmp_path / "check")))
        return {(r.id, r.link) for r in spark.read.parquet(out).collect()}

    def listed(url):
        spark.createDataFrame([(url,)], "url string").write.mode("overwrite").parquet(hubs)

    listed("http://a.cn/")
    write_part(spark, [(1, "http://a.cn/", page)], schema, folder, "p0")
    assert run() == {(1, "http://a.cn/x")}
    listed("http://b.cn/")
    write_part(spark, [(2, "http://a.cn/", page)], schema, folder, "p1")
    assert run() == {(1, "http://a.cn/x"), (2, "http://b.cn/y")}


@pytest.mark.parametrize("shape", ["file", "folder", "partitions"])
def test_a_table_is_a_stream_whether_file_or_folder(spark, tmp_path, shape):
    rows = spark.range(60).selectExpr("id", "concat('t', id) AS t", "id % 3 AS k")
    path = f"{tmp_path}/data/pages.parquet"
    if shape == "file":
        (tmp_path / "data").mkdir()
        rows.toPandas().to_parquet(path)
    else:
        writer = rows.repartition(4).write
        (writer.partitionBy("k") if shape == "partitions" else writer).parquet(path)
    rows.limit(5).write.parquet(f"{tmp_path}/data/pages.parquet2")
    schema = spark.read.parquet(path).schema
    found = streams.read_stream(spark, f"{tmp_path}/data", "pages", schema).selectExpr("id", "t", "bigint(k) AS k")
    out = str(tmp_path / "out")
    streams.drain(streams.write_batches(found, out, str(tmp_path / "check"), "append"))
    got = spark.read.parquet(out).select("id", "t", "k")
    assert sorted(got.collect()) == sorted(rows.collect())


@pytest.mark.parametrize("name", ["stream_hub_refresh", "stream_upsert"])
def test_stream_queries_read_a_folder_of_parts(spark, small, tmp_path, name):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got, want = (catalog.QUERIES[name](spark, str(folder)) for folder in (tmp_path, small))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
