import json

from pyspark.sql import functions as F

from spinneret.functions import html, text
from spinneret.operators import expand, feeds, rank, segments
from spinneret.sources import files


def test_feed_items_nests_and_missing_fields(spark):
    document = {"contList": [
        {"userInfo": {"name": "n"}, "title": "t", "complaintObject": "c", "description": "d",
         "responseObject": "r", "response": "s"},
        {"title": "only"},
    ]}
    raw = spark.createDataFrame([(1, json.dumps(document)), (2, "{}"), (3, "oops")], "k int, j string")
    got = [tuple(r) for r in feeds.feed_items(raw, "j", ("k",)).collect()]
    assert got == [(1, 0, "n", "t", "c", "d", "r", "s"), (1, 1, None, "only", None, None, None, None)]


def test_steps_run_by_priority(spark):
    df = spark.createDataFrame([(1,)], "x int")
    plus = lambda d: d.withColumn("x", F.col("x") + 1)
    times = lambda d: d.withColumn("x", F.col("x") * 10)
    assert feeds.apply_steps(df, [(300, times), (100, plus)]).first().x == 20


def test_item_csv_with_mark_crlf_and_shift(spark, tmp_path):
    path = tmp_path / "items.csv"
    lines = ["a,b,c,d,e,f", "a,b,c,d one, two,e,f", "g,h,i,j,k,"]
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode() + b"\r\n")
    got = [tuple(r) for r in files.read_items_csv(spark, str(path)).collect()]
    assert got == [
        ("a", "b", "c", "d", "e", "f", None, False),
        ("a", "b", "c", "d one", " two", "e", "f", True),
        ("g", "h", "i", "j", "k", None, None, False),
    ]


def test_assets_are_named_by_last_segment(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/pic.jpg").write_bytes(b"\x00\x01")
    got = files.read_assets(spark, str(tmp_path / "x"), "*.jpg").collect()
    assert [(r.name, r.length, bytes(r.content)) for r in got] == [("pic.jpg", 2, b"\x00\x01")]


def test_source_rank_keeps_equal_proxies_with_other_latency(spark):
    pages = spark.createDataFrame(
        [(1, ["a", "a", "b"], ["80", "80"]), (2, ["a", "c"], ["80", "1"])],
        "page int, ip array<string>, port array<string>",
    )
    rows = rank.zip_columns(pages, ["ip", "port"], ["page"])
    assert [tuple(r) for r in rows.orderBy("page", "pos").collect()] == [
        (1, 0, "a", "80"), (1, 1, "a", "80"), (1, 2, "b", None), (2, 0, "a", "80"), (2, 1, "c", "1"),
    ]
    within = rank.dedupe_within(rows.drop("pos"), "page", ["ip", "port"])
    assert within.count() == 4
    pinged = within.withColumn(
        "ping", F.when(F.col("ip") == "b", -1.0).when(F.col("page") == 1, 0.3).otherwise(0.2)
    ).drop("page")
    got = rank.latency_rank(pinged, "ping", ["ip"]).orderBy("rank").collect()
    assert [(r["rank"], r.ip, r.ping) for r in got] == [(0, "a", 0.2), (1, "c", 0.2), (2, "a", 0.3)]
    assert rank.dedupe(pinged, ["ip", "port"]).count() == 3


def test_anchor_forms(spark):
    page = (
        "<A HREF='/one'>x</A><a class=c href=/two>y\nz</a><a href=\"\n/three\t\">t</a>"
        "<abbr href=/four>q</a><p data-href=/five></p><a href=/six>no end"
    )
    got = spark.createDataFrame([(page,)], "h string").select(
        html.anchor_hrefs(F.col("h")).alias("raw"),
        html.clean_links(html.anchor_hrefs(F.col("h"))).alias("clean"),
        html.page_link_set(F.lit("http://a.cn/d/p?q"), F.col("h")).alias("links"),
        html.first_regex(F.col("h"), "none(.)").alias("none"),
    ).first()
    assert got.raw == ["/one", "/two", "\n/three\t", "/four"]
    assert got.clean == ["/one", "/two", "/three", "/four"]
    assert got.links == [f"http://a.cn/{n}" for n in ("one", "two", "three", "four")]
    assert got.none is None


def test_match_pairs_with_flags_and_start(spark):
    df = spark.createDataFrame([(1, 'k="a" v="b" K="c"\nv="d"')], "id int, t string")
    pattern = 'k="(.*?)".*?v="(.*?)"'
    pick = lambda **o: [
        (r.pos, r.x, r.y) for r in html.match_pairs(df, "t", pattern, ("x", "y"), **o).collect()
    ]
    assert pick() == [(0, "a", "b")]
    assert pick(flags="is") == [(0, "a", "b"), (1, "c", "d")]
    assert pick(flags="is", start=3) == [(0, "c", "d")]


def test_manifest_and_segment_names(spark):
    manifest = "#EXTM3U\n#EXTINF:1\n a.ts \n#EXTINF:1\nb.ts\r\n"
    df = spark.createDataFrame([(1, manifest), (2, "one line"), (3, "")], "id int, t string")
    got = segments.segment_rows(df, "t", ["id"]).collect()
    assert [(r.id, r.pos, r.segment) for r in got] == [(1, 0, "a.ts"), (1, 1, "b.ts")]
    names = segments.segment_number(
        df.select("id", text.manifest_entries(F.col("t")).alias("s")), "s", ["id"]
    )
    assert [r.name for r in names.collect()] == ["000000000.ts", "000000001.ts"]
    last = df.select(text.line_at(F.col("t")).alias("l")).collect()
    assert [r.l for r in last] == ["b.ts\r", None, None]


def test_merge_gives_one_object_in_order(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 50 == 0, "small").otherwise("large").alias("k"),
        (5000 - F.col("id")).alias("pos"), F.col("id").cast("string").alias("t"))
    df = df.unionByName(spark.createDataFrame([("large", None, "first")], "k string, pos bigint, t string"))
    rows = {r.k: (r.body, r.segments) for r in segments.ordered_merge(df, ["k"], "pos", "t", ",").collect()}
    large = ",".join(["first", *[str(i) for i in range(4999, -1, -1) if i % 50]])
    small = ",".join(str(i) for i in range(4950, -1, -50))
    assert rows == {k: (body, body.count(",") + 1) for k, body in (("large", large), ("small", small))}


def test_a_missing_latency_is_live_and_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", -1.0), ("d", 1.0)], "ip string, ping double")
    got = rank.latency_rank(df, "ping", ["ip"]).orderBy("rank").collect()
    assert [r.ip for r in got] == ["d", "b", "a"]
    both = rank.union_indexed(["ip"], df.where("ping > 0"), df.where("ping < 0"))
    assert [(r.ip, r["index"]) for r in both.orderBy("index").collect()] == [("b", 0), ("d", 1), ("c", 2)]


def test_genuine_replacement_characters_stay(spark):
    df = spark.createDataFrame(
        [("a\ufffdb".encode(),), ("a\ufffdb".encode() + b"\xff\xc3",)], "b binary")
    out = df.select(text.decode_body(F.col("b"), F.lit("utf-8")).alias("t")).collect()
    assert [r.t for r in out] == ["a\ufffdb", "a\ufffdb"]


def test_hostile_markup_stays_linear(spark):
    import time

    hostile = ["<a " * 40_000, "<title>" * 40_000, "<title " * 40_000, "<a href=x>" * 40_000,
               "<a " * 20_000 + "<a href=/x>x</a>" + "<a href=" * 20_000]
    df = spark.createDataFrame([(h,) for h in hostile], "h string").coalesce(1)
    start = time.time()
    got = df.select(html.anchor_hrefs(F.col("h")).alias("l"), html.title_token(F.col("h")).alias("t"),
                    html.first_regex(F.col("h"), html.TITLE_PATTERN).alias("f")).collect()
    assert time.time() - start < 15
    assert [r.l for r in got] == [[], [], [], [], ["/x"]]
    assert all(r.t == "" and r.f is None for r in got)


def test_titles_and_anchors_equal_the_plain_patterns(spark):
    import random
    import re

    anchor = re.compile(r"""<a[^>]*?href=['"]?([^> '"]+)[^>]*?>(.*?)</a>""", re.I | re.S)
    title = re.compile(r"<title[^>]*>(.*?)</title>", re.I | re.S)
    rng = random.Random(5)
    parts = ["<a ", "<A", "href=", "'", '"', ">", "</a>", "</A>", "x", " ", "\n", "<title", "</title>", "<b>", "href=''"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, h string")
    got = df.select("i", html.anchor_hrefs(F.col("h")).alias("l"),
                    html.first_regex(F.col("h"), html.TITLE_PATTERN).alias("t")).collect()
    for r in got:
        found = title.search(pages[r.i])
        assert r.l == [m[0] for m in anchor.findall(pages[r.i])], pages[r.i]
        assert r.t == (found.group(1) if found else None), pages[r.i]
    pairs = html.anchor_pairs(df, "h").collect()
    want = [(i, k, *m) for i, p in enumerate(pages) for k, m in enumerate(anchor.findall(p))]
    assert sorted(map(tuple, pairs)) == want


def test_decode_known_charsets(spark):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")
    try:
        df = spark.createDataFrame(
            [(b"ok\xff\xe4\xbd", "utf-8"), ("中文".encode("gbk") + b"\xff", "GBK"), (b"a", None)],
            "b binary, c string",
        )
        out = df.select(text.decode_body(F.col("b"), F.col("c")).alias("t")).collect()
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")
        spark.conf.unset("spark.sql.legacy.codingErrorAction")
    assert [r.t for r in out] == ["ok", "中文", "a"]


def test_small_text_columns(spark):
    df = spark.sql(
        "SELECT map('a', '1', 'b', '2') l, map('b', cast(null as string), 'c', '3') r, "
        "timestamp_ntz'2024-01-31 20:00:00' t, cast(null as timestamp) n, ' x  y' k"
    )
    got = df.select(
        text.merge_maps(F.col("l"), F.col("r")).alias("m"),
        text.local_time(F.col("t")).cast("string").alias("local"),
        text.elapsed_micros(F.col("t"), F.col("n")).alias("gone"),
        text.keywords(F.col("k")).alias("k"),
        text.date_tag(F.col("t"), "p_").alias("d"),
        text.prefix_all(F.array(F.lit("a")), "b").alias("p"),
    ).first()
    assert got.m == {"a": "1", "b": None, "c": "3"}
    assert (got.local, got.gone, got.k, got.d, got.p) == (
        "2024-02-01 04:00:00", -1, ["x", "y"], "p_20240131", ["ba"]
    )


def test_templates_rules_and_targets(spark):
    urls = spark.createDataFrame([("http://a.cn/x",), ("http://b.cn/y",), ("odd",)], "url string")
    crossed = expand.template_cross(urls, ["t1=", "t2="]).collect()
    assert {(r.template_no, r.target) for r in crossed} == {
        (i, f"t{i + 1}={u.url}") for i in (0, 1) for u in urls.collect()
    }
    rules = spark.createDataFrame(
        [("a.cn", True, "x", "https:", ["j?", "k?"]), ("b.cn", False, None, None, None)],
        expand.RULE_SCHEMA,
    )
    ruled = expand.site_rule(urls.withColumn("links", F.array(F.lit("//l"))), rules)
    assert {(r.url, r.follow) for r in ruled.collect()} == {
        ("http://a.cn/x", True), ("http://b.cn/y", False), ("odd", None)
    }
    targets = expand.rule_targets(ruled, "links").collect()
    assert sorted(r.target for r in targets) == ["j?https://l", "k?https://l"]
    found = expand.search_urls(
        spark.createDataFrame([("a b&c",)], "q string"), {"s": "http://s.cn/?q="}, "q"
    ).first()
    assert found.search_url == "http://s.cn/?q=a+b%26c"


def test_unclosed_anchors_stay_linear(spark):
    page = "<a href=/x>x</A>" + "<a href=/open>" * 40000
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(html.anchor_hrefs(F.col("h")).alias("l")).first().l == ["/x"]
