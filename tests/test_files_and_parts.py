"""Object parts, JSON arrays, quoted CSV, charsets and buckets."""

import csv
import io
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from spinneret.functions import charsets
from spinneret.functions.text import decode_body
from spinneret.operators import assembly, joins, store
from spinneret.plans import catalog
from spinneret.sources import buckets, files


# Objects in parts

def turns(spark, n=4000):
    """One object with nearly all segments, small ones, a NULL key, empty and NULL texts."""
    rng = random.Random(2)
    rows = [("large", i, "é" * rng.randrange(12)) for i in range(n)]
    rows += [(f"o{i % 7}", i, None if i % 5 == 0 else f"t{i}") for i in range(40)] + [(None, 1, "nobody"), ("empty", 1, "")]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, pos int, t string").repartition(6)


@pytest.mark.parametrize("separator", ["", "\n", "é,"])
def test_parts_put_end_to_end_are_the_object(spark, tmp_path, separator):
    rows, df = turns(spark)
    bound = 512
    parts = assembly.object_parts(df, ["k"], ["pos"], "t", separator, bound)
    got = sorted(parts.collect(), key=lambda r: (str(r.k), r.part))
    want = {}
    for k, _, t in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want[k] = want.get(k, "") + (t or "") + separator
    joined = {k: "".join(r.body for r in got if r.k == k) for k in want}
    assert joined == want
    for k in want:
        own = [r for r in got if r.k == k]
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert all(r.length == len(r.body.encode()) < bound + 40 and r.offset // bound == r.part for r in own)
    assert len([r for r in got if r.k == "large"]) > 40 and sum(r.segments for r in got) == len(rows)
    path = str(tmp_path / "o")
    assembly.write_object_parts(parts, ["k"], path)
    listed = {(r.k, r.part): r.crc for r in assembly.read_manifest(spark, path).collect()}
    assert listed == {(r.k, r.part): zlib.crc32(r.body.encode()) for r in got}
    assert {(r.k, r.part): r.body for r in assembly.checked_parts(spark, path, ["k"]).collect()} == {
        (r.k, r.part): r.body for r in got}


def test_a_long_object_is_dealt_over_tasks(spark):
    """No task gets an object with most of the rows as a whole."""
    _, df = turns(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = assembly.segment_offsets(df, ["k"], ["pos"], "t")
        sizes = [r["count"] for r in placed.where("k = 'large'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 3000
    none = assembly.object_parts(df.limit(0), ["k"], ["pos"], "t")
    assert none.count() == 0


# JSON array

@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_json_parts_are_one_array(spark, tmp_path, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a\n[\"]é,"), "id")).alias("t")).repartition(5)
    path = str(tmp_path / "j")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.item_export(df, path, "json", ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "j").glob("part-*"))
    whole = "".join(p.read_text() for p in parts)
    want = [{"id": i, "t": f'a\n["]é,{i}' if i % 3 else None} for i in range(n)]
    assert json.loads(whole) == want
    assert n < 1000 or len(parts) > 1
    back = files.read_json_array(spark, path, "id bigint, t string").orderBy("id").collect()
    assert [r.asDict() for r in back] == want


# Quoted CSV

def test_quoted_csv_in_many_blocks_of_a_file(spark, tmp_path):
    """Blocks of some hundred bytes that begin anywhere in a record."""
    rng = random.Random(4)
    cells = ["plain", 'say "x"', "two\nlines", "", "\n", 'a"\n"b', "comma, too", "é\r\nü", "x" * 300, '"', '""', "\n\n,\n"]
    rows = [[rng.choice(cells) for _ in range(6)] for _ in range(400)]
    text = io.StringIO()
    csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator="\r\n").writerows(rows)
    for name, data in (("a", "﻿" + text.getvalue()), ("b", '"only one","2","3","4","5","6"')):
        (tmp_path / f"{name}.csv").write_bytes(data.encode())
    rows.append(["only one", "2", "3", "4", "5", "6"])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "700")
        assert files.csv_records(spark, str(tmp_path)).count() == len(rows)
        found = files.read_items_csv(spark, str(tmp_path), multi_line=True)
        got = [tuple(r)[:6] for r in found.collect()]
        blocks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert blocks > 20 and not found.where("shifted").count()
    plain = lambda r: tuple((c or "").lstrip("﻿") for c in r)
    assert sorted(map(plain, got)) == sorted(map(plain, rows))


def records_of(text):
    """Lines joined to records by the parity of the quotes before them."""
    found, held = [], []
    for line in text.removesuffix("\n").split("\n"):
        held.append(line)
        if sum(x.count('"') for x in held) % 2 == 0:
            found.append("\n".join(held).removesuffix("\r"))
            held = []
    return [r for r in found if r] + (["\n".join(held).removesuffix("\r")] if held else [])


@pytest.mark.parametrize("chunk_bytes", [1, 90, 1 << 14])
def test_csv_records_over_chunks_blocks_and_files(spark, tmp_path, chunk_bytes):
    """Escape characters, records longer than a block, empty lines and a quote that nothing ends."""
    rng = random.Random(9)
    cells = ["", "a", '"b"', '"\n"', '"c\r\n""\n"', "\x1b", '"\x1bn\n\x1be\x1b"', '"' + "long\n" * 200 + '"', "é" * 90, '"\n\n\n"']
    texts = ["\r\n".join(",".join(rng.choice(cells) for _ in range(rng.randrange(4))) for _ in range(150)) for _ in range(3)]
    texts += ['x\n"open\n' + "rest\n" * 300, "\n\n", "no end"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "500")
        got = [r.record for r in files.csv_records(spark, str(tmp_path), chunk_bytes).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(r for text in texts for r in records_of(text))


def shuffled_bytes(node):
    """Bytes written to shuffles by an executed plan."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_bytes(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_bytes(node.plan())
    own = node.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_bytes(node.children().apply(i)) for i in range(node.children().size()))


def test_lines_of_csv_records_are_not_moved(spark, tmp_path):
    """Records over several lines are joined where they are read; no task gets the lines of a file."""
    data = "".join(f'"{i}","two\n\nlines {i}"\n' for i in range(40_000))
    (tmp_path / "a.csv").write_text(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = files.csv_records(spark, str(tmp_path))
        assert len(found.collect()) == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert shuffled_bytes(found._jdf.queryExecution().executedPlan()) < len(data) / 10


# Charsets

@pytest.mark.parametrize("codec", ["gbk", "gb18030", "gb2312", "big5", "euc_kr"])
def test_double_byte_pages_equal_the_codec(spark, codec):
    rng = random.Random(codec)
    rows = [rng.randbytes(rng.randrange(60)) for _ in range(400)]
    known = [c for c in charsets.pairs(codec) if c]
    rows += [("<p>" + "".join(rng.choice(known) for _ in range(40)) + "</p>").encode(codec) for _ in range(60)]
    if codec == "gb18030":
        rows += [("ü\U0001f600é€" * 3 + "\u0080￿\U0010ffff").encode(codec), b"\x84\x31\xa5\x30x", b"".join(map(charsets.quad_bytes, range(0, charsets.BASIC_QUADS, 7))), b"\x81\x30\x81", b"\xe3\x32\x9a\x36"]
    rows += [None, b"", b"\x81", bytes(range(256))]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, b binary")
    got = {r.i: r.t for r in df.select("i", charsets.decode_pairs(F.col("b"), codec).alias("t")).collect()}
    for i, data in enumerate(rows):
        assert got[i] == (None if data is None else data.decode(codec, errors="ignore")), data


def test_gbk_needs_no_setting(spark):
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"
    text = "新闻 news 下载"
    df = spark.createDataFrame([(text.encode("gbk"), "gbk"), (text.encode(), "utf-8"), (text.encode("gb18030"), "GB18030"),
                                ("é".encode("latin-1"), "iso-8859-1")], "b binary, c string")
    got = [r.t for r in df.select(decode_body(F.col("b"), F.col("c")).alias("t")).collect()]
    assert got == [text, text, text, "é"]


# Buckets

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_store_is_not_moved(spark, small, tmp_path):
    pages = catalog.stored_pages(spark, small)
    kept = buckets.kept(pages, str(tmp_path / "b"), "url", 4, "kept_pages")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalog.fx.links(spark, small).select(F.col("link").alias("url")).distinct()
        new = catalog.incoming_pages(spark, small).select("url", "html", "page_id")
        for df, moved in (
            (found.join(kept, "url"), 1), (found.join(kept.select("url"), "url", "left_anti"), 1),
            (store.merge_all(kept, new, "url", ["page_id"]), 1),
        ):
            text = plan(df).split("== Initial Plan ==")[0]
            scan = text[text.index("kept_pages") - 2000 : text.index("kept_pages")]
            assert "Bucketed: true" in text or "SelectedBucketsCount" in text
            side = scan[scan.rindex(":-") if ":-" in scan else 0 :]
            assert "Exchange" not in side.split("Sort")[-1]
        again = buckets.declare(spark, str(tmp_path / "b"), store.STORE_SCHEMA, "url", 4, "kept_again")
        assert again.count() == pages.count() and "SelectedBucketsCount" in plan(again.join(found, "url"))
        buckets.add(spark.createDataFrame([("http://new.cn/", None, "x")], store.STORE_SCHEMA), "kept_pages", "url", 4)
        assert spark.table("kept_pages").count() == pages.count() + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_large_upsert_only_moves_rows_it_may_meet(spark, monkeypatch):
    monkeypatch.setattr(store, "fits_broadcast", lambda df: False)
    old = spark.range(5000).selectExpr("concat('u', id) AS url", "'1' AS status", "concat('body ', id) AS html")
    new = spark.range(4990, 5010).selectExpr("concat('u', id) AS url", "'new' AS html", "id AS ts")
    out = store.upsert_pages(old, new, ["ts"])
    got = {r.url: (r.status, r.html) for r in out.collect()}
    assert len(got) == 5010 and got["u4990"] == ("1", "new") and got["u5009"] == (None, "new") and got["u7"] == ("1", "body 7")
    text = plan(out)
    untouched, rest = text.split("FullOuter")[0], text.split("FullOuter")[1]
    assert "Exchange hash" not in untouched.split("Union")[1] and "Exchange" in rest


def test_hot_split_join_evaluates_the_facts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    facts = spark.range(900).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 9)) AS k", "id").mapInPandas(
        watched, "k string, id bigint")
    other = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    assert joins.hot_split_join(facts, other, "k", "inner").count() == 400 and read.value == 900


# Assets

def test_large_assets_come_in_parts(spark, tmp_path):
    content = {"a b%20.bin": bytes(range(256)) * 5, "sub/c.bin": b"x" * 128, "d.bin": b"y" * 129}
    (tmp_path / "sub").mkdir()
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    rows = files.read_assets(spark, str(tmp_path), "*.bin", whole=128, part=50).orderBy("name", "at").collect()
    got = {}
    for r in rows:
        before = got.setdefault(r.name, b"")
        assert r.at == len(before) and r.length == len(content["sub/c.bin" if r.name == "c.bin" else r.name])
        got[r.name] = before + bytes(r.content)
    assert got == {name.removeprefix("sub/"): data for name, data in content.items()}
    assert max(len(r.content) for r in rows if r.length > 128) < 100
    assert [len(r.content) for r in rows if r.name == "c.bin"] == [128]


def test_tables_over_two_gigabytes_or_in_folders_are_assets(spark, small, tmp_path):
    with open(tmp_path / "lineitem.parquet", "wb") as file:  # a hole, no disk
        file.write(b"PAR1")
        file.seek((1 << 31) + 7)
        file.write(b"TAIL")
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages.repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    pages.selectExpr("*", "page_id % 2 AS k").write.partitionBy("k").parquet(f"{tmp_path}/orders.parquet")
    got = catalog.QUERIES["binary_assets"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [
        ("lineitem.parquet", "PAR1", "TAIL"), ("orders.parquet", "PAR1", "PAR1"), ("pages.parquet", "PAR1", "PAR1"),
    ]
