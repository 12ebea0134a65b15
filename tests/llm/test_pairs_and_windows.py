"""SimHash, decontamination, licenses: against plain Python on small tables."""

import re
from itertools import combinations

import pytest
import xxhash

from spinneret.llm import components, decontaminate, license_scan, queries, simhash

DOC = "doc_id bigint, text string"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(sorted(nodes), 2):
        if linked(a, b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components_equal_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, small).select("doc_id", "text").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(list(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
    got = {r["doc_id"]: r for r in queries.op1_simhash(spark, small).collect()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_fingerprint_edge_cases(spark):
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (5, "one"), (None, "two words"),
             (7, "É É\x1cx ÀB c d"), (8, "word " * 30_000)]
    df = spark.createDataFrame(texts, DOC).selectExpr("*", "1 as node", "2 as s0", "3 as component_id")
    got = rows_of(simhash.close_components(simhash.fingerprints(df)).select("doc_id", "s0", "component_id", "n_equal"))
    by_id = {}
    for doc_id, s0, component, equal in got:
        by_id.setdefault(doc_id, []).append((s0 % (1 << 64), component, equal))
    for doc_id, text in texts:
        assert by_id[doc_id][0][0] == plain_fingerprint(text)
    assert by_id[1][0][1:] == (1, 3) and by_id[3][0][1] == 1
    assert by_id[5] == [by_id[5][0]] * 2 and by_id[4][0][1:] == (4, 3)
    assert by_id[None][0][1] is None
    assert len(got) == len(texts)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    assert simhash.close_components(simhash.fingerprints(none)).count() == 0
    assert simhash.one_of_each(none).count() == 0


def linked_by_bits(spark, prints, bits=3, bucket=4):
    nodes = spark.createDataFrame([(p, p) for p in prints], "node bigint, s0 bigint")
    places = list(combinations(range(3 + bits), 3))

    def verify(pairs):
        from pyspark.sql import functions as F

        return pairs.where(F.bit_count(F.col("x0").bitwiseXOR(F.col("y0"))) <= bits)

    edges = simhash.linked_pairs(nodes, places, 1, 8 - bits, verify, bucket)
    return {r["node"]: r["component"] for r in components.components(edges).collect()}


def test_large_buckets_lose_no_link(spark):
    """Chains and clusters that share most bytes, in buckets far above the bound."""
    import random

    rng = random.Random(7)
    prints = set()
    for base in (0, 0x5555 << 20):
        for _ in range(60):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(24), rng.randrange(6))))
    prints = sorted(prints)
    want = plain_components(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    got = linked_by_bits(spark, prints)
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(200, 400)]
    edges = spark.createDataFrame(path + hub + [(5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 7 for i in range(200, 400)) and 5 not in got


def test_one_document_of_each_group(spark, small):
    docs = queries.documents(spark, small)
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.select("doc_id", "text").collect()}
    want = plain_components(list(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in want.items() if i == c)


def test_one_of_each_keeps_a_row_of_repeated_and_null_rows(spark):
    long = " ".join(f"w{i}" for i in range(2000))
    near = long.replace("w50 ", "changed ")
    assert bin(plain_fingerprint(long) ^ plain_fingerprint(near)).count("1") <= 3
    rows = [(1, long, 1), (1, long, 1), (2, near, 2), (None, long, 3), (4, None, 4), (5, "", 5),
            (6, "a b c", 6), (7, "a b d", 7), (None, "x y", 8), (None, "x y", 8)]
    docs = spark.createDataFrame(rows, DOC + ", node int")
    kept = sorted(rows_of(simhash.one_of_each(docs)), key=str)
    assert kept == sorted([(1, long, 1), (4, None, 4), (6, "a b c", 6), (7, "a b d", 7), (None, "x y", 8)], key=str)


def test_hot_group_of_copies_leaves_one(spark):
    base = " ".join(f"w{i}" for i in range(150))
    rows = [(i, base.upper() if i % 2 else base) for i in range(3000)]
    rows += [(5000 + i, " ".join(f"t{i}x{j}" for j in range(60))) for i in range(40)]
    kept = {r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, DOC)).collect()}
    assert kept == {0} | {5000 + i for i in range(40)}


# Decontamination

ITEM = ("A farmer named John Smith bought 12 apples for 3 dollars each and gave John Smith half of them "
        "while 12 children watched the market close at 5 hours")


def leak_ids(spark, docs, items=(ITEM,)):
    frame = spark.createDataFrame(docs, DOC)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return sorted({(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(frame, benchmark).collect()}, key=str)


def test_verbatim_and_reparameterised_items_leak(spark):
    changed = ITEM.replace("John Smith", "Mary Jones").replace("12", "40").replace("dollars", "euros")
    torn = ITEM.replace("12 apples", "12 pears").replace("John Smith half", "Peter Miller half").replace(
        "12 children", "77 children")
    docs = [(1, "before it all. " + ITEM + ". and after"), (2, "x y z " + changed + " tail"), (3, torn),
            (4, "nothing of the kind " * 40), (5, None), (6, ""), (7, ITEM[:60])]
    assert leak_ids(spark, docs) == [(1, 0), (2, 0)]


def test_edited_quoted_and_capital_copies_leak(spark):
    words = ITEM.split()
    edited = " ".join(words[:14] + ["fruit"] + words[15:])
    short = "the children of the valley sing softly when seven lanterns glow over the frozen lake"
    one = short.replace("softly", "loudly")
    quoted = " ".join(words[:22])
    docs = [(1, "x " + edited + " y"), (2, ITEM.upper()), (3, ITEM.lower()), (4, "\n".join(words)), (5, quoted),
            (6, " ".join(words[:12])), (7, "so " + one + " again"), (8, " ".join(words[::2]))]
    assert leak_ids(spark, docs, [ITEM, short]) == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (7, 1)]


def test_clashing_columns_and_very_long_texts_of_decontamination(spark):
    long = "filler words go here " * 20_000 + ITEM + " filler words go here" * 20_000
    rows = [(1, long, 1, 2, "a"), (2, "filler words go here " * 30_000, 3, 4, "b")]
    docs = spark.createDataFrame(rows, DOC + ", key int, item_id int, windows string")
    benchmark = spark.createDataFrame([(0, ITEM, "z")], "item_id bigint, text string, doc_id string")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()] == [(1, 0)]
    kept = decontaminate.clean_documents(docs, benchmark)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_repeated_rows_and_short_items(spark):
    docs = [(1, ITEM), (1, ITEM), (None, ITEM), (2, "a b c")]
    assert leak_ids(spark, docs, [ITEM, "a b c", ITEM]) == sorted(
        [(1, 0), (1, 2), (None, 0), (None, 2)], key=str)
    none = spark.createDataFrame([], DOC)
    benchmark = spark.createDataFrame([(0, ITEM)], "item_id bigint, text string")
    assert decontaminate.leaks(none, benchmark).count() == 0
    docs = spark.createDataFrame([(1, ITEM, 3), (2, "free of it", 4)], DOC + ", size int")
    assert rows_of(decontaminate.clean_documents(docs, benchmark)) == [(2, "free of it", 4)]
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.clean_documents(docs, empty).count() == 2


def test_planted_passages_are_found(spark, small):
    """Every document that holds a whole benchmark text, word for word."""
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    want = set()
    for r in queries.documents(spark, small).select("doc_id", "text").collect():
        text = f" {words(r['text'])} "
        want |= {(r["doc_id"], i) for i, t in items.items() if f" {t} " in text}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op3_decontaminate(spark, small).collect()}
    assert want and want <= got and len(got - want) <= 1


# Licenses

PHRASES = [("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])]


def plain_places(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for label, p in PHRASES for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), found


@pytest.mark.parametrize("source", ["table", "made"])
def test_base_phrases_equal_brute_force(spark, small, source):
    if source == "table":
        docs = queries.documents(spark, small).select("doc_id", "text")
    else:
        made = ["MIT license mit LICENSE", None, "", "the KMIT license", "mit, license; apache\nlicense",
                "GNU General Public License general public license version 3", "mité license", "general public",
                "mit mit license license", "Apache-License 2.0", "mit\x00license", "x " * 20_000 + "mit license"]
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(made)] + [(0, made[0])], DOC)
    got = license_scan.scan_licenses(docs, license_scan.template_frame(spark)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        n, found = plain_places(texts[r["doc_id"]])
        places = [p for p, _ in found]
        want = (n, len(found), min(places, default=None), max(places, default=None),
                ",".join(sorted({label for _, label in found})))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (not found or r["score"] == 1)


def test_notices_with_small_changes_are_labelled(spark):
    texts = ["Licensed under CC BY-NC 4.0.",
             "Redistribution and use in source and binary forms, with or without any modification, are permitted",
             "redistribution of books and the use of a library in town"]
    got = license_scan.scan_licenses(
        spark.createDataFrame(list(enumerate(texts)), DOC), license_scan.template_frame(spark)).collect()
    assert [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["cc-by-nc", "bsd", ""]
