"""Personal data and revealing terms against plain Python."""

import hashlib
import math
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spinneret.llm import pii, queries
from spinneret.llm.columns import match_spans, running

DOC = "doc_id bigint, text string"


def luhn(digits):
    odd = [int(d) for d in digits[::-1][::2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def digits(match):
    return re.sub("[^0-9]", "", match)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def plain_base(text):
    found = []
    for rank, (kind, pattern, kept) in enumerate(PLAIN):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if kept(m.group())]
    return sorted(found)


MADE = [
    None, "", "nothing here", "mail a.b+c@x-y.example.org, and a@b", "a@b.c_d@e.f.g @x.y %@1.2", "é\U0001f600 x@y.zz 1.2.3.4",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.00 1.2.3 999999999999.1.1.1", "4539 1488 0343 6467 and 4539-1488-0343-6467 45391488034364671",
    "4111111111111111", "4111 1111 1111 1112", "+1 (612) 555-4887 +49 30 1234567- +123 +1234567890123456", "+1+2+3 555 0100 200",
    "12-34-56-78-90-12 000000000000 0000 0000 0000 0000 000", "+1 (612) 555-4887, a@b.cc 39.29.36.155 4265371806664683",
    "a@b" + ".c" * 3000, "7" * 4000, "+1" + "-" * 3000, "x" * 5000 + "@", "a.b" * 2000 + "@c.d", "1." * 4000, "m@n.oo " * 1500,
]


def test_patterns_equal_brute_force(spark, small):
    made = spark.createDataFrame([*enumerate(MADE), (3, "m@n.oo"), (None, "m@n.oo"), (None, None)], DOC)
    for docs in (made, queries.documents(spark, small).select("doc_id", "text")):
        nobody = spark.createDataFrame([], "key struct<k0:bigint,k1:bigint>, terms array<string>")
        got = pii.digest_columns(pii.scan_personal(docs, nobody)).collect()
        want = []
        for r in docs.collect():
            spans = plain_base(r["text"])
            joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
            want.append((r["doc_id"], *[sum(s[3] == k for s in spans) for k, _, _ in PLAIN],
                         hashlib.sha256(joined.encode()).hexdigest(), joined, 0))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_long_texts_take_linear_time(spark):
    text = "é a@b.cc 1.2.3.4 " * 20_000 + "1" * 100_000 + "x" * 100_000
    docs = spark.createDataFrame([(1, text)], DOC)
    nobody = spark.createDataFrame([], "key struct<k0:bigint,k1:bigint>, terms array<string>")
    start = time.monotonic()
    row = pii.digest_columns(pii.scan_personal(docs, nobody)).first()
    assert row["n_email"] == row["n_ip"] == 20_000
    assert time.monotonic() - start < 40


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_sums(spark, n):
    values = [(i * 7) % 13 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<bigint>")
    zero = F.lit(0).cast("bigint")
    got = df.select(running(F.col("v"), "bigint", lambda done, x: F.coalesce(done, zero) + x).alias("r")).first()["r"]
    assert got == [sum(values[: i + 1]) for i in range(n)]


def texts_with_entities():
    """Texts in which one term only stands with one entity, others stand everywhere."""
    rows = []
    for i in range(400):
        words = [f"common{i % 7}", "everyday", f"own{i}"]
        text = " ".join(words)
        if i % 50 == 0:
            text = f"Zebulon meets everyday {words[0]} zeb@mail.example, room 4711. " + text + " then zebulon left"
        rows.append((i, text))
    rows += [(1000 + i, rows[0][1]) for i in range(5)]  # copies
    rows += [(2000, None), (2001, ""), (2002, "once only solo@mail.example Solo")]
    return rows


def plain_disclosures(rows, support, least_bits, context=pii.CONTEXT):
    texts = sorted({t or "" for _, t in rows})
    term_in, entity_in, both = defaultdict(set), defaultdict(set), defaultdict(set)
    words = lambda t: {w.lower() for w in re.findall(r"[^\W_]+", t) if len(w) >= pii.LEAST_LETTERS}
    for k, text in enumerate(texts):
        for w in words(text):
            term_in[w].add(k)
        for kind, pattern, kept in PLAIN:
            spans = [m.span() for m in re.finditer(pattern, text)]
            edges = [(0, 0), *spans, (len(text), len(text))]
            for i, (a, b) in enumerate(spans, 1):
                if not kept(text[a:b]):
                    continue
                value = text[a:b]
                entity = f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else digits(value)}"
                entity_in[entity].add(k)
                left, right = text[edges[i - 1][1] : a], text[b : edges[i + 1][0]]
                if len(left) > context:
                    left = re.sub(r"^[^\W_]+", "", left[-context:])
                if len(right) > context:
                    right = re.sub(r"[^\W_]+$", "", right[:context])
                for w in words(left) | words(right):
                    both[entity, w].add(k)
    found = {}
    n = len(texts)
    for (entity, w), held in both.items():
        d = len(entity_in[entity])
        if d >= support and math.log2(n / d) >= least_bits and len(held) >= support:
            found[entity, w] = math.log2(n * len(held) / (d * len(term_in[w]))) / math.log2(n / d)
    return found


def test_disclosure_equals_brute_force(spark):
    rows = texts_with_entities()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{DOC}, k0 int, term string")
    got = pii.disclosures(docs, support=3, least_bits=4.0).select("entity", "term", "disclosure").distinct().collect()
    want = plain_disclosures(rows, 3, 4.0)
    assert {(r["entity"], r["term"]) for r in got} == set(want)
    assert all(abs(r["disclosure"] - want[r["entity"], r["term"]]) < 1e-9 for r in got)
    assert want["email:zeb@mail.example", "zebulon"] == pytest.approx(1.0)
    assert want["email:zeb@mail.example", "everyday"] < 0.1


def test_terms_that_cannot_reveal_are_not_looked_up(spark, monkeypatch):
    """The bound drops words that stand beside many entities, and no pair that reaches it."""
    rows = [(i, f"common own{i} person{i // 4} mail a{i // 4}@b.org now") for i in range(400)]
    rows += [(i, f"common person{i // 4} nothing{i}") for i in range(400, 800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    looked = []
    plain = pii.lookup_join

    def watched(facts, lookup, on, how):
        if on == "term":
            looked.append(sorted(r.term for r in lookup.collect()))
        return plain(facts, lookup, on, how)

    monkeypatch.setattr(pii, "lookup_join", watched)
    every = pii.disclosures(docs, least_bits=4.0).where(F.col("disclosure") >= 0.8).collect()
    few = pii.disclosures(docs, least_bits=4.0, least=0.8).where(F.col("disclosure") >= 0.8).collect()
    assert sorted(map(str, few)) == sorted(map(str, every)) != []
    pii.revealing_terms(docs, least_bits=4.0)
    assert "common" in looked[0] and looked[2] == looked[4] == sorted(f"person{k}" for k in range(100))


def test_revealing_terms_are_marked_and_replaced(spark):
    rows = texts_with_entities()
    docs = spark.createDataFrame(rows, DOC)
    spans = {r["doc_id"]: r for r in pii.digest_columns(pii.personal_spans(docs, least_bits=4.0)).collect()}
    text = rows[0][1]
    marked = {text[int(s):int(e)] for k, s, e in (x.split(":") for x in spans[0]["spans"].split(",")) if k == "term"}
    assert marked == {"Zebulon", "zebulon", "4711", "room", "meets", "then", "left"} and spans[0]["n_email"] == 1
    assert spans[1000]["spans"] == spans[0]["spans"] and spans[1]["spans"] == "" and spans[2002]["n_terms"] == 0
    clean = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(docs, least_bits=4.0).collect()}
    assert clean[0] == "<name>  everyday common0 <email>,  <number>. common0 everyday own0   "
    assert clean[1] == rows[1][1] and clean[2000] == "" and clean[2002] == "once only <email> Solo"


def test_terms_that_meet_a_pattern_are_left_to_it(spark):
    from spinneret.llm.columns import apart_from

    df = spark.createDataFrame([("a1 b2 c3 d4",)], "t string")
    spans = match_spans(F.col("t"), "[a-z0-9]+", 5)
    others = match_spans(F.col("t"), "1 b|3", 1)
    got = df.select(apart_from(spans, others).alias("s")).first()["s"]
    assert [(s["start"], s["end"]) for s in got] == [(9, 11)]


def test_empty_table(spark):
    assert pii.digest_columns(pii.personal_spans(spark.createDataFrame([], DOC))).collect() == []
