"""The corpus pipeline on tables with odd rows."""

import random

import pytest

import corpus_pipeline
from spinneret.llm import queries

LABELS = "doc_id bigint, quality int, toxic int"


def words(rng, n, prefix):
    return " ".join(f"{prefix}{rng.randrange(4000)}" for _ in range(n))


def folder(spark, tmp_path, rows, schema):
    path = str(tmp_path / "tables")
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int("curse" in (r[1] or ""))) for r in rows[:120] if r[0] is not None]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    item = "A farmer named John bought 12 apples at the market and carried all of them home before the rain came"
    spark.createDataFrame([(0, item), (1, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, item


def stages(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{path}/{name}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        found.append(docs)
    return found


def test_odd_rows_pass_all_stages(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, ("curse foul " if i % 10 == 0 else "") + words(rng, 60, "w"), "en", "a" if i % 3 else "b", 1) for i in range(240)]
    path, item = folder(spark, tmp_path, rows, "doc_id bigint, text string, lang string, source string, key int")
    plain = [r[0] for r in rows if "curse" not in r[1]]
    long = words(rng, 30_000, "long")
    odd = [(None, None, None, None, None), (None, None, None, None, None), (500, "", "de", None, 2), (501, long, "de", "a", 3),
           (502, rows[1][1], "en", "a", 4), (502, rows[1][1], "en", "a", 4), (503, "so " + item + " indeed", "en", "a", 5),
           (504, "curse foul " + words(rng, 40, "v"), "en", "a", 6), (None, words(rng, 50, "n"), None, "b", 7)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, lang string, source string, key int")
    docs.write.mode("append").parquet(f"{path}/documents.parquet")
    clean, single, spared, mixed, tokens = stages(spark, path)
    kinds = docs.dtypes
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect() if r["doc_id"] is not None)
    assert clean.dtypes == single.dtypes == spared.dtypes == mixed.dtypes == kinds
    assert ids(clean) == sorted([*plain, 500, 501, 502, 502, 503]) and clean.count() == len(ids(clean)) + 3
    assert ids(single) == sorted([*plain, 500, 501, 503]) and single.where("text is null").count() == 0
    assert ids(spared) == sorted([*plain, 500, 501]) and spared.where("doc_id is null").count() == 1
    assert set(ids(mixed)) <= set(ids(spared)) and 0 < mixed.count() < spared.count()
    got = tokens.collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in mixed.collect())
    assert max(r["start"] + r["n_tokens"] for r in got) == sum(r["n_tokens"] for r in got)


def test_an_empty_table_stays_empty(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    path, _ = folder(spark, tmp_path, [], schema)
    assert all(df.count() == 0 for df in stages(spark, path))


@pytest.mark.parametrize("name", ["op2_toxicity", "op3_decontaminate", "op5_quality", "op8_license_scan", "op10_secret_scan"])
def test_queries_on_an_empty_table(spark, tmp_path, name):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    path, _ = folder(spark, tmp_path, [], schema)
    assert queries.QUERIES[name](spark, path).count() == 0
