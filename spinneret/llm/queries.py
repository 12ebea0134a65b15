"""The operators as queries over the given tables, with their SQL twins."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.llm import (
    alignment,
    decontaminate,
    fingerprint,
    license_scan,
    mixing,
    phrases,
    pii,
    quality,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    url_rules,
)
from spinneret.llm.columns import documents
from spinneret.operators.scratch import scratch_path

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"

# The rules of the URL query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.close_components(simhash.fingerprints(documents(spark, sf_dir)))
    digits = F.lower(F.lpad(F.hex("s0"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id", "n_equal")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is toxic."""
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model).drop("key")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked benchmark items per document."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leaks(documents(spark, sf_dir), benchmark).drop("key")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to token files and read back from them."""
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(documents(spark, sf_dir), path, tokenizer_path())
    return token_files.read_token_files(spark, path)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    forest = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_documents(docs, forest)


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(documents(spark, sf_dir).select("doc_id", "text"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_rules.judge_urls(pages, url_rules.rule_frame(spark, URL_RULES), ["page_id"])


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(
        documents(spark, sf_dir), license_scan.template_frame(spark)
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its topic, tokens, probability and draw."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    fitted, topic = mixing.standard_fit(docs)
    return mixing.drawn(docs, fitted, topic, seed=9).select("doc_id", "source", "lang", "_draw.*")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secret_scan.scan_secrets(docs, secret_scan.train(docs))
    return found.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
        F.size("added").cast("bigint").alias("n_markov"),
    )


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers, aligned by the bytes they spell."""
    return alignment.align_tokenizers(
        documents(spark, sf_dir), tokenizer_path(), tokenizer_path(OTHER_TOKENIZER)
    )


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it."""
    return pii.digest_columns(pii.personal_spans(documents(spark, sf_dir)))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return phrases.collocations(documents(spark, sf_dir))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_files": op4_token_files,
    "op5_quality": op5_quality,
    "op6_fingerprint": op6_fingerprint,
    "op7_url_filter": op7_url_filter,
    "op8_license_scan": op8_license_scan,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_align": op11_align,
    "op12_pii": op12_pii,
    "op13_phrases": op13_phrases,
}

_RULE_ROWS = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)
ORACLES = {
    "op7_url_filter": f"""
        WITH rules(action, host, path) AS (VALUES {_RULE_ROWS}),
        parts AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                    '{url_rules.CAPITALS}', '{url_rules.SMALL}') AS host,
                regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        fitting AS (
            SELECT p.page_id, p.host, p.path, r.action, r.host || r.path AS rule,
                row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS n
            FROM parts p LEFT JOIN rules r
                ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
                AND starts_with(p.path, r.path))
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
        FROM fitting WHERE n = 1
    """,
}
