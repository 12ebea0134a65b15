"""URL filtering by hashed host-suffix and path-prefix expressions.

Each URL is expanded into every ``host suffix + path prefix`` it can match. The
expressions meet the rules in an equi-join on the first four bytes of their
SHA-256; the full digest confirms a match, and the longest rule decides.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.operators.joins import lookup_join

RULE_SCHEMA = "action string, host string, path string"
PREFIX_DIGITS = 8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(action, host, path)`` rows as a rule table."""
    return spark.createDataFrame(rules, RULE_SCHEMA)


def _index(rules: DataFrame) -> DataFrame:
    """Digest prefix -> the rules that have it. Equal rules count once, block first."""
    ruled = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))
        .withColumn("digest", F.sha2(F.concat("host", "path"), 256))
    )
    return ruled.groupBy(F.substring("digest", 1, PREFIX_DIGITS).alias("prefix")).agg(
        F.collect_list(F.struct("digest", "host", "path", "action")).alias("rules")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, keys: list[str], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``keys, host, path, rule, verdict`` of every row of ``pages``.

    A rule fits its host and all subdomains when the path starts with the
    rule's. The longest rule (host and path together) wins, then the longer
    host, then ``block``. Without a rule the verdict is ``default``. A NULL URL
    or one without ``://`` has an empty host and path and fits no rule. Repeated
    rows are judged one by one; other columns of ``pages`` are left out.

    Path prefixes are cut at the lengths that rules have, and host suffixes have at
    most as many labels as the longest rule host; others could not meet a rule.
    """
    known = rules.where("host is not null and path is not null")
    cuts = sorted(row[0] for row in known.select(F.length("path")).distinct().collect())
    most = known.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    lengths = F.array(*[F.lit(n) for n in cuts]) if cuts else F.array().cast("array<int>")
    named = {f"_key{i}": F.col(f"`{k}`") for i, k in enumerate(keys)}
    rows = pages.select(
        *[column.alias(name) for name, column in named.items()],
        F.monotonically_increasing_id().alias("_row"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    counts = F.sequence(F.lit(1), F.least(F.lit(most), F.regexp_count("host", F.lit(r"\.")) + 1))
    suffixes = F.transform(counts, lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring("path", F.lit(1), n)
    )
    expressions = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))
    )
    expanded = rows.select(
        *named, "_row", "host", "path", F.posexplode_outer(expressions).alias("_pos", "_expression")
    ).withColumn("_digest", F.sha2("_expression", 256))
    looked_up = lookup_join(
        expanded.withColumn("prefix", F.substring("_digest", 1, PREFIX_DIGITS)),
        _index(rules), "prefix", "left",
    )
    confirmed = F.filter("rules", lambda r: r["digest"] == F.col("_digest"))
    ranked = F.transform(
        confirmed,
        lambda r: F.struct(
            F.length(F.concat(r["host"], r["path"])).alias("length"),
            F.length(r["host"]).alias("host_length"),
            r["action"].alias("action"),
            F.concat(r["host"], r["path"]).alias("rule"),
        ),
    )
    # One row per URL goes on even where nothing matched.
    best = (
        looked_up.withColumn("_found", F.get(ranked, F.lit(0)))
        .where(F.col("_found").isNotNull() | (F.coalesce("_pos", F.lit(0)) == 0))
        .groupBy("_row", *named, "host", "path")
        .agg(F.max("_found").alias("_best"))
    )
    return best.select(
        *[F.col(name).alias(key) for name, key in zip(named, keys)],
        "host", "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.action"), F.lit(default)).alias("verdict"),
    )
