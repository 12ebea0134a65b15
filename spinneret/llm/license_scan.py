"""License detection by diagonal voting.

All rolling word k-grams of the documents meet the k-grams of the templates in
one join. Each match votes for a template and a diagonal (place in the document
less place in the template). Neighbouring diagonals are merged, and a merged
span that covers enough of its template and is not stretched is a notice.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spinneret.llm.columns import body, count_words, lower_words, word_windows
from spinneret.operators.joins import lookup_join

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEMPLATE_SCHEMA = "template int, label string, exact boolean, words string"

# Phrases whose every place counts, and openings of public license notices.
BASE_PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("unlicense", "free and unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    """Lower-cased words (ASCII letters, digits, anything beyond ASCII), one blank apart."""
    return F.btrim(F.regexp_replace(lower_words(text), NOT_WORD, " "))


def template_frame(
    spark: SparkSession,
    base: list[tuple[str, str]] = BASE_PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
) -> DataFrame:
    rows = [(label, True, words) for label, words in base]
    rows += [(label, False, words) for label, words in notices]
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], TEMPLATE_SCHEMA)


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame,
    k: int = 2,
    slack: int = 2,
    coverage: float = 0.75,
    text: str = "text",
) -> DataFrame:
    """One row per document: counts, places, labels and score.

    ``exact`` templates are the base phrases: every place where their words
    stand consecutively counts. The others need ``coverage`` of their k-grams
    on diagonals at most ``slack`` apart, within a span at most twice as long as
    the template. ``score`` is the largest covered share of any template, 1 for
    a base phrase. Templates have at least ``k`` words. A NULL or empty text
    has no words, no label and score 0; a repeated row gets its own result.
    Matching needs no shuffle of texts or words; only votes are shuffled, first
    combined per document, template and diagonal.
    """
    pieces = templates.select(
        "template", "label", "exact",
        (count_words(F.col("words")) - k + 1).alias("size"),
        F.posexplode(word_windows(F.col("words"), k)).alias("at", "window"),
    )
    index = pieces.groupBy("window").agg(
        F.collect_list(F.struct("template", "label", "exact", "size", "at")).alias("places")
    ).select(F.xxhash64("window").alias("hash"), F.struct("window", "places").alias("entry"))
    index = index.groupBy("hash").agg(F.collect_list("entry").alias("entries"))

    # Words are counted and cut before the explode, or each run would count them anew.
    spread = (
        docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(body(text)).alias("words"))
        .select(
            "doc_id", "row", count_words(F.col("words")).alias("n_words"),
            word_windows(F.col("words"), k).alias("windows"),
        )
        .select("doc_id", "row", "n_words", F.posexplode_outer("windows").alias("place", "window"))
        .withColumn("hash", F.xxhash64("window"))
    )
    met = lookup_join(spread, index, "hash", "left")
    same = F.filter("entries", lambda e: e["window"] == F.col("window"))
    hits = (
        met.withColumn("places", F.get(same, F.lit(0))["places"])
        .where(F.col("places").isNotNull() | (F.coalesce("place", F.lit(0)) == 0))
        .select("doc_id", "row", "n_words", "place", F.explode_outer("places").alias("hit"))
        .select("doc_id", "row", "n_words", "place", "hit.*")
    )
    document = ["row", "doc_id", "n_words"]
    votes = hits.groupBy(
        *document, "template", "label", "exact", "size", (F.col("place") - F.col("at")).alias("diagonal")
    ).agg(F.count("place").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"))

    along = Window.partitionBy(*document, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > slack, F.lit(False))
    step = F.when(F.col("exact") | apart, 1).otherwise(0)
    merged = (
        votes.withColumn("step", step)
        .withColumn("span", F.sum("step").over(along))
        .groupBy(*document, "template", "label", "exact", "size", "span")
        .agg(
            F.sum("votes").alias("votes"),
            F.min(F.col("diagonal") + F.col("low")).alias("start"),
            F.max(F.col("diagonal") + F.col("high")).alias("end"),
        )
    )
    covered = F.least(F.col("votes") / F.col("size"), F.lit(1.0))
    compact = F.col("end") - F.col("start") < 2 * (F.col("size") + k - 1)
    full = F.col("exact") & (F.col("votes") == F.col("size"))
    close = ~F.col("exact") & compact
    verified = full | (close & (covered >= coverage))

    def listed(condition):
        labels = F.array_sort(F.collect_set(F.when(condition, F.col("label"))))
        return F.array_join(labels, ",")

    return merged.groupBy(*document).agg(
        F.count_if(full).alias("n_base"),
        F.min(F.when(full, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(full, F.col("start"))).cast("bigint").alias("last_word"),
        listed(full).alias("base_labels"),
        listed(verified).alias("labels"),
        F.coalesce(F.max(F.when(full, 1.0).when(close, covered)), F.lit(0.0)).alias("score"),
    ).drop("row")
