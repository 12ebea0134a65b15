"""Secret detection: fixed patterns plus a character Markov likelihood ratio.

Two character bigram models, one of random strings and one of ordinary
identifiers, are trained from labelled samples. A long token whose
log-likelihood ratio clears a bound is a secret, beside what patterns find.
Everything is evaluated inside the row; no text is shuffled.
"""

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.llm.columns import SPAN_TYPE, apart_from, body, bounded_sample, joined_spans, match_spans

# Kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN_CHARACTERS = "A-Za-z0-9+/_=-"
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

LEAST_TOKEN = 20
LEAST_RATIO = 12.0
SAMPLE_DOCUMENTS = 2000
SAMPLE_STRINGS = 6000


def token_pattern(least: int = LEAST_TOKEN) -> str:
    return f"(?<![{TOKEN_CHARACTERS}])[{TOKEN_CHARACTERS}]{{{least},}}"


# Training

def random_strings(spark: SparkSession, count: int) -> DataFrame:
    """Strings labelled random: hexadecimal, base 64 and upper-case alphanumeric digests."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(count).select(
        F.lit("random").alias("label"),
        F.when(F.col("id") % 3 == 0, digest)
        .when(F.col("id") % 3 == 1, F.base64(F.unhex(digest)))
        .otherwise(F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "")))
        .alias("string"),
    )


def identifier_strings(docs: DataFrame, count: int, text: str = "text") -> DataFrame:
    """Strings labelled ordinary: words of a sample of ``count`` documents, alone and
    joined into snake case, camel case and paths. The sample is fixed by a hash."""
    sample = bounded_sample(docs.select(body(text).alias("text")), count, F.col("text"), seed=10)
    # One task picks the sample; what is done with it is dealt out again.
    sample = sample.repartition(docs.sparkSession.sparkContext.defaultParallelism)
    words = F.regexp_extract_all("text", F.lit("(?<![A-Za-z0-9])[A-Za-z]{2,15}(?![A-Za-z0-9])"), F.lit(0))
    runs = F.transform("words", lambda _, i: F.slice("words", i + 1, F.lit(3)))
    triples = F.filter(runs, lambda run, i: (i % 3 == 0) & (F.size(run) == 3))
    joined = F.flatten(
        F.transform(
            triples,
            lambda t: F.array(
                F.element_at(t, 1), F.array_join(t, "_"), F.array_join(t, "-"), F.array_join(t, "/"),
                F.array_join(F.transform(t, F.initcap), ""), F.upper(F.array_join(t, "_")),
            ),
        )
    )
    return (
        sample.select(words.alias("words"))
        .where(F.size("words") > 2)
        .select(F.lit("ordinary").alias("label"), F.explode(joined).alias("string"))
    )


def bigram_ratios(samples: DataFrame) -> list[float]:
    """Log of P(b | a, random) / P(b | a, ordinary) for every pair of symbols.

    ``samples`` holds ``label`` (``random`` or ``ordinary``) and ``string``. Only
    the counts of the symbol pairs, a fixed number, reach the driver. A pair
    never seen counts as half a time in both models.
    """
    pairs = samples.where(F.length("string") > 1).select(
        "label",
        F.explode(
            F.transform(F.split("string", ""), lambda _, i: F.substring("string", i + 1, F.lit(2)))
        ).alias("pair"),
    )
    known = F.col("pair").rlike(f"^[{TOKEN_CHARACTERS}]{{2}}$")
    counts = {
        (row["label"], row["pair"]): row["n"]
        for row in pairs.where(known).groupBy("label", "pair").agg(F.count("*").alias("n")).collect()
    }

    def chance(label: str, a: str) -> list[float]:
        row = [counts.get((label, a + b), 0) + 0.5 for b in SYMBOLS]
        return [n / sum(row) for n in row]

    return [
        log(r / o) for a in SYMBOLS for r, o in zip(chance("random", a), chance("ordinary", a))
    ]


def train(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, strings: int = SAMPLE_STRINGS) -> list[float]:
    """Fit on at most ``documents`` documents and ``strings`` random strings."""
    random = random_strings(docs.sparkSession, strings)
    return bigram_ratios(random.unionByName(identifier_strings(docs, documents)))


def likelihood_ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of the log ratios along a token of known symbols."""
    table = F.from_json(F.lit(str(ratios)), "array<double>")
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    steps = F.zip_with(
        places, F.slice(places, F.lit(2), F.size(places)),
        lambda a, b: F.coalesce(F.try_element_at(table, (a - 1) * len(SYMBOLS) + b), F.lit(0.0)),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x)


# Scan

def _long_value(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)


def scan_secrets(
    docs: DataFrame,
    ratios: list[float],
    least_token: int = LEAST_TOKEN,
    least_ratio: float = LEAST_RATIO,
    text: str = "text",
) -> DataFrame:
    """Per document ``doc_id``, the spans of each kind and all of them in order.

    Patterns are matched leftmost and without overlap per kind. ``markov`` spans
    are tokens of at least ``least_token`` symbols that mix letters with digits
    or both cases, whose ratio reaches ``least_ratio``, and that meet no pattern
    span. NULL and empty texts have no span; repeated rows stay.
    """
    def unlike(found):
        mixed = lambda t: (t.rlike("[0-9]") & t.rlike("[A-Za-z]")) | (t.rlike("[a-z]") & t.rlike("[A-Z]"))
        return F.transform(
            found, lambda t: mixed(t) & (likelihood_ratio(t, ratios) >= least_ratio)
        )

    content = F.col("content")
    found = (
        docs.select("doc_id", body(text).alias("content"))
        .withColumn("assign", match_spans(content, ASSIGN, 1, lambda _: _long_value(content)))
        .withColumn("access", match_spans(content, ACCESS, 2))
        .withColumn("hex", match_spans(content, HEX, 3))
        .withColumn("markov", match_spans(content, token_pattern(least_token), 4, unlike))
    )
    base = F.array_sort(F.concat("assign", "access", "hex"))
    nothing = F.array().cast(SPAN_TYPE)
    added = F.when(F.size("markov") > 0, apart_from(F.col("markov"), F.col("base"))).otherwise(nothing)
    return (
        found.withColumn("base", base)
        .withColumn("added", added)
        .select("doc_id", "assign", "access", "hex", "base", "added",
                joined_spans(F.col("base"), KINDS).alias("base_spans"),
                joined_spans(F.array_sort(F.concat("base", "added")), KINDS).alias("spans"))
    )
