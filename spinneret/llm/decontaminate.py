"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question keeps its
template when its parameters change. Windows of template tokens of documents and
benchmark items meet in a hash join. Along one alignment every slot value of the
item must stand for one value of the document; windows that break this do not
count. A document leaks an item when windows cover enough of the item's tokens, so an
edit only costs the tokens around it that no whole window reaches.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, same_row, small, text_key, word_windows
from spinneret.operators.joins import lookup_join
from spinneret.operators.scratch import settle

WINDOW = 5
LITERALS = 2
COVERAGE = 0.8
#: So many covered tokens of one alignment are a leak whatever share of the item they are.
LONG = 20
#: Markers in front of slot values; private-use letters, dropped from any input.
NUMBER, NAME, UNIT = "\ue001", "\ue002", "\ue003"
MARKERS = "\ue001-\ue003"
#: All but ASCII letters and digits and what lies beyond Latin and general punctuation.
SEPARATORS = r"[^a-z0-9\u00C0-\u1FFF\u2070-\x{10FFFF}]+"
# Units that may follow a number.
UNITS = (
    "mm|cm|km|m|kg|mg|g|ml|l|s|ms|min|mins|h|hr|hrs|kmh|mph|kwh|kw|w|mb|gb|tb|kb|"
    "meters|metres|kilometers|kilometres|miles|feet|inches|grams|kilograms|pounds|ounces|"
    "liters|litres|seconds|minutes|hours|days|weeks|months|years|dollars|euros|cents|percent"
)


def template_text(text: Column) -> Column:
    """Lower-case tokens one blank apart, each slot value behind its marker.

    A token that begins with a digit is a number; a capitalised word that goes
    on a sentence is a name, one in capitals throughout is not; a unit stands right
    behind a number.
    """
    plain = text
    for marker in (NUMBER, NAME, UNIT):
        plain = F.replace(plain, F.lit(marker), F.lit(""))
    for blank in ("\n", "\t"):
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    # Each pattern looks for its rare character first and around it only then.
    whole = F.regexp_replace(plain, r"[.,:](?=\d)(?<=\d.)", "")
    named = F.regexp_replace(whole, r"(?=\p{Lu}\p{Ll})(?<=[\p{L}\p{N},;] )", NAME)
    counted = F.regexp_replace(named, rf"(?=\d)(?<![\p{{L}}\p{{N}}{NAME}])", NUMBER)
    united = F.regexp_replace(
        F.lower(counted), rf"({NUMBER}[\p{{L}}\p{{N}}]+ )({UNITS})(?![\p{{L}}\p{{N}}])", f"$1{UNIT}$2"
    )
    return F.btrim(F.regexp_replace(united, SEPARATORS, " "))


def template_only(annotated: Column) -> Column:
    """The same tokens with slot values left out."""
    return F.regexp_replace(annotated, f"([{MARKERS}])[^ ]*", "$1")


def _telling(window: Column, literals: int) -> Column:
    """Whether a window holds enough literal words to say anything."""
    slots = F.regexp_count(window, F.lit(f"[{MARKERS}]"))
    return slots <= WINDOW - literals


def _covered(ats: Column) -> Column:
    """How many tokens of an item the windows at these places reach."""
    reached = F.transform(ats, lambda at: F.sequence(at, at + F.lit(WINDOW - 1)))
    return F.size(F.array_distinct(F.flatten(reached)))


def item_windows(benchmark: DataFrame, literals: int = LITERALS) -> DataFrame:
    """``item_id, at, window, size, tokens`` of every telling window of every item.

    ``size`` counts the item's tokens in telling windows. An item without such a
    window, as one with fewer than ``WINDOW`` tokens, is never found.
    """
    annotated = benchmark.where(F.col("text").isNotNull()).select(
        "item_id", template_text(F.col("text")).alias("annotated")
    ).distinct()
    numbered = F.transform(
        word_windows(template_only(F.col("annotated")), WINDOW),
        lambda w, i: F.struct(i.alias("at"), w.alias("window")),
    )
    told = F.filter(numbered, lambda w: _telling(w["window"], literals))
    return annotated.select(
        "item_id", F.split("annotated", " ").alias("tokens"), told.alias("told")
    ).select("item_id", "tokens", _covered(F.transform("told", lambda w: w["at"])).alias("size"), F.explode("told").alias("w")).select(
        "item_id", "tokens", "size", "w.at", "w.window"
    )


def template_hits(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """``doc_id, key, item_id, size, diagonal, ats`` of documents that share windows.

    Matches are combined per alignment before anything is shuffled. The list of
    an alignment is no longer than its item.
    """
    index = windows.groupBy(F.xxhash64("window").alias("hash")).agg(
        F.collect_list(F.struct("window", "item_id", "size", "at")).alias("places")
    )
    # The key is taken before the explode, or every window would hash the whole text anew.
    spread = docs.select(
        "doc_id", text_key(text).alias("key"),
        word_windows(template_only(template_text(body(text))), WINDOW).alias("windows"),
    ).select("doc_id", "key", F.posexplode("windows").alias("place", "window")).withColumn(
        "hash", F.xxhash64("window")
    )
    met = lookup_join(spread, index, "hash", "inner")
    hits = met.select(
        "doc_id", "key", "place",
        F.explode(F.filter("places", lambda p: p["window"] == F.col("window"))).alias("hit"),
    )
    return hits.groupBy(
        "doc_id", "key", "hit.item_id", "hit.size", (F.col("place") - F.col("hit.at")).alias("diagonal")
    ).agg(F.collect_set("hit.at").alias("ats"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    literals: int = LITERALS,
    text: str = "text",
    long: int = LONG,
) -> DataFrame:
    """``doc_id, key, item_id, tokens, matched, coverage`` of every leaked item.

    ``coverage`` is the least share of an item's tokens that windows with consistent
    slots cover; ``long`` tokens along one alignment, a quotation, are enough in any
    case. NULL and empty texts leak nothing; equal rows (same id and text) give
    one result for both; items with equal text are each reported. Texts are read
    again only for documents that share enough windows.
    """
    windows = item_windows(benchmark, literals)
    hits = template_hits(docs, windows, text)
    # Settled: it is counted for the join below, and all texts went into it.
    enough = settle(
        hits.groupBy("doc_id", "key", "item_id", "size")
        .agg(F.array_distinct(F.flatten(F.collect_set("ats"))).alias("all"),
             F.collect_list(F.struct("diagonal", "ats")).alias("lines"))
        .where(
            (_covered(F.col("all")) >= F.col("size") * coverage)
            | F.exists("lines", lambda x: _covered(x["ats"]) >= long)
        )
        .drop("all")
    )
    items = windows.select("item_id", F.col("tokens").alias("item_tokens")).distinct()
    tokens = (
        docs.alias("d")
        .join(small(enough).alias("e"), same_row("d", "e", text))
        .select(
            "e.doc_id", "e.key", "e.item_id", "e.size", "e.lines",
            F.split(template_text(body(f"d.{text}")), " ").alias("tokens"),
        )
    ).join(small(items), "item_id")
    line = F.col("line")

    def slots_at(at):
        here = F.transform(
            F.array(*[F.lit(o) for o in range(WINDOW)]),
            lambda o: F.struct(
                F.get("item_tokens", at + o).alias("item"),
                F.get("tokens", (at + o + line["diagonal"]).cast("int")).alias("doc"),
            ),
        )
        return F.filter(here, lambda s: s["item"].rlike(f"^[{MARKERS}]"))

    slots = F.transform(line["ats"], lambda at: F.struct(at.alias("at"), slots_at(at).alias("slots")))
    pairs = F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"])))
    names = F.transform("pairs", lambda p: p["item"])
    torn = F.filter(
        F.array_distinct(names), lambda n: F.size(F.filter("names", lambda m: m == n)) > 1
    )
    fitting = F.filter(
        "windows", lambda w: ~F.exists(w["slots"], lambda s: F.array_contains("torn", s["item"]))
    )
    consistent = (
        tokens.select("*", F.explode("lines").alias("line")).drop("lines")
        .withColumn("windows", slots).withColumn("pairs", pairs).withColumn("names", names)
        .withColumn("torn", torn)
        .withColumn("ats", F.transform(fitting, lambda w: w["at"]))
    )
    found = (
        consistent.groupBy("doc_id", "key", "item_id", "size")
        .agg(
            _covered(F.array_distinct(F.flatten(F.collect_set("ats")))).alias("matched"),
            F.max(_covered(F.col("ats"))).alias("longest"),
        )
        .withColumn("coverage", F.col("matched") / F.col("size"))
        .where((F.col("coverage") >= coverage) | (F.col("longest") >= long))
    )
    return found.select(
        "doc_id", "key", "item_id", F.col("size").cast("bigint").alias("tokens"),
        F.col("matched").cast("bigint").alias("matched"), "coverage",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that leak no item, with all their columns."""
    leaking = settle(leaks(docs, benchmark, text=text).select("doc_id", "key").distinct())
    return docs.alias("d").join(
        small(leaking).alias("x"), same_row("d", "x", text), "left_anti"
    )
