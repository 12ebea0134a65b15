"""Mixing sources to target weights by iterative proportional fitting.

The tokens of every (source, language, topic) cell are counted once. Cell weights
are raked to the target share of each marginal in turn until they agree, never
above what a cell holds. A document is then drawn with its cell's probability,
weight over tokens, so the expected sample has the target marginals.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, share_of_hash, small
from spinneret.operators.scratch import settle

MARGINALS = ("source", "lang", "topic")
MISSING = "\x00none"


def topic_of(text: Column) -> Column:
    """A topic for tables that have none: the form of the text."""
    per_bar = F.length(text) - F.length(F.replace(text, F.lit(" | "), F.lit("  ")))
    per_mark = F.length(text) - F.length(F.replace(text, F.lit("!! "), F.lit("  ")))
    per_symbol = (
        4 * F.length(text)
        - F.length(F.replace(text, F.lit("### "), F.lit("   ")))
        - F.length(F.replace(text, F.lit("*** "), F.lit("   ")))
        - F.length(F.replace(text, F.lit("$$$ "), F.lit("   ")))
        - F.length(F.replace(text, F.lit("%%% "), F.lit("   ")))
    )
    often = F.length(text) / 40
    return (
        F.when(per_bar > often, "table")
        .when(per_mark > often, "shouting")
        .when(per_symbol > often, "symbols")
        .otherwise("prose")
    )


def count_tokens(text: Column) -> Column:
    """Blank-separated words; at least 1, so an empty document has weight too."""
    return F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1)).cast("double")


def _described(docs: DataFrame, topic: Column, text: str) -> DataFrame:
    named = [F.coalesce(F.col(d).cast("string"), F.lit(MISSING)).alias(d) for d in MARGINALS[:2]]
    return docs.select(*named, topic.alias("topic"), count_tokens(body(text)).alias("tokens"))


def cells(docs: DataFrame, topic: Column, text: str = "text") -> DataFrame:
    """Tokens per (source, lang, topic). NULL values are a category of their own."""
    return _described(docs, topic, text).groupBy(*MARGINALS).agg(F.sum("tokens").alias("tokens"))


def tempered(table: DataFrame, dimension: str, power: float) -> DataFrame:
    """Targets in proportion to a power of the natural share: ``dimension, target``."""
    return table.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("target"))


def fit_weights(
    table: DataFrame,
    targets: dict[str, DataFrame],
    budget: float,
    rounds: int = 20,
    tolerance: float = 1e-3,
) -> tuple[DataFrame, float]:
    """Rake ``table`` to ``targets`` (``dimension, target`` rows, any scale).

    Returns cells with ``weight`` and ``probability``, and the largest relative
    error left. ``budget`` is the share of all tokens to keep. A category without
    a target keeps nothing; a target without tokens is left out. Weights never
    exceed a cell's tokens; where the budget cannot be met under that bound the
    fit ends after ``rounds`` with the error it has. Every round is settled, and
    only its error reaches the driver.
    """
    total = F.lit(float(table.agg(F.sum("tokens")).first()[0] or 0.0) * budget)
    wanted = {}
    for dimension, target in targets.items():
        held = target.join(table.select(dimension).distinct(), dimension, "left_semi")
        whole = held.agg(F.sum("target")).first()[0] or 1.0
        wanted[dimension] = settle(held.select(dimension, (total * F.col("target") / F.lit(float(whole))).alias("aim")))
    state = settle(table.withColumn("weight", F.col("tokens") * F.lit(float(budget))))
    error = 0.0
    for _ in range(rounds):
        for dimension, aim in wanted.items():
            now = state.groupBy(dimension).agg(F.sum("weight").alias("now"))
            factor = now.join(aim, dimension, "left").select(
                dimension,
                F.when(F.col("now") > 0, F.coalesce("aim", F.lit(0.0)) / F.col("now")).otherwise(0.0).alias("factor"),
            )
            state = state.join(factor, dimension).withColumn(
                "weight", F.least(F.col("weight") * F.col("factor"), F.col("tokens"))
            ).drop("factor")
        state = settle(state)
        error = _largest_error(state, wanted)
        if error <= tolerance:
            break
    fitted = state.withColumn("probability", F.least(F.col("weight") / F.col("tokens"), F.lit(1.0)))
    return fitted, error


def _largest_error(state: DataFrame, wanted: dict[str, DataFrame]) -> float:
    off = None
    for dimension, aim in wanted.items():
        one = (
            state.groupBy(dimension).agg(F.sum("weight").alias("now")).join(aim, dimension)
            .agg(F.max(F.abs(F.col("now") / F.col("aim") - 1)).alias("off"))
        )
        off = one if off is None else off.union(one)
    return off.agg(F.max("off")).first()[0] or 0.0


def drawn(
    docs: DataFrame, fitted: DataFrame, topic: Column, seed: int, text: str = "text"
) -> DataFrame:
    """``docs`` with struct ``_draw (topic, tokens, probability, kept)``.

    The draw is fixed by the row's id and text, so equal rows share it and a
    rerun repeats it.
    """
    lookup = small(
        fitted.select(F.struct(*MARGINALS).alias("_cell"), "probability")
    ).alias("f")
    chance = share_of_hash(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)), body(text), seed=seed
    )
    cell = F.struct(
        *[F.coalesce(F.col(f"`{d}`").cast("string"), F.lit(MISSING)).alias(d) for d in MARGINALS[:2]],
        topic.alias("topic"),
    )
    described = docs.withColumn(
        "_draw", F.struct(cell.alias("cell"), count_tokens(body(text)).alias("tokens"), chance.alias("chance"))
    )
    met = described.alias("d").join(lookup, F.col("d._draw.cell") == F.col("f._cell"), "left")
    probability = F.coalesce("f.probability", F.lit(0.0))
    return met.select(
        *[F.col(f"d.`{c}`") for c in docs.columns if c != "_draw"],
        F.struct(
            F.col("d._draw.cell.topic").alias("topic"),
            F.col("d._draw.tokens").alias("tokens"),
            probability.alias("probability"),
            (F.col("d._draw.chance") < probability).alias("kept"),
        ).alias("_draw"),
    )


#: Production targets: the natural share of each marginal to this power.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.9}


def standard_fit(
    docs: DataFrame, budget: float = 0.5, powers: dict[str, float] = POWERS, text: str = "text"
) -> tuple[DataFrame, Column]:
    """Production mix: flattened marginals, ``budget`` of all tokens."""
    topic = topic_of(body(text))
    table = settle(cells(docs, topic, text))
    targets = {d: tempered(table, d, power) for d, power in powers.items()}
    return fit_weights(table, targets, budget)[0], topic


def mix(docs: DataFrame, seed: int = 9, text: str = "text") -> DataFrame:
    """The drawn documents, with the columns they had."""
    fitted, topic = standard_fit(docs, text=text)
    return drawn(docs, fitted, topic, seed, text).where("_draw.kept").drop("_draw")
