"""Column expressions that several of the operators share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spinneret.functions.binding import let
from spinneret.operators.joins import fits_broadcast

KELVIN, STAND_IN = "\u212a", "\u0138"  # the only letter outside ASCII whose lower case is a single ASCII letter


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def body(text: str = "text") -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def lower_words(text: Column) -> Column:
    """Lower case that never turns another letter into an ASCII one.

    Letters outside ASCII change as well, which cannot matter to a comparison
    with ASCII phrases.
    """
    return F.lower(F.replace(text, F.lit(KELVIN), F.lit(STAND_IN)))


def word_windows(words: Column, k: int) -> Column:
    """Every run of ``k`` words of a text whose words stand one blank apart.

    One linear regular expression pass; overlapping runs come from a lookahead.
    """
    more = f"(?: [^ ]++){{{k - 1}}}"
    return F.regexp_extract_all(words, F.lit(f"(?=([^ ]++{more}))[^ ]++ ?"), F.lit(1))


def count_words(words: Column) -> Column:
    """Number of words of a text whose words stand one blank apart."""
    blanks = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
    return F.when(words == "", 0).otherwise(blanks + 1).cast("bigint")


def text_key(text: str = "text") -> Column:
    """With ``doc_id``, what tells one row from another: equal rows share it."""
    return F.xxhash64(F.col(text).cast("string"), F.col(text).isNull())


def same_row(left: str, right: str, text: str = "text") -> Column:
    """Join condition between documents ``left`` and keys ``right (doc_id, key)``."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        text_key(f"{left}.{text}") == F.col(f"{right}.key")
    )


def small(df: DataFrame) -> DataFrame:
    """Broadcast a frame that is counted to be small; else leave the choice to Spark."""
    return F.broadcast(df) if fits_broadcast(df) else df


def bounded_sample(df: DataFrame, size: int, *key: Column, seed: int) -> DataFrame:
    """Up to ``size`` rows with the smallest hashes of ``key``, the same ones each time.

    A count first tells how small a hash must be to have a chance, so a task sends
    few rows to the one that picks, however many tasks there are.
    """
    total = df.count()
    near = df.where(share_of_hash(*key, seed=seed) < min(1.0, 4 * size / max(total, 1)))
    return near.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(size)


def share_of_hash(*columns: Column, seed: int) -> Column:
    """A number from 0 (inclusive) to 1 that only depends on the values."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


# Spans of matches

SPAN_TYPE = "array<struct<start:bigint,rank:int,end:bigint>>"
RUN_BLOCK = 256


def running(values: Column, kind: str, fold: Callable[[Column, Column], Column]) -> Column:
    """The values of an array folded up to each place, itself included.

    ``fold`` is associative and takes NULL for nothing before. Blocks are folded one
    by one and then carried on, so a long array is never copied for each of its values.
    """
    nothing = F.array().cast(f"array<{kind}>")
    last = lambda done: F.try_element_at(done, F.lit(-1))
    grown = lambda done, x: F.array_append(done, fold(last(done), x))

    def joined(blocks: Column) -> Column:
        carried = F.aggregate(F.transform(blocks, last), nothing, grown)
        before = F.slice(F.concat(F.array(F.lit(None).cast(kind)), carried), 1, F.size(blocks))
        return F.flatten(
            F.zip_with(blocks, before, lambda block, done: F.transform(block, lambda x: fold(done, x)))
        )

    def folded(array: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(array), F.lit(RUN_BLOCK))
        blocks = F.transform(starts, lambda at: F.aggregate(F.slice(array, at, F.lit(RUN_BLOCK)), nothing, grown))
        return F.when(F.size(array) > 0, let(blocks, joined)).otherwise(nothing)

    return let(values, folded)


def match_spans(
    text: Column, pattern: str, rank: int,
    kept: Callable[[Column], Column] | None = None, there: Column | None = None,
) -> Column:
    """Spans of the matches that ``kept`` keeps of all found ones (an array of booleans).

    Places are code points, the end is exclusive. What lies between matches and the
    matches themselves alternate, so running sums of their lengths give the places.
    Texts of which ``there`` is not true are passed over.
    """
    def placed(found: Column) -> Column:
        steps = F.zip_with(
            F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
            lambda gap, match: (F.length(gap) + F.length(match)).cast("bigint"),
        )
        ends = running(steps, "bigint", lambda done, x: F.coalesce(done, F.lit(0).cast("bigint")) + x)
        spans = F.zip_with(
            ends, found,
            lambda end, match: F.struct((end - F.length(match)).alias("start"), F.lit(rank).alias("rank"), end.alias("end")),
        )
        if kept is None:
            return spans
        tested = F.zip_with(spans, kept(found), lambda span, good: F.struct(span.alias("span"), good.alias("good")))
        return F.transform(F.filter(tested, lambda t: t["good"]), lambda t: t["span"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(there if there is not None else text.rlike(pattern), let(found, placed)).otherwise(
        F.array().cast(SPAN_TYPE)
    )


def apart_from(spans: Column, others: Column) -> Column:
    """Those ``spans`` (which do not overlap each other) that meet none of ``others``.

    Both are walked once, in the order of their starts.
    """
    rank_of_span = F.lit(1 << 30)
    tagged = F.array_sort(
        F.concat(
            F.transform(others, lambda o: F.struct(o["start"].alias("start"), F.lit(0).alias("own"), o["end"].alias("end"), o["rank"].alias("rank"))),
            F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank_of_span.alias("own"), s["end"].alias("end"), s["rank"].alias("rank"))),
        )
    )
    def free(tagged: Column) -> Column:
        end_before = running(
            F.transform(tagged, lambda t: F.when(t["own"] == 0, t["end"])), "bigint", lambda done, x: F.greatest(done, x)
        )
        start_after = F.reverse(running(
            F.reverse(F.transform(tagged, lambda t: F.when(t["own"] == 0, t["start"]))), "bigint",
            lambda done, x: F.least(done, x),
        ))
        tested = F.zip_with(
            tagged, F.zip_with(end_before, start_after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            lambda t, near: F.struct(
                t.alias("t"),
                ((t["own"] != 0) & (F.coalesce(near["a"], t["start"]) <= t["start"])
                 & (F.coalesce(near["b"], t["end"]) >= t["end"])).alias("free"),
            ),
        )
        return F.transform(
            F.filter(tested, lambda x: x["free"]),
            lambda x: F.struct(x["t"]["start"].alias("start"), x["t"]["rank"].alias("rank"), x["t"]["end"].alias("end")),
        )

    return let(tagged, free)


def joined_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    named = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.element_at(F.array(*[F.lit(k) for k in kinds]), s["rank"]), s["start"], s["end"]
        ),
    )
    return F.array_join(named, ",")
