"""Personal data: fixed patterns, and terms that give a protected entity away.

What the patterns find are the protected entities. How strongly a term reveals
one is estimated from the corpus: the pointwise mutual information of the term
and the entity, as a share of the entity's own information. With ``n`` texts that
differ, of which ``d(x)`` hold ``x``,

    information(e) = log2(n / d(e))
    disclosure(e, t) = log2(n d(e, t) / (d(e) d(t))) / information(e)

A term that stands only where the entity does discloses all of it (1); a term as
frequent elsewhere discloses nothing (0). Terms above a bound are generalised to
a typed placeholder, or removed.

Everything is column expressions, grouping and joins; texts are never shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import SPAN_TYPE, apart_from, body, joined_spans, match_spans, running
from spinneret.operators.joins import lookup_join
from spinneret.operators.scratch import settle

# Kinds in their order, and their patterns. A match starts where its
# first run of characters does, or where the match before it ended.
KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{0,2})(?:\.|$)){4}"
LONG_NUMBER = r"[0-9](?:[\x20-]?[0-9]){11}"
TERM = r"[\p{L}\p{N}]+"

#: Characters on either side of an entity that belong to its context.
CONTEXT = 80
LEAST_LETTERS = 3
#: An entity, and a term with it, must stand in so many different texts.
SUPPORT = 3
#: Share of an entity's information that a term may reveal, and the bits it must have
#: to need protection: what stands in a 64th of all texts is no secret.
DISCLOSURE = 0.8
LEAST_BITS = 6.0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))


def base_kinds(text: Column) -> list[tuple[str, Column, Column]]:
    """Pattern, test of all matches, and whether a text may have any, by kind."""
    return [
        (EMAIL, lambda found: F.transform(found, lambda m: F.lit(True)), F.contains(text, F.lit("@"))),
        (IP, lambda found: F.transform(found, lambda m: m.rlike(PARTS)), text.rlike(IP)),
        (CARD, lambda found: F.transform(found, _is_card), text.rlike(LONG_NUMBER)),
        (PHONE, lambda found: F.transform(found, lambda m: F.length(_digits(m)).between(9, 15)),
         F.contains(text, F.lit("+"))),
    ]


def with_base_spans(docs: DataFrame, content: str) -> DataFrame:
    """``docs`` with one array of spans for each pattern."""
    found = docs
    for rank, (name, (pattern, kept, there)) in enumerate(zip(KINDS, base_kinds(F.col(content))), 1):
        found = found.withColumn(f"_{name}", match_spans(F.col(content), pattern, rank, kept, there))
    return found


# What reveals an entity

def _key(content: Column) -> list[Column]:
    return [F.xxhash64(content).alias("k0"), F.xxhash64(F.lit(12), content).alias("k1")]


def entity_contexts(texts: DataFrame, context: int = CONTEXT) -> DataFrame:
    """``k0, k1, entity, around`` of every entity in ``texts (content)``.

    The context reaches ``context`` characters to both sides, up to the next match
    of the pattern; words that its outer ends cut are left out.
    """
    text = F.col("content")
    frames = []
    for rank, (pattern, kept, there) in enumerate(base_kinds(text), 1):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        gaps = F.split(text, pattern, -1)
        cut = lambda gap: F.length(gap) > context
        before = lambda gap: F.when(
            cut(gap), F.regexp_replace(F.right(gap, F.lit(context)), r"^[\p{L}\p{N}]+", "")).otherwise(gap)
        after = lambda gap: F.when(
            cut(gap), F.regexp_replace(F.left(gap, F.lit(context)), r"[\p{L}\p{N}]++$", "")).otherwise(gap)
        left = F.transform(F.slice(gaps, 1, F.size(found)), before)
        right = F.transform(F.slice(gaps, 2, F.size(found)), after)
        around = F.zip_with(left, right, lambda a, b: F.concat_ws("\n", a, b))
        value = F.transform(found, lambda m: F.lower(m) if rank == 1 else _digits(m) if rank > 2 else m)  # noqa: B023
        rows = F.arrays_zip(value.alias("value"), around.alias("around"), kept(found).alias("kept"))
        frames.append(
            texts.where(there).select("k0", "k1", F.explode(rows).alias("m")).where("m.kept").select(
                "k0", "k1", F.concat_ws(":", F.lit(KINDS[rank - 1]), "m.value").alias("entity"), "m.around"
            )
        )
    total = frames[0]
    for frame in frames[1:]:
        total = total.unionByName(frame)
    return total


def terms_of(text: Column, least: int = LEAST_LETTERS) -> Column:
    """The different terms of a text, in lower case."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))
    return F.filter(words, lambda w: F.length(w) >= least)


def disclosures(
    docs: DataFrame, text: str = "text", context: int = CONTEXT, support: int = SUPPORT,
    least_bits: float = LEAST_BITS, least: float | None = None,
) -> DataFrame:
    """``entity, term, d_entity, d_term, d_both, n, disclosure, k0, k1``: a row for each
    text in whose context of the entity the term stands.

    Copies of a text count once. All statistics cover all texts; those of terms are
    only counted for terms that stand beside an entity in ``support`` texts. With ``least``
    pairs that cannot disclose so much are left out, and their terms are not looked up
    in all texts: a term stands in no fewer texts than beside entities of any kind, protected or
    not, which bounds what it discloses. No pair that reaches ``least`` is lost.
    """
    texts = docs.select(body(text).alias("content")).select(*_key(F.col("content")), "content")
    keys = settle(texts.groupBy(F.struct("k0", "k1").alias("key")).agg(F.count("*").alias("copies")))
    total = keys.count()
    found = settle(entity_contexts(texts, context))
    held = found.select("entity", "k0", "k1").distinct().groupBy("entity").agg(F.count("*").alias("d_entity"))
    bits = F.log2(F.lit(float(max(total, 1))) / F.col("d_entity"))
    protected = settle(held.where((F.col("d_entity") >= support) & (bits >= least_bits)))
    beside = settle(
        lookup_join(found, protected, "entity", "inner")
        .select("entity", "d_entity", "k0", "k1", F.explode(terms_of(F.col("around"))).alias("term")).distinct()
    )
    pairs = settle(
        beside.groupBy("entity", "term").agg(F.first("d_entity").alias("d_entity"), F.count("*").alias("d_both"))
        .where(F.col("d_both") >= support)
    )
    n = F.lit(float(max(total, 1)))
    if least is not None:
        near = found.select("k0", "k1", F.explode(terms_of(F.col("around"))).alias("term"))
        held_by = (
            lookup_join(near, settle(pairs.select("term").distinct()), "term", "inner")
            .distinct().groupBy("term").agg(F.count("*").alias("d_beside"))
        )
        most = F.log2(n * F.col("d_both") / (F.col("d_entity") * F.col("d_beside").cast("double")))
        needed = F.lit(least) * F.log2(n / F.col("d_entity")) - 1e-9
        pairs = settle(pairs.join(held_by, "term").where(most >= needed).drop("d_beside"))
    wanted = settle(pairs.select("term").distinct())
    each = texts.select(F.struct("k0", "k1").alias("key"), F.explode(terms_of(F.col("content"))).alias("term"))
    marked = lookup_join(
        lookup_join(each, wanted, "term", "inner"), keys.where(F.col("copies") > 1), "key", "left"
    )
    # Only of texts with copies must each be told apart; all others are counted in their task.
    copied = F.when(F.col("copies").isNotNull(), F.col("key")).alias("copied")
    counts = (
        marked.groupBy("term", copied).agg(F.count("*").alias("rows"))
        .groupBy("term").agg(F.sum(F.when(F.col("copied").isNull(), F.col("rows")).otherwise(1)).alias("d_term"))
    )
    known = settle(
        pairs.join(counts, "term").withColumn("n", F.lit(total).cast("bigint")).withColumn(
            "disclosure",
            F.log2(n * F.col("d_both") / (F.col("d_entity") * F.col("d_term").cast("double")))
            / F.log2(n / F.col("d_entity")),
        )
    )
    return known.join(beside.select("entity", "term", "k0", "k1"), ["entity", "term"])


def revealing_terms(docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, **options) -> DataFrame:
    """``key, terms``: by text, the terms that disclose an entity of it.

    There are at most as many as the contexts of that text hold.
    """
    found = disclosures(docs, text, least=disclosure, **options).where(F.col("disclosure") >= disclosure)
    return settle(
        found.groupBy(F.struct("k0", "k1").alias("key")).agg(F.collect_set("term").alias("terms"))
    )


# Scan

def scan_personal(docs: DataFrame, revealing: DataFrame, text: str = "text") -> DataFrame:
    """Per document ``doc_id, content``, the spans of each kind, ``base`` and ``added``.

    Patterns are matched leftmost and without overlap per kind; matches that fail
    their test go, without another try inside them. ``added`` are the revealing
    terms of the text wherever they stand in it, but for those that meet a base span.

    A NULL or empty text has no span; repeated rows, and rows with equal or NULL
    ``doc_id``, stay as they are. Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col("doc_id").alias("doc_id"), body(text).alias("content"))
    keyed = texts.withColumn("key", F.struct(*_key(F.col("content"))))
    told = with_base_spans(lookup_join(keyed, revealing, "key", "left"), "content")
    base = [f"_{k}" for k in KINDS[:-1]]
    term = match_spans(
        F.col("content"), TERM, len(KINDS),
        lambda found: F.transform(found, lambda w: F.array_contains(F.col("terms"), F.lower(w))),
        F.col("terms").isNotNull(),
    )
    met = told.withColumn("base", F.array_sort(F.concat(*base))).withColumn("_term", term)
    added = F.when(F.size("_term") > 0, apart_from(F.col("_term"), F.col("base")))
    return met.select(
        "doc_id", "content", *[F.col(f"_{k}").alias(k) for k in KINDS[:-1]], "base",
        F.coalesce(added, F.array().cast(SPAN_TYPE)).alias("added"),
    )


def personal_spans(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``scan_personal`` with the terms that ``docs`` themselves show to be revealing.

    An empty table gives no rows.
    """
    return scan_personal(docs, revealing_terms(docs, text, **options), text)


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``doc_id, sanitised``: texts whose personal data and revealing terms are replaced.

    Base spans and terms with a general kind (numbers, capitalised words) become a
    placeholder such as ``<email>``; other terms are removed. Of spans that overlap,
    the first one stands for all. NULL texts come out empty.
    """
    found = personal_spans(docs, text, **options).withColumn("_all", F.array_sort(F.concat("base", "added")))
    spans = F.col("_all")
    ends = F.transform(spans, lambda s: s["end"])
    furthest = running(ends, "bigint", lambda done, x: F.greatest(done, x))
    covered = F.concat(F.array(F.lit(0).cast("bigint")), furthest)
    letters = F.split("content", "")
    cut = lambda a, b: F.array_join(F.slice(F.col("_letters"), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")), "")
    word = lambda s: cut(s["start"], s["end"])
    general = lambda s: (
        F.when(s["rank"] < len(KINDS), F.concat(F.lit("<"), F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"]), F.lit(">")))
        .when(word(s).rlike(r"^\p{N}+$"), F.lit("<number>")).when(word(s).rlike(r"^\p{Lu}"), F.lit("<name>")).otherwise(F.lit(""))
    )
    parts = F.zip_with(
        spans, F.slice(F.col("_covered"), 1, F.size(spans)),
        lambda s, done: F.when(s["start"] >= done, F.concat(cut(done, s["start"]), general(s))).otherwise(F.lit("")),
    )
    rest = cut(F.element_at("_covered", -1), F.length("content").cast("bigint"))
    return (
        found.withColumn("_covered", covered).withColumn("_letters", letters)
        .select("doc_id", F.when(F.size(spans) == 0, F.col("content")).otherwise(
            F.concat(F.array_join(parts, ""), rest)).alias("sanitised"))
    )


def digest_columns(found: DataFrame) -> DataFrame:
    """``doc_id``, counts by kind, a digest of the base spans, and all spans in order."""
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:-1]],
        F.sha2(joined_spans(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined_spans(F.array_sort(F.concat("base", "added")), KINDS).alias("spans"),
        F.size("added").cast("bigint").alias("n_terms"),
    )
