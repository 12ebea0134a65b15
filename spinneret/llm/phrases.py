"""Phrase collocations from a weighted de Bruijn graph.

Nodes are runs of three words, edges runs of four; an edge weighs as often as its
run occurs. Only edges are counted, and the last run of three, two and one words
of every piece. The count of a shorter run is the flow through its node: what goes
on along edges, plus the pieces that end there.

A phrase can only occur ``least`` times when all pairs of neighbouring words in it
do. So pairs are counted first by a hash, and pieces are cut between words whose
hash falls short; frequent phrases keep all their occurrences, whatever collides.
Words are 64-bit hashes whose collisions are looked for and avoided by another seed.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spinneret.llm.columns import body
from spinneret.operators.scratch import settle

WORDS = 4
LEAST = 30
#: A phrase goes when a longer one has at least so many hundredths of its occurrences.
COVERED = 80
SCALE = 2_000_000
NO_LANGUAGE = "und"
#: Words that a task holds before it counts them, and bytes of text taken at once.
HELD_WORDS = 3 << 18
TEXT_AT_ONCE = 1 << 21
#: Words whose hashes a task remembers between two counts.
KNOWN_WORDS = 150_000
#: Rows that go to Spark at once.
ROWS_AT_ONCE = 1 << 15
#: The filter of frequent pairs has 2^n bits, about 16 for each pair.
FILTER_BITS = (16, 26)

MARK = b"."
BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", MARK * 9)
# Odd factors that mix the hashes of neighbouring words.
FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64
)
KEYS = [f"w{i + 1}" for i in range(WORDS)]


# Counting inside a task

class _Words:
    """Hashes of words, with the words they stand for."""

    def __init__(self, seed: int):
        self.seed, self.known, self.names = seed, {MARK: 0}, {}

    def ids(self, texts: list[str]) -> np.ndarray:
        """Hashes of all words in order; 0 between pieces."""
        data = b" . ".join(t.encode("utf-8", "surrogatepass") for t in texts)
        words = data.lower().translate(BREAKS).replace(MARK, b" . ").split()
        known = self.known
        for word in set(words) - known.keys():
            key = int(np.uint64(xxhash.xxh64_intdigest(word, self.seed) or 1).view(np.int64))
            known[word] = key
            self.names[key] = word
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def forget(self) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known, self.names = {MARK: 0}, {}


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    """One unsigned 64-bit number for each row of word hashes."""
    total = np.zeros(len(columns[0]), dtype=np.uint64)
    for column, factor in zip(columns, FACTORS):
        total += column.view(np.uint64) * factor
    return total ^ (total >> np.uint64(31))


def counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often they occur."""
    if not len(columns[0]):
        return columns, np.zeros(0, dtype=np.int64)
    order = np.argsort(mixed(columns))
    rows = [c[order] for c in columns]
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for row in rows:
        new[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(new)  # a row whose mix collides may come out twice, which sums mend
    return [r[first] for r in rows], np.diff(np.append(first, len(order)))


def _by_language(
    batches: Iterator[pa.RecordBatch], seed: int, emit: Callable[[str, np.ndarray, _Words], Iterator]
) -> Iterator[pa.RecordBatch]:
    """Hand the word hashes of each language to ``emit``, many at once."""
    words = _Words(seed)
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush():
        while held:
            lang, parts = held.popitem()
            for rows in emit(lang, np.concatenate([*parts, np.zeros(1, dtype=np.int64)]), words):
                for at in range(0, rows.num_rows, ROWS_AT_ONCE):
                    yield rows.slice(at, ROWS_AT_ONCE)
        words.forget()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        at = 0
        while at < batch.num_rows:
            stop, taken = at, 0
            texts: dict[str, list[str]] = {}
            while stop < batch.num_rows and taken < TEXT_AT_ONCE:
                text = batch.column("text")[stop].as_py()
                texts.setdefault(langs[stop], []).append(text)
                taken += len(text)
                stop += 1
            for lang, some in texts.items():
                ids = words.ids(some)
                held.setdefault(lang, []).extend([np.zeros(1, dtype=np.int64), ids])
                size += len(ids)
            at = stop
            if size >= HELD_WORDS:
                yield from flush()
                size = 0
    yield from flush()


def _words_and_pairs(lang: str, ids: np.ndarray, words: _Words) -> Iterator[pa.RecordBatch]:
    """Words with their count, and pairs of neighbours by their mix alone."""
    def batch(keys: np.ndarray, names: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), names, pa.array(keys), pa.array(n, pa.int64())],
            names=["lang", "word", "key", "n"],
        )

    keys, n = np.unique(ids[ids != 0], return_counts=True)
    names = pa.array([words.names[k] for k in keys.tolist()], pa.binary()).cast(pa.string())
    yield batch(keys, names, n)
    both = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
    pairs, n = np.unique(mixed([ids[both], ids[both + 1]]).view(np.int64), return_counts=True)
    yield batch(pairs, pa.nulls(len(pairs), pa.string()), n)


def graph_rows(ids: np.ndarray, linked: np.ndarray) -> list[np.ndarray]:
    """Four columns: every edge, and the last runs of each piece filled up with 0.

    ``linked`` tells whether a word and the next one are in the same piece.
    """
    at = np.arange(len(ids))
    before = [np.concatenate([np.zeros(k, dtype=bool), linked[: len(linked) - k]]) for k in (1, 2)]
    after = [np.concatenate([linked[k:], np.zeros(k, dtype=bool)]) for k in (1, 2)]
    end = (ids != 0) & ~linked
    runs = [
        (at[linked & after[0] & after[1]], 4),
        (at[end & before[0] & before[1]] - 2, 3),
        (at[end & before[0]] - 1, 2),
        (at[end], 1),
    ]
    nothing = lambda starts: np.zeros(len(starts), dtype=np.int64)
    return [
        np.concatenate([ids[starts + i] if i < n else nothing(starts) for starts, n in runs])
        for i in range(WORDS)
    ]


def _edges_of(bits: bytes) -> Callable:
    """Counts of graph rows; pairs outside the filter are cut apart."""
    table = np.frombuffer(bits, dtype=np.uint8)
    mask = np.uint64(8 * len(table) - 1)

    def emit(lang: str, ids: np.ndarray, words: _Words) -> Iterator[pa.RecordBatch]:
        linked = np.zeros(len(ids), dtype=bool)
        both = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        cells = (mixed([ids[both], ids[both + 1]]) & mask).astype(np.int64)
        linked[both] = (table[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 != 0
        rows, n = counted(graph_rows(ids, linked))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), *[pa.array(r) for r in rows], pa.array(n, pa.int64())],
            names=["lang", *KEYS, "n"],
        )

    return emit


# The graph as tables

def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), body(text).alias("text")
    )


def count_words(docs: DataFrame, least: int, seed: int = 0) -> tuple[DataFrame, int]:
    """``lang, word, key, n`` of all words, and with a NULL word of all pairs (by a mix of
    their hashes) that may occur ``least`` times; the seed under which no two words
    of a language have one hash.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_language(batches, seed, _words_and_pairs)

    found = settle(
        docs.mapInArrow(counts, "lang string, word string, key bigint, n bigint")
        .groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))
        .where(F.col("word").isNotNull() | (F.col("n") >= least))
    )
    same = found.where(F.col("word").isNotNull()).groupBy("lang", "key").count()
    if same.where(F.col("count") > 1).isEmpty():
        return found, seed
    return count_words(docs, least, seed + 1)


def pair_filter(pairs: DataFrame) -> bytes:
    """A bit for every ``key``; the size is bounded, so some other keys have theirs set too."""
    total = pairs.count()
    low, high = FILTER_BITS
    bits = min(high, max(low, int(16 * total).bit_length()))
    cell = F.col("key").bitwiseAND((1 << bits) - 1)
    blocks = pairs.groupBy(F.shiftright(cell, 15).alias("block")).agg(
        F.bitmap_construct_agg(cell.bitwiseAND(32767)).alias("bits")
    )
    table = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in blocks.collect():  # at most 2^11 blocks of 4 KB
        table[row["block"] * 4096 : (row["block"] + 1) * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table.tobytes()


def frequent_runs(docs: DataFrame, pairs: DataFrame, least: int, seed: int) -> DataFrame:
    """``lang, w1..w4, n``: runs of up to four words that occur ``least`` times, exactly.

    Shorter runs end in 0. Edges are aggregated first; nodes and what is shorter
    get the flow of the rows that begin with them.
    """
    bits = docs.sparkSession.sparkContext.broadcast(pair_filter(pairs))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_language(batches, seed, _edges_of(bits.value))

    schema = ", ".join(["lang string", *[f"{k} bigint" for k in KEYS], "n bigint"])
    rows = settle(docs.mapInArrow(edges, schema).groupBy("lang", *KEYS).agg(F.sum("n").alias("n")))
    levels = []
    for size in range(1, WORDS + 1):
        begun = rows.where(F.col(KEYS[size - 1]) != 0)
        flow = begun.groupBy("lang", *KEYS[:size]).agg(F.sum("n").alias("n")) if size < WORDS else begun
        padded = [F.col(k) if i < size else F.lit(0).cast("bigint").alias(k) for i, k in enumerate(KEYS)]
        levels.append(flow.where(F.col("n") >= least).select("lang", *padded, "n"))
    union = levels[0]
    for level in levels[1:]:
        union = union.unionByName(level)
    return settle(union)


def compact_paths(runs: DataFrame) -> DataFrame:
    """``lang, words, n``: the edges of ``runs``, joined through nodes with one way in and out.

    An edge that weighs as much as the flow of the node it enters is the only way
    in, and no piece begins there; likewise for the way out. Such edges are
    chained by pointer doubling, in as many rounds as the longest path has bits. A path lies
    within a piece. Ends of pieces keep a path from closing into a ring.
    """
    edges = settle(runs.where(F.col("w4") != 0).withColumn("id", F.monotonically_increasing_id()))
    nodes = runs.where((F.col("w3") != 0) & (F.col("w4") == 0)).select("lang", "w1", "w2", "w3", "n")
    node = F.struct("lang", "w2", "w3", "w4", "n").alias("node")
    into = edges.select(node, F.col("id").alias("before"))
    out = edges.select(F.struct("lang", "w1", "w2", "w3", "n").alias("node"), "id")
    unary = nodes.select(
        F.struct("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), "n").alias("node")
    )
    out = out.select(
        F.struct(
            F.col("node.lang").alias("lang"), F.col("node.w1").alias("w2"), F.col("node.w2").alias("w3"),
            F.col("node.w3").alias("w4"), F.col("node.n").alias("n"),
        ).alias("node"), "id",
    )
    links = unary.join(into, "node").join(out, "node").select("id", "before")
    state = settle(
        edges.select("id").join(links, "id", "left").select(
            "id", F.coalesce("before", "id").alias("head"), F.col("before").isNotNull().cast("bigint").alias("place")
        )
    )
    while True:
        ahead = state.where(F.col("place") > 0).select(
            F.col("id").alias("head"), F.col("head").alias("further"), F.col("place").alias("more")
        )
        moved = settle(
            state.join(ahead, "head", "left").select(
                "id", F.coalesce("further", "head").alias("head"),
                (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"), F.col("further").isNotNull().alias("moved"),
            )
        )
        state = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    along = edges.join(state, "id").groupBy("lang", "head").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", *KEYS))).alias("steps")
    )
    first = F.element_at("steps", 1)
    start = F.array(*[first[k] for k in KEYS[:-1]])
    return along.select(
        "lang", F.concat(start, F.transform("steps", lambda s: s[KEYS[-1]])).alias("words"), "n"
    )


# Candidates and scores

def _padded(words: list[Column]) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    return [(words[i] if i < len(words) else zero).alias(f"p{i + 1}") for i in range(WORDS)]


def _pieces_of(runs: DataFrame, size: int, cut: Callable) -> DataFrame:
    """``runs`` of ``size`` words with one row per struct that ``cut`` lists."""
    held = runs.where(F.col(KEYS[size - 1]) != 0)
    if size < WORDS:
        held = held.where(F.col(KEYS[size]) == 0)
    words = [F.col(k) for k in KEYS[:size]]
    return held.withColumn("part", F.explode(F.array(*cut(words)))).select("lang", *KEYS, "n", "part.*")


def _cuts(words: list[Column]) -> list[Column]:
    return [
        F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), *_padded(part))
        for k in range(1, len(words)) for side, part in (("l", words[:k]), ("r", words[k:]))
    ]


def _inner(words: list[Column]) -> list[Column]:
    return [
        F.struct(*_padded(words[a : a + size]))
        for size in range(2, len(words)) for a in range(len(words) - size + 1)
    ]


def _union(frames: list[DataFrame]) -> DataFrame:
    total = frames[0]
    for frame in frames[1:]:
        total = total.unionByName(frame)
    return total


def scored_candidates(runs: DataFrame, paths: DataFrame, covered: int = COVERED, scale: int = SCALE) -> DataFrame:
    """``lang, w1..w4, a, l, r, score`` of the runs of two words and more that stay.

    What lies inside a longer run with enough of its occurrences goes; nodes within
    a compacted path do so unseen.
    """
    held = ["lang", *KEYS]
    longer = _union([_pieces_of(runs, size, _inner) for size in range(3, WORDS + 1)])
    most = longer.groupBy("lang", *[f"p{i + 1}" for i in range(WORDS)]).agg(F.max("n").alias("most"))
    most = most.select("lang", *[F.col(f"p{i + 1}").alias(k) for i, k in enumerate(KEYS)], "most")
    inside = (
        paths.where(F.size("words") > WORDS)
        .select("lang", F.explode(F.expr("transform(sequence(2, size(words) - 3), i -> slice(words, i, 3))")).alias("node"))
        .select("lang", *[F.element_at("node", i + 1).alias(k) for i, k in enumerate(KEYS[:3])],
                F.lit(0).cast("bigint").alias(KEYS[3]))
    )
    candidates = runs.where(F.col("w2") != 0).join(inside, held, "left_anti")
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    covers = F.lit(100) * whole("most") >= F.lit(covered) * whole("n")
    kept = settle(
        candidates.join(most, held, "left").where(~F.coalesce(covers, F.lit(False))).select(*held, "n")
    )
    parts = _union([_pieces_of(kept, size, _cuts) for size in range(2, WORDS + 1)])
    counts = runs.select("lang", *[F.col(k).alias(f"p{i + 1}") for i, k in enumerate(KEYS)], F.col("n").alias("f"))
    sides = parts.join(counts, ["lang", *[f"p{i + 1}" for i in range(WORDS)]])
    cuts = sides.groupBy(*held, "n", "k").agg(
        F.sum(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
        F.sum(F.when(F.col("side") == "r", F.col("f"))).alias("r"),
    )
    score = F.expr(f"({scale}BD * CAST(n AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = cuts.groupBy(*held, "n").agg(
        F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r")).alias("cut")
    )
    return lowest.select(*held, F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def spelt(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``phrase``, its words joined by blanks."""
    names = words.select("lang", F.col("key").alias("w"), "word")
    each = found.select("*", F.posexplode(F.array(*[F.col(k) for k in KEYS])).alias("place", "w")).where(F.col("w") != 0)
    others = [c for c in found.columns if c not in ("lang", *KEYS)]
    joined = each.join(names, ["lang", "w"]).groupBy("lang", *KEYS).agg(
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelling"),
        *[F.first(c).alias(c) for c in others],
    )
    return joined.withColumn(
        "phrase", F.array_join(F.transform("spelling", lambda s: s["word"]), " ")
    ).drop("spelling")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = 2000, text: str = "text", lang: str = "lang",
    covered: int = COVERED, scale: int = SCALE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line breaks, words stand between
    blanks and tabs. Phrases of 2 to 4 words with ``a`` of at least ``least``
    occurrences are scored by ``scale * a / (l + r)``, floored, at their worst cut
    (the earliest of equal ones), where ``l`` and ``r`` count the two parts. Phrases inside a longer one with ``covered``
    hundredths of their occurrences go. Equal scores are ordered by ``a``, then by phrase.

    A NULL text is empty, a NULL language ``und``; repeated rows count as often as they
    occur, other columns are not read, an empty table gives no rows. Long texts are
    taken whole; a task holds one batch of texts and ``HELD_WORDS`` word hashes.
    """
    texts = _texts(docs, text, lang)
    counts, seed = count_words(texts, least)
    words = counts.where(F.col("word").isNotNull())
    runs = frequent_runs(texts, counts.where(F.col("word").isNull()).select("key"), least, seed)
    found = spelt(scored_candidates(runs, compact_paths(runs), covered, scale), words)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))  # one row per language
    best_first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best_first).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def repeated_passages(docs: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, passage, n_words, n``: the compacted paths in words, passages longer than four
    words among them. Same rules on rows and columns as ``collocations``."""
    texts = _texts(docs, text, lang)
    counts, seed = count_words(texts, least)
    runs = frequent_runs(texts, counts.where(F.col("word").isNull()).select("key"), least, seed)
    paths = settle(compact_paths(runs).withColumn("path", F.monotonically_increasing_id()))
    names = counts.where(F.col("word").isNotNull()).select("lang", F.col("key").alias("w"), "word")
    each = paths.select("lang", "path", "n", F.posexplode("words").alias("place", "w")).join(names, ["lang", "w"])
    return each.groupBy("lang", "path", "n").agg(
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelling")
    ).select(
        "lang", F.array_join(F.transform("spelling", lambda s: s["word"]), " ").alias("passage"),
        F.size("spelling").cast("bigint").alias("n_words"), "n",
    )
