"""Quality by histogram gradient-boosted trees over document statistics.

Each text becomes a short vector of statistics. The trees split on histogram
bins, and the fitted forest is kept as flat arrays, so a batch of documents walks
all trees with a few numpy steps.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, bounded_sample

BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15
#: At most so many labelled documents are learnt from.
SAMPLE = 12_000

STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "top_word",
    "letters", "capitals", "digits", "blanks", "marks", "symbols", "beyond_ascii",
    "bars", "exclamations", "hashes", "percents", "full_stops", "commas",
    "lines", "distinct_lines", "line_length", "capital_words", "one_letter_words",
    "marked_words", "repeated_pairs",
)

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LETTER = _UPPER | ((_CODES >= 97) & (_CODES <= 122))
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_BLANK = np.isin(_CODES, [32, 9, 10, 11, 12, 13])
_BEYOND = _CODES >= 128
_SENTENCE = np.isin(_CODES, [ord(c) for c in ".,;:!?'\"-()"])
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK | _BEYOND | _SENTENCE)


def statistics(text: str) -> list[float]:
    """The statistics of a whole text; an empty one gives zeros."""
    data = text.encode("utf-8", "replace")
    size = len(data)
    words = text.split()
    if not words:
        return [float(np.log1p(size))] + [0.0] * (len(STATISTICS) - 1)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = lambda mask: counts[mask].sum() / size
    one = lambda c: counts[ord(c)] / size
    n = len(words)
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = text.split("\n")
    pairs = n - len(set(zip(words, words[1:]))) - 1 if n > 1 else 0
    sizes = [len(w) for w in tally]
    return [
        np.log1p(size), np.log1p(n), size / n, max(sizes), len(tally) / n, max(tally.values()) / n,
        share(_LETTER), share(_UPPER), share(_DIGIT), share(_BLANK), share(_SENTENCE),
        share(_SYMBOL), share(_BEYOND),
        one("|"), one("!"), one("#"), one("%"), one("."), one(","),
        np.log1p(len(lines)), len(set(lines)) / len(lines), size / len(lines),
        sum(c for w, c in tally.items() if w[0].isupper()) / n,
        sum(c for w, c in tally.items() if len(w) == 1) / n,
        sum(c for w, c in tally.items() if not w[-1].isalnum()) / n,
        pairs / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: ``feature`` and ``cut`` per inner node, ``value`` per leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
    least_weight: float = 2.0, ridge: float = 1.0,
) -> Forest:
    """Boost logistic loss. A node that cannot gain passes everything to the left."""
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(y), base)
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), dtype=np.int32)
    cut = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-raw))
        slope, weight = y - chance, chance * (1 - chance)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = node - first
            best = np.zeros(count)
            cut_bin = np.full(count, BINS + 1)
            for f, bins in enumerate(binned):
                width = len(edges[f]) + 1
                key = place * width + bins
                g = np.bincount(key, slope, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(key, weight, count * width).reshape(count, width).cumsum(1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = (
                    g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge)
                    - whole_g**2 / (whole_h + ridge)
                )
                gain[(h < least_weight) | (whole_h - h < least_weight)] = 0
                at = gain[:, :-1].argmax(1) if width > 1 else np.zeros(count, dtype=int)
                found = gain[np.arange(count), at]
                better = found > best + 1e-9
                best[better] = found[better]
                for k in np.flatnonzero(better):
                    feature[tree, first + k] = f
                    cut[tree, first + k] = edges[f][at[k]]
                    cut_bin[k] = at[k]
            right = binned[feature[tree, node], np.arange(len(y))] > cut_bin[place]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, slope, leaves)
        h = np.bincount(leaf, weight, leaves)
        value[tree] = rate * g / (h + ridge)
        raw += value[tree][leaf]
    return Forest(feature, cut, value, base)


def forest_scores(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Probabilities of a batch: all rows step down all trees at once."""
    rows = np.arange(len(x))[:, None]
    trees = np.arange(len(forest.feature))[None, :]
    node = np.zeros((len(x), len(forest.feature)), dtype=np.int64)
    inner = forest.feature.shape[1]
    while len(x) and node[0, 0] < inner:
        right = x[rows, forest.feature[trees, node]] > forest.cut[trees, node]
        node = 2 * node + 1 + right
    raw = forest.base + forest.value[trees, node - inner].sum(1)
    return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def is_held_out(doc_id: str = "doc_id"):
    """Every third id by crc32; a NULL id counts as its text ``null``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, text: str = "text") -> Forest | None:
    """Fit on up to ``size`` labelled documents that are not held out.

    A document with several labels has the larger one. The sample is fixed by a
    hash of the id, and only its statistics reach the driver. None without both
    classes.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~is_held_out()).groupBy(
        "doc_id"
    ).agg(F.max("quality").alias("label"))
    chosen = bounded_sample(known, size, F.col("doc_id"), seed=5)
    sample = docs.select("doc_id", body(text).alias("text")).join(chosen, "doc_id")

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    rows = sample.select("doc_id", "label", measured("text").alias("x")).toPandas()
    if rows["label"].nunique() < 2:
        return None
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist())
    return fit_forest(x, rows["label"].to_numpy(dtype=float))


def score_documents(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, repeated ones included.

    NULL and empty texts are scored by their (zero) statistics. Without a forest
    the score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if shared.value is None or not len(texts):
            return pd.Series([0.5] * len(texts), dtype="float64")
        x = np.array([statistics(t) for t in texts])
        parts = [forest_scores(shared.value, x[i : i + 1000]) for i in range(0, len(x), 1000)]
        return pd.Series(np.concatenate(parts))

    return (
        docs.select("doc_id", is_held_out().alias("held_out"), scored(body(text)).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
