"""Toxicity grades by cumulative-link ordinal regression.

The chance that a document is at least of grade k is ``logistic(w.x - theta_k)``:
one weight vector for sparse text features, shared by ordered thresholds. The
score is the expected grade. Features are the words of a document and the
beginnings of its words, each present or not.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.columns import body, share_of_hash, text_key
from spinneret.operators.scratch import settle

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7, 8)
GRADES = 4
#: About so many toxic documents are learnt from, so many times as many clean ones,
#: and so many features.
SAMPLE = 6000
CLEAN_TIMES = 4
FEATURES = 40_000
#: A feature stands in so many toxic documents, and so many times as often as in clean ones.
LEAST_HELD, LEAST_LIFT = 3, 4.0
#: The cut is found on documents that the weights were not learnt from.
FOLDS = 3
STEPS, DECAY = 600, 1e-3


#: Bytes of text whose features are held at once, and words a task remembers.
TEXT_AT_ONCE = 1 << 21
KNOWN_WORDS = 200_000


@dataclass(frozen=True)
class OrdinalModel:
    #: By the 64-bit hash of a feature.
    weights: dict[int, float]
    thresholds: tuple[float, ...]
    #: A document is toxic when ``w.x`` reaches this.
    cut: float


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings."""
    spelt = [word, *("^" + word[:size] for size in BEGINNINGS if len(word) >= size)]
    return tuple(xxhash.xxh64_intdigest(f.encode("utf-8", "surrogatepass")) - (1 << 63) for f in spelt)


class _Features:
    """Features by word, remembered for a bounded number of words."""

    def __init__(self, chosen: dict[int, float] | None = None):
        self.chosen, self.known = chosen, {}

    def of(self, text: str) -> set[int]:
        """The features of a text; only the chosen ones, if any are."""
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known, chosen = self.known, self.chosen
        found: set[int] = set()
        for word in set(WORD.findall(text.lower())):
            mine = known.get(word)
            if mine is None:
                mine = word_features(word)
                if chosen is not None:
                    mine = tuple(f for f in mine if f in chosen)
                if len(word) <= 40:
                    known[word] = mine
            if mine:
                found.update(mine)
        return found


# Learning

def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``label, text`` of about ``size`` toxic documents and ``CLEAN_TIMES`` as many clean
    ones, the same ones each time. Where ``docs`` has a ``lang``, no language gives more
    than what the others leave.

    A document with several labels counts as toxic if one of them says so; labels
    without a document or without a grade are left out.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("label")
    )
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    spoken = docs.select("doc_id", F.coalesce(lang, F.lit("")).alias("lang")).groupBy("doc_id").agg(
        F.min("lang").alias("lang")
    )
    known = settle(marked.join(spoken, "doc_id"))
    counts = known.groupBy("label", "lang").count()

    def some(label: int, most: int) -> DataFrame:
        rows = known.where(F.col("label") == label)
        cap = _cap([r["count"] for r in counts.where(F.col("label") == label).collect()], most)
        near = rows.join(F.broadcast(counts), ["label", "lang"])
        share = F.lit(float(cap)) / F.col("count")
        return near.where(share_of_hash(F.col("doc_id"), seed=2) < share).select("doc_id", "label")

    wanted = some(0, CLEAN_TIMES * size).unionByName(some(1, size))
    found = docs.select("doc_id", body().alias("text")).join(wanted, "doc_id").select("label", "text")
    # Copies are no further evidence.
    return found.dropDuplicates(["label", "text"])


def _cap(counts: list[int], most: int) -> int:
    """The largest number per group with which all groups give about ``most``."""
    left, cap = most, 0
    for place, count in enumerate(sorted(counts)):
        cap = max(1, left // (len(counts) - place))
        left -= min(count, cap)
    return cap


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``label, features`` of a few documents at a time."""
    known = _Features()
    for batch in batches:
        labels, at = batch.column("label").to_pylist(), 0
        while at < batch.num_rows:
            taken, found, begin = 0, [], at
            while at < batch.num_rows and taken < TEXT_AT_ONCE:
                text = batch.column("text")[at].as_py()
                found.append(np.sort(np.fromiter(known.of(text), dtype=np.int64)))
                taken += len(text)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels[begin:at], pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                names=["label", "features"],
            )


def telling_features(rows: DataFrame, most: int = FEATURES) -> list[int]:
    """Features that toxic documents hold more often than chance would have it.

    Counted by Spark. No test of significance is made: every feature of at least
    ``LEAST_HELD`` toxic documents that is ``LEAST_LIFT`` times as frequent there as in
    clean ones is left to the fit. Only above ``most`` are those with the largest
    log-likelihood ratio taken.
    """
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    counts = rows.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b")
    )
    share = toxic / (toxic + clean)
    held = F.col("a") + F.col("b")

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), held * share) + part(F.col("b"), held * (1 - share)))
    chosen = (
        counts.where((F.col("a") >= LEAST_HELD) & (F.col("a") * clean > LEAST_LIFT * F.col("b") * toxic))
        .orderBy(ratio.desc(), "feature").limit(most)
    )
    return [r["feature"] for r in chosen.select("feature").collect()]


def grades(label: np.ndarray, held: np.ndarray, count: int = GRADES) -> np.ndarray:
    """Severity grades out of two-valued labels: 0 for clean documents, then the toxic
    ones in equal parts by the number of telling features they hold."""
    toxic = label == 1
    result = np.zeros(len(label), dtype=int)
    if toxic.any():
        cuts = np.quantile(held[toxic], np.linspace(0, 1, count)[1:-1])
        result[toxic] = 1 + np.searchsorted(cuts, held[toxic], side="left")
    return result


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, grade: np.ndarray, width: int, count: int = GRADES,
    steps: int = 1200, rate: float = 0.1, decay: float = 3e-5,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ``count - 1`` ordered thresholds by gradient ascent with Adam.

    ``row`` and ``column`` are the places of the ones in the feature matrix.
    """
    n = len(grade)
    w, theta = np.zeros(width), np.arange(1, count, dtype=float)
    moments = [np.zeros(width + count - 1), np.zeros(width + count - 1)]
    for step in range(1, steps + 1):
        eta = np.bincount(row, w[column], n)
        above = np.ones((n, count + 1))
        above[:, 1:count] = 1 / (1 + np.exp(np.clip(theta - eta[:, None], -40, 40)))
        above[:, count] = 0
        at, over = above[np.arange(n), grade], above[np.arange(n), grade + 1]
        chance = np.maximum(at - over, 1e-12)
        slope = 1 - at - over
        gradient = np.zeros(width + count - 1)
        gradient[:width] = np.bincount(column, slope[row], width) / n - decay * w
        low, high = at * (1 - at) / chance, over * (1 - over) / chance
        gradient[width:] = (
            np.bincount(grade, -low, count)[1:] + np.bincount(grade, high, count)[:-1]
        ) / n
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w += move[:width]
        theta = np.maximum.accumulate(theta + move[width:])
    return w, theta


def held_out_sums(row: np.ndarray, column: np.ndarray, label: np.ndarray, width: int) -> np.ndarray:
    """``w.x`` of every document by weights learnt without its part of the documents.

    Each part chooses its features anew, as a feature owed to the documents that are
    judged would tell nothing.
    """
    part = np.random.default_rng(0).permutation(len(label)) % FOLDS
    sums = np.zeros(len(label))
    for fold in range(FOLDS):
        learnt = part != fold
        seen = learnt[row]
        a = np.bincount(column[seen & (label[row] == 1)], minlength=width)
        b = np.bincount(column[seen & (label[row] == 0)], minlength=width)
        toxic, clean = (learnt & (label == 1)).sum(), (learnt & (label == 0)).sum()
        telling = (a >= min(LEAST_HELD, toxic)) & (a * clean > LEAST_LIFT * b * toxic)
        used = telling[column]
        held = np.bincount(row[used], minlength=len(label))
        place = np.cumsum(learnt) - 1
        mine = used & seen
        w, _ = fit_ordinal(
            place[row[mine]], column[mine], grades(label[learnt], held[learnt]), width, steps=STEPS, decay=DECAY
        )
        sums[~learnt] = np.bincount(row[used], w[column[used]], len(label))[~learnt]
    return sums


def decision_cut(eta: np.ndarray, toxic: np.ndarray, weight: float = 1.0) -> float:
    """Where ``eta`` tells toxic from clean documents best, a clean one taken for toxic
    counting three times, and each for ``weight`` of them; of equally good values the middle of the widest gap."""
    order = np.sort(np.unique(eta))
    if len(order) < 2:
        return float("inf")
    cuts = (order[1:] + order[:-1]) / 2
    missed = np.searchsorted(np.sort(eta[toxic]), cuts)
    wrong = (~toxic).sum() - np.searchsorted(np.sort(eta[~toxic]), cuts)
    cost = missed + 3 * weight * wrong
    best = cost == cost.min()
    return float(cuts[best][np.diff(order)[best].argmax()])


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> OrdinalModel:
    """Fit on the labelled sample. Without both classes nothing is ever toxic."""
    rows = settle(labelled_sample(docs, labels, size).mapInArrow(_listed, "label int, features array<bigint>"))
    names = telling_features(rows)
    if not names:
        return OrdinalModel({}, tuple(float(k) for k in range(1, GRADES)), float("inf"))
    chosen = np.array(names, dtype=np.int64)
    order = np.argsort(chosen)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            held = lists.flatten().to_numpy()
            at = order[np.minimum(np.searchsorted(chosen, held, sorter=order), len(chosen) - 1)]
            kept = chosen[at] == held
            before = np.concatenate([[0], np.cumsum(kept)])
            first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(
                    pa.array(before[first], pa.int32()), pa.array(at[kept], pa.int32()))],
                names=["label", "places"],
            )

    sample = rows.mapInArrow(encoded, "label int, places array<int>").toPandas()
    held = sample["places"].map(len).to_numpy()
    row = np.repeat(np.arange(len(sample)), held)
    column = np.concatenate([np.asarray(p, dtype=int) for p in sample["places"]])
    label = sample["label"].to_numpy()
    w, theta = fit_ordinal(row, column, grades(label, held), len(names), steps=STEPS, decay=DECAY)
    # The sample holds the classes in other shares than the labels.
    judged = {r["toxic"]: r["count"] for r in labels.where("toxic is not null").groupBy("toxic").count().collect()}
    taken = np.bincount(label, minlength=2)
    weight = max(1.0, judged[0] * taken[1] / (judged[1] * taken[0]))
    cut = decision_cut(held_out_sums(row, column, label, len(names)), label == 1, weight)
    return OrdinalModel(dict(zip(names, w.tolist())), tuple(theta.tolist()), cut)


# Scoring

def severity(text: str, model: OrdinalModel, known: _Features) -> tuple[float, float, bool]:
    """Expected grade, the chance of any grade above 0, and whether the text is toxic."""
    eta = sum(model.weights[f] for f in sorted(known.of(text)))
    above = [1 / (1 + np.exp(min(max(t - eta, -500.0), 500.0))) for t in model.thresholds]
    return float(sum(above)), float(above[0]), bool(eta >= model.cut)


def score_documents(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """``doc_id, key, severity, chance, toxic`` of every row.

    NULL and empty texts have no feature and get the severity of none; repeated rows,
    and rows with equal or NULL ``doc_id``, each get their own. ``toxic`` follows the
    cut that told the classes apart best in training; a text that reaches it is toxic.
    An empty table gives no rows, long texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, chance double, toxic boolean")
    def graded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Features(shared.value.weights)
        for texts in batches:
            yield pd.DataFrame(
                [severity(t, shared.value, known) for t in texts], columns=["severity", "chance", "toxic"]
            )

    return docs.select("doc_id", text_key(text).alias("key"), graded(body(text)).alias("g")).select(
        "doc_id", "key", "g.severity", "g.chance", "g.toxic"
    )


def drop_toxic(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """The documents that are not toxic, with their columns; each row is judged where it is."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Features(shared.value.weights)
        for texts in batches:
            yield pd.Series([severity(t, shared.value, known)[2] for t in texts], dtype="bool")

    return docs.where(~toxic(body(text)))
