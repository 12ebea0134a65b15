"""Keyed state of the crawl streams: one small value per URL, kept in the state store.

Rows are combined per URL inside each input task before they are shuffled, and again
where they meet the state, so a URL with a third of all rows sends a few of them.
"""

import heapq
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from spinneret.operators.frontier import FAILED, SUCCESS, WAITING

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EVENT_SCHEMA = "url string, kind int, at bigint, id bigint, n bigint"
FAILURE, SERVED, MISSING, PICK = 0, 1, 2, 3
OUTCOME_SCHEMA = "url string, mode string, state string, failure int"
SIGHTING_SCHEMA = "url string, ts timestamp"


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; queries started from here on use it."""
    spark.conf.set(PROVIDER, ROCKSDB)


# Outcomes

def combined_events(events: pd.DataFrame, needed: int) -> pd.DataFrame:
    """Events that decide as much as all of ``events`` would, at most ``needed`` + 7 per URL.

    Kept are the first ``needed`` failures of a URL and the first event of another kind
    (the last pick), each with ``n`` 1; one more row of each kind counts the others in ``n``.
    """
    rows = events.sort_values(["url", "kind", "at", "id"])
    by = rows.groupby(["url", "kind"], sort=False)
    place = by.cumcount().where(rows["kind"] != PICK, by.cumcount(ascending=False))
    slot = place.clip(upper=1).where(rows["kind"] != FAILURE, place.clip(upper=needed))
    kept = rows.groupby([rows["url"], rows["kind"], slot.rename("slot")], sort=False).agg(
        at=("at", "first"), id=("id", "first"), n=("n", "sum")
    )
    return kept.reset_index()[["url", "kind", "at", "id", "n"]]


class Attempts:
    """What decides a URL out of its combined events, whatever their order."""

    def __init__(self, needed: int):
        self.needed = needed
        self.failed = self.served = 0
        self.missing = False
        self.failures: list[tuple[int, int]] = []  # the first ones, as a heap with the latest on top
        self.end: tuple[int, int, int] | None = None
        self.tried: int | None = None
        self.picked: int | None = None

    def add(self, kind: int, at: int, number: int, n: int) -> None:
        if kind == PICK:
            self.picked = at if self.picked is None else max(self.picked, at)
            return
        self.tried = at if self.tried is None else max(self.tried, at)
        if kind != FAILURE:
            self.end = min(self.end or (at, number, kind), (at, number, kind))
            self.missing |= kind == MISSING
            self.served += n if kind == SERVED else 0
            return
        self.failed += n
        # A row that stands for several failures comes after enough single ones.
        if len(self.failures) < self.needed:
            heapq.heappush(self.failures, (-at, -number))
        else:
            heapq.heappushpop(self.failures, (-at, -number))

    def state(self, mode: str, failure: int, threshold: int, strict: bool) -> tuple[str, int | None]:
        """State, and the failures that a waiting URL carries on."""
        if mode == "hub":
            if self.missing:
                return FAILED, None
            return WAITING, failure + self.failed + (self.served if strict else 0)
        before = sum(self.end is None or (-a, -b) < self.end[:2] for a, b in self.failures)
        if before >= max(max(threshold + 1, 2) - failure, 1):
            return FAILED, None
        if self.end is not None:
            return (SUCCESS if self.end[2] == SERVED else FAILED), None
        return WAITING, failure + self.failed


class UrlOutcomes(StatefulProcessor):
    """State ``mode, failure, pended`` of every URL that waits in the frontier.

    It begins with the frontier's row or an admission, and goes when the URL leaves.
    Attempts on URLs without a state are not answered. A pick starts a timer; without an
    attempt until ``pend_span`` seconds later the URL is given out as waiting again.
    """

    def __init__(self, threshold: int, strict: bool, pend_span: float | None):
        self.threshold, self.strict, self.pend_span = threshold, strict, pend_span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "mode string, failure int, pended bigint")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: Any) -> None:
        self.entry.update((initialState["mode"], initialState["failure"], None))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        seen = Attempts(max(self.threshold + 1, 2))
        for row in rows:
            seen.add(row["kind"], row["at"], row["id"], row["n"])
        if not self.entry.exists():
            return
        mode, failure, pended = self.entry.get()
        due = pended
        if seen.tried is not None:
            state, failure = seen.state(mode, failure, self.threshold, self.strict)
            due = None
            yield Row(url=key[0], mode=mode, state=state, failure=failure)
        if seen.picked is not None and self.pend_span is not None:
            if seen.tried is None or seen.picked > seen.tried:
                due = seen.picked // 1000 + round(1000 * self.pend_span)
        gone = seen.tried is not None and state != WAITING
        if pended is not None and (gone or due != pended):
            self.handle.deleteTimer(pended)
        if gone:
            self.entry.clear()
            return
        if due is not None and due != pended:
            self.handle.registerTimer(due)
        self.entry.update((mode, failure, due))

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.entry.exists():
            mode, failure, pended = self.entry.get()
            if pended == expiredTimerInfo.getExpiryTimeInMs():
                self.entry.update((mode, failure, None))
                yield Row(url=key[0], mode=mode, state=WAITING, failure=failure)

    def close(self) -> None:
        pass


def outcome_states(
    events: DataFrame, frontier: DataFrame, threshold: int = 3, strict: bool = False,
    pend_span: float | None = None,
) -> DataFrame:
    """``url, mode, state, failure`` of the URLs that each micro-batch of ``events`` tried.

    ``events`` is a stream ``url, code, ts, id``; a NULL code is a pick. ``frontier``
    (``url, mode, failure``) is the state the stream starts with; it is not read again
    after a restart. With ``pend_span`` the stream needs a watermark on ``ts``.
    """
    use_state_store(frontier.sparkSession)
    needed = max(threshold + 1, 2)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield combined_events(batch, needed)

    tried = events.where(F.col("url").isNotNull()).select(
        "url",
        F.when(F.col("code").isNull(), PICK).when(F.col("code") == 200, SERVED)
        .when(F.col("code") == 404, MISSING).otherwise(FAILURE).alias("kind"),
        F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(-(1 << 62))).alias("at"),
        F.coalesce(F.col("id").cast("bigint"), F.lit(-(1 << 62))).alias("id"),
        F.lit(1).cast("bigint").alias("n"),
    )
    few = tried.mapInPandas(combine, EVENT_SCHEMA)
    start = frontier.where("url IS NOT NULL").selectExpr("url", "mode", "CAST(failure AS INT) AS failure")
    return few.groupBy("url").transformWithState(
        UrlOutcomes(threshold, strict, pend_span), OUTCOME_SCHEMA, "update",
        "EventTime" if pend_span is not None else "None", initialState=start.groupBy("url"),
    )


# First sightings

class RecentUrls(StatefulProcessor):
    """Lets a URL through unless it did so within the last ``keep_seconds`` of event time."""

    def __init__(self, keep_seconds: float):
        self.keep = max(1, round(1000 * keep_seconds))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = min(row["at"] for row in rows)
        if not self.seen.exists():
            self.seen.update((True,))
            self.handle.registerTimer(max(0, first // 1000 + self.keep))
            yield Row(url=key[0], at=first)

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def recent_sightings(urls: DataFrame, ts: str, keep_seconds: float) -> DataFrame:
    """``url, ts`` of URLs that were not let through in the last ``keep_seconds``.

    ``ts`` is the earliest one of the URL in its micro-batch. A timer forgets the URL
    when the watermark, the latest ``ts`` so far, is ``keep_seconds`` beyond its own.
    Rows behind the watermark are not dropped: they only are forgotten sooner.
    """
    use_state_store(urls.sparkSession)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby("url", as_index=False)["at"].min()

    timed = urls.select("url", F.col(ts).cast("timestamp").alias("ts")).withWatermark("ts", "0 seconds")
    seen = timed.where(F.col("url").isNotNull() & F.col("ts").isNotNull()).select(
        "url", F.unix_micros("ts").alias("at")
    )
    few = seen.mapInPandas(combine, "url string, at bigint")
    return (
        few.groupBy("url")
        .transformWithState(RecentUrls(keep_seconds), "url string, at bigint", "update", "EventTime")
        .select("url", F.timestamp_micros("at").alias("ts"))
    )
