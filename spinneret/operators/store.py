"""Document store operators: query, upsert, insert, delete, update.

A store is a DataFrame with one row per key. The functions return the new
content; ``spinneret.sources.tables`` keeps it.
"""

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spinneret.operators.joins import fits_broadcast
from spinneret.operators.ordering import last_per_key
from spinneret.operators.scratch import settle
from spinneret.operators.sketch import key_sketch, with_possible

STORE_SCHEMA = "url string, status string, html string"
COMPARISONS = {
    "$eq": lambda c, v: c == v,
    "$gt": lambda c, v: c > v,
}


def query_predicate(query: dict[str, Any]) -> Column:
    """``{"a": 1, "b": {"$gt": 2}}`` as an AND of comparisons."""
    def terms():
        for field, wanted in query.items():
            if isinstance(wanted, dict):
                for operator, value in wanted.items():
                    yield COMPARISONS[operator](F.col(field), value)
            else:
                yield F.col(field).isNull() if wanted is None else F.col(field) == wanted

    return reduce(lambda a, b: a & b, terms(), F.lit(True))


def where(store: DataFrame, query: dict[str, Any] | None) -> DataFrame:
    return store.where(query_predicate(query)) if query else store


def page_store_scan(
    store: DataFrame, query: dict[str, Any] | None = None, limit: int | None = None
) -> DataFrame:
    """All matches, or any ``limit`` of them; both reach the Parquet scan."""
    found = where(store, query)
    return found if limit is None else found.limit(limit)


def first_match(store: DataFrame, query: dict[str, Any] | None, order: list[str]) -> DataFrame:
    return where(store, query).orderBy(*order).limit(1)


def limited_scan(store: DataFrame, n: int, order: list[str]) -> DataFrame:
    return store.orderBy(*order).limit(n)


def upsert(store: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Set the columns of ``incoming`` on existing keys, insert the others.

    The last incoming row per key (by ``order``) wins; store columns that are
    not incoming keep their value, NULL on insert. When the incoming keys are
    counted to be few, the store is filtered where it lies and only its narrow
    carried columns move. Otherwise a sketch of the incoming keys, of bounded size,
    tells which stored rows may be met: only those are shuffled.
    """
    fields = [c for c in incoming.columns if c != key and c in store.columns]
    carried = [c for c in store.columns if c != key and c not in fields]
    incoming = incoming.where(F.col(key).isNotNull())
    keys = incoming.select(key).distinct()

    if fits_broadcast(keys):
        latest = last_per_key(incoming, [key], order).select(key, *fields)
        keys = F.broadcast(keys)
        old = store.select(key, *carried).join(keys, key, "left_semi")
        written = latest.join(old, key, "left").select(*store.columns)
        return store.join(keys, key, "left_anti").unionByName(written)

    met = with_possible(store, settle(key_sketch(keys, key)), key)
    untouched = met.where(~F.col("_possible")).drop("_possible")
    return untouched.unionByName(merge_all(met.where("_possible").drop("_possible"), incoming, key, order))


def merge_all(store: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``upsert`` as one full outer join on the key.

    A store kept in buckets of the key is read where it lies; any other is shuffled.
    """
    fields = [c for c in incoming.columns if c != key and c in store.columns]
    latest = last_per_key(incoming.where(F.col(key).isNotNull()), [key], order)
    both = store.join(latest.select(key, F.struct(*fields).alias("_new")), key, "full_outer")
    new = F.col("_new").isNotNull()
    return both.select(
        *[
            F.when(new, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in fields else c
            for c in store.columns
        ]
    )


def upsert_pages(store: DataFrame, pages: DataFrame, order: list[str]) -> DataFrame:
    """Replace or add ``html`` by (redirected) URL; the status stays."""
    return upsert(store, pages.select("url", "html", *order), "url", order)


def upsert_status(store: DataFrame, outcomes: DataFrame, order: list[str]) -> DataFrame:
    """Replace or add ``status`` by URL; the page body stays."""
    return upsert(store, outcomes.select("url", "status", *order), "url", order)


def store_insert(store: DataFrame, documents: DataFrame) -> DataFrame:
    """Append documents, which may lack or add fields."""
    return store.unionByName(documents, allowMissingColumns=True)


def _matched(store: DataFrame, predicate: Column, order: str, many: bool) -> Column:
    """Rows to change: all matches, or the first one by the unique ``order``."""
    if not many:
        first = store.where(predicate).agg(F.min(order)).scalar()
        predicate = predicate & (F.col(order) == first)
    return F.coalesce(predicate, F.lit(False))


def store_delete(store: DataFrame, predicate: Column, order: str, many: bool = False) -> DataFrame:
    return store.where(~_matched(store, predicate, order, many))


def store_update(
    store: DataFrame, predicate: Column, values: dict[str, Any], order: str, many: bool = False
) -> DataFrame:
    hit = _matched(store, predicate, order, many)
    changed = {}
    for name, value in values.items():
        new = value if isinstance(value, Column) else F.lit(value)
        old = F.col(name) if name in store.columns else F.lit(None)
        changed[name] = F.when(hit, new).otherwise(old)
    return store.withColumns(changed)
