"""Name an intermediate value inside one Column expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used.

    Higher-order functions are interpreted, so this is for rarer branches.
    """
    return F.transform(F.array(value), body).getItem(0)


def record(**fields: Column) -> Column:
    return F.struct(*[col.alias(name) for name, col in fields.items()])
