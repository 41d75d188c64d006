"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    The body runs as a lambda, outside generated code. That suits rare, long paths: they
    would otherwise push the generated method over the JVM's size limit and take the
    common path with them into interpretation.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
