"""A value computed once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once per row.

    The body of a lambda is evaluated for each element, and so is any column
    expression inside it; the optimizer may also merge a costly projection into
    its consumer. Binding the value to a lambda variable rules both out.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
