"""Column expressions: each takes a column (or its name) and returns a Column."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it.

    Spark shares repeated subexpressions only where they are always evaluated,
    so one used inside ``when`` branches or lambdas would run again each time.
    """
    return F.transform(F.array(value), body)[0]
