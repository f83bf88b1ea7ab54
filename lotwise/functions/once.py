"""Values that several parts of an expression need, worked out once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unless(value: Column, absent: str | int) -> Column:
    """nullif(value, absent); nullif may work out its value twice, and again in every nullif around it."""
    return F.get(F.array_remove(F.array(value), F.lit(absent)), F.lit(0))
