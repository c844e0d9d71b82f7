"""Date expressions (X1, X2). Day arithmetic is integer days, never intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def parse_date(col: Column, lenient: bool = False) -> Column:
    """Text -> date. Strict parsing fails on bad input (ANSI); lenient gives NULL."""
    if lenient:
        return F.try_to_date(col, DATE_FORMAT)
    return F.to_date(col, DATE_FORMAT)


def days_between(later: Column, earlier: Column) -> Column:
    """Difference in whole days as int (``later - earlier``)."""
    return F.datediff(later, earlier)

