"""Number lists written as text, such as `2-5,7,15-17,12`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ranges(text: Column) -> Column:
    """Sorted distinct integers of a range list.

    An element runs from its smallest to its largest number, so `9-8` and `1-2-4` are ranges too.
    Text starting with `-` is one negative number. Anything else that is no number gives NULL.
    """
    bounds = F.transform(
        F.split(text, ","),
        lambda element: F.transform(F.split(element, "-"), lambda number: number.try_cast("int")),
    )
    malformed = F.exists(bounds, lambda ends: F.exists(ends, lambda end: end.isNull()))
    numbers = F.flatten(
        F.transform(bounds, lambda ends: F.sequence(F.array_min(ends), F.array_max(ends)))
    )
    negative = text.try_cast("int")
    return (
        F.when(text.startswith("-"), F.when(negative.isNotNull(), F.array(negative)))
        .when(~malformed, F.array_sort(F.array_distinct(numbers)))
    )
