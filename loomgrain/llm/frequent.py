"""The most frequent keys of a counted table, without sending every task's best to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 64


def most_frequent(counts: DataFrame, n: Column, most: int) -> DataFrame:
    """Rows of counts from the highest n down, at most ``most`` of them; rows of nearly equal n come or stay together.

    n falls into classes of 1/64 of a doubling; as many whole classes from the top as fit are kept, so only
    a short histogram reaches the driver before the rows themselves.
    """
    step = F.floor(F.log2(n.cast("double")) * _STEPS).cast("int")
    sizes = counts.where(n > 0).groupBy(step.alias("step")).count().collect()
    held, least = 0, None
    for r in sorted(sizes, key=lambda r: -r.step):
        held += r["count"]
        if held > most:
            break
        least = r.step
    return counts.where(F.lit(False) if least is None else (n > 0) & (step >= least))
