"""Star joins that don't move the fact.

A filter on a dimension becomes a filter on the fact: the dimension's matching keys
are measured first and, while they are few, go into the fact's scan as an ``IN``
list. What is asked of the fact per attribute of a dimension is summed per join key
before the join (in each task, then once per key), so the join and what follows see
one row per key, not one per reading, and the one exchange of these sums by the
join key serves the join as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import sum_parts

#: Keys that may stand in a scan's filter.
MOST_KEYS = 1000


def pruned(fact: DataFrame, dim: DataFrame, key: str, condition: Column,
           most: int = MOST_KEYS) -> DataFrame:
    """The fact's rows whose ``key`` belongs to a row of ``dim`` with ``condition``
    (a dimension has one row per key). Up to ``most`` matching keys become an ``IN``
    list of the scan; beyond that the dimension is joined."""
    chosen = dim.where(condition).select(key)
    found = [r[0] for r in chosen.limit(most + 1).collect()]
    if len(found) > most:
        return fact.join(chosen, key, "left_semi")
    return fact.where(F.col(key).isin(found)) if found else fact.where(F.lit(False))


def per_key(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, int | None],
            squares: bool = False) -> DataFrame:
    """The fact summed per join key: for each measure its exact sum's parts, its
    count and its maximum (``functions.numeric.sum_parts``), with ``squares`` also
    the sum of its squares; and ``_rows``."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for m, scale in measures.items():
        aggs += sum_parts(m, scale)
        if squares:
            aggs.append(F.sum(F.col(m) * F.col(m)).alias(f"{m}_sq"))
    return fact.groupBy(*keys).agg(*aggs)


def corr_of_sums(measure: str, x: Column | str) -> Column:
    """Aggregate over ``per_key`` rows (with squares) joined to a dimension:
    Pearson correlation of the fact's measure with the dimension's ``x``, over rows
    that have both; NULL when either side does not vary."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    has = x.isNotNull()
    n, s, q = (F.when(has, F.col(f"{measure}_{k}")) for k in ("n", "sum", "sq"))
    cnt = F.sum(n).cast("double")
    my, mx = F.try_divide(F.sum(s), cnt), F.try_divide(F.sum(n * x), cnt)
    cov = F.try_divide(F.sum(s * x), cnt) - my * mx
    vy = F.try_divide(F.sum(q), cnt) - my * my
    vx = F.try_divide(F.sum(n * x * x), cnt) - mx * mx
    return F.try_divide(cov, F.when((vy > 1e-12) & (vx > 1e-12), F.sqrt(vy) * F.sqrt(vx)))
