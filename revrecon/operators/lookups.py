"""Building blocks for joins on (patient, date) and on names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order_by: Sequence[str]) -> Column:
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def pick_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool = True
) -> DataFrame:
    """One row per key: the last (or first) in the given order.

    Written as an aggregate, not as a ranking window: each task keeps one row per key before the
    shuffle, so a key that holds a third of all rows never meets in one sort. Columns a caller does
    not use drop out of the aggregate.
    """
    pick = F.max_by if last else F.min_by
    order = _order(order_by)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[pick(F.col(c), order).alias(c) for c in rest])


def lookup(
    facts: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "left", spread_by: str = "row_no"
) -> DataFrame:
    """Join facts to a side that is unique per key, safe when one key or null dominates the facts.

    Both sides carry a hash of the key as an extra join column. Facts with a null in the key get a
    hash of ``spread_by`` instead: they cannot match, and this keeps them from meeting in one task.
    As the unique side usually comes out of an aggregate on the same keys, the extra column also
    makes Spark exchange it on its own, and that is the shape AQE's skew join splits: a hot
    partition of facts is divided over many tasks, each reading the few unique rows again. AQE
    broadcasts the unique side instead only when its measured size is below the threshold.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    hashed = F.xxhash64(*keys)
    left = facts.withColumn("_spread", F.when(complete, hashed).otherwise(F.xxhash64(spread_by)))
    right = unique.filter(complete).withColumn("_spread", hashed)
    return left.join(right, ["_spread", *keys], how).drop("_spread")
