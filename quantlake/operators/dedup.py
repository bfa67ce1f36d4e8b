"""Keep one row per key, chosen by a total order.

Implemented as an aggregation (``max_by`` of the whole row by an ordering
struct), not as ``row_number() == 1``: an aggregate is combined map-side before
the shuffle, so a key holding a third of all rows (many copies of one bar, a
hot symbol's ticks) is reduced in every input task instead of being sorted in
one. The ordering struct makes the choice deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_max_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row whose ``order`` tuple is greatest.

    ``order`` defaults to every non-key column in schema order, which is a total
    order over row content (equal tuples mean identical rows). Output keeps the
    input column order.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in (order if order is not None else rest)]
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order_cols)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
