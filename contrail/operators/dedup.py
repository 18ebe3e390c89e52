"""Keep the latest row per key (W1), skew-safe.

``row_number() over (partition by key order by ...) = 1`` is planned by
Catalyst as a *partial* ``WindowGroupLimit`` before the shuffle and a final
one after it, so every map task forwards at most ``k`` rows per key. A key
holding a third of all rows therefore ships only ``k`` rows per map task,
not its whole group, to one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    xs = [xs] if isinstance(xs, (str, Column)) else list(xs)
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_k_per_group(df: DataFrame, keys, order: Sequence[Column], k: int = 1,
                    rank_col: str | None = None, ties: bool = False) -> DataFrame:
    """Rows ranked ``<= k`` within each group of ``keys`` under ``order``.

    ``ties=False`` uses ``row_number`` (exactly k rows, order must be total
    for a deterministic result); ``ties=True`` uses ``rank``. The rank is kept
    as ``rank_col`` when given.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rk"
    out = df.withColumn(name, fn.over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def dedup_latest(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (put the source time first, descending,
    then enough tie-breakers to make the order total)."""
    return top_k_per_group(df, keys, order, k=1)
