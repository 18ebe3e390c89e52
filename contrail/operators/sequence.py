"""Previous / next row within a key, without one task per key.

``lag(x) over (partition by key order by ts)`` sends every row of a key to
one task; a key holding a third of the data would then run in one task. Here
the rows are range-partitioned by (key, order): Spark samples the order and
cuts it at quantiles, so a hot key is split by rank into as many pieces as
its share of the rows asks for, whatever its times look like. A window then
runs per (key, piece), and the last row of a piece is handed on to the
key's next piece as a carried copy, which a second window reads and drops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  direction: str = "prev", prefix: str | None = None, pieces: int | None = None) -> DataFrame:
    """Add ``<prefix><c>`` = value of ``c`` on the previous (``direction='prev'``)
    or next (``'next'``) row of the same key, rows ordered by ``order`` ascending
    (NULLs first). ``order`` must be total within a key. A NULL key is a key.

    One lazy plan over one read of ``df`` (plus Spark's sample of the order):
    rows of a key stand in neighbouring pieces, and a piece between two pieces of
    one key holds that key only, so its next piece is always the one that follows.
    ``pieces`` fixes the number of pieces; by default it follows Spark's settings.
    """
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    prefix = prefix if prefix is not None else f"{direction}_"
    keys, order, cols = list(keys), list(order), list(cols)
    # Looking ahead is looking back over the reversed order.
    rank = [F.col(o).asc_nulls_first() if direction == "prev" else F.col(o).desc_nulls_last() for o in order]
    rng = [*(F.col(k).asc_nulls_first() for k in keys), *rank]
    piece, last, copy = "__piece", "__last", "__copy"

    d = df.repartitionByRange(pieces, *rng) if pieces else df.repartitionByRange(*rng)
    d = d.withColumn(piece, F.spark_partition_id())
    in_piece = Window.partitionBy(*keys, piece).orderBy(*rank)
    d = d.withColumn(last, F.lead(F.lit(1)).over(in_piece).isNull())
    # Every row stays; the last one of a piece also goes to the next piece, marked as a copy that sorts first.
    d = d.withColumn(copy, F.explode(F.when(F.col(last), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    d = d.withColumn(piece, F.col(piece) + F.col(copy))
    w = Window.partitionBy(*keys, piece).orderBy(F.col(copy).desc(), *rank)
    d = d.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in cols})
    return d.where(F.col(copy) == 0).drop(piece, last, copy)
