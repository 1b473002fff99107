"""Keep the newest observation of every key.

``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY captured_at DESC, tie DESC) = 1``.
Spark plans the ``= 1`` filter as a window group limit: every map task first
keeps only its own newest row per key (a partial top-1 before the shuffle), so
a key that holds a third of all captures still moves at most one row per map
task across the network.  NULL key values form one group, as in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("captured_at",),
                   tie_breakers: Sequence[str] = (), rank_col: str = "_rn") -> DataFrame:
    """Rows of ``df`` that are newest per ``keys`` by ``order`` (then ``tie_breakers``), all DESC.

    Ties on every ordering column keep one arbitrary row; pass a unique column
    in ``tie_breakers`` for a deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (*order, *tie_breakers)])
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)
