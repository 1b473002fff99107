"""Dimension joins whose broadcast Spark decides.

No hint is given: a side is broadcast only when its size is under
``spark.sql.autoBroadcastJoinThreshold``, checked at planning time from
statistics and again at run time by AQE from the measured shuffle output.
Beyond it the join is sort-merge, with AQE's skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def left_join_small(big: DataFrame, small_df: DataFrame, on: str | list | Column, how: str = "left") -> DataFrame:
    """``big`` LEFT JOIN a usually small dimension, at any size of it."""
    return big.join(small_df, on, how)
