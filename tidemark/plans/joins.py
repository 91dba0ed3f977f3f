"""Joins with a side that should be small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.plans.scratch import written


def join_small(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a narrow aggregate to a large table.

    The aggregate is written first, so it is not computed again and the optimizer knows its size in bytes: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, which spares the large side a shuffle by keys that may
    be few and hot; beyond that the tables are shuffled.
    """
    return left.join(written(right, "side"), list(on), how)
