"""Choosing how a join side travels: broadcast only after it was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.params import Params


def counted_broadcast(side: DataFrame, p: Params = Params()) -> DataFrame:
    """Hint a broadcast when ``side`` has at most ``broadcast_rows`` rows.

    The count stops one row past the limit. A larger side comes back without a
    hint, so Spark joins it by shuffle, with AQE splitting skewed partitions.
    """
    fits = side.limit(p.broadcast_rows + 1).count() <= p.broadcast_rows
    return F.broadcast(side) if fits else side

