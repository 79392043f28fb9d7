"""Previous row per key, safe when one key holds a large share of all rows.

``lag`` over ``PARTITION BY key`` sorts each key in a single task. That is fine
for ordinary keys and hopeless for a key with billions of rows. A pre-aggregated
pass therefore counts rows per key first. Where no key exceeds
``Params.hot_key_rows`` the plain window is used. Otherwise the rows of the other
keys take the plain window, and those of hot keys are cut by rank:

1. they are dealt by range of key and whole order, tie columns included. Spark draws
   the cuts from a sample of the rows, so ranges follow the rows and not the clock.
   Each range is sorted and cut every ``hot_key_rows`` rows: bursts, outliers and a
   single crowded second give slices of the limit at most. One task cuts many slices
   where the limit is small, so tasks follow the rows and not the limit. The slices
   are written once, which fixes them for every later reader;
2. the last row of every group and slice is found by a pre-aggregated ``max_by``;
   the last one before a slice enters that slice as a marker ahead of its rows;
3. one window over ``key + slice`` then reads rows and markers alike.

The result equals the plain window row for row. Rows equal in all of the order may
be cut apart, as nothing tells them apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators.sides import counted_broadcast
from cadence.params import Params
from cadence.sources.staging import stage

_SLICE, _EDGE, _VIEW = "__slice", "__edge", "__view"
_TASK_ROWS = 1_000_000
_TASK_BITS = 33  # of monotonically_increasing_id: the task is above them, the row below


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    views: Mapping[str, Sequence[str]] | None = None,
    p: Params = Params(),
) -> DataFrame:
    """Add one struct column of ``carry`` values per entry of ``views``.

    ``views`` maps an output column to extra partition columns, so that
    ``{"prev": (), "prev_same": ("svc",)}`` gives the previous row of the key and
    the previous row of the key with the same ``svc``. All views share the shuffle
    on ``keys``. The struct is NULL on the first row of a partition.
    """
    views = views or {"prev": ()}
    hot = _hot_keys(df, keys, p)
    if hot is None:
        return _plain(df, keys, order, carry, views)
    side = counted_broadcast(hot.select(*_as_match(keys)), p)
    cold = df.join(side, _same_key(keys), "left_anti")
    rows = df.join(side, _same_key(keys), "left_semi")
    sliced = _sliced(rows, hot.agg(F.sum("__n")).first()[0], keys, order, p)
    return _plain(cold, keys, order, carry, views).unionByName(
        _stitched(sliced, keys, order, carry, views).select(*df.columns, *views)
    )


def _plain(df: DataFrame, keys, order, carry, views) -> DataFrame:
    for name, extra in views.items():
        w = Window.partitionBy(*keys, *extra).orderBy(*order)
        df = df.withColumn(name, F.lag(F.struct(*carry)).over(w))
    return df


def _hot_keys(df: DataFrame, keys: Sequence[str], p: Params) -> DataFrame | None:
    """Keys above the limit with their counts, stored, or None when there are none."""
    seen = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = stage(seen.where(F.col("__n") > p.hot_key_rows), "hot-keys")
    return None if hot.isEmpty() else hot


def _sliced(rows: DataFrame, count: int, keys, order, p: Params) -> DataFrame:
    """The rows with the number of their slice, which rises along keys and order."""
    slices = max(2, -(-count // p.hot_key_rows))
    side_by_side = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(slices, max(2, side_by_side, -(-count // _TASK_ROWS)))
    dealt = rows.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order)
    # numbered before anything else is computed: ids count the sorted rows of a task from 0
    place = F.monotonically_increasing_id()
    task, row = F.shiftright(place, _TASK_BITS), place.bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    per_task = (1 << _TASK_BITS) // p.hot_key_rows + 1
    return stage(dealt.withColumn(_SLICE, task * per_task + F.floor(row / p.hot_key_rows)), "slices")


def _stitched(sliced: DataFrame, keys, order, carry, views) -> DataFrame:
    rows = sliced
    for name, extra in views.items():
        marks = _carried_over(sliced, [*keys, *extra], order, carry)
        rows = rows.unionByName(marks.withColumn(_VIEW, F.lit(name)), allowMissingColumns=True)
    is_row = F.col(_VIEW).isNull()
    for name, extra in views.items():
        own = F.col(_VIEW) == name
        w = Window.partitionBy(*keys, _SLICE, *extra).orderBy(
            F.when(is_row, 2).when(own, 1).otherwise(0), *order
        )
        value = F.when(is_row, F.struct(*carry)).when(own, F.col(_EDGE))
        rows = rows.withColumn(name, F.lag(value).over(w))
    return rows.where(is_row)


def _carried_over(sliced: DataFrame, group, order, carry) -> DataFrame:
    """For every slice of a group but its first: the last row before it."""
    if list(carry) == [order[0]]:  # the last time alone: a hash aggregate, no sort
        last = F.struct(F.max(order[0]).alias(order[0]))
    else:
        last = F.max_by(F.struct(*carry), F.struct(*order))
    before = F.lag("__last").over(Window.partitionBy(*group).orderBy(_SLICE))
    return (
        sliced.groupBy(*group, _SLICE)
        .agg(last.alias("__last"))
        .select(*group, _SLICE, before.alias(_EDGE))
        .where(F.col(_EDGE).isNotNull())
    )


def _as_match(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"__is_{c}") for c in cols]


def _same_key(cols: Sequence[str]) -> Column:
    """Null-safe, as window partitions treat NULL keys as equal."""
    return reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__is_{c}")) for c in cols)
    )
