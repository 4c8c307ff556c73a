"""Order-dependent computations without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task. The
questions that rank or accumulate over stores or products would then be bounded by one
executor. These operators compute the same results over ranges of the ordering key:

1. Split points are fixed by an aggregate of the frame: of each of SAMPLE_CLASSES classes of
   keys (by hash) the member with the smallest second hash, sorted, and of these every n-th.
   They enter the plan as a scalar subquery, so all reads of the frame see the same ranges,
   nothing is checkpointed and no job runs while a question is built.
2. A row's range is the number of split points up to its key: equal keys share a range, and
   ranges are numbered along the order. Totals per range, at most RANGES rows (times the
   groups of a partitioned order), give the exclusive running sum that each range begins with.
3. A local window per range plus the range's offset.

Peer rows (equal ordering keys) are first collapsed with a ``groupBy`` on the key, so a
key that holds a third of all rows is one row in the ordered pass and is re-attached by
an equi-join (a plain shuffle-able join; AQE skew-join handling is enabled for it).

The frame is named several times in such a plan. Its last exchange is the same each time, so
Spark runs it once and reads its shuffle files again; what the frame is made from is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "__range"
#: Members of the sample of keys, at most; it is sorted in one task.
SAMPLE_CLASSES = 8192
#: Cells of split points, and split points in a cell: a key is looked up in two short lists.
CELLS = 32
RANGES = CELLS * CELLS

OrderSpec = Sequence[tuple[str, bool]]  # (column, ascending)


def sort_exprs(order: OrderSpec) -> list[Column]:
    """Spark/MySQL null order: NULLs first ascending, last descending."""
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def _leading(order: OrderSpec) -> tuple[list[str], bool]:
    """The first columns of ``order`` that are sorted the same way: ranges are cut by these."""
    ascending = order[0][1]
    columns = []
    for column, asc in order:
        if asc != ascending:
            break
        columns.append(column)
    return columns, ascending


def split_points(df: DataFrame, columns: Sequence[str]) -> Column:
    """Split points of the rows' keys as a scalar: (heads, cells), where ``cells`` holds CELLS
    lists of CELLS points and ``heads`` the first point of each. Keys are structs of
    ``columns``, compared as in an ascending sort with NULLs first."""
    # whole rows, so that the frame below has the columns, and so the exchange, of its other reads
    row = F.struct(F.struct(*columns).alias("key"), F.struct(*df.columns).alias("rest"))
    # the class by one hash, its member by another: each class gives a key drawn at random,
    # but the same one on every read
    sample = (df.groupBy(F.pmod(F.xxhash64(*columns), F.lit(SAMPLE_CLASSES)).alias("class"))
              .agg(F.min_by(row, F.hash(*columns)).alias("row")))
    keys = sample.agg(F.sort_array(F.collect_list("row.key")).alias("keys"))
    at = f"transform(sequence(0, {RANGES - 1}), i -> keys[cast(i * size(keys) div {RANGES} as int)])"
    points = keys.filter(F.size("keys") > 0).select(F.expr(at).alias("points"))
    cells = points.select(F.expr(
        f"transform(sequence(0, {CELLS - 1}), c -> slice(points, c * {CELLS} + 1, {CELLS}))").alias("cells"))
    return cells.select(F.struct(F.expr("transform(cells, c -> c[0])").alias("heads"), "cells").alias("s")).scalar()


def with_range(df: DataFrame, order: OrderSpec, name: str = RANGE) -> DataFrame:
    """``df`` with the number of each row's range, ascending along ``order``."""
    columns, ascending = _leading(order)
    key = F.struct(*columns)

    def up_to(points: Column) -> Column:
        return F.size(F.filter(points, lambda p: p <= key))

    found = df.withColumn("__split", split_points(df, columns)).withColumn("__cell", up_to(F.col("__split.heads")))
    inside = up_to(F.get(F.col("__split.cells"), F.col("__cell") - 1))
    number = F.when(F.col("__cell") == 0, F.lit(0)).otherwise((F.col("__cell") - 1) * CELLS + inside)
    return found.withColumn(name, number if ascending else -number).drop("__split", "__cell")


def prefix_sum(df: DataFrame, value: str, order: OrderSpec, name: str, exclusive: bool = False,
               partition: Sequence[str] = ()) -> DataFrame:
    """Running sum of ``value`` along ``order`` (within ``partition``), in which rows must be
    unique."""
    part = list(partition)
    ranged = with_range(df, order)
    totals = ranged.groupBy(*part, RANGE).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*part).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, RANGE, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    local_w = (Window.partitionBy(*part, RANGE).orderBy(*sort_exprs(order))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("__local", F.sum(value).over(local_w))
    # without groups there are RANGES + 1 offsets at most
    joined = _key_join(local, offsets, [*part, RANGE]) if part else local.join(F.broadcast(offsets), RANGE, "inner")
    running = F.col("__local") + F.col("__offset")
    if exclusive:
        running = running - F.col(value)
    return joined.withColumn(name, running).drop(RANGE, "__local", "__offset")


def _key_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi-join on ``keys`` (both sides may share lineage: keys are renamed)."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else (cond & c)
    return left.join(renamed, cond, "inner").drop(*[f"__r_{k}" for k in keys])


def cumulative_sum(df: DataFrame, value: str, order: OrderSpec, name: str) -> DataFrame:
    """``sum(value) OVER (ORDER BY order)`` with the default RANGE frame: peers share the total."""
    keys = [c for c, _ in order]
    peers = df.groupBy(*keys).agg(F.sum(value).alias("__peer_sum"))
    running = prefix_sum(peers, "__peer_sum", order, name).drop("__peer_sum")
    return _key_join(df, running, keys)


def rank(df: DataFrame, order: OrderSpec, name: str = "rank",
         partition: Sequence[str] = ()) -> DataFrame:
    """``rank() OVER ([PARTITION BY partition] ORDER BY order)`` as an int column."""
    part = list(partition)
    keys = part + [c for c, _ in order]
    peers = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__peer_n"))
    before = prefix_sum(peers, "__peer_n", order, "__before", exclusive=True, partition=part)
    return _key_join(df, before.select(*keys, (F.col("__before") + 1).cast("int").alias(name)), keys)


def lag(df: DataFrame, value: str, order: OrderSpec, name: str) -> DataFrame:
    """``lag(value) OVER (ORDER BY order)``; ``order`` must be a total order (unique key)."""
    keys = [c for c, _ in order]
    ranged = with_range(df, order)
    order_struct = F.struct(*[F.col(k) for k in keys])
    # Last value of each range, carried to the next one: RANGES + 1 rows at most.
    if all(asc for _, asc in order):
        last = F.max_by(F.col(value), order_struct)
    elif not any(asc for _, asc in order):
        last = F.min_by(F.col(value), order_struct)
    else:
        raise ValueError("lag: mixed ascending/descending order is not supported")
    tails = ranged.groupBy(RANGE).agg(last.alias("__tail"))
    carry = F.broadcast(tails.select(
        RANGE, F.lag("__tail").over(Window.orderBy(RANGE)).alias("__carry")))
    local_w = Window.partitionBy(RANGE).orderBy(*sort_exprs(order))
    local = (ranged
             .withColumn("__local_lag", F.lag(value).over(local_w))
             .withColumn("__pos", F.row_number().over(local_w)))
    return (local.join(carry, RANGE, "inner")
            .withColumn(name, F.when(F.col("__pos") == 1, F.col("__carry"))
                        .otherwise(F.col("__local_lag")))
            .drop(RANGE, "__local_lag", "__pos", "__carry"))


def median(df: DataFrame, part: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """The exact median of ``value`` in each group, NULLs left out: value counts, their running
    count over ranges, and the one or two values at the middle. No group is gathered; a group
    without a value has a NULL."""
    part = list(part)
    counts = (df.filter(F.col(value).isNotNull()).groupBy(*part, value).agg(F.count(F.lit(1)).alias("__n")))
    upto = prefix_sum(counts, "__n", [(value, True)], "__upto", partition=part)
    sizes = df.groupBy(*part).agg(F.count(value).alias("__size"))
    placed = _key_join(upto, sizes, part) if part else upto.withColumn("__size", sizes.select("__size").scalar())
    low, high = F.floor((F.col("__size") + 1) / 2), F.floor(F.col("__size") / 2) + 1
    first = F.col("__upto") - F.col("__n") + 1

    def holds(place: Column) -> Column:
        return (first <= place) & (place <= F.col("__upto"))

    middle = placed.filter(holds(low) | holds(high)).groupBy(*part).agg(
        ((F.min(value).cast("double") + F.max(value).cast("double")) / 2).alias(name))
    if not part:
        return middle
    groups = sizes.drop("__size")
    renamed = middle.select(*[F.col(c).alias(f"__r_{c}") for c in part], name)
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in part]
    return groups.join(renamed, cond, "left").drop(*[f"__r_{c}" for c in part])
