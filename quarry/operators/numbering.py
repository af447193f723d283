"""Row numbers without one task: range partitions, counts a partition, prefix sums, local numbers.

A window over a whole table sends all rows to one task, and one over a hot key sends its rows to one.  Here
rows are dealt by ranges of the order, sorted in their partitions and written; only a count a partition comes
to the driver, and what a row needs besides is its place in its partition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import scratch

#: monotonically_increasing_id() has the place in the partition in its lower bits.
PLACE = (1 << 33) - 1


def _column(key: str | Column) -> Column:
    return F.col(key).asc_nulls_first() if isinstance(key, str) else key


def numbered(
    df: DataFrame, order: list[str | Column], within: list[str] = (), name: str = "number", start: int = 1,
    write: Callable[[DataFrame, str], DataFrame] = scratch.written, side: Callable[[DataFrame, str], DataFrame] = scratch.small_side,
) -> DataFrame:
    """df with its place in the order (names ascend, nulls first), counted from start anew for each value of `within`.

    The result reads a table made by write(df, name), so numbers stay as they are however often it is computed;
    rows that tie get different numbers.  Repeated rows count apart.  An empty table gives an empty table.
    A column called `name` is replaced.  Groups of `within` may be of any size: no task sees a whole group.
    """
    keys = [*[_column(k) for k in within], *[_column(k) for k in order]]
    part, place, group = (_free(df, c, name) for c in ("part", "place", "group"))
    sorted_rows = df.drop(name).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = write(sorted_rows.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE))}), "numbered")
    counts = {r[part]: r["n"] for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect()}  # a row for each partition
    before, total = [], 0
    for i in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(i, 0)
    offset = F.get(F.lit(before or [0]).cast("array<bigint>"), F.col(part))
    out = placed.withColumn(name, offset + F.col(place) + F.lit(start)).drop(part, place)
    if not within:
        return out
    own = {c: f"{group}_{i}" for i, c in enumerate(within)}
    # A group's rows stand together, so its first number is where it starts.
    firsts = side(out.groupBy(*[F.col(c).alias(o) for c, o in own.items()]).agg(F.min(name).alias(group)), "groups")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(o)) for c, o in own.items()])
    return out.join(firsts, same).withColumn(name, F.col(name) - F.col(group) + F.lit(start)).drop(group, *own.values())


def _free(df: DataFrame, name: str, *also: str) -> str:
    taken = {c.lower() for c in (*df.columns, *also)}
    out = f"_{name}"
    while out in taken:
        out = "_" + out
    return out
