"""Exact global ranks, tiles, quantiles and running totals that do not pass through one task.

Tiles, quantiles and shares need a few rows of an order only: `selection` finds them in two scans, without a sort. With
`method="ranged"` rows are sorted by range partitioning on the whole sort key instead, tie-break included, so that equal values
spread over many tasks, and checkpointed with their place in their block; only the counts per block are then summed in one task.
A caller who knows the table to be small may ask for `method="window"`: plain windows, which send all rows of a group,
or of the table, to one task.

Running totals keep the sorted blocks where they are: their sums meet on the driver, one number a block, and each block adds
its own start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.selection import boundary_rows, values_at
from basketry.session import materialise, small_side

METHODS = ("selected", "ranged", "window")
_IN_BLOCK = (1 << 33) - 1  # monotonically_increasing_id keeps the place within the partition in 33 bits


def _settle(df: DataFrame, method: str) -> tuple[DataFrame, bool]:
    """The rows, checkpointed if they are to be sorted, and whether the caller asked for plain windows."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    return (materialise(df)[0], False) if method == "ranged" else (df, method == "window")


def laid_out(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in global order, with block number and place in the block fixed by a checkpoint."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_BLOCK))
    laid = df.orderBy(*order).withColumns({"_block": F.spark_partition_id(), "_place": place})
    return materialise(laid)[0]


def _blocks(laid: DataFrame, group: str) -> DataFrame:
    """Per group and block: rows, first place, and how many rows of the group lie in earlier blocks."""
    counts = laid.groupBy(group, "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint")))


def rows_at(laid: DataFrame, group: str, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """The rows at given 1-based ranks of each group, with `_slot` telling which rank was asked for.

    `ranks` turns the group's row count into rank expressions. Only block counts are shuffled; the rows
    themselves are filtered in place.
    """
    blocks = _blocks(laid, group)
    sizes = blocks.groupBy(group).agg(F.sum("_rows").alias("_n"))
    wanted = sizes.select(group, F.posexplode(F.array(*ranks(F.col("_n")))).alias("_slot", "_rank"))
    inside = (F.col("_rank") > F.col("_start")) & (F.col("_rank") <= F.col("_start") + F.col("_rows"))
    spots = (
        wanted.withColumnRenamed(group, "_group")
        .join(blocks, F.col("_group").eqNullSafe(F.col(group)) & inside)
        .select(
            "_group",
            "_slot",
            F.col("_block").alias("_at"),
            (F.col("_first") + F.col("_rank") - F.col("_start") - 1).alias("_spot"),
        )
    )
    hit = (
        F.col(group).eqNullSafe(F.col("_group"))
        & (F.col("_block") == F.col("_at"))
        & (F.col("_place") == F.col("_spot"))
    )
    return laid.join(small_side(spots), hit).drop("_group", "_at", "_spot", "_block", "_place")


def tile_ends(count: Column, tiles: int) -> list[Column]:
    """Last rank of every tile but the last; the first `count % tiles` tiles hold one row more."""
    size, extra = F.call_function("div", count, F.lit(tiles)), count % tiles
    return [size * t + F.least(F.lit(t).cast("bigint"), extra) for t in range(1, tiles)]


def ntiles(
    df: DataFrame,
    key: str,
    scores: Mapping[str, tuple[str, bool]],
    tiles: int = 4,
    method: str = "selected",
) -> DataFrame:
    """Add one NTILE column per entry of `scores`: name -> (numeric column, ascending).

    NULLs come last; `key`, unique per row, breaks ties in ascending order.
    """
    df, small = _settle(df, method)
    tie = F.col(key).asc_nulls_last()
    if small:
        def over(column: str, ascending: bool) -> Column:
            value = F.col(column)
            first = value.asc_nulls_last() if ascending else value.desc_nulls_last()
            return F.ntile(tiles).over(Window.orderBy(first, tie))

        return df.withColumns({name: over(*how) for name, how in scores.items()})

    def past(column: str, ascending: bool, end: Row) -> Column:
        """Whether a row comes after the row `end` in the order of its measure."""
        value, last = F.col(column), F.lit(end[column]).cast(df.schema[column].dataType)
        later = F.lit(False)
        if end[key] is not None:
            later = F.coalesce(F.col(key) > F.lit(end[key]).cast(df.schema[key].dataType), F.lit(True))
        if end[column] is None:
            return value.isNull() & later
        beyond = value > last if ascending else value < last
        return F.when(value.isNull() | beyond, True).when(value == last, later).otherwise(False)

    if method == "selected":
        orders = {name: ((column, ascending), (key, True)) for name, (column, ascending) in scores.items()}
        shares = [t / tiles for t in range(1, tiles)]
        found = boundary_rows(df, orders, shares, lambda n: [n // tiles * t + min(t, n % tiles) for t in range(1, tiles)])
        ends = {name: [found[name, t] for t in range(tiles - 1) if (name, t) in found] for name in scores}
    else:
        ends = {name: _sorted_ends(df, key, *how, tiles) for name, how in scores.items()}
    return df.withColumns(
        {name: sum((past(*how, end).cast("int") for end in ends[name]), F.lit(1)) for name, how in scores.items()}
    )


def _sorted_ends(df: DataFrame, key: str, column: str, ascending: bool, tiles: int) -> list[Row]:
    """The last row of every tile but the last, each measure sorted in its own type."""
    first = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    rows = df.select(F.lit(0).alias("_all"), *dict.fromkeys((key, column)))
    laid = laid_out(rows, [first, F.col(key).asc_nulls_last()])
    return rows_at(laid, "_all", lambda n: tile_ends(n, tiles)).collect()  # at most tiles - 1 rows


def quantiles(
    df: DataFrame,
    group: str,
    value: str,
    points: Mapping[str, float],
    method: str = "selected",
) -> DataFrame:
    """Exact quantiles per group with linear interpolation: one row per group, one column per point."""
    rows = df.select(F.col(group), F.col(value).cast("double").alias("_value")).where("_value IS NOT NULL")
    rows, small = _settle(rows, method)
    if small:
        at = F.percentile("_value", F.array(*(F.lit(float(p)) for p in points.values())))
        found = rows.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), at.alias("_q"))
        return found.select(group, "rows", *(F.col("_q")[i].alias(n) for i, n in enumerate(points)))

    def ranks(n: Column) -> list[Column]:
        spots = [(n - 1) * F.lit(float(p)) for p in points.values()]
        return [f(s).cast("bigint") + 1 for s in spots for f in (F.floor, F.ceil)]

    if method == "selected":
        found = values_at(rows, group, ["_value"], list(points.values()), ranks)
        slots = found.select(group, F.col("_n").alias("rows"), *(F.col(f"_v{i}._value").alias(f"_v{i}") for i in range(2 * len(points))))
    else:
        # Equal values are told apart by a number of no meaning, so that they too spread over blocks.
        tied = rows.withColumn("_tie", F.monotonically_increasing_id())
        laid = laid_out(tied, [F.col(group).asc_nulls_last(), F.col("_value"), F.col("_tie")])
        counts = laid.groupBy(F.col(group).alias("_counted")).agg(F.count(F.lit(1)).alias("rows"))
        slots = (
            rows_at(laid, group, ranks)
            .groupBy(group)
            .agg(*(F.max(F.when(F.col("_slot") == i, F.col("_value"))).alias(f"_v{i}") for i in range(2 * len(points))))
            .join(counts, F.col(group).eqNullSafe(F.col("_counted")))
        )

    def between(i: int, point: float) -> Column:
        spot = (F.col("rows") - 1) * F.lit(float(point))
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        mixed = low * (F.ceil(spot) - spot) + high * (spot - F.floor(spot))
        return F.when(spot == F.floor(spot), low).otherwise(mixed)

    columns = [between(i, p).alias(name) for i, (name, p) in enumerate(points.items())]
    return slots.select(group, "rows", *columns)


def lowest_share(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    share: tuple[int, int],
    name: str,
    method: str = "selected",
) -> DataFrame:
    """Flag the lowest `share` = (part, whole) of every group by `order`, the count rounded half up.

    The columns of `order` must identify a row and hold no NULL.
    """
    df, small = _settle(df, method)
    part, whole = share

    def size(n: Column) -> Column:
        return F.call_function("div", n * (2 * part) + whole, F.lit(2 * whole))

    if small:
        within = Window.partitionBy(group)
        rank = F.row_number().over(within.orderBy(*order))
        return df.withColumn(name, rank <= size(F.count(F.lit(1)).over(within)))

    if method == "selected":
        found = values_at(df.select(group, *order), group, order, [part / whole], lambda n: [size(n)])
        last = found.select(F.col(group).alias("_group"), F.col("_v0").alias("_last"))
    else:
        laid = laid_out(df.select(group, *order), [F.col(group).asc_nulls_last(), *map(F.col, order)])
        last = rows_at(laid, group, lambda n: [size(n)]).select(
            F.col(group).alias("_group"), F.struct(*order).alias("_last")
        )
    flag = F.coalesce(F.struct(*order) <= F.col("_last"), F.lit(False))
    marked = df.join(small_side(last), F.col(group).eqNullSafe(F.col("_group")), "left").withColumn(name, flag)
    return marked.drop("_group", "_last")


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, str],
    method: str = "selected",
) -> DataFrame:
    """Add inclusive running sums over the whole table in a total order: new column -> summed column, of whole numbers.

    Rows come back in that order, partition after partition. A NULL adds nothing.
    """
    return totalled(df, order, totals, method)[0]


def totalled(
    df: DataFrame, order: Sequence[Column], totals: Mapping[str, str], method: str = "selected"
) -> tuple[DataFrame, dict[str, int]]:
    """`running_totals`, and the sums over the whole table, which it knows beforehand.

    One shuffle sorts the rows into ranges, which stay where they are: a sum per block and total goes to the driver (as many
    blocks as shuffle partitions), and the stage that reads a block adds up from the block's start.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "window":
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first = df.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in totals.items())).first().asDict()
        return df.withColumns({name: F.coalesce(F.sum(c).over(upto), F.lit(0)) for name, c in totals.items()}), first

    laid = laid_out(df, order).drop("_place")
    sums = laid.groupBy("_block").agg(*(F.coalesce(F.sum(c).cast("bigint"), F.lit(0)).alias(n) for n, c in totals.items()))
    starts, whole = {}, dict.fromkeys(totals, 0)
    for row in sums.orderBy("_block").collect():  # one row per block
        starts[row["_block"]] = dict(whole)
        whole = {name: whole[name] + row[name] for name in totals}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto = None
        for batch in batches:
            if not batch.num_rows:
                continue
            upto = upto or dict(starts[batch.column("_block")[0].as_py()])
            kept = {n: batch.column(n) for n in batch.schema.names if n != "_block"}
            for name, column in totals.items():
                added = np.cumsum(batch.column(column).cast(pa.int64()).fill_null(0).to_numpy()) + upto[name]
                kept[name], upto[name] = pa.array(added, pa.int64()), int(added[-1])
            yield pa.RecordBatch.from_pydict(kept)

    kinds = T.StructType([*df.schema.fields, *(T.StructField(n, T.LongType()) for n in totals)])
    return laid.mapInArrow(add_up, kinds), whole
