"""Rows at given ranks without sorting the table: a sketch brackets each rank, and only what lies in brackets is ordered.

One scan takes a quantile sketch of every measure; sketches merge on the map side, and their rank error is bounded, so the
sought value lies between two quantiles around it. A second scan counts what comes before a bracket and keeps what lies in it:
a few ten-thousandths of the rows, besides rows whose values are equal. Those alone are ordered. The counts prove that
a bracket holds its rank; should one not, it is opened wider.

A bracket is a range of *places*: doubles in which a measure's order may lose ties but never turns around. Numbers and
dates place themselves, texts by six bytes after what they have in common, nulls after everything else.
"""

from __future__ import annotations

import os.path
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import materialise, small_side
from basketry.store import discard

ACCURACY = 10_000  # the sketch's rank error is at most rows / ACCURACY
MARGIN = 2 / ACCURACY
FEW = 5_000  # rows; in smaller tables a rank's share says too little, all rows are kept
BOUND = 500_000  # kept rows or steps that plain windows order; more are narrowed first, or laid out by a distributed sort
LAST = float("inf")

Order = Sequence[tuple[str, bool]]  # columns and whether each ascends; nulls come last either way


def place(column: Column, kind: T.DataType, ascending: bool = True, skip: int = 0) -> Column:
    """A double that never decreases along the order of the column; texts agree in their first `skip` bytes."""
    if isinstance(kind, T.StringType):
        head = F.substring(F.encode(column, "utf-8"), skip + 1, 6)  # 48 bits: exact as a double
        number = F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(column).cast("double")
    else:
        number = column.cast("double")
    # NaN is the greatest value of its type, as infinity is here.
    number = F.when(F.isnan(number), LAST).otherwise(number)
    return F.coalesce(number if ascending else -number, F.lit(LAST))


def sketched(at: Column, shares: Sequence[float]) -> Column:
    """Aggregate: places at the given shares of the rows, within the sketch's error."""
    return F.percentile_approx(at, F.array(*(F.lit(min(max(s, 0.0), 1.0)) for s in shares)), ACCURACY)


def _ends(values: Sequence[float], i: int, share: float, margin: float) -> tuple[float, float]:
    """The bracket around share `i`; beyond the first or last row it is open."""
    return (values[2 * i] if share > margin else -LAST), (values[2 * i + 1] if share < 1 - margin else LAST)


@dataclass(frozen=True)
class Spot:
    """A sought row: which measure, which end, its rank among the rows kept for it, and its present bracket."""

    name: str
    end: int
    order: Order
    rank: int
    low: float = -LAST
    high: float = LAST
    level: int = 0  # the column of the order that is bracketed; all before are the same in the rows kept
    skip: int = 0  # bytes that the texts in that column have in common

    def place(self, df: DataFrame) -> Column:
        column, ascending = self.order[self.level]
        return place(F.col(column), df.schema[column].dataType, ascending, self.skip)


def boundary_rows(df: DataFrame, orders: Mapping[str, Order], shares: Sequence[float], ranks: Callable[[int], Sequence[int]]) -> dict[tuple[str, int], Row]:
    """The rows at `ranks(count)` in each of the orders, by (name, number of the rank): at most as many as were asked for.

    `shares` are the ranks as parts of the count, to within one row. Rows that agree in all columns of an order are
    one as good as the other.
    """
    sketches = [sketched(Spot(name, 0, order, 0).place(df), [s for p in shares for s in (p - MARGIN, p + MARGIN)]) for name, order in orders.items()]
    rows, *found = df.agg(F.count(F.lit(1)), *sketches).first()
    if not rows:
        return {}
    spots = []
    for (name, order), values in zip(orders.items(), found, strict=True):
        for i, (share, rank) in enumerate(zip(shares, ranks(rows), strict=True)):
            spots.append(Spot(name, i, order, rank, *(_ends(values, i, share, MARGIN) if rows > FEW else ())))
    spots = [s for s in spots if 1 <= s.rank <= rows]
    kept, spots, size = _kept(df, spots, first=True)
    order = _windowed
    while size > BOUND:
        narrower, after, smaller = _narrowed(kept, spots)
        if smaller == size and all(a.level == s.level for a, s in zip(after, spots, strict=True)):
            order = _ordered
            break
        discard(kept)
        kept, spots, size = narrower, after, smaller
    found_rows = order(kept, spots)
    discard(kept)
    return found_rows


def _kept(df: DataFrame, spots: list[Spot], first: bool) -> tuple[DataFrame, list[Spot], int]:
    """Rows in their brackets, as (_sought, columns), with each spot's rank counted from its bracket's begin.

    `df` is the table itself or rows kept before. A spot whose rows all agree in the present column goes on to the next one.
    """
    columns = list(dict.fromkeys(c for s in spots for c, _ in s.order))
    seen, watched = Observation(), []
    inside = []
    for i, spot in enumerate(spots):
        own = F.lit(True) if first else F.col("_sought") == i
        at, column = spot.place(df), F.col(spot.order[spot.level][0])
        within = own & (at >= spot.low) & (at <= spot.high)
        inside.append(within)
        watched += [
            F.count_if(own & (at < spot.low)).alias(f"before{i}"),
            F.count_if(within).alias(f"inside{i}"),
            F.count_if(within & column.isNull()).alias(f"nulls{i}"),
            F.min(F.when(within, column)).eqNullSafe(F.max(F.when(within, column))).alias(f"same{i}"),
        ]
    if first:
        chosen = F.explode(F.filter(F.array(*(F.when(w, F.lit(i)) for i, w in enumerate(inside))), lambda s: s.isNotNull()))
        kept = df.observe(seen, *watched).select(chosen.alias("_sought"), *columns)
    else:
        kept = df.observe(seen, *watched).where(F.array(*inside)[F.col("_sought")]).select("_sought", *columns)
    kept = materialise(kept)[0]
    counts, after, failed = seen.get, [], False
    for i, spot in enumerate(spots):
        rank, many = spot.rank - counts[f"before{i}"], counts[f"inside{i}"]
        if not 1 <= rank <= many:  # the sketch was further off than it says
            failed = True
            after.append(replace(spot, low=-LAST, high=LAST))
            continue
        settled = counts[f"nulls{i}"] in (0, many) and counts[f"same{i}"] and spot.level + 1 < len(spot.order)
        after.append(replace(spot, rank=rank, level=spot.level + settled, skip=0 if settled else spot.skip))
    if failed:
        discard(kept)
        wider = [replace(a, rank=s.rank, level=s.level) if a.low == -LAST and a.high == LAST else s for a, s in zip(after, spots, strict=True)]
        return _kept(df, wider, first)
    return kept, after, sum(counts[f"inside{i}"] for i in range(len(spots)))


def _narrowed(kept: DataFrame, spots: list[Spot]) -> tuple[DataFrame, list[Spot], int]:
    """Rows kept, bracketed again: each spot by the column that still tells its rows apart."""
    spots = list(spots)
    mine = [F.when(F.col("_sought") == i, F.col(spot.order[spot.level][0])) for i, spot in enumerate(spots)]
    about = kept.agg(*(F.struct(F.count_if(F.col("_sought") == i), F.min(c), F.max(c)) for i, c in enumerate(mine))).first()
    many = [count for count, _, _ in about]
    own = F.lit(None).cast("double")
    for i, (_, least, most) in enumerate(about):
        if isinstance(least, str):  # all texts between these two begin with what they have in common
            spots[i] = replace(spots[i], skip=len(os.path.commonprefix([least.encode(), most.encode()])))
        own = F.when(F.col("_sought") == i, spots[i].place(kept)).otherwise(own)
    shares = [spot.rank / many[i] for i, spot in enumerate(spots)]
    found = kept.groupBy("_sought").agg(sketched(own, [s for p in shares for s in (p - MARGIN, p + MARGIN)]).alias("at")).collect()
    ends = {r["_sought"]: r["at"] for r in found}
    tighter = []
    for i, spot in enumerate(spots):
        low, high = _ends(ends[i], i, shares[i], MARGIN) if many[i] > FEW else (-LAST, LAST)
        tighter.append(replace(spot, low=low, high=high))
    return _kept(kept, tighter, first=False)


def _sorting(spots: list[Spot]) -> list[Column]:
    """One order for the rows of all spots: within a spot only its own columns differ from null."""
    return [F.when(F.col("_sought") == i, F.col(c)).asc_nulls_last() if up else F.when(F.col("_sought") == i, F.col(c)).desc_nulls_last() for i, s in enumerate(spots) for c, up in s.order]


def _windowed(kept: DataFrame, spots: list[Spot]) -> dict[tuple[str, int], Row]:
    rank = F.row_number().over(Window.partitionBy("_sought").orderBy(*_sorting(spots)))
    wanted = F.array(*(F.lit(s.rank) for s in spots))[F.col("_sought")]
    found = kept.withColumn("_rank", rank).where(F.col("_rank") == wanted).collect()  # one row per spot
    return {(spots[r["_sought"]].name, spots[r["_sought"]].end): r for r in found}


def _ordered(kept: DataFrame, spots: list[Spot]) -> dict[tuple[str, int], Row]:
    """The same for rows that brackets cannot part, by a distributed sort."""
    from basketry.operators.ranking import laid_out, rows_at

    laid = laid_out(kept, [F.col("_sought"), *_sorting(spots)])
    wanted = F.array(*(F.lit(s.rank).cast("bigint") for s in spots))
    found = rows_at(laid, "_sought", lambda n: [wanted[F.col("_sought")]]).collect()  # one row per spot
    return {(spots[r["_sought"]].name, spots[r["_sought"]].end): r for r in found}


def values_at(df: DataFrame, group: str, order: Sequence[str], shares: Sequence[float], ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """Per group its row count `_n` and the values `_v0`, `_v1`, ... of `order` at the ranks `ranks(_n)`, all ascending.

    `shares` are the ranks as parts of the count, to within one row and a half; the columns of `order` hold no null. One
    sketch per group and task is shuffled, then one row per group, task and value inside of a bracket, or gap between
    brackets: a hot group is combined before it moves.
    """
    at, shares = place(F.col(order[0]), df.schema[order[0]].dataType), sorted(shares)
    ends = sketched(at, [s for p in shares for s in (p - MARGIN, p + MARGIN)])
    sketches = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), ends.alias("_at"))
    few = F.col("_n") <= FEW
    open_at = [(few | F.lit(s <= MARGIN), few | F.lit(s >= 1 - MARGIN)) for s in shares]
    lows = F.array(*(F.when(start, -LAST).otherwise(F.col("_at")[2 * i]) for i, (start, _) in enumerate(open_at)))
    highs = F.array(*(F.when(end, LAST).otherwise(F.col("_at")[2 * i + 1]) for i, (_, end) in enumerate(open_at)))
    brackets = small_side(sketches.select(F.col(group).alias("_group"), "_n", lows.alias("_lows"), highs.alias("_highs")))
    return _resolved(df, group, order, at, brackets, len(shares), ranks)


def _resolved(df: DataFrame, group: str, order: Sequence[str], at: Column, brackets: DataFrame, many: int, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    met = df.withColumn("_place", at).join(brackets, F.col(group).eqNullSafe(F.col("_group")))
    # Brackets that end before the row. A row outside of all comes before those of the next bracket, which have passed as many.
    # Both ends ascend, so that a row in any bracket is in the first that does not end before it. One comparison a bracket written
    # out as an expression made a method too long for the JVM to compile.
    passed = F.size(F.filter("_highs", lambda high: high < F.col("_place")))
    met = met.withColumn("_passed", passed)
    step = F.when(F.get("_lows", F.col("_passed")) <= F.col("_place"), F.struct(*order))
    steps, size = materialise(met.groupBy("_group", "_n", "_passed", step.alias("_step")).agg(F.count(F.lit(1)).alias("_rows")))
    along = [F.col("_passed"), F.col("_step").asc_nulls_first()]
    if size <= BOUND:
        upto = Window.partitionBy("_group").orderBy(*along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = steps.withColumn("_upto", F.sum("_rows").over(upto))
    else:
        from basketry.operators.ranking import running_totals

        whole = running_totals(steps, [F.col("_group").asc_nulls_first(), *along], {"_over": "_rows"})
        # Sums run over all groups: what came before a group is the least of them, less its own first step.
        starts = whole.groupBy(F.col("_group").alias("_of")).agg(F.min(F.col("_over") - F.col("_rows")).alias("_start"))
        summed = whole.join(starts, F.col("_group").eqNullSafe(F.col("_of"))).withColumn("_upto", F.col("_over") - F.col("_start"))
    wanted = list(ranks(F.col("_n")))
    holds = [(F.col("_upto") >= w) & (F.col("_upto") - F.col("_rows") < w) for w in wanted]
    found = summed.groupBy("_group", "_n").agg(
        *(F.max(F.when(h, F.col("_step"))).alias(f"_v{i}") for i, h in enumerate(holds)),
        *(F.count_if(h & F.col("_step").isNull()).alias(f"_missed{i}") for i, h in enumerate(holds)),
    )
    found = materialise(found)[0]
    discard(steps)
    missed = sum((F.col(f"_missed{i}") for i in range(len(holds))), F.lit(0)) > 0
    if not found.where(missed).isEmpty():  # a sketch was further off than it says: those groups' brackets open
        opened = found.where(missed).select(F.col("_group").alias("_open"))
        whole = brackets.join(opened, F.col("_group").eqNullSafe(F.col("_open")), "left")
        everything = {c: F.when(F.col("_open").isNotNull() | F.col("_group").isNull(), F.array_repeat(F.lit(v), many)).otherwise(F.col(c)) for c, v in (("_lows", -LAST), ("_highs", LAST))}
        return _resolved(df, group, order, at, whole.withColumns(everything).drop("_open"), many, ranks)
    return found.select(F.col("_group").alias(group), "_n", *(F.col(f"_v{i}") for i in range(len(holds))))
