"""Order totals kept up to date by difference, and customer sets per month that any report can unite.

The state holds, per order and category, sums that can be added and taken away: cents and counts. Changed lines are summed the
same way with a sign, old values negative, and only the buckets of orders that they touch are written anew, as the next version
of the table. Sums are whole numbers, so any sequence of changes gives what a full build gives. A change is one grouping of plain
numbers; an order's categories are gathered only when the state is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.exact import cents, from_cents, rounded_mean, units
from basketry.operators.distinct import distinct_sets, sizes
from basketry.plans.facts import ORDER_COLUMNS
from basketry.sources.versioned import VersionedTable

_MARGIN_PLACES = 4
SUMS = ("_rows", "_lines", "_cents", "_discounts", "_discounted", "_margins", "_margined")


def line_sums(items: DataFrame, products: DataFrame, sign: int = 1) -> DataFrame:
    """(order_id, category, sums) of order lines, counted `sign` times."""
    return _summed(_each_line(_signed(items, sign), products))


def _signed(items: DataFrame, sign: int) -> DataFrame:
    """What is summed of each line, and how often it counts."""
    kept = items.where("order_id IS NOT NULL")
    return kept.select("order_id", "product_id", "item_id", cents(F.col("line_total")).alias("_total"), cents(F.col("discount")).alias("_discount"), F.lit(sign).alias("_sign"))


def _each_line(signed: DataFrame, products: DataFrame) -> DataFrame:
    """Each line as the sums of one line. Lines with either sign meet the products in one join."""
    priced = products.select("product_id", "category", units(F.col("margin"), _MARGIN_PLACES).alias("_margin"))
    whole = {
        "_rows": F.lit(1),
        "_lines": F.col("item_id").isNotNull(),
        "_cents": F.coalesce("_total", F.lit(0)),
        "_discounts": F.coalesce("_discount", F.lit(0)),
        "_discounted": F.col("_discount").isNotNull(),
        "_margins": F.coalesce("_margin", F.lit(0)),
        "_margined": F.col("_margin").isNotNull(),
    }
    return signed.join(priced, "product_id", "left").select("order_id", "category", *((v.cast("bigint") * F.col("_sign")).alias(k) for k, v in whole.items()))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("order_id", "category").agg(*(F.sum(s).alias(s) for s in SUMS))


def merged(state: DataFrame, *changes: DataFrame) -> DataFrame:
    """The state after changes: all are sums per order and category, of which those that have come to nothing drop out."""
    both = state
    for change in changes:
        both = both.unionByName(change)
    return _summed(both).where(" OR ".join(f"{s} <> 0" for s in SUMS))


def per_order(state: DataFrame) -> DataFrame:
    """(order_id, sums, categories) of orders that have lines. A category's count is of the lines that have it."""
    there = F.when(F.col("category").isNotNull() & (F.col("_rows") != 0), F.struct("category", F.col("_rows").alias("many")))
    each = state.withColumn("_of", there).groupBy("order_id")
    return each.agg(*(F.sum(s).alias(s) for s in SUMS), F.collect_list("_of").alias("categories")).where("_rows <> 0")


def order_facts(orders: DataFrame, state: DataFrame) -> DataFrame:
    """Order facts from staged orders, each id once, and the kept sums; the columns of a full build."""
    lines = state.select(
        F.col("order_id").alias("_order"),
        from_cents(F.col("_cents")).alias("_total"),
        "_lines",
        rounded_mean(F.col("_discounts"), F.col("_discounted"), 2, 4).alias("avg_discount"),
        rounded_mean(F.col("_margins"), F.col("_margined"), _MARGIN_PLACES, 4).alias("avg_margin"),
        F.sort_array(F.col("categories.category")).alias("_categories"),
    )
    done = orders.select(*ORDER_COLUMNS).join(lines, F.col("order_id") == F.col("_order"), "left")
    return done.select(
        *ORDER_COLUMNS,
        F.col("_total").alias("order_total"),
        F.coalesce("_lines", F.lit(0).cast("bigint")).alias("num_items"),
        "avg_discount",
        "avg_margin",
        F.coalesce("_categories", F.array().cast("array<string>")).alias("categories_purchased"),
    )


class LineTotals:
    """The kept state: a versioned table in buckets of order ids."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.table, self.buckets = VersionedTable(spark, path), buckets

    def _bucketed(self, state: DataFrame) -> DataFrame:
        return state.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int"))

    def rebuild(self, items: DataFrame, products: DataFrame) -> None:
        """Replace the state by a full build."""
        self.table.write(self._bucketed(line_sums(items, products)), ["bucket"])

    def state(self) -> DataFrame:
        """One row per order that has lines."""
        return per_order(self.table.read().drop("bucket"))

    def apply(self, inserted: DataFrame, deleted: DataFrame, products: DataFrame) -> list[int]:
        """Add and take away lines (a changed line is both, old and new), and return the buckets that were written.

        Only buckets with orders that the changes touch are read and written; a bucket left without orders keeps no rows. Products
        must be those that the deleted lines were added with.
        """
        orders = inserted.select("order_id").unionByName(deleted.select("order_id")).where("order_id IS NOT NULL")
        touched = sorted(r.bucket for r in self._bucketed(orders).select("bucket").distinct().collect())  # at most one row per bucket
        if not touched:
            return []
        old = self.table.read().where(F.col("bucket").isin(touched)).drop("bucket")
        new = self._bucketed(merged(old, _each_line(_signed(inserted, 1).unionByName(_signed(deleted, -1)), products)))
        self.table.write(new, ["bucket"], only_touched=True, touched=[f"bucket={b}" for b in touched])
        return touched


def monthly_customers(facts: DataFrame, status: str = "completed") -> DataFrame:
    """Customers with an order of one status per month, as sets; customer ids are whole numbers."""
    return distinct_sets(facts.where(F.col("status") == status), ["order_year", "order_month"], F.col("customer_id"))


def customers_in(sets: DataFrame, years: Sequence[int] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Different customers in the chosen years, per group of months, from the sets alone."""
    chosen = sets if years is None else sets.where(F.col("order_year").isin(*years))
    return sizes(chosen, list(groups), "unique_customers")
