"""Parquet tables laid out along a curve through several columns, with the bounds of every file kept beside them.

Each column is cut at exact quantiles into as many bins as there is room for; the bins' bits are interleaved, so that rows near
to each other in all columns lie in the same files. A reader that names ranges or values gets only the files whose bounds
meet them: the others are not even opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.selection import place, values_at

BITS = 4  # of a column: 16 bins


def bin_ends(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """Per column the places at which its bins end, ascending; the last bin is open."""
    cuts = 2**bits
    stacked = df.select(F.explode(F.array(*(F.struct(F.lit(i).alias("c"), place(F.col(c), df.schema[c].dataType).alias("at")) for i, c in enumerate(columns)))).alias("s")).select("s.*")
    shares = [i / cuts for i in range(1, cuts)]
    found = values_at(stacked, "c", ["at"], shares, lambda n: [F.greatest(F.ceil(n * F.lit(s)), F.lit(1)).cast("bigint") for s in shares])
    ends = {r["c"]: sorted({r[f"_v{i}"]["at"] for i in range(len(shares))}) for r in found.collect()}  # one row per column
    return [ends.get(i, []) for i in range(len(columns))]


def bin_of(at: Column, ends: Sequence[float]) -> Column:
    return reduce(lambda total, end: total + (at > F.lit(end)).cast("int"), ends, F.lit(0))


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS, ends: Sequence[Sequence[float]] | None = None) -> Column:
    """The place of a row on the curve: bits of its bins, the first column's foremost. Nulls lie in a column's last bin."""
    key = F.lit(0).cast("bigint")
    for i, (column, own) in enumerate(zip(columns, ends or bin_ends(df, columns, bits), strict=True)):
        bin_number = bin_of(place(F.col(column), df.schema[column].dataType), own)
        # Columns of few values have few bins: they are stretched over all numbers, so that every bit parts rows.
        number = F.call_function("div", bin_number * F.lit(2**bits), F.lit(len(own) + 1)).cast("int")
        for bit in range(bits):
            shift = bit * len(columns) + len(columns) - 1 - i
            key = key.bitwiseOR(F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint"), shift))
    return key


class RangedTable:
    """A table written once to `path`, with the bounds of `columns` per file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, df: DataFrame, columns: Sequence[str], files: int | None = None) -> None:
        """Lay out `df` in about `files` files (as many as shuffle partitions unless given) and keep their bounds.

        Rows of one place on the curve may fill several files. An empty table has files without rows, or none.
        """
        cuts = bin_ends(df, columns)
        laid = df.withColumns({"_curve": curve(df, columns, ends=cuts), "_part": F.monotonically_increasing_id()})
        spread = laid.repartitionByRange(files, "_curve", "_part") if files else laid.repartitionByRange("_curve", "_part")
        spread.drop("_curve", "_part").write.parquet(f"{self.path}/rows")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/rows")
        ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
        nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
        # A file that ends in another column's step holds few of the values between its bounds: the bins it has rows in, as bits.
        bins = []
        for c, own in zip(columns, cuts, strict=True):
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), bin_of(place(F.col(c), df.schema[c].dataType), own))
            bins += [F.bit_or(bit).alias(f"bins_{c}"), F.any_value(F.array(*map(F.lit, own)).cast("array<double>")).alias(f"ends_{c}")]
        bounds = rows.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends, *nulls, *bins)
        bounds.write.parquet(f"{self.path}/bounds")

    def files(self, wanted: Mapping[str, Sequence] | None = None) -> list[str]:
        """Files that can hold rows wanted: per column a (least, most) pair, or a list of values. Bounds are one row per file."""
        bounds = self.spark.read.parquet(f"{self.path}/bounds")
        for column, what in (wanted or {}).items():
            least, most = F.col(f"least_{column}"), F.col(f"most_{column}")
            if isinstance(what, tuple):
                bounds = bounds.where((most >= F.lit(what[0])) & (least <= F.lit(what[1])))
            else:
                kind = bounds.schema[f"least_{column}"].dataType

                def held(value) -> Column:
                    at = place(F.lit(value).cast(kind), kind)
                    passed = F.size(F.filter(f"ends_{column}", lambda end: end < at))
                    return F.call_function("shiftright", F.col(f"bins_{column}"), passed).bitwiseAND(F.lit(1).cast("bigint")) == 1

                bounds = bounds.where(reduce(Column.__or__, ((least <= F.lit(v)) & (most >= F.lit(v)) & held(v) for v in what), F.lit(False)))
        return sorted(r.file for r in bounds.select("file").collect())

    def read(self, schema: T.StructType, wanted: Mapping[str, Sequence] | None = None) -> DataFrame:
        """The rows wanted, from the files that can hold them; rows with a null in a wanted column are not."""
        files = self.files(wanted)
        rows = self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
        for column, what in (wanted or {}).items():
            inside = F.col(column).between(F.lit(what[0]), F.lit(what[1])) if isinstance(what, tuple) else F.col(column).isin(list(what))
            rows = rows.where(inside)
        return rows
