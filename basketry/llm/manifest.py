"""A Merkle manifest of a dataset: every row a leaf, one tree per group, one tree over the groups, a proof per leaf.

Leaves are appended in order to a forest of open subtrees. An append gives the new leaf an empty witness; each time a run of
siblings is complete, the witnesses of all leaves under it grow by the digests of the others, so that a witness is a leaf's
proof as far as its subtree is built. Aligned blocks of FANOUT ** height leaves are appended in tasks of their own, whatever
group they belong to; their roots are the leaves of the next round, and the witness that a block root gets there extends the
witnesses of all leaves in its block. The roots of the groups are appended in the same way.

No task holds more than one block, and a group of any size is spread over its blocks. What is shuffled for a leaf is its key
and one or two digests; the texts are read once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import written

FANOUT, HEIGHT = 3, 6  # siblings of a run, levels of a block
IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id keeps the place within the partition in 33 bits


def digest(text: bytes) -> bytes:
    """The lowercase hex SHA-256 that stands for a node."""
    return sha256(text).hexdigest().encode()


class Witnesses:
    """A streaming append of nodes with the witness of each: per level the digests before and after it in its run."""

    def __init__(self, height: int = HEIGHT) -> None:
        self.height = height
        self.open: list[list[tuple[bytes, int, int]]] = [[]]  # per level: digest, first and last node below, of the open run
        self.sides: list[list[bytes]] = []

    def append(self, node: bytes) -> None:
        self.sides.append([])
        self._add(0, (node, len(self.sides) - 1, len(self.sides)))

    def _add(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        names = [name for name, _, _ in run]
        for at, (_, first, last) in enumerate(run):
            beside = (b"".join(names[:at]), b"".join(names[at + 1 :]))
            for sides in self.sides[first:last]:
                sides += beside
        self._add(level + 1, (digest(b"".join(names)), run[0][1], run[-1][2]))

    def root(self, whole: bool) -> bytes:
        """The digest over all nodes: `height` levels up in a block that others follow or precede, else as soon as one is left."""
        levels, reach = 0, 1
        while levels < self.height and (whole or reach < len(self.sides)):
            levels, reach = levels + 1, reach * FANOUT
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0][0]


def fold(node: bytes, sides: Sequence[bytes]) -> bytes:
    """The root that a node and its witness give."""
    for before, after in zip(sides[::2], sides[1::2], strict=True):
        node = digest(before + node + after)
    return node


def _placed(rows: DataFrame, *order: Column | str) -> DataFrame:
    """`rows` with the place of each in its `group`, from 0, by `order`: one global sort, then sums over counts per partition."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION))
    laid = written(rows.orderBy("group", *order).withColumns({"part": F.spark_partition_id(), "at": place}), "sorted")
    begun = laid.groupBy("group", "part").agg(F.count(F.lit(1)).alias("many"), F.min("at").alias("first"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = begun.select("group", "part", "first", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("earlier"))
    return laid.join(before, ["group", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("earlier")).drop("part", "at", "first", "earlier")


def _block(height: int) -> Column:
    return F.expr(f"pos div {FANOUT**height}").alias("block")


def _dealt(rows: DataFrame) -> DataFrame:
    """Whole blocks in one task each, their rows in order."""
    return rows.repartition("group", "block").sortWithinPartitions("group", "block", "pos")


def _roots(nodes: DataFrame, height: int) -> DataFrame:
    """The root of every block of `nodes`, as a node of the next round."""

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, Witnesses(height)

        def root() -> tuple:
            return *key, bytes.fromhex(tree.root(key[1] > 0).decode())

        def made(done: list[tuple]) -> pa.RecordBatch:
            groups, blocks, roots = zip(*done, strict=True) if done else ([], [], [])
            return pa.RecordBatch.from_pydict({"group": pa.array(groups, pa.string()), "pos": pa.array(blocks, pa.int64()), "node": pa.array(roots, pa.binary())})

        for batch in batches:
            done = []
            for group, block, node in zip(*(batch.column(n).to_pylist() for n in ("group", "block", "node")), strict=True):
                if (group, block) != key:
                    if key:
                        done.append(root())
                    key, tree = (group, block), Witnesses(height)
                tree.append(node.hex().encode())
            yield made(done)
        if key:
            yield made([root()])

    return _dealt(nodes.select("group", "pos", "node", _block(height))).mapInArrow(append, "group string, pos long, node binary")


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """`nodes` and the block roots of each round above them, up to one per group."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        rounds.append(written(_roots(rounds[-1], height), "block-roots"))
    return rounds


def _extended(nodes: DataFrame, above: DataFrame, height: int, kinds: str, give: Callable[[dict, list[bytes], dict], tuple]) -> DataFrame:
    """Rows of `give` for each node: its own witness, extended by that of its block root in `above` (group, pos, sides, whole)."""
    tops = above.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))
    both = nodes.select("*", _block(height)).unionByName(tops, allowMissingColumns=True)
    dealt = _dealt(both)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        top, held = None, []

        def finished() -> list[tuple]:
            tree = Witnesses(height)
            for row in held:
                tree.append(row["node"].hex().encode())
            if held:
                tree.root(top["whole"])
            upper = [side.encode() for side in top["sides"] or ()] if top else []
            return [give(row, sides + upper, top) for row, sides in zip(held, tree.sides, strict=True)]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([(n, TYPES[k]) for n, k in (c.split(" ") for c in kinds.split(", "))])
            done = []
            for row in batch.to_pylist():
                if row["pos"] == -1:
                    done += finished()
                    top, held = row, []
                else:
                    held.append(row)
            yield made(done)
        if held:
            yield made(finished())

    return dealt.mapInArrow(extend, kinds)


TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def _tops(rounds: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """One row per block of leaves: its root's witness, and whether `height` levels lie below it. `above`: (group, sides)."""
    sides = above.select("group", F.lit(0).cast("long").alias("pos"), "sides")
    for nodes in reversed(rounds):
        several = nodes.groupBy("group").agg((F.max("pos") >= FANOUT**height).alias("whole"))
        sides = sides.join(several, "group")
        if nodes is not rounds[0]:
            sides = _extended(nodes, sides, height, "group string, pos long, sides array<string>", lambda row, sides, top: (row["group"], row["pos"], [s.decode() for s in sides]))
    return sides


def manifest(leaves: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of every row of `leaves` (source, doc_id, leaf, claimed).

    `leaf` and `claimed` are 32-byte digests; `folded_root` is what `claimed` gives with the witness of `leaf`, `proof` that
    witness as hex text. Trees stand over the leaves of each source by doc_id (null first), rows of one id by their digest;
    the sources' roots are ordered by source, null first, then bytewise. A null source is a source of its own. An empty table
    gives no rows.
    """
    group = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("."), "source"))
    # Written first: the sort samples its input before it deals it out, and would hash all texts twice.
    named = written(leaves.select(group.alias("group"), "doc_id", F.col("leaf").alias("node"), "claimed"), "digests")
    rows = written(_placed(named, "doc_id", "node"), "leaves")
    rounds = _rounds(rows, height)
    subroots = rounds[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), "node")
    over = _rounds(written(_placed(subroots, "name"), "subroots"), height)
    root = over[-1].select("node").first()  # the one row of the last round, or none

    nothing = over[-1].select("group", F.array().cast("array<string>").alias("sides"))
    upper = _extended(
        over[0], _tops(over, nothing, height), height, "group string, subroot binary, sides array<string>",
        lambda row, sides, top: (row["name"], row["node"], [s.decode() for s in sides]),
    )
    upper = written(upper.withColumn("root", F.lit(bytes(root.node) if root else None).cast("binary")), "proofs")
    tops = _tops(rounds, upper, height).join(upper.select("group", "subroot", "root"), "group")

    def give(row: dict, sides: list[bytes], top: dict) -> tuple:
        folded = fold(row["claimed"].hex().encode(), sides)
        return row["doc_id"], row["node"].hex(), top["subroot"].hex(), top["root"].hex(), b"".join(sides).decode(), folded.decode()

    kinds = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string"
    return _extended(rows, tops, height, kinds, give)


def encoded(column: Column) -> Column:
    """A field as text: `-` for null, else its length in UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(*fields: Column) -> Column:
    """The 32-byte digest of a row's fields."""
    return F.unhex(F.sha2(F.concat(*(encoded(f) for f in fields)), 256))


def document_leaves(documents: DataFrame, tampered: Column) -> DataFrame:
    """(source, doc_id, leaf, claimed) of documents; where `tampered` holds, `claimed` is of the text without its line ends."""
    doc_id, n_chars = (F.col(c).cast("long") for c in ("doc_id", "n_chars"))
    source, lang, text = (F.col(c).cast("string") for c in ("source", "lang", "text"))
    own = leaf(doc_id, source, lang, n_chars, text)
    changed = tampered & F.contains(text, F.lit("\n"))
    other = leaf(doc_id, source, lang, n_chars, F.replace(text, F.lit("\n"), F.lit("")))
    return documents.select(source.alias("source"), doc_id.alias("doc_id"), own.alias("leaf"), F.when(changed, other).alias("claimed")).withColumn(
        "claimed", F.coalesce("claimed", "leaf")
    )
