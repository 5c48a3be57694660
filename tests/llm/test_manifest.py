"""The manifest against a tree built leaf by leaf, over more rounds than the query's table needs."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from basketry.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return sha256(text.encode("utf-8")).hexdigest()


def plain_leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def plain_proofs(nodes):
    """Root, and per node the digests beside its path, level by level."""
    above, paths, at = list(nodes), [[] for _ in nodes], list(range(len(nodes)))
    while len(above) > 1:
        for path, i in zip(paths, at):
            run = i // 3 * 3
            path.append((above[run:i], above[i + 1 : run + 3]))
        at = [i // 3 for i in at]
        above = [sha("".join(above[i : i + 3])) for i in range(0, len(above), 3)]
    return (above or [None])[0], paths


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root of rows (doc_id, source, lang, n_chars, text), tampered where doc_id is odd."""
    first = lambda value: (value is not None, value)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = [sorted((first(r[0]), plain_leaf(*r), r) for r in rows if r[1] == s) for s in sources]
    made = [plain_proofs([name for _, name, _ in tree]) for tree in trees]
    root, upper = plain_proofs([subroot for subroot, _ in made])
    found = []
    for tree, (subroot, paths), over in zip(trees, made, upper):
        for (_, name, row), path in zip(tree, paths):
            odd = row[0] is not None and row[0] % 2 == 1 and row[4] is not None
            folded = plain_leaf(*row[:4], row[4].replace("\n", "")) if odd else name
            for before, after in path + over:
                folded = sha("".join([*before, folded, *after]))
            proof = "".join("".join(before + after) for before, after in path + over)
            found.append((row[0], name, subroot, root, proof, folded))
    return sorted(found, key=repr)


def run(spark, rows, height):
    documents = spark.createDataFrame(rows, SCHEMA).repartition(5)
    odd = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    made = manifest.manifest(manifest.document_leaves(documents, odd), height)
    return sorted(map(tuple, made.collect()), key=repr)


def some_rows(counts, seed=1):
    pick = random.Random(seed)
    rows = []
    for source, many in counts.items():
        for _ in range(many):
            text = pick.choice([None, "", "a\nb", "line", "ü\n\nß" * 3])
            rows.append((pick.choice([None, *range(-5, 500)]), source, pick.choice([None, "en"]), pick.choice([None, 3]), text))
    return rows


@pytest.mark.parametrize("height", [1, 2, 6])
def test_equals_a_tree_built_leaf_by_leaf(spark, height):
    rows = some_rows({None: 2, "": 1, "hot": 85, "b": 27, "ä": 28, "Z": 9, "z": 4})
    rows += rows[:7] + rows[20:40]  # repeated rows
    assert run(spark, rows, height) == plain(rows)


def test_one_source_one_leaf_and_no_rows(spark):
    one = [(None, None, None, None, None)]
    (row,) = run(spark, one, 6)
    assert row == (None, sha("-----"), sha("-----"), sha("-----"), "", sha("-----"))
    assert run(spark, [], 6) == []


def test_only_tampering_breaks_the_proof(spark):
    rows = [(i, f"s{i % 3}", "en", 5, "a\nb" if i % 4 else "ab") for i in range(40)]
    for doc_id, _, _, root, _, folded in run(spark, rows, 2):
        assert (folded == root) == (doc_id % 2 == 0 or doc_id % 4 == 0)


def test_very_long_text_and_clashing_columns(spark):
    rows = [(1, "s", "en", 1, "x\n" * 400_000), (2, "s", "en", 1, "y")]
    wide = spark.createDataFrame([(*r, 7, "p", b"l") for r in rows], SCHEMA + ", pos long, group string, leaf binary")
    made = manifest.manifest(manifest.document_leaves(wide, F.lit(False)))
    assert {r["folded_root"] for r in made.collect()} == {plain(rows)[0][3]}


@pytest.mark.parametrize("many", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28])
def test_streaming_append_extends_witnesses(many):
    names = [sha(str(i)).encode() for i in range(many)]
    tree = manifest.Witnesses()
    for name in names:
        tree.append(name)
    root = tree.root(False)
    assert root.decode() == plain_proofs([n.decode() for n in names])[0]
    assert all(manifest.fold(name, sides) == root for name, sides in zip(names, tree.sides))
