"""The registered queries over whole small tables, against SQL or a plain computation of the same thing."""

import collections
import html
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from basketry.llm.oracle import ORACLE
from basketry.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def result(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    found = [tuple(r[c] for c in columns) for r in result(spark, name)]
    assert sorted(found, key=repr) == sorted(cursor.fetchall(), key=repr)


def test_language_model_counts_and_base(spark, duck):
    docs = duck.execute("select doc_id, text from documents").fetchall()
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, vocabulary = sum(counts.values()), len(counts)
    rows = result(spark, "op3_language_model")
    assert sorted(r["doc_id"] for r in rows) == sorted(tokens)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + vocabulary + 1)) for w in own))
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_html_text_is_the_article(spark, duck):
    truth = {}
    for page, source in duck.execute("select page_id, html from pages").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", source, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        truth[page] = "\n\n".join(b for b in blocks if b)
    rows = result(spark, "op4_html_extraction")
    assert {r["page_id"]: r["text"] for r in rows} == truth
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_packing_and_token_files_round_trip(spark, duck):
    library = Tokenizer.from_file(tokenizer_path())
    docs = duck.execute("select doc_id, text from documents order by doc_id").fetchall()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in docs}
    check = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    start = 0
    for row in sorted(result(spark, "op10_token_files"), key=lambda r: r["doc_id"]):
        own = [*ids[row["doc_id"]], 2]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(own), check(own))
        start += len(own)
    sequences, covered = collections.defaultdict(list), collections.Counter()
    for row in result(spark, "op8_packing"):
        own = [*ids[row["doc_id"]], 0]
        assert row["doc_tokens"] == len(own)
        assert row["ids_crc32"] == check(own[row["start"] : row["start"] + row["length"]])
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
        covered[row["doc_id"]] += row["length"]
    assert covered == {i: len(x) + 1 for i, x in ids.items()}
    for held in sequences.values():
        assert [o for o, _ in sorted(held)] == [sum(n for _, n in sorted(held)[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 1024
    assert sum(covered.values()) > 0.98 * 1024 * len(sequences)


def test_quality_separates_held_out_documents(spark, duck):
    labels = dict(duck.execute("select doc_id, quality from labels").fetchall())
    rows = [r for r in result(spark, "op9_quality") if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    good = [r["score"] for r in rows if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in rows if labels[r["doc_id"]] == 0]
    ordered = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert ordered >= 0.9 * len(good) * len(bad)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
