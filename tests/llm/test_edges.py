"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, operator by operator."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import components, decontaminate, html_text, language_model, line_dedup, near_dedup, packing, quality, substring_dedup, token_files, topk
from basketry.llm.common import new_folder
from basketry.llm.queries import tokenizer_path
from basketry.llm.tokenizer import TextEncoder

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
ROWS = [
    (1, "the first line is long enough to count\nown line one"),
    (2, "THE first line is long enough to count  \nown line two"),
    (3, "the first line is long enough to count"),
    (4, None),
    (5, ""),
    (6, LONG),
    (7, f"before {PASSAGE} after"),
    (8, f"{PASSAGE} else"),
    (8, f"{PASSAGE} else"),
    (None, "a row without an id has words of its own here"),
]
EXTRA = "doc_id long, text string, print string, row string, score string, hash string, words string, place string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", None, "x", "x", "x", "x") for i, t in ROWS], EXTRA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_lines(docs, none):
    rows = by_id(line_dedup.dedup_lines(docs))
    assert rows[1]["kept"] == "own line one" and rows[2]["n_dropped"] == 1 and rows[3]["n_dropped"] == 0
    assert rows[4]["n_lines"] == rows[5]["n_lines"] == 1 and rows[4]["kept"] == ""
    assert rows[6]["kept"] == LONG and rows[None]["n_lines"] == 1
    assert line_dedup.dedup_lines(docs).count() == len(ROWS)
    assert line_dedup.dedup_lines(none).count() == 0


def test_runs_hold_each_hash_once_through_compaction(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for low in (0, 50, 25, 90, 10):
        runs.add(spark.range(low, low + 40).selectExpr("cast(cast(id as string) as binary) as hash", f"{low} as keeper"))
    held = runs.all().collect()
    assert len(held) == len({bytes(r["hash"]) for r in held}) == 130 - 0
    assert len(runs.levels) > 1


def test_benchmark(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE), (2, "own line two"), (3, None), (4, "..."), (None, "of its own here")], "item_id long, text string")
    rows = by_id(decontaminate.contamination(docs, items))
    assert (rows[7]["n_hit"], rows[7]["items"]) == (40, ["1"]) and (rows[2]["n_hit"], rows[2]["items"]) == (3, ["2"])
    assert rows[None]["contaminated"] and rows[None]["items"] == [] and not rows[6]["contaminated"] and rows[4]["n_words"] == 0
    assert decontaminate.contamination(docs, items).count() == len(ROWS)
    assert decontaminate.contamination(none, items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, items.limit(0)).collect())


def test_near_copies(spark, docs, none):
    base = [f"w{i}" for i in range(60)]
    copies = [(20, " ".join(base)), (21, " ".join([*base[:59], "z"])), (22, " ".join(["y", *base[1:59], "z"])), (19, " ".join(base).upper())]
    rows = by_id(near_dedup.near_duplicates(docs.select("doc_id", "text").union(spark.createDataFrame(copies, "doc_id long, text string"))))
    assert {rows[i]["component_id"] for i in (19, 20, 21, 22)} == {19}
    assert rows[4]["component_id"] == 4 and rows[4]["n_shingles"] == 0 and rows[None]["component_id"] is None
    assert near_dedup.near_duplicates(docs).count() == len(ROWS)
    assert near_dedup.near_duplicates(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(1000, i) for i in range(100, 140)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(1, 31)} == {0} and {found[i] for i in [*range(101, 140), 1000]} == {100}


def test_substrings(docs, none):
    rows = by_id(substring_dedup.dedup_substrings(docs))
    assert rows[7]["kept"] == "before after" and rows[7]["n_removed"] == 40 and rows[8]["kept"] == ""
    assert rows[4]["n_words"] == 0 and rows[1]["n_removed"] == 0
    words = LONG.split()
    runs = [tuple(words[i : i + 35]) for i in range(len(words) - 34)]
    assert (rows[6]["n_removed"] == 0) == (len(set(runs)) == len(runs))
    assert substring_dedup.dedup_substrings(docs).count() == len(ROWS)
    assert substring_dedup.dedup_substrings(none).count() == 0


def test_substrings_among_equal_texts(spark):
    """Equal texts, one of them without an id, others that share part of them, and short ones, against a plain count."""
    copied, other = f"start {PASSAGE} end", " ".join(f"q{i % 23}" for i in range(90))
    held = [copied, copied, copied, f"x y {PASSAGE} z", other, "short text", "short text", f"{PASSAGE[:60]} cut", copied, PASSAGE]
    ids = [1, 2, None, 4, 5, 6, 7, 8, 1, 10]
    seen = {}
    for at, text in enumerate(held):
        words = text.split()
        for i in range(len(words) - 34):
            seen.setdefault(tuple(words[i : i + 35]), []).append((at, i))
    gone = {(at, i + k) for places in seen.values() if len(places) > 1 for at, i in places for k in range(35)}
    want = [(ids[at], len(t.split()), " ".join(w for k, w in enumerate(t.split()) if (at, k) not in gone)) for at, t in enumerate(held)]
    found = substring_dedup.dedup_substrings(spark.createDataFrame(list(zip(ids, held, strict=True)), "doc_id long, text string"))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_words"], r["kept"])) for r in found.collect())


def test_topk_is_exact_with_ties_and_odd_rows(spark):
    """Also repeated rows: all are candidates, and query rows of one id are one query."""
    draw = np.random.default_rng(0)
    vectors = [(i, draw.normal(size=40).tolist()) for i in range(300)] + [(300, [0.5] * 40), (301, [0.5] * 40), (302, [0.5] * 40)]
    vectors += [(0, vectors[0][1]), (7, vectors[7][1]), (40, vectors[1][1])]  # whole rows again, and an id with another vector
    odd = [(900, None), (901, [None] * 40), (902, [float("nan")] * 40), (None, [1.0] * 40), (903, [float("inf")] * 40), (980, [1.0, 2.0])]
    empty = [(1000, []), (1001, []), (1001, []), (1020, [])]
    schema = "vec_id long, embedding array<double>, query_id string, ids int, block string"
    table = topk.integer_vectors(spark.createDataFrame([(*r, "x", 1, "y") for r in [*vectors, *odd, *empty]], schema))
    found = topk.nearest(table, table.where("vec_id % 20 = 0"), k=7).collect()
    whole = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors]
    for q in range(0, 303, 20):
        best = sorted((-int(own @ v), i) for j, own in whole if j == q for i, v in whole if i != q)[:7]
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [(-r["score"], r["vec_id"]) for r in own] == best and [r["rank"] for r in own] == [*range(1, 8)]
    assert not [r for r in found if r["query_id"] == 980]
    assert [(r["vec_id"], r["score"]) for r in sorted((r for r in found if r["query_id"] == 1000), key=lambda r: r["rank"])] == [(1001, 0), (1001, 0), (1020, 0)]
    assert topk.nearest(table.limit(0), table.limit(0), k=3).count() == 0


def test_topk_equals_its_sql_on_repeated_rows(spark):
    import duckdb
    import pandas as pd

    from basketry.llm.oracle import ORACLE

    draw = np.random.default_rng(4)
    rows = [(i % 70, draw.normal(size=6).astype(np.float32).tolist()) for i in range(90)]
    rows += rows[:30]
    embeddings = pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]})
    expected = duckdb.sql(ORACLE["op2_exact_topk"]).fetchall()
    table = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert len(embeddings) and sorted(map(tuple, topk.nearest(table, table.where("vec_id % 20 = 0"), k=20).collect())) == sorted(expected)


ARTICLE = "<article><p>" + "A sentence of the article with enough words. " * 8 + "</p></article>"


@pytest.mark.parametrize(
    "before",
    ["<![foo[bar]]>", "<![if !IE]>", "<![", "<![CDATA[x]]>", "<!-- no end ", "<!-- no end > ", "<nav><ul><li><a href=/>menu</a>", "<!doctype", "<?php x", "<!-", "&#xZZ;", "<a <b <c"],
)
def test_broken_markup_before_an_article_ends_no_job(before):
    for page in (f"<html><body>{before}{ARTICLE}</body></html>", f"<body>{ARTICLE}{before}", before, before * 50 + ARTICLE):
        blocks = html_text.main_blocks(page)
        assert not any("<" in block or "article>" in block for block in blocks if "A sentence" in block)
    for wrapped in ("<![foo[bar]]>", "<![if !IE]>", "<!-- no end > ", "<nav><ul><li><a href=/>menu</a>"):
        assert html_text.main_blocks(f"<html><body>{wrapped}{ARTICLE}</body></html>") == [("A sentence of the article with enough words. " * 8).strip()]


def test_many_unclosed_comments_take_linear_time():
    import time

    start = time.perf_counter()
    assert html_text.main_blocks(ARTICLE + "<!-- <p> x" * 20_000)[0].startswith("A sentence")
    assert time.perf_counter() - start < 5


def test_packing_and_files(spark, docs, none):
    pieces = packing.pack(docs, tokenizer_path(), end_id=0, capacity=64).collect()
    assert sum(p["length"] for p in pieces if p["doc_id"] in (4, 5)) == 2
    fill = {}
    for p in pieces:
        fill.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert all(sorted(f)[0][0] == 0 and sum(n for _, n in f) <= 64 for f in fill.values())
    folder = new_folder(spark, "test-files")
    token_files.write_token_files(docs, folder, tokenizer_path(), end_id=2)
    read = token_files.read_documents(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in read] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 8]
    assert packing.pack(none, tokenizer_path(), end_id=0).count() == 0
    empty = new_folder(spark, "test-files")
    token_files.write_token_files(none, empty, tokenizer_path(), end_id=2)
    assert token_files.read_documents(spark, empty).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1, max_size=20))
def test_patterns_hold_every_length_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held = {length: 0 for length in histogram}
    for pattern, packs in patterns:
        assert sum(length * copies for length, copies in pattern) <= 64
        for length, copies in pattern:
            held[length] += copies * packs
    assert held == histogram


LIBRARY, ENCODER = Tokenizer.from_file(tokenizer_path()), TextEncoder(tokenizer_path())


@settings(max_examples=300)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sretlld.,éß0 9\xa0<|>")), max_size=60))
def test_encoder_equals_the_library(text):
    assert np.frombuffer(ENCODER.encode(text), dtype="<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_special_strings_are_encoded_as_the_library_does():
    for text in ("<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>\n"):
        assert np.frombuffer(ENCODER.encode(text), dtype="<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (8, 0), (None, 1), (3, None), (99, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scores = quality.score(docs, model, "doc_id").collect()
    assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.score(docs, None, "doc_id").collect()} == {0.5}
    assert quality.score(none, model, "doc_id").count() == 0


def test_language_model(docs, none):
    rows = language_model.score(docs).collect()
    assert len(rows) == len(ROWS) and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {1}
    assert language_model.score(none).count() == 0


def test_language_model_probabilities_sum_to_one(docs):
    posted = language_model.postings(docs, [b"the", b"is"])
    model = language_model.fit(posted)
    rows = model.rows.collect()
    for context in range(4):
        total = (model.opening[:, context] * model.unknown).mean()
        for r in rows:
            seen = dict(zip(r["context"], r["probability"], strict=True))
            total += seen.get(context, (model.opening[:, context] * np.array(r["parent"])).mean())
        assert total == pytest.approx(1, abs=1e-4)


def page(body):
    return f"<html><head><title>t</title><script>if (a < b) x('<p>no</p>')</script></head><body>{body}</body></html>"


def test_pages(spark):
    text = "A sentence of the article that is long enough to stand out from all that surrounds it on the page."
    surroundings = (
        "<nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies on this page to serve you well.</div>"
        "<div id=sidebar><p>Other news of the day which is also long enough to look like text.</p></div>"
    )
    after = "<section class=comments><p>A reader comment that is long enough to look like the text of an article.</p></section><footer>end</footer>"
    rows = [
        (1, page(f"{surroundings}<article><h1>Title</h1><p>{text}</p><p>Short.</p>{after}</article>")),
        (2, page(f"{surroundings}<div><h2>Title</h2><p>{text}</p><p>a&amp;b &lt;c&gt;\n\t d</p><p>{text}</p></div>{after}")),
        (3, None),
        (4, ""),
        (5, page("<nav>only a menu</nav>")),
        (6, f"<article><p>{text}<p>open <b>end"),
    ]
    pages = spark.createDataFrame([(i, None, h, "x") for i, h in rows], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r["text"] for r in html_text.extract_text(pages).collect()}
    assert found[1] == f"Title\n\n{text}\n\nShort."
    assert found[2] == f"Title\n\n{text}\n\na&b <c> d\n\n{text}"
    assert found[3] == found[4] == found[5] == ""
    assert found[6] == f"{text}\n\nopen end"
    assert html_text.extract_text(pages.limit(0)).count() == 0
