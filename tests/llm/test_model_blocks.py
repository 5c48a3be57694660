"""The language model's tables have a row for each block, part or shard, and its parts take turns to be scored."""

import numpy as np
from pyspark.sql import functions as F

from basketry.llm import language_model
from basketry.llm.common import ascii_words

TEXTS = ["a b A", None, "", " \t\n", "\x0bx\x0cy\r\nz ", "ÀB à b \x1f c\x85d", "E" * 300_000 + " e", "end", "e end"]


def test_blocks_hold_every_token(spark, monkeypatch):
    monkeypatch.setattr(language_model, "DOCUMENTS", 4)
    table = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)
    found, trained = {}, {}
    for r in language_model.postings(table, [b"a"]).collect():
        words, tokens = bytes(r["words"]).split(b"\n"), np.frombuffer(r["token"], "<i4")
        for i, held, own in zip(r["doc_ids"], r["held"], np.split(tokens, np.cumsum(r["lengths"])[:-1]), strict=True):
            found[i] = [words[t] for t in own]
            assert held == language_model.is_held_out(i)
            for word in () if held else found[i]:
                trained[word] = trained.get(word, 0) + 1
        assert sum(np.frombuffer(r["n"], "<i4")) == r["tokens"]
    assert found == {i: [*ascii_words(text), b""] for i, text in enumerate(TEXTS)}
    best = language_model._most_frequent(language_model._numbered(table), 8, 3)
    assert best == sorted(((w, n) for w, n in trained.items()), key=lambda x: (-x[1], x[0]))[:3]


def test_tables_have_few_rows(spark, monkeypatch):
    rows, write = {}, language_model.written
    monkeypatch.setattr(language_model, "written", lambda df, name, **how: (made := write(df, name, **how), rows.setdefault(name, made.count()))[0])
    table = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 3_000}" for k in range(40))) for i in range(600)], "doc_id long, text string")
    assert language_model.score(table).count() == 600
    assert rows["postings"] <= 8 and rows["word-counts"] <= 8 and rows["model"] <= 8
    # Eight shards with eight parts: each sends each a row, and keeps two.
    assert rows["restaurants"] <= 8 * (8 + 2) and rows["tables"] <= 8 * (8 + 2)


def test_parts_take_turns(spark, monkeypatch):
    met, repartition = [], type(spark.range(0)).repartition

    def seen(frame, *how):
        if "kind" in frame.columns:
            met.append({kind: {r["part"] for r in frame.where(F.col("kind") == kind).select("part").collect()} for kind in range(3)})
        return repartition(frame, *how)

    monkeypatch.setattr(type(spark.range(0)), "repartition", seen)
    # A word in more training tokens than a part has is in several, whose scores are the same.
    monkeypatch.setattr(language_model, "PART", 500)
    table = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k * k) % 900} the" for k in range(10))) for i in range(300)], "doc_id long, text string")
    split = {r["doc_id"]: r for r in language_model.score(table).collect()}
    assert len(met) == language_model.TURNS > 1
    for turn, kinds in enumerate(met):
        assert all(part % language_model.TURNS == turn for parts in kinds.values() for part in parts) and kinds[1] >= kinds[2]
    assert set.union(*(kinds[2] for kinds in met)) >= set(range(8))
    monkeypatch.setattr(language_model, "PART", 1_000_000)
    whole = {r["doc_id"]: r for r in language_model.score(table).collect()}
    assert split.keys() == whole.keys() and len(whole) == 300
    for i, r in whole.items():
        assert (split[i]["n_tokens"], split[i]["n_known"]) == (r["n_tokens"], r["n_known"])
        assert abs(split[i]["score"] - r["score"]) < 1e-4 * abs(r["score"])
