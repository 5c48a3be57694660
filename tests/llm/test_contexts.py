"""Every training word that precedes another has a restaurant of its own, however many such words there are."""

import numpy as np
import pytest

from basketry.llm import common, language_model
from basketry.store import file_system

WORDS = 400


def test_rare_contexts_predict_what_followed_them(spark, monkeypatch):
    rows = [(i, " ".join(f"a{i % WORDS} b{i % WORDS}" for _ in range(4)), i) for i in range(3 * WORDS)]
    held = next(i for i in range(10**6, 10**6 + 100) if language_model.is_held_out(i))
    probes = [(held, "a399 b399 a399 b399", 0), (None, "", 0)]
    for other in range(held + 1, held + 100):
        if language_model.is_held_out(other):
            probes.append((other, "a399 b398 a397 b396", 0))
            break
    table = spark.createDataFrame(rows + probes, "doc_id long, text string, n long")
    found = {r["doc_id"]: r for r in language_model.score(table).collect()}
    assert len(found) == len(rows) + len(probes)
    alike, unlike = found[probes[0][0]], found[probes[2][0]]
    assert alike["n_known"] == unlike["n_known"] == 5
    assert alike["score"] > unlike["score"] + 3
    # Words spread over several parts give the same sums.
    monkeypatch.setattr(language_model, "PART", 40)
    again = {r["doc_id"]: r for r in language_model.score(table).collect()}
    assert all(again[i]["n_tokens"] == r["n_tokens"] and again[i]["score"] == pytest.approx(r["score"], rel=1e-4) for i, r in found.items())


def test_rare_contexts_sum_to_one(spark):
    table = spark.createDataFrame([(i, f"x{i % 9} y{i % 7} x{i % 5} z y{i % 3}") for i in range(200)], "doc_id long, text string")
    model = language_model.fit(language_model.postings(table, [b"z"]))
    rows, places = model.rows.collect(), model.restaurants.collect()
    assert {r["context"] for r in places} == {language_model.context_hash(f"{w}{i}".encode()) for w, n in (("x", 9), ("y", 7)) for i in range(n)}
    for place in places:
        back = np.array(place["back"])
        total = (back * model.unknown).mean()
        for r in rows:
            total += (back * np.array(r["parent"])).mean() + dict(zip(r["rare"], r["own"], strict=True)).get(place["context"], 0) * place["scale"]
        assert total == pytest.approx(1, abs=1e-4)


def test_only_the_model_is_left_of_what_it_was_made_from(spark, monkeypatch):
    kept, write = [], language_model.written
    monkeypatch.setattr(language_model, "written", lambda df, name, **how: (made := write(df, name, **how), kept.append((name, made)))[0])
    table = spark.createDataFrame([(i, f"x{i % 9} y{i % 7} x{i % 5} z y{i % 3}") for i in range(200)], "doc_id long, text string")
    before = spark.conf.get(common.CLEANUP)
    scored = language_model.score(table)
    there = [name for name, made in kept if file_system(spark, made.written_to)[0].exists(file_system(spark, made.written_to)[1])]
    assert sorted(there) == ["backing", "model", "postings"] and len(kept) > 8
    assert scored.count() == 200 and spark.conf.get(common.CLEANUP) == before
