"""Links between short documents at and above the threshold, none of which may be left out before it is confirmed."""

import numpy as np
import pytest

from basketry.llm import components, near_dedup


@pytest.mark.parametrize(("size", "percent", "words", "more"), [(5, 80, 8, 1), (3, 85, 8, 1), (5, 80, 12, 2)])
def test_short_documents_are_linked(spark, size, percent, words, more):
    rows = []
    for i in range(600):
        text = [f"a{i}x{k}" for k in range(words + more)]
        rows += [(2 * i, " ".join(text[:words])), (2 * i + 1, " ".join(text))]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i // 2 * 2 for i in range(1200)}


def test_parities_never_claim_more_than_differs():
    draw = np.random.default_rng(3)
    for n in (1, 7, 300, 5000):
        every = draw.integers(0, 2**63, 2 * n, dtype=np.uint64)
        for own in (0, 1, n // 2, n):
            a, b = every[:n], every[own : n + own]
            differing = np.bitwise_count((near_dedup.parities(a) ^ near_dedup.parities(b)).view(np.uint64)).sum()
            assert differing <= 2 * own


@pytest.mark.parametrize("seed", [1, 2])
def test_components_grow_by_new_links(spark, seed):
    draw = np.random.default_rng(seed)
    steps = [[(int(a), int(b)) for a, b in draw.integers(0, 300, (60, 2))] for _ in range(3)]
    steps[1] += [(0, i) for i in range(0, 300, 7)] + steps[0][:5]  # a star, and links known before
    steps.append([(5, 5), *steps[2][:3]])  # nothing new
    roots, leasts = None, list(range(300))
    for step in steps:
        links = spark.createDataFrame(step, "a long, b long")
        roots = components.components(links) if roots is None else components.merged(roots, links)
        for a, b in step:
            low, high = sorted((leasts[a], leasts[b]))
            leasts = [low if x == high else x for x in leasts]
        rows = [(r["node"], r["root"]) for r in roots.collect()]
        assert sorted(rows) == [(i, x) for i, x in enumerate(leasts) if x != i]


def test_large_buckets_go_several_rounds(spark):
    """Chains of texts, each alike its neighbours only, share buckets in which no hub links all."""
    words = [f"w{k}" for k in range(260)]
    rows = [(1000 * c + i, " ".join([f"c{c}", *words[4 * i : 4 * i + 60]])) for c in range(3) for i in range(50)]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    leasts = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((leasts[a], leasts[b]))
                leasts = {i: low if x == high else x for i, x in leasts.items()}
    assert found == leasts
