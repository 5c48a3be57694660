"""What the classifier takes of a worker, and that its short way to a word's terms gives the same ones."""

import tracemalloc
from collections import Counter

import numpy as np

from basketry.llm import quality


def test_blocks_of_documents_bound_what_a_worker_takes():
    draw = np.random.default_rng(0)
    axes = draw.standard_normal((quality.TERMS, quality.DIMENSIONS)).astype(np.float32)
    vectors = quality.unit(draw.standard_normal((4_000, quality.DIMENSIONS)))
    model = quality.Model(np.ones(quality.TERMS, np.float32), axes, vectors, draw.integers(0, 2, 4_000).astype(float))
    terms = [draw.choice(quality.TERMS, 300, replace=False).astype(np.int32) for _ in range(1_050)]
    values = [np.ones(300, np.float32)] * len(terms)
    tracemalloc.start()
    found = model.score(model.project(terms, values))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6  # in one product of all documents they took some 150 MB
    alone = [model.score(model.project([t], [v]))[0] for t, v in zip(terms, values, strict=True)]
    assert np.allclose(found, alone, atol=1e-5)


def test_terms_of_words_follow_the_patterns():
    words = "a A ab Ab AB aB Abc, abc. ABC! a, A. ,. .. X x Xx xX Ünder über ab1 1ab 12, a-b a.. ß ſ K ab' \"Ab\" a; b: c? d! _a é. dž Dž".split()
    for word in words:
        shape = word
        for pattern, sign in quality.SHAPES:
            shape = pattern.sub(sign, shape)
        assert quality._word_terms(word) == (quality._hashed("w" + word.lower().strip(".,;:!?\"'()")), quality._hashed("s" + shape[:12])), word
    found, weights = quality.term_weights("the the cat The cat, the")
    counts = Counter()
    for word in "the the cat The cat, the".split():
        counts.update(quality._word_terms(word))
    counts.update({quality._hashed("words 3"): 1, quality._hashed("distinct 6 3"): 2, quality._hashed("repeats 1"): 2})
    assert dict(zip(found.tolist(), weights.tolist(), strict=True)) == {t: np.float32(1 + np.log(np.float32(n))) for t, n in counts.items()}


def test_the_memory_of_words_is_bounded():
    for i in range(quality.KEPT_WORDS + 1_000):
        quality._word_terms(f"word{i}")
    assert quality._word_terms.cache_info().currsize <= 50_000
