"""Near duplicates at a similarity of 0.8, held against all pairs and against exact similarities."""

from __future__ import annotations

import random

import numpy as np
import pytest
from topicframe.llm import wide_simhash

from . import brute
from .cases import docs, empty, odd  # noqa: F401


@pytest.mark.parametrize("most", [wide_simhash.MOST_IN_SHARD, 1])
def test_components_equal_brute_force(docs, most):
    got = {r.doc_id: r.component_id for r in wide_simhash.near_duplicates(docs, most).collect()}
    assert got == brute.near_wide([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_and_empty_tables(odd, empty):
    rows = wide_simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert {r.component_id for r in rows if r.doc_id is None} == {by_id[7], by_id[300]}
    assert {r.component_id for r in rows if r.doc_id == 7} == {7}
    assert len({by_id[i] for i in (300, 301, 302)}) == 1
    assert wide_simhash.near_duplicates(empty).count() == 0


def test_a_long_text_counts_whole(spark):
    words = [f"w{i * 7919 % 100003}" for i in range(200_000)]
    half = words[:100_000] + [f"z{i}" for i in range(100_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-50])), (3, " ".join(half))]
    got = {r.doc_id: r.component_id for r in wide_simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def _copy(words, rng, similarity):
    """words with some replaced, one at a time, until the similarity is at most the one asked for."""
    out, whole = list(words), brute.shingles(" ".join(words))
    while True:
        before = list(out)
        out[rng.randrange(len(out))] = f"new{rng.random():.9f}"
        if brute.jaccard(whole, brute.shingles(" ".join(out))) < similarity:
            return before


def test_recall_and_strangers(spark):
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=rng.randint(150, 500)) for _ in range(600)]
    wanted = [rng.uniform(0.8, 0.95) for _ in base]
    rows = [(2 * i, " ".join(w)) for i, w in enumerate(base)]
    rows += [(2 * i + 1, " ".join(_copy(w, rng, s))) for i, (w, s) in enumerate(zip(base, wanted, strict=True))]
    half = [" ".join(_copy(w, rng, 0.5)) for w in base[:200]]
    rows += [(10_000 + i, t) for i, t in enumerate(half)]
    got = {r.doc_id: r.component_id for r in wide_simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    caught = np.array([got[2 * i + 1] == 2 * i for i in range(len(base))])
    low = np.array(wanted) < 0.84
    print("recall", caught.mean(), "below 0.84", caught[low].mean())
    assert caught.mean() >= 0.95 and caught[low].mean() >= 0.85
    strangers = np.mean([got[10_000 + i] == 10_000 + i for i in range(200)])
    print("strangers left alone", strangers)
    assert strangers >= 0.98
