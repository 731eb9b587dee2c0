"""Families stay small where documents share a passage only, and those that are large lose no link when they are split."""

import random
from collections import Counter

import numpy as np
import pytest

from gridmetrics.llm import jaccard_join
from gridmetrics.llm.jaccard_join import Bands, jaccard_groups, shingle_set


def words_of(count, seed):
    draw = random.Random(seed)
    return [f"w{draw.randrange(10**6)}" for _ in range(count)]


def test_a_common_passage_joins_few_documents():
    passage = words_of(24, 0)
    bands, owners = Bands(80), {}
    for n in range(600):
        own = words_of(110 + n % 7, n + 1)
        for key in set(bands.keys(shingle_set(" ".join([*own[:50], *passage, *own[50:]]), 5)).tolist()):
            owners.setdefault(key, []).append(n)
    joined = {n for some in owners.values() if len(some) > 1 for n in some}
    assert len(joined) < 60


@pytest.mark.parametrize(("percent", "spread"), [(80, 1), (80, 2), (80, 3), (90, 1), (90, 2), (90, 3)])
def test_pairs_at_the_limit_share_a_word(percent, spread):
    bands, draw = Bands(percent, spread), np.random.default_rng(spread)
    for size in (5, 9, 10, 18, 30, 60, 150, 400, 1500):
        for _ in range(60):
            members = draw.integers(0, 2**63, size + 1, np.int64).astype(np.uint64)
            differ = size * (100 - percent) // (100 + percent)
            # of equal size, each with as many members of its own
            other = np.r_[members[differ:size], draw.integers(0, 2**63, differ, np.int64).astype(np.uint64)]
            assert 100 * (size - differ) >= percent * (size + differ)
            assert np.intersect1d(bands.keys(members[:size]), bands.keys(other)).size, size
            # and of the smallest size that is linked
            smaller = members[: -(-size * percent // 100)]
            assert np.intersect1d(bands.keys(members[:size]), bands.keys(smaller)).size, size


def test_split_families_keep_their_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SKETCH_BLOCK", 8)
    passage = words_of(30, 0)
    texts = []
    for n in range(240):
        own = words_of(60, 1 + n % 16)
        own[n // 16] = f"x{n}"  # near copies
        texts.append(" ".join([*passage, *own] if n % 2 else [*own, *passage]))
    sets = [set(shingle_set(text, 5).tolist()) for text in texts]
    parent = list(range(len(sets)))
    for _ in range(4):
        for a, one in enumerate(sets):
            for b, two in enumerate(sets):
                if 100 * len(one & two) >= 80 * len(one | two):
                    parent[a] = min(parent[a], parent[b])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    split, calls = jaccard_join._split, []
    monkeypatch.setattr(jaccard_join, "_split", lambda *x: calls.append((x[1], split(*x))) or calls[-1][1])
    found = {row.doc_id: row.component_id for row in jaccard_groups(frame, 5, 80).collect()}
    assert found == dict(enumerate(parent)) and max(Counter(parent).values()) > 8
    assert len(calls) == 2
    for before, after in calls:
        assert after.count() <= before.count()
