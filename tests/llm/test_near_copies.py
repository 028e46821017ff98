"""Many near copies of one text: the links are those of brute force, and few pairs are compared for them."""

import random

import numpy as np
from test_operators import brute_components

from shoptrail.llm import jaccard


def near_copies(seed=21):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(words)}
    for i in range(1, 140):  # up to two changed words link with the first text, three or more mostly don't
        near = list(words)
        for at in rng.sample(range(150), 1 + i % 4):
            near[at] = f"x{i}y{at}"
        texts[i] = " ".join(near)
    return texts


def test_near_copies_below_the_threshold_are_not_compared_pair_by_pair(spark, monkeypatch):
    proposed, plain = [], jaccard.pairs_left

    def counted(open_, counts=None, threshold=jaccard.THRESHOLD):
        pairs = plain(open_, counts, threshold)
        if counts is not None:
            proposed.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "GROUP", 8)
    monkeypatch.setattr(jaccard, "pairs_left", counted)
    texts = near_copies()
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(frame).collect()}
    assert got == brute_components(texts)
    assert len(proposed) == 1 and proposed[0] <= 2 * len(texts)


def test_sets_that_agree_up_to_one_shingle_share_a_signature_that_both_name_whole_or_not():
    """A pair passes the filter of ``pairs_left`` on some shared signature, whenever it shares any."""
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64))
    b = np.unique(np.concatenate([a[8:], rng.integers(0, 2**63, 8).astype(np.uint64)]))
    found, row, _, whole = jaccard._with_wholes(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 85, jaccard.WIDE)
    mine, other = ({int(s): int(w) for s, w in zip(found[row == r], whole[row == r], strict=True)} for r in (0, 1))
    shared = set(mine) & set(other)
    passing = {s for s in shared if mine[s] != other[s] or s == mine[s]}
    assert passing and len(passing) < len(shared)
    assert {mine[s] for s in shared if mine[s] == other[s]} <= passing


def test_smaller_sketches_bound_the_difference_too():
    rng = np.random.default_rng(6)
    for size in (1, 30, 400):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 5:], rng.integers(0, 2**63, 7).astype(np.uint64)]))
        _, made = jaccard._sketched(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, jaccard.ROW_SKETCH)
        x, y = (np.array(v, np.int64).view(np.uint64) for v in made["sketch"].to_pylist())
        assert len(x) == jaccard.ROW_SKETCH and sum(int(v).bit_count() for v in x ^ y) <= len(np.setxor1d(a, b))


def test_signatures_and_shingles_move_once(spark):
    """They are most of what the search moves: one exchange by signature, and one by shingle."""
    texts = near_copies()
    docs = spark.createDataFrame(list(texts.items()), "class long, _text string")
    classes = spark.createDataFrame([(i, 1) for i in texts], "class long, n_shingles long")
    rare = jaccard.rare_signatures(docs, classes, 85)._jdf.queryExecution().executedPlan().toString()
    assert rare.count("hashpartitioning(shingle") == 1

    seen = []
    plain, jaccard.materialize = jaccard.materialize, lambda df: seen.append(df) or df
    try:
        jaccard._shared(jaccard.signature_table(docs, 85))
    finally:
        jaccard.materialize = plain
    assert seen[0]._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(signature#") == 1
