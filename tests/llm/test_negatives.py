"""Hard-negative mining against plain Python, and the walk's certificate."""

import math
import random

import numpy as np
import pytest

from latewatch.llm import negatives

from .support import rows

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, score string, slot string, q string"


def brute(data, every=100, positives=5, hard=10):
    """data: (vec_id, vector, label); the result rows, vec_ids being distinct."""
    part = []
    for vec_id, v, label in data:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((vec_id, [math.floor(256 * x) for x in v], (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = set()
    for a, va, la in part:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in part if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            fit = [(t, n) for t, n, label in scored if label != la and 30 * -s <= 100 * -t <= 90 * -s]
            out |= {(a, p, i + 1, n, -s, -t) for i, (t, n) in enumerate(fit[:hard])}
    return out


def some(seed, n, dim=6, scale=1.0, labels=4, step=1):
    """Clustered vectors with copies and zeros, so that scores tie."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(dim)] for _ in range(8)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        v = list(c) if rng.random() < 0.3 else [x + rng.gauss(0, 0.3 * scale) for x in c]
        out.append((i * step, [0.0] * dim if rng.random() < 0.03 else v, rng.randrange(labels)))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame([(i, v, label, "u", "s", "x", "q") for i, v, label in data], SCHEMA).repartition(parts)


def mined(df, **options):
    found = [tuple(r.values()) for r in rows(negatives.mine(df, **options).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("every, block_bytes, scale", [(100, 1 << 24, 0.1), (10, 2000, 0.1), (10, 1 << 24, 1e4)])
def test_against_brute_force(spark, every, block_bytes, scale):
    data = some(every, 700, scale=scale)
    want = brute(data, every)
    assert len(want) > 50
    assert mined(frame(spark, data), every=every, block_bytes=block_bytes) == want


def test_odd_rows(spark):
    """Nulls, non-finite and missing components, vectors of other lengths, negative ids, few rows of a label."""
    nan, inf = float("nan"), float("inf")
    data = some(3, 120, step=50)
    data += [(1, None, 1), (2, [], 1), (3, [nan] * 6, 1), (4, [0.1, None], 1), (6, [inf], 2), (8, [-inf, 0.0], 2), (9, [0.5, -0.25], 1), (11, [0.5] * 9, 2),
             (None, [1.0] * 6, 1), (13, [1.0] * 6, None), (-100, [0.3] * 6, 1), (-101, [0.31] * 6, 2), (100_000, [0.2] * 3, 77), (100_001, [0.2] * 3, 77), (200_000, [], 1)]
    assert mined(frame(spark, data)) == brute(data)


def test_repeated_rows_are_rows_of_their_own(spark):
    data = [(100, [1.0, 0.0], 1), (101, [0.9, 0.1], 1), (101, [0.9, 0.1], 1), (102, [0.5, 0.2], 2), (102, [0.5, 0.2], 2)]
    found = rows(negatives.mine(frame(spark, data)))
    assert len(found) == 4  # two positives, two negatives each
    assert {(r["positive_id"], r["rank"], r["negative_id"]) for r in found} == {(101, 1, 102), (101, 2, 102)}


def test_empty_tables(spark):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for data in ([], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [1.0], 1)], [(100, None, 1)]):
        got = negatives.mine(frame(spark, data, 1))
        assert got.columns == columns and rows(got) == []


def test_members_leave_the_list_early_without_loss():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 16))
    x = np.floor(256 * (centres[rng.integers(0, 10, 20_000)] + 0.05 * rng.normal(size=(20_000, 16)))).astype(np.int64)
    label = rng.integers(0, 3, len(x))
    uid = np.arange(len(x))
    own = uid[::200]
    block = negatives.Block(own, own, label[own], x[own])
    state, seen = negatives.Positives(block, 5), []
    walk = block.walk
    block.walk = lambda v, need, visit, only=None: walk(v, need, lambda live, some, s: (seen.append(s.size), visit(live, some, s)), only)
    state.see(uid, uid, label, x)
    assert sum(seen) < 0.5 * len(x) * len(own)
    for i, a in enumerate(own):
        same = np.flatnonzero((label == label[a]) & (uid != a))
        score = x[same] @ x[a]
        best = same[np.lexsort((same, -score))][:5]
        assert state.best.uid[i].tolist() == best.tolist()


def test_exact_kinds():
    assert negatives.exact_kind(1e6) is np.float32 and negatives.exact_kind(1e12) is np.float64 and negatives.exact_kind(1e17) is np.int64
    with pytest.raises(OverflowError):
        negatives.exact_kind(1e19)
