"""Top-k search and hard negatives against brute force over all rows."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parents[2])]

from cohort.llm import meetings  # noqa: E402
from cohort.llm.hard_negatives import hard_negatives  # noqa: E402
from cohort.llm.topk_search import top_k  # noqa: E402

NONE, INF, NAN = None, float("inf"), float("nan")


def whole(vector, scale):
    """The scaled vector, or nothing if it takes no part."""
    if not vector or any(x is None or not np.isfinite(x) for x in vector):
        return None
    scaled = [int(np.floor(scale * float(np.float64(x)))) for x in vector]
    return scaled if sum(x * x for x in scaled) < 2**62 else None


def ranked(own, others):
    """(score, id, index) of others of the same length, best first."""
    made = [
        (sum(a * b for a, b in zip(own[2], x)), i, k) for k, i, x, *_ in others if k != own[0] and len(x) == len(own[2])
    ]
    return sorted(made, key=lambda m: (-m[0], m[1] is None, m[1] or 0, m[2]))


def brute_top(rows, k=10, scale=1024, every=100):
    sound = [(n, i, x, label) for n, (i, v, label) in enumerate(rows) if (x := whole(v, scale))]
    out = []
    for own in sound:
        if own[1] is not None and own[1] % every == 0:
            out += [(own[1], r + 1, i, s) for r, (s, i, _) in enumerate(ranked(own, sound)[:k])]
    return sorted(out, key=repr)


def brute_negatives(rows, positives=5, negatives=10, scale=256, every=100, low=30, high=90):
    sound = [(n, i, x, label) for n, (i, v, label) in enumerate(rows) if label is not None and (x := whole(v, scale))]
    labels = {n: label for n, _, _, label in sound}
    out = []
    for own in sound:
        if own[1] is None or own[1] % every:
            continue
        order = ranked(own, sound)
        same = [m for m in order if labels[m[2]] == own[3]][:positives]
        other = [m for m in order if labels[m[2]] != own[3]]
        for score, i, _ in same:
            fit = [m for m in other if low * score <= 100 * m[0] <= high * score][:negatives]
            out += [(own[1], i, r + 1, m[1], score, m[0]) for r, m in enumerate(fit)]
    return sorted(out, key=repr)


def made(rng, n=260, d=6, clustered=True):
    """Clusters, a vector that a third of the rows share, few distinct scores, odd rows."""
    middles = rng.standard_normal((7, d)) * 0.3
    rows = []
    for k in range(n):
        x = middles[k % 7] + rng.standard_normal(d) * (0.05 if clustered else 0.5)
        if k % 3 == 0:
            x = middles[0]
        if k % 11 == 0:
            x = np.round(x * 4) / 4
        rows.append((k, [float(a) for a in x], f"l{int(rng.integers(0, 4))}" if k % 13 else None))
    rows += [
        (n, None, "l0"), (n + 1, [], "l0"), (n + 2, [NONE] * d, "l0"), (n + 3, [INF] + [0.0] * (d - 1), "l1"),
        (n + 4, [NAN] * d, "l1"), (n + 5, [0.0] * d, "l1"), (None, [0.5] * d, "l1"), (None, [0.5] * d, "l2"),
        (40, [0.4] * d, "l0"), (40, [0.4] * d, "l1"), (80, [0.0] * d, "l0"), (n + 6, [0.5, 0.5], "l0"),
        (20 * n, [0.5, -0.5], "l0"), (n + 8, [0.25, 1.5], "l3"), (n + 9, [-1e30] * d, "l0"), (n + 10, [1e5] * d, "l2"),
        (20 * n + 20, [-3e4] * d, "l1"), (n + 11, [2.0] * d, "single"),
    ]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label string, row long, shard string, score int"


@pytest.mark.parametrize("values, pack, visitors, crew", [(1 << 19, 1_024, 20_000, 256), (600, 2, 3, 4)])
def test_against_brute_force(spark, monkeypatch, values, pack, visitors, crew):
    # The second line: many shards, packs and crews, and shards met in several tasks.
    for name, value in (("SHARD_VALUES", values), ("PACK", pack), ("VISITORS", visitors), ("CREW", crew)):
        monkeypatch.setattr(meetings, name, value)
    for seed, clustered in ((1, True), (2, False)):
        rows = made(np.random.default_rng(seed), clustered=clustered)
        df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(6)
        got = top_k(df, "vec_id % 20 = 0", block=8).collect()
        assert sorted(map(tuple, got), key=repr) == brute_top(rows, every=20)
        got = hard_negatives(df, "vec_id % 20 = 0").collect()
        assert sorted(map(tuple, got), key=repr) == brute_negatives(rows, every=20)


def test_parameters(spark):
    rows = made(np.random.default_rng(3))
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = top_k(df, "vec_id % 30 = 0", k=3, scale=10).collect()
    assert sorted(map(tuple, got), key=repr) == brute_top(rows, 3, 10, 30)
    got = hard_negatives(df, "vec_id % 30 = 0", positives=2, negatives=4, low=50, high=100, scale=64).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows, 2, 4, 64, 30, 50, 100)


def test_long_vectors_are_exact(spark):
    # Scores beyond 2^53 differ by 1.
    rows = [(0, [2.0**28, 1.0], "a"), (1, [2.0**28, 2.0], "a"), (2, [2.0**28, 1.0], "b"), (3, [2.0**28, 0.0], "b")]
    rows += [(4, [2.0**27, 1.0], "b"), (5, [2.0**40, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = top_k(df, "vec_id = 0", scale=1).collect()
    assert sorted(map(tuple, got), key=repr) == brute_top(rows, scale=1)
    got = hard_negatives(df, "vec_id = 0", scale=1, high=100).collect()
    assert sorted(map(tuple, got), key=repr) == brute_negatives(rows, scale=1, high=100)


def test_empty(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], "a")], "vec_id long, embedding array<float>, label string")
    for df_ in (df.filter("false"), df):
        assert top_k(df_).count() == 0
        assert hard_negatives(df_).count() == 0
    assert [tuple(r) for r in top_k(df, "true").collect()] == []
