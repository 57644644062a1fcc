"""Hard negatives against plain loops over Python integers."""

import math
import random

import numpy as np
import pytest

from tallyforge.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, rank string"


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (3, 5, 2), (40, 64, 70), (65, 33, 129), (256, 64, 100), (0, 3, 4)])
def test_strassen_is_exact(monkeypatch, m, k, n):
    monkeypatch.setattr(H, "LEAF", 2)
    r = np.random.default_rng(1)
    a, b = r.integers(-(1 << 26), 1 << 26, (m, k)), r.integers(-(1 << 26), 1 << 26, (k, n))
    assert (H.strassen(a, b) == a @ b).all()
    whole = r.integers(-(1 << 62), 1 << 62, (5, 7))
    assert (H.strassen(whole, whole.T.copy()) == whole @ whole.T).all()  # modulo 2^64


def test_heaps_merge_in_any_order():
    rows = [(0, 5, 1), (0, 5, 0), (0, -3, 9), (2, 7, 4), (2, 7, 3), (2, 8, 8), (0, 6, 2), (2, 1, 1)]
    random.seed(2)
    for _ in range(5):
        random.shuffle(rows)
        heaps = H.Heaps(3, 2)
        for low in range(0, len(rows), 3):
            heaps.merge(*map(np.array, zip(*rows[low : low + 3])))
        got = heaps.rows().to_pydict()
        assert list(zip(got["slot"], got["score"], got["id"])) == [(0, 6, 2), (0, 5, 0), (2, 8, 8), (2, 7, 3)]


def brute(rows, every=50, positives=5, negatives=3):
    fine = [
        (k, label, [math.floor(256 * float(np.float32(x))) for x in v]) for k, v, label in rows
        if k is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, label, v in fine:
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), k, other) for k, other, w in fine if k != a)
        for s, p, _ in [x for x in scores if x[2] == label][:positives]:
            near = [(n, k) for n, k, other in scores if other != label and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            out += [(a, p, rank, k, -s, -n) for rank, (n, k) in enumerate(near, 1)]
    return sorted(out)


def found(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in H.mine(df, **more).collect())


@pytest.mark.parametrize("pass_bytes,tile", [(32 << 20, (256, 4096)), (40, (2, 7))])
def test_like_plain_loops(spark, monkeypatch, pass_bytes, tile):
    """Copies, ties, zeros, nulls, odd sizes; one pass and many."""
    monkeypatch.setattr(H, "PASS_BYTES", pass_bytes)
    monkeypatch.setattr(H, "TILE", tile)
    r = random.Random(4)
    rows = [(k, [r.choice([-0.5, 0.0, 0.25, 0.5, 0.3]) for _ in range(5)], r.randrange(3)) for k in range(-100, 151)]
    rows += [(1000 + k, [0.5] * 5, 1) for k in range(80)]  # one vector in many rows
    rows += [(2000, None, 1), (2050, [None] * 5, 1), (2100, [0.5] * 5, None), (None, [0.5] * 5, 1), (2150, [float("nan")] * 5, 1), (2200, [float("inf")] * 5, 2)]
    rows += [(2250, [0.5, 0.5], 1), (2300, [], 0), (7, [0.5] * 5, 2), (50, [0.25] * 5, 0)]  # short, empty, repeated keys
    expected = brute(rows)
    assert len(expected) > 30 and found(spark, rows) == expected


def test_few_rows(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(50, [0.5], 1)], 1) == []
    assert found(spark, [(1, [0.5], 1), (2, [0.5], 2)], 1) == []
    assert found(spark, [(50, [], 1), (2, [], 1)], 1) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2), (3, [-1.0, 0.0], 1)]
    assert found(spark, rows, 1) == [(0, 1, 1, 2, 65536, 58880)]
    assert found(spark, [*rows, (4, [3e30, 0.0], 1)], 1) == found(spark, rows, 1)  # too large to score
