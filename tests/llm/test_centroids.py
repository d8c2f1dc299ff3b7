"""Annulus search against comparison with all centroids, and k-means against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from tallyforge.llm import centroids
from tallyforge.llm.queries import op13_centroids


def test_nearest_with_ties_on_the_border():
    rng = np.random.default_rng(3)
    for _ in range(300):
        spread, dims, k = rng.integers(1, 6), rng.integers(1, 5), rng.integers(1, 12)
        c, x = rng.integers(-spread, spread + 1, (k, dims)), rng.integers(-spread, spread + 1, (50, dims))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        number, best, _ = centroids.Annuli(c).nearest(x)
        assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_annulus_spares_comparisons_and_is_exact_at_the_largest_values():
    rng = np.random.default_rng(4)
    c = rng.integers(-50, 51, (40, 8)) * np.arange(1, 41)[:, None]
    x = c[rng.integers(0, 40, 500)] + rng.integers(-3, 4, (500, 8))
    number, _, compared = centroids.Annuli(c).nearest(x)
    assert compared < 500 * 20 and (number == ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    most = np.full((1, 64), centroids.LARGEST)
    assert centroids.Annuli(np.concatenate([-most, -most + 1])).nearest(most)[1][0] == 64 * (2 * centroids.LARGEST - 1) ** 2


def plain(rows, k=40, rounds=5):
    kept = [(i, [max(min(math.floor(256 * x), 1 << 27), -(1 << 27)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(kept, key=key)[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda: [min((away(v, m), j) for j, m in enumerate(c)) for _, v in kept]
    for _ in range(rounds):
        own = [j for _, j in near()]
        for j in range(len(c)):
            if mine := [v for (_, v), o in zip(kept, own, strict=True) if o == j]:
                c[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = near()
    of = lambda j: sum(d for d, o in last if o == j)
    return [(i, j, d, of(j), of(None) + sum(d for d, _ in last), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, last, strict=True)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_query_against_a_plain_version(spark, tmp_path, kind):
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 0.3, (9, 64))
    rows = [(i, (middles[i % 9] + rng.normal(0, 0.1, 64)).astype(np.float32).tolist()) for i in range(300)]
    rows += [rows[3]] * 40 + [(None, rows[4][1]), (None, None), (900, None), (901, [0.5] * 63), (902, [0.5] * 65), (903, [0.1] * 63 + [None]), (904, [float("nan")] + [0.0] * 63), (905, [float("inf")] * 64), (906, []), (907, [3e30] * 64), (908, [-0.0] * 64)]
    frame = spark.createDataFrame([(*r, "x", 2) for r in rows], f"vec_id long, embedding array<{kind}>, cluster string, distance int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in op13_centroids(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows)))


def test_few_and_no_vectors(spark, tmp_path):
    order = sorted((1, 2), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    for n in (2, 0):
        rows = [(1, [0.1] * 64), (2, [0.2] * 64)][:n] + [(3, [9.0])]
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/{n}/embeddings.parquet")
        got = sorted((r.vec_id, r.cluster, r.distance) for r in op13_centroids(spark, f"{tmp_path}/{n}").collect())
        assert got == [(i, order.index(i), 0) for i in (1, 2)[:n]]
