import math
import random

import numpy as np
import pytest

from quakespark.llm import multi_index, va_file, vectors

NAN, INF = float("nan"), float("inf")


def table(spark, rows, columns="vec_id bigint, embedding array<float>, label int, score string, rank int"):
    return spark.createDataFrame([(*r, 0, "x", 1) for r in rows], columns).repartition(3)


def corpus(seed, n=400, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[rng.integers(5)] + rng.normal(size=dim) * 0.7]) for i in range(n)]
    hot = rows[7][1]
    rows += [(n + i, hot) for i in range(n // 2)]  # a third of the vectors are one
    rows += [(5000, None), (5100, [NAN] * dim), (5200, [INF] + [0.0] * (dim - 1)), (5300, [None] + [1.0] * (dim - 1)), (5400, [0.0] * dim), (5500, [1.0, 2.0, 3.0]), (5501, [-1.0, 0.5, 2.0])]
    rows += [(0, rows[0][1]), (None, hot)]  # a repeated row, and one without an id
    random.Random(seed).shuffle(rows)
    return rows


def usable(rows, zero):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = v
    return out


def plain(rows, every, k, score, zero):
    out, use = set(), usable(rows, zero)
    for q, v in use.items():
        if q % every == 0:
            found = sorted((-score(v, w), i) for i, w in use.items() if i != q and len(w) == len(v))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


def product(v, w):
    return sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(v, w, strict=True))


@pytest.mark.parametrize("k", [1, 10])
def test_exact_search(spark, k, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 64)  # several blocks of rows
    rows = corpus(5)
    found = va_file.search(table(spark, rows), "embedding", every=50, k=k).collect()
    want = plain(rows, 50, k, product, True)
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 30)
    rows = corpus(6, n=100)
    found = va_file.search(table(spark, rows), "embedding", every=2, k=3).collect()
    assert {tuple(r) for r in found} == plain(rows, 2, 3, product, True)


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 1.0]), (2, [2.0, -1.0]), (100, [0.5])]
    assert {tuple(r) for r in va_file.search(table(spark, rows), "embedding", every=100).collect()} == {(0, 1, 2, 1024 * 1024)}
    assert [r.vec_id for r in multi_index.search(table(spark, rows), "embedding", every=100).collect()] == [2]
    for none in ([], [(0, None)], [(1, [1.0])]):
        assert va_file.search(table(spark, none), "embedding", every=100).collect() == []
        assert multi_index.search(table(spark, none), "embedding", every=100).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for scale in (3, 10**6, 2**45):
        x, q = rng.integers(-scale, scale, (300, 9)), rng.integers(-scale, scale, (20, 9))
        grid = va_file.Grid(x.min(0), x.max(0))
        low, high = grid.bounds(grid.cells(x), q.astype(float))
        true = q.astype(object) @ x.T.astype(object)
        assert (low <= true).all() and (true <= high).all()


def test_large_components():
    with pytest.raises(ValueError):
        va_file.quantise(np.array([[1e300]]))
    rows, query = np.array([[2**45, 2**45]]), np.array([2**45, 2**45])
    with pytest.raises(ValueError):
        va_file.exact(rows, query)
    assert va_file.exact(rows, np.array([3, -2])).tolist() == [2**45]


def test_probe_finds_every_code_in_the_radius():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    bits[::3] = bits[0]
    order = np.argsort(bits, axis=0, kind="stable").T
    starts = np.stack([np.searchsorted(np.sort(b), np.arange(257)) for b in bits.T])
    for radius in (0, 1, 5, 15, 16, 40, 60, 128):
        for code in (bits[0], bits[7], rng.integers(0, 256, 16, dtype=np.uint8)):
            apart = np.bitwise_count(bits ^ code).sum(1)
            assert multi_index.probe(code, radius, bits, order, starts).tolist() == np.nonzero(apart <= radius)[0].tolist()


def cosine(v, w):
    return sum(a * b for a, b in zip(v, w, strict=True)) / math.sqrt(sum(a * a for a in v) * sum(b * b for b in w))


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 100)
    rows = corpus(9)
    found = multi_index.search(table(spark, rows), "embedding", every=5, k=5).collect()
    use = usable(rows, False)
    lists = {}
    for r in found:
        assert r.score == pytest.approx(cosine(use[r.query_id], use[r.vec_id]), abs=1e-12)
        lists.setdefault(r.query_id, []).append(r)
    want = plain(rows, 5, 5, lambda v, w: round(cosine(v, w), 12), False)
    assert set(lists) == {q for q, *_ in want}
    for q, mine in lists.items():
        mine.sort(key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, len(mine) + 1)) and len({r.vec_id for r in mine}) == len(mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert len(mine) == sum(w[0] == q for w in want)
    hit = {(r.query_id, r.vec_id) for r in found} & {(q, i) for q, _, i, _ in want}
    assert len(hit) >= 0.9 * len(want)


def test_huge_and_tiny_vectors_have_a_cosine(spark):
    rows = [(0, [1e300, 0.0]), (1, [1e-300, 1e-300]), (2, [0.0, 1e300]), (3, [5e-324, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in multi_index.search(frame, "embedding", every=1, k=5).collect()}
    assert got[0, 1] == pytest.approx(math.sqrt(0.5)) and got[0, 2] == 0 and got[0, 3] == 1 and len(got) == 12
