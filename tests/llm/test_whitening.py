import math

import numpy as np
import pytest

from quillmart.llm import whitening
from quillmart.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(vectors):
    """(n, sums, eigenvalues, eigenvectors, trace) by numpy's own solver."""
    x = np.array(sorted({tuple(math.floor(256 * c) for c in v) for v in vectors}), dtype=float)
    y = x - x.mean(0)
    cov = y.T @ y / len(x)
    e, v = np.linalg.eigh(cov)
    return len(x), x.sum(0), e[::-1], v[:, ::-1], np.trace(cov), x.mean(0)


def check(rows, vectors, ids, k):
    n, sums, e, v, trace, mean = plain(vectors)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, vec in zip(ids, vectors):
        x = np.array([math.floor(256 * c) for c in vec])
        assert sorted(by[i]) == list(range(1, k + 1))
        for c, same in by[i].items():
            for r in same:
                assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
                assert abs(r.explained - e[c - 1] / trace) <= 1e-9 and r.identity_error <= 1e-9
    signs = {}
    for i, vec in zip(ids, vectors):
        y = np.array([math.floor(256 * c) for c in vec]) - mean
        for c in by[i]:
            want, got = y @ v[:, c - 1] / math.sqrt(e[c - 1]), by[i][c][0].whitened
            if abs(want) > 1e-6:
                signs.setdefault(c, np.sign(got / want))
                assert abs(got - signs[c] * want) < 1e-7


def test_components_equal_the_library_solver():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 40):
        a = rng.standard_normal((n, n))
        for m in (a @ a.T, np.diag(np.arange(n) // 2.0), np.zeros((n, n)), np.eye(n), a[:, :1] @ a[:, :1].T):
            e, v = whitening.components(m)
            scale = max(1.0, np.linalg.norm(m))
            assert np.allclose(e, np.linalg.eigvalsh(m)[::-1], atol=1e-12 * scale)
            assert np.allclose(v.T @ v, np.eye(n), atol=1e-11) and np.allclose(m @ v, v * e, atol=1e-11 * scale)


def test_whole_table(spark):
    rows = table(spark, SF, "embeddings").collect()
    check(whitening.op13_qdwh_whitening(spark, SF).collect(), [r.embedding for r in rows], [r.vec_id for r in rows], 4)


def run(spark, df, tmp_path, name):
    df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    return whitening.op13_qdwh_whitening(spark, f"{tmp_path}/{name}").collect()


def test_odd_rows(spark, tmp_path, clash):
    rng = np.random.default_rng(2)
    vectors = [(rng.standard_normal(5) * [5, 4, 3, 2, 1]).tolist() for _ in range(30)]
    good = [(i, v) for i, v in enumerate(vectors)] + [(0, vectors[0]), (None, vectors[1])] + [(50 + i, vectors[2]) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [float("nan")] * 5), (104, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0])]
    df = clash(spark.createDataFrame(good + bad, "vec_id long, embedding array<float>"))
    got = run(spark, df, tmp_path, "odd")
    single = [np.float32(v).astype(float).tolist() for _, v in good]
    assert len(got) == len(good) * 4 and {r.vec_id for r in got} == {i for i, _ in good}
    check(got, single, [i for i, _ in good], 4)


@pytest.mark.parametrize("vectors,components", [([], 0), ([[1.0, 2.0]] * 3, 0), ([[1.0, 2.0], [3.0, 2.0]], 1), ([[-0.001], [0.5], [0.5]], 1)])
def test_little_variance(spark, tmp_path, vectors, components):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = run(spark, df, tmp_path, f"few{len(vectors)}{components}")
    assert len(got) == components * len(vectors)
    if components:
        check(got, vectors, range(len(vectors)), components)


def test_large_entries_keep_exact_deviations(spark, tmp_path):
    vectors = [[1e15, 1.0], [-1e15, 2.0], [3e5, 7.0]]
    got = run(spark, spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"), tmp_path, "large")
    x = [[math.floor(256 * c) for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in want.items()}
