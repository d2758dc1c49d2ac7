import numpy as np
import pytest

from ratewright.llm import whitening as W
from ratewright.storage import materialise


def matrices():
    rng = np.random.default_rng(5)
    yield rng.standard_normal((90, 40)) * np.exp(2 * rng.standard_normal(40))
    yield rng.standard_normal((7, 20))
    yield np.eye(12) * 3
    yield np.diag([3.0, 3, 3, 2, 2, 1, 1, 0])
    yield np.linalg.qr(rng.standard_normal((40, 40)))[0] * np.repeat([3, 2, 1, 0.5], 10)
    low = rng.standard_normal((50, 9))
    yield np.hstack([low, low[:, :3], np.zeros((50, 1))])
    yield rng.standard_normal((5, 1))
    graded = np.triu(rng.standard_normal((30, 30))) * 10.0 ** -np.arange(30)[:, None]
    yield graded


@pytest.mark.parametrize("x", list(matrices()))
def test_decomposition(x):
    values, z, total = W.decompose(W._triangle(x), 16)
    true = np.linalg.svd(x, compute_uv=False) ** 2
    k = len(values)
    assert k == min(16, int((true > W.RANK**2 * true[0]).sum()))
    assert np.abs(values - true[:k]).max() < 1e-13 * true[0]
    assert abs(total - true.sum()) < 1e-13 * total
    assert np.abs(z.T @ z - np.eye(k)).max() < 1e-11
    assert np.linalg.norm(x.T @ x @ z - z * values) < 1e-13 * true[0]


def test_small_values_to_high_relative_accuracy():
    """Of a graded bidiagonal matrix, far below what a plain decomposition tells apart."""
    a, b = 10.0 ** -np.arange(0, 24, 2), 10.0 ** -np.arange(1, 23, 2) * 0.5
    from fractions import Fraction

    values = W.dqds(a, b)
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    got = Fraction(1)
    for v in values:
        got *= Fraction(float(v))
    assert abs(float(got / product) - 1) < 1e-12  # the determinant


def test_bidiagonal_form():
    r = np.triu(np.random.default_rng(1).standard_normal((9, 9)))
    a, b, p = W.bidiagonal(r)
    full = np.diag(a) + np.diag(b, 1)
    assert np.abs(p @ full.T @ full @ p.T - r.T @ r).max() < 1e-13
    assert np.abs(p.T @ p - np.eye(9)).max() < 1e-14


SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(vectors, most=16):
    """By a plain eigendecomposition of the covariance."""
    x = np.floor(64 * vectors.astype("float64")).astype("int64") + 1_000_000
    once = np.unique(x, axis=0)
    n, sums = len(once), once.sum(0)
    centred = (once * n - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    return n, ((x * n - sums) ** 2).sum(1), (x * n - sums) / n @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_against_plain(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.toPandas().sort_values("vec_id")
    n, deviation, whitened, explained = expected(np.stack(rows["embedding"]))
    got = W.whitened(table.repartition(5)).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(rows) and got["component"].tolist() == list(range(1, 17)) * len(rows)
    assert (got["n"] == n).all() and (got["identity_error"] < 1e-9).all()
    assert got["deviation"].to_numpy().reshape(-1, 16)[:, 0].tolist() == deviation.tolist()
    mine = got["whitened"].to_numpy().reshape(-1, 16)
    signs = np.sign((mine * whitened).sum(0))
    assert np.abs(mine - whitened * signs).max() < 1e-8
    assert np.abs(got["explained"].to_numpy()[:16] / explained - 1).max() < 1e-10


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), float(i % 3), 1.0], 0) for i in range(30)]
    rows += [(100, None, 0), (101, [1.0, None, 2.0], 0), (102, [nan, 1.0, 1.0], 0), (103, [inf, 1.0, 1.0], 0)]
    rows += [(None, [1.0, 2.0, 1.0], 0), (5, [0.0, 2.0, 1.0], 0), (200, [4.0], 0), (201, [], 0)]
    table = materialise(spark.createDataFrame(rows, SCHEMA).repartition(3), "vectors")
    from pyspark.sql import functions as F

    got = W.whitened(table.withColumns({c: F.lit("x") for c in ("x", "c", "part", "r", "component")}), components=5).collect()
    used = [r for r in rows if r[1] is not None and None not in r[1] and not any(v != v or v == inf for v in r[1])]
    full = np.array([r[1] + [0.0] * (3 - len(r[1])) for r in used])
    n, deviation, _, _ = expected(full)
    assert sorted(((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1), key=str) == sorted(
        ((r[0], int(d)) for r, d in zip(used, deviation)), key=str
    )
    assert {r["n"] for r in got} == {n} and max(r["component"] for r in got) == 3
    assert max(r["identity_error"] for r in got) < 1e-10


def test_nothing_to_learn(spark):
    assert W.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect() == []
    assert W.whitened(spark.createDataFrame([(1, [], 0), (2, None, 0)], SCHEMA)).collect() == []
    one = W.whitened(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0)], SCHEMA)).collect()
    assert sorted((r["vec_id"], r["component"], r["explained"]) for r in one) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_beyond_64_bits():
    learned = W.Whitening(1 << 40, np.array([1 << 62]), np.array([1.0]), np.ones((1, 1)), 1.0)
    centred = learned.centred(np.array([[1 << 23]]))
    assert centred.tolist() == [[(1 << 63) - (1 << 62)]] and learned.deviation(centred).tolist() == [1 << 124]


def test_many_factors(spark):
    x = np.random.default_rng(2).standard_normal((400, 6))
    table = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], SCHEMA).repartition(70)
    rows = materialise(W.scaled(table), "rows")
    learned = W.Whitening(400, np.zeros(6, "int64"), np.empty(0), np.empty((6, 0)), 0.0)
    r = W.triangular_factor(rows.repartition(70), learned)
    whole = np.floor(64 * x.astype("float32").astype(float)) + W.SHIFT
    assert np.abs(r.T @ r / (whole.T @ whole) - 1).max() < 1e-12
