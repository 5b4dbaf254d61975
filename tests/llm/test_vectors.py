"""Whitening and clustering against plain versions."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from texlode.llm.clustering import cluster, nearest
from texlode.llm.queries import ORACLE, QUERIES
from texlode.llm.spectrum import count_above, leading
from texlode.llm.whitening import _products, whiten, whitened_rows
from texlode.llm.workers import reach

from .conftest import CLASHING

SCHEMA = "vec_id bigint, embedding array<float>, label int, " + ", ".join(
    f"{name} string" for name in (*CLASHING, "x", "cluster", "distance", "component", "whitened", "i", "j", "s")
)


def make_vectors(n=400, seed=3):
    rnd = np.random.default_rng(seed)
    mix = rnd.standard_normal((64, 64)) * np.linspace(0.02, 1.2, 64)
    rows = [(int(i), rnd.standard_normal(64).astype(np.float32) @ mix.astype(np.float32) + 0.3) for i in range(n)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    # Repeated rows, repeated ids, no ids, ties.
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[10][1]), (None, rows[11][1])] + [(1000 + i, rows[5][1]) for i in range(40)]
    bad = [(600, None), (601, []), (602, [1.0] * 63), (603, [1.0] * 65)]
    for i, x in enumerate((None, math.nan, math.inf, -math.inf, 3e38)):
        v = list(rows[3][1])
        v[i] = x
        bad.append((610 + i, v))
    return rows, bad


def frame(spark, rows):
    reach(spark)
    names = len(SCHEMA.split(",")) - 2
    return spark.createDataFrame([(i, v, 0, *(["x"] * (names - 1))) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, bad = make_vectors()
    path = tmp_path_factory.mktemp("vectors")
    frame(spark, rows + bad).repartition(5).write.parquet(f"{path}/embeddings.parquet")
    frame(spark, []).write.parquet(f"{path}/none/embeddings.parquet")
    frame(spark, bad[:2]).write.parquet(f"{path}/bad/embeddings.parquet")
    return str(path), rows


def integers(rows):
    return np.asarray([[math.floor(64 * x) for x in v] for _, v in rows], dtype=np.int64)


@pytest.mark.parametrize("seed", range(4))
def test_counts_and_eigenpairs(seed):
    rnd = np.random.default_rng(seed)
    d = int(rnd.integers(1, 40))
    q = np.linalg.qr(rnd.standard_normal((d, d)))[0]
    values = rnd.choice([0.0, 1.0, 1.0 + 1e-9, 5.0, 5.0, *rnd.random(10) * 100], d)
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    for shift in (-1.0, 0.5, 3.0, 50.0):
        assert count_above(matrix, shift) == (want > shift).sum()
    found, vectors = leading(matrix, 12)
    k = min(12, d)
    assert np.allclose(found, want[:k], atol=1e-10 * max(1, want[0]))
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-9 * max(1, want[0])


def test_indefinite_matrix_with_zero_diagonal():
    matrix = np.array([[0.0, 2.0, 0.0], [2.0, 0.0, 1.0], [0.0, 1.0, 0.0]])
    assert [count_above(matrix, s) for s in (-3, -1, 1e-9, 3)] == [3, 2, 1, 0]
    assert np.allclose(leading(matrix, 3)[0], [5**0.5, 0, -(5**0.5)])


def test_products_are_exact():
    y = np.random.default_rng(1).integers(-(1 << 30), 1 << 30, (9, 3))
    want = sum(np.outer(row, row) for row in y.astype(object))
    assert (_products(y) == want).all()
    big = y * (1 << 8)
    assert (_products(big) == want * (1 << 16)).all()


def test_op11(spark, tables):
    path, rows = tables
    x = integers(rows) + 1_000_000
    n = len(x)
    total = x.sum(axis=0)
    z = n * x - total
    covariance = (z.astype(float) / n).T @ (z.astype(float) / n) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    got = QUERIES["op11_embedding_whitening"](spark, path).toPandas()
    assert len(got) == 32 * n and set(got.n) == {n} and got.identity_error.max() < 1e-8
    assert got.component.min() == 1 and got.component.max() == 32
    shares = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, values / np.trace(covariance), rtol=1e-9)
    deviation = (z.astype(object) ** 2).sum(axis=1)
    white = z / n @ vectors / np.sqrt(values)
    # Signs are free, but the same for all rows.
    by_row = {}
    for i, (vec_id, _) in enumerate(rows):
        by_row.setdefault((-1 if vec_id is None else vec_id, int(deviation[i])), []).append(white[i])
    own = got.assign(vec_id=got.vec_id.fillna(-1)).sort_values("component")
    signs = None
    for key, part in own.groupby(["vec_id", "deviation"]):
        values = part.whitened.to_numpy().reshape(32, -1)
        want = np.asarray(by_row[key[0], key[1]]).T
        assert values.shape == want.shape
        if want.shape[1] == 1:
            if signs is None:
                signs = np.sign(values * want)
            assert np.allclose(values, want * signs, atol=1e-7)


def test_op11_degenerate(spark, tables):
    path, rows = tables
    assert QUERIES["op11_embedding_whitening"](spark, f"{path}/none").collect() == []
    assert QUERIES["op11_embedding_whitening"](spark, f"{path}/bad").collect() == []
    same = whitened_rows(frame(spark, [(i, [1.0, 2.0]) for i in range(3)])).collect()
    assert len(same) == 6 and {(r.deviation, r.whitened, r.explained) for r in same} == {(0, None, 0.0)}
    # The third dimension follows from the others; the fourth is another length.
    few = [(i, [float(a), float(b), float(a - b)]) for i, (a, b) in enumerate([(1, 5), (2, 3), (4, 4), (9, 1), (3, 0)])]
    out, fit = whiten(frame(spark, few + [(9, [1.0] * 4)]), components=3)
    assert fit["n"] == 5 and fit["identity_error"] < 1e-9 and fit["explained"][2] == 0
    assert all(r.whitened[2] is None and None not in r.whitened[:2] for r in out.collect())
    huge = [(i, [float(x), 1.0]) for i, x in enumerate((1e9, -1e9, 5.0))]
    out, fit = whiten(frame(spark, huge), components=1)
    x = [int(64 * v[0]) for _, v in huge]
    assert sorted(int(r.deviation) for r in out.collect()) == sorted((3 * a - sum(x)) ** 2 for a in x)


def plain_clusters(rows, k=16, rounds=3):
    x = [[math.floor(64 * e) for e in v] for _, v in rows]
    ids = ["" if i is None else str(i) for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda r: (hashlib.sha256(f"1:{ids[r]}".encode()).hexdigest(), x[r]))
    centroids = [x[r] for r in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for v in x]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            members = [v for v, (_, c) in zip(x, own) if c == j]
            if members:
                centroids[j] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    total = sum(d for d, _ in own)
    inertia = {}
    for d, c in own:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(rows[r][0], c, d, inertia[c], total, sha[c]) for r, (d, c) in enumerate(own)]


def test_op13(spark, tables):
    path, rows = tables
    got = QUERIES["op13_centroid_clustering"](spark, path).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_clusters(rows), key=str)


def test_op13_sql(spark, tables):
    path, _ = tables
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet' WHERE vec_id <> 614 OR vec_id IS NULL")
    want = db.sql(ORACLE["op13_centroid_clustering"])
    got = QUERIES["op13_centroid_clustering"](spark, path)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_op13_few_and_none(spark, tables):
    path, rows = tables
    assert QUERIES["op13_centroid_clustering"](spark, f"{path}/none").collect() == []
    assert QUERIES["op13_centroid_clustering"](spark, f"{path}/bad").collect() == []
    few = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-7.0, 1.0])]
    out, centroids = cluster(frame(spark, few), k=16, rounds=2, dims=2)
    assert {(r.vec_id, r.distance) for r in out.collect()} == {(1, 0), (2, 0), (3, 0)} and len(centroids) == 3


@pytest.mark.parametrize("d", [1, 2, 64])
def test_search_is_exact(d):
    rnd = np.random.default_rng(d)
    for spread in (2, 100, 1 << 27):
        centroids = rnd.integers(-spread, spread + 1, (33, d))
        centroids[5] = centroids[20]
        x = np.concatenate((rnd.integers(-spread, spread + 1, (500, d)), centroids))
        exact = (x[:, None, :] - centroids[None, :, :]).astype(object)
        distances = (exact * exact).sum(axis=2)
        label, best = nearest(x, centroids)
        assert label.tolist() == [int(row.argmin()) for row in distances]
        assert best.tolist() == distances.min(axis=1).tolist()
