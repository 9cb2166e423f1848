import numpy as np
import pytest

from strata.llm import lattice as L
from strata.llm.queries import op9_lattice, table


def brute(rows, threshold=0.9):
    """n_links, component and kept by id, from all pairs in double precision."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            good[i] = a / np.linalg.norm(a)
    links = {i: set() for i, _ in rows if i is not None}
    for i, a in good.items():
        for j, b in good.items():
            if i != j and len(a) == len(b) and float(a @ b) >= threshold:
                links[i].add(j)
    least = {i: i for i in links}
    while True:
        lower = {i: min([least[i]] + [least[j] for j in links[i]]) for i in links}
        if lower == least:
            return {i: (len(links[i]), least[i], least[i] == i) for i in links}
        least = lower


def got(frame):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in frame.collect()}


def test_nearest_points_are_nearest():
    y = np.random.default_rng(0).normal(size=(300, 8)) * 2
    near = L.nearest_point(y)
    doubled = 2 * near
    assert (doubled == np.rint(doubled)).all() and (near.sum(1) % 2 == 0).all()
    assert (np.abs(doubled) % 2 == np.abs(doubled[:, :1]) % 2).all()
    around = near[:, None] + L.minimal_vectors()
    assert (((y - near) ** 2).sum(1) <= ((y[:, None] - around) ** 2).sum(2).min(1) + 1e-9).all()
    assert len(np.unique(L.minimal_vectors(), axis=0)) == 240


def test_recall_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    o = rng.normal(size=x.shape)
    o -= (o * x).sum(1)[:, None] * x
    o /= np.linalg.norm(o, axis=1)[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * o
    met = np.zeros(len(x), bool)
    for table_no in range(L.TABLES):
        a, b = L.cells(x, table_no), L.cells(y, table_no)
        met |= (a[:, :, None] == b[:, None, :]).any((1, 2))
    assert met.mean() >= 0.97


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of near copies, exact copies, and vectors that link with nothing."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(12):
        centre = rng.normal(size=32)
        rows += [(centre + rng.normal(size=32) * s).tolist() for s in (0.0, 0.05, 0.2, 0.3, 0.35) for _ in range(8)]
    rows += [rows[3]] * 30 + [[2 * x for x in rows[3]]] * 3
    rows += [[0.0] * 32, None, [], [1.0, None], [float("nan")] * 32, [float("inf")] + [0.0] * 31, [1.0, 0.0], [1.0, 0.1]]
    order = rng.permutation(len(rows))
    rows = [(int(k), rows[i]) for k, i in enumerate(order)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def as_floats(rows):
    return [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_equals_brute_force(vectors):
    rows, frame = vectors
    assert got(L.near_duplicates(frame)) == brute(as_floats(rows))


def test_small_tiles(vectors, monkeypatch):
    monkeypatch.setattr(L, "TILE", 4)
    rows, frame = vectors
    assert got(L.near_duplicates(frame)) == brute(as_floats(rows))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf_dir, "embeddings").collect()]
    assert got(op9_lattice(spark, sf_dir)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (None, [1.0, 0.0], "b"), (2, [1.0, 0.1], None), (3, None, "c")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component_id string")
    out = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in L.near_duplicates(frame).collect())
    assert out == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)] or out[0][0] == 0
    assert [x for x in out if x[0]] == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert L.near_duplicates(frame.limit(0)).count() == 0
