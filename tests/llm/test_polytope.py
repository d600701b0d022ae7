import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import polytope
from tests.llm.brute import components

KIND = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def brute(rows, cosine=0.9):
    known = {}
    for i, v in rows:
        x = np.array([np.nan if c is None else c for c in v], float) if v else np.zeros(0)
        if len(x) and np.isfinite(x).all() and x.any():
            known[i] = x / np.linalg.norm(x)
    links = [
        (a, b) for a in known for b in known if a < b and len(known[a]) == len(known[b]) and known[a] @ known[b] >= cosine
    ]
    of = components([i for i, _ in rows], links)
    return {i: (sum(i in link for link in links), of[i], of[i] == i) for i, _ in rows}


def corpus(seed=5):
    random = np.random.default_rng(seed)
    rows = random.normal(size=(150, 24)).astype(np.float32)
    near = [rows[k % 6] + 0.3 * random.normal(size=24).astype(np.float32) for k in range(120)]
    same = [rows[7]] * 15 + [-rows[7], 3 * rows[7]]
    out = [[float(c) for c in v] for v in [*rows, *near, *same]]
    out += [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    return list(enumerate(out))


def found(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND).withColumn("node", F.lit("clash"))
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in polytope.vector_components(frame, **more).collect()}


def test_links_equal_brute_force(spark):
    rows = corpus()
    assert found(spark, rows) == brute(rows)


def test_large_buckets_are_cut_into_blocks(spark):
    rows = corpus(6)
    assert found(spark, rows, block=7) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in polytope.vector_components(frame).collect()]
    assert sorted(got, key=str) == [(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True)]
    assert polytope.vector_components(frame.limit(0)).count() == 0


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(9, 32))
    y = polytope.hadamard(x.copy()) / np.sqrt(32)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(polytope.hadamard(y.copy()) / np.sqrt(32), x)


def test_pairs_of_large_groups():
    random = np.random.default_rng(2)
    x = random.normal(size=(8, 16))[random.integers(0, 8, 500)] + 0.2 * random.normal(size=(500, 16))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    sizes, begin = np.array([3, 297, 200]), np.array([0, 3, 300])
    got = {pair for p, q in polytope._near_in_large(unit, sizes, begin, 0.9) for pair in zip(p.tolist(), q.tolist(), strict=True)}
    near = unit @ unit.T
    want = {(i, j) for lo, hi in ((3, 300), (300, 500)) for i in range(lo, hi) for j in range(i + 1, hi) if near[i, j] >= 0.9}
    assert want <= got and all(near[i, j] >= 0.9 - 1e-8 for i, j in got)


def test_miss_rate_of_large_tables():
    random = np.random.default_rng(7)
    for dims, rows in ((64, 10**6), (64, 10**8), (64, 10**10), (384, 10**9)):
        shape = polytope.shape_for(dims, rows, 0.9)
        x = random.normal(size=(6000, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = random.normal(size=x.shape)
        y -= (y * x).sum(axis=1, keepdims=True) * x
        y = 0.9 * x + (1 - 0.81) ** 0.5 * y / np.linalg.norm(y, axis=1, keepdims=True)
        few = polytope.Polytope(dims, shape.hashes, 4)
        meet = (few.keys(x)[:, :, :, None] == few.keys(y)[:, :, None, :]).any(axis=(2, 3)).mean()
        assert shape.signs.shape[0] == shape.tables and (1 - meet) ** shape.tables < 3e-6
