import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import topk


def brute(rows, queries, k):
    out = []
    for q in queries:
        for v in [v for i, v in rows if i == q and v]:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and w and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_search_equals_brute_force(spark):
    random = np.random.default_rng(1)
    # Few values, so that many scores are tied.
    rows = [(i, [int(x) for x in random.integers(-3, 4, 20)]) for i in range(400)]
    rows += [(1000, None), (1001, []), (1002, [1, 2]), (1003, [3, 4])]
    frame = spark.createDataFrame(rows, "id LONG, v ARRAY<LONG>").withColumn("score", F.lit("clash"))
    queries = [i for i, _ in rows if i % 20 == 0] + [1002]
    got = topk.exact_top_k(frame.where(F.col("id").isin(queries)), frame, 7, block=64, query_block=5)
    assert found(got) == brute(rows, queries, 7)


def test_fewer_candidates_than_asked_for(spark):
    frame = spark.createDataFrame([(1, [1, 2]), (2, [5, 0]), (None, [1, 1])], "id LONG, v ARRAY<LONG>")
    assert found(topk.exact_top_k(frame, frame, 20)) == [(1, 1, 2, 5), (2, 1, 1, 5)]
    assert topk.exact_top_k(frame.limit(0), frame, 3).count() == 0
    assert topk.exact_top_k(frame, frame.limit(0), 3).count() == 0


def test_pruning_in_many_chunks_keeps_every_result(monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 50)
    monkeypatch.setattr(topk, "STEP", 4)
    random = np.random.default_rng(2)
    for factor, spread in ((1, 1.0), (1, 8.0), (1 << 22, 1.0)):
        norms = np.exp(random.normal(size=(700, 1)) * np.log(spread))
        vectors = (random.normal(size=(700, 24)) * 40 * norms).astype(np.int64) * factor
        vectors[200:420] = vectors[200]  # copies
        ids = random.permutation(700)
        asked = np.flatnonzero(ids % 7 == 0)
        which, other, score = topk.search_block(vectors[asked], ids[asked], vectors, ids, 9)
        got = sorted((int(ids[asked][w]), int(o), int(s)) for w, o, s in zip(which, other, score, strict=True))
        rows = [(int(i), [int(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
        assert got == sorted((q, i, s) for q, _, i, s in brute(rows, [int(i) for i in ids[asked]], 9))


def test_repeated_ids_spread_over_the_blocks(spark):
    frame = spark.createDataFrame([(5, [i % 9, i]) for i in range(300)] + [(6, [1, 1])], "id LONG, v ARRAY<LONG>")
    got = found(topk.exact_top_k(frame.where("id = 6"), frame, 3, block=16, query_block=4))
    assert [g[3] for g in got] == sorted((i % 9 + i for i in range(300)), reverse=True)[:3]


def test_scaled_components(spark):
    rows = [([0.99, -0.01],), ([float("nan"), 1.0],), ([None, 1.0],), (None,), ([],), ([float("-inf")],)]
    frame = spark.createDataFrame(rows, "embedding ARRAY<FLOAT>")
    assert [r[0] for r in frame.select(topk.floor_scaled()).collect()] == [[63, -1], None, None, None, None, None]
