import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import toxicity

LABELS = "doc_id LONG, quality INT, toxic INT"


def corpus(spark, n=900):
    rng = random.Random(2)
    words = [f"{a}{b}{c}" for a in ("tra", "mo", "li", "ke") for b in ("na", "ri", "su") for c in ("to", "be", "gu")]
    bad = ["snargle", "blugoth", "krizzle"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 8 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(3, 9) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(bad).upper() + "!!"
        docs.append((i, " ".join(text), "en", f"src{toxic}"))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING, lang STRING, source STRING")
    return frame, spark.createDataFrame(labels, LABELS)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    got = toxicity.toxicity(docs.withColumn("score", F.lit("clash")), labels).collect()
    assert len(got) == 900
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    right = [r.predicted == int(r.doc_id % 8 == 0) for r in held]
    assert len(held) > 150 and sum(right) / len(right) > 0.97


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(spark, 300)
    changed = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.fit_toxicity(docs, x) for x in (labels, changed))
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights)


def test_odd_rows(spark):
    docs, labels = corpus(spark, 300)
    odd = spark.createDataFrame(
        [(None, "snargle blugoth", None, None), (5000, None, None, None), (5001, "", None, None), (5002, "123 !!", None, None),
         (5003, "snargle krizzle " * 40_000, None, None), (5003, "traso", None, None)], docs.schema,
    )
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, None), (8, 0, 0), (8, 0, 1)], LABELS))
    got = toxicity.toxicity(docs.unionByName(odd), labels).where("doc_id is null or doc_id >= 5000").collect()
    score = {(r.doc_id, n): r.score for n, r in enumerate(sorted(got, key=lambda r: (r.doc_id or 0, -r.score)))}
    assert len(got) == 6 and score[(None, 0)] > 0.3 and score[(5000, 1)] == score[(5001, 2)] == score[(5002, 3)]
    assert score[(5003, 4)] > 0.3


def test_without_labels_or_documents(spark):
    docs, labels = corpus(spark, 50)
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_risk_does_not_go_below_zero():
    # Two columns: the first only among positives, the second everywhere.
    rng = np.random.default_rng(1)
    positive = np.arange(400) < 100
    truly = positive | (rng.random(400) < 0.25)
    rows = np.repeat(np.arange(400), 2)
    cols = np.tile([0, 1], 400)
    values = np.stack([truly.astype(float), np.ones(400)], axis=1).reshape(-1)
    weights, bias = toxicity.nnpu(rows, cols, values, positive, 2, 0.25, toxicity.Fit(steps=800))
    prob = 1 / (1 + np.exp(-(values.reshape(400, 2) @ weights + bias)))
    assert prob[truly].min() > prob[~truly].max() and prob[truly].min() > 0.5 > prob[~truly].max()
