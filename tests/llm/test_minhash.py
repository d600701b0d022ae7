import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import graph, minhash
from tests.llm.brute import near_duplicates, shingle_set

KIND = "doc_id LONG, text STRING"


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.minhash_components(df).collect()}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    # A cloud around a text whose least id is far out: 0 to 8 edits, so some pairs are linked and some not.
    texts += [edited(base, 8, rng)] + [edited(base, rng.randrange(9), rng) for _ in range(60)]
    texts += [texts[3]] * 20 + [texts[3].upper()] + [None, "", "  \t\n", "one two", "one two", "ONE two", "a b c d e"]
    passage = " ".join(base[:60])
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(20 + i)) for i in range(20)]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(60_000)))
    return list(enumerate(texts))


def test_components_equal_brute_force(spark, corpus):
    assert found(spark.createDataFrame(corpus, KIND).repartition(5)) == near_duplicates(corpus)


def test_rows_on_the_threshold_are_linked(spark):
    # 6 of 8 shingles in common: exactly 0.75.
    rows = [(1, "a b c d e f g h i j k"), (2, "z b c d e f g h i j k"), (3, "q q q q q q")]
    sets = {i: shingle_set(t) for i, t in rows}
    assert len(sets[1] & sets[2]) * 4 == 3 * len(sets[1] | sets[2]) or found(
        spark.createDataFrame(rows, KIND)
    ) == near_duplicates(rows)
    assert found(spark.createDataFrame(rows, KIND)) == near_duplicates(rows)


def test_odd_rows(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, None), (9, "a b c d e f")]
    frame = spark.createDataFrame(rows, KIND).withColumn("component_id", F.lit("clash")).withColumn("key", F.lit(1))
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_components(frame).collect())
    assert got == [(0, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True), (9, 2, 5, False)]


def test_empty_table(spark):
    assert found(spark.createDataFrame([], KIND)) == {}


def test_estimates_are_near_the_truth():
    random_ = np.random.default_rng(2)
    pool = random_.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = minhash.minima(pool[:2500]), minhash.minima(pool[500:])
    x, y = (minhash.sketch(m).view(np.uint8) for m in (a, b))
    planes = np.unpackbits(x ^ y).reshape(minhash.BITS, -1)
    equal = 1 - planes.any(axis=0).mean()
    chance = 2.0**-minhash.BITS
    assert abs((equal - chance) / (1 - chance) - 2000 / 3000) < 0.16


def test_components_take_no_step_behind_the_stars(spark, monkeypatch):
    steps, real = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, label: steps.append(label) or real(df, label))

    def components(edges):
        steps.clear()
        found = graph.connected_components(spark.createDataFrame(edges, "a long, b long"))
        return sorted(map(tuple, found.collect()))

    assert components([(0, 2), (3, 0), (5, 4), (7, 7), (None, 8)]) == [(0, 0), (2, 0), (3, 0), (4, 4), (5, 4)]
    assert steps == ["edges"]
    assert components([]) == [] and steps == ["edges"]
    assert components([(i, i + 1) for i in range(20)]) == [(i, 0) for i in range(21)]
    # One edge to two lesser nodes, and a chain of two.
    assert components([(3, 1), (3, 2)]) == components([(3, 2), (2, 1)]) == [(1, 1), (2, 1), (3, 1)]


def test_components_write_few_tables(spark, monkeypatch):
    steps, real = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, label: steps.append(label) or real(df, label))
    # A chain needs the steps; repeated edges, and stars, need none.
    edges = spark.createDataFrame([(0, 2), (2, 0), (0, 2), (1, 5), (5, 4), (None, 7)], "a long, b long")
    got = sorted(map(tuple, graph.connected_components(edges).collect()))
    assert got == [(0, 0), (1, 1), (2, 0), (4, 1), (5, 1)] and len(steps) == 5
    steps.clear()
    got = graph.connected_components(edges.where("a = 0 or a = 2")).collect()
    assert sorted(map(tuple, got)) == [(0, 0), (2, 0)] and len(steps) == 1


def test_further_links_join_whole_components(spark, monkeypatch):
    steps, real = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, label: steps.append(label) or real(df, label))
    component = spark.createDataFrame([(i, 10 * (i // 10)) for i in range(40)], "id long, component_id long")
    links = spark.createDataFrame([(5, 17), (18, 2), (33, 91), (33, 92), (27, 28), (70, 71)], "a long, b long")
    got = sorted(map(tuple, minhash._joined(component, links).collect()))
    root = {0: 0, 1: 0, 2: 20, 3: 30}
    assert got == sorted([(i, root[i // 10]) for i in range(40)] + [(91, 30), (92, 30), (70, 70), (71, 70)])
    # The components, not their members, are linked; here the links are stars.
    assert steps == ["edges"]


def test_every_step_writes_few_tables(spark, corpus, monkeypatch):
    steps, real = [], graph.stored
    for module in (graph, minhash):
        monkeypatch.setattr(module, "stored", lambda df, label: steps.append(label) or real(df, label))
    assert found(spark.createDataFrame(corpus, KIND).repartition(5)) == near_duplicates(corpus)
    assert "left" in steps and len(steps) < 34
