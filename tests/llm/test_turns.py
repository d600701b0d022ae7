import random

import pytest

from tallyline.llm.turns import conversation_trie
from tests.llm.brute import digest, trie

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS k", "2 AS words", "3 AS at").repartition(3)
    got = conversation_trie(frame, **sizes)
    assert got.columns == COLUMNS
    out = {(r[0], r[1]): tuple(r[2:]) for r in got.collect()}
    assert len(out) == got.count()
    return out


def conversations(seed, n=130, alphabet=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), n):
        turns = range(rng.randrange(1, longest))
        rows += [(c, t if rng.random() < 0.95 else None, rng.choice(["user", None, ""]), rng.choice(["a b", "c", " \t ", None][:alphabet])) for t in turns]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"width": 2, "shard_rows": 4, "ordered_rows": 6}, {"width": 3, "shard_rows": 1}])
def test_nodes_equal_brute_force(spark, sizes):
    rows = conversations(1)
    assert found(spark, rows, **sizes) == trie(rows)


def test_copies_beyond_a_range_and_a_long_conversation(spark):
    chat = [("user", "one two three"), ("bot", "four"), ("user", None), ("bot", "five six")]
    # Families without a first conversation, so that all are copies: a group over many ranges.
    rows = [(c, t, *chat[t]) for c in range(0, 300, 20) for t in range(4)]
    rows += [(c, t, *chat[t]) for c in range(1000, 1200, 20) for t in range(4)]
    rows += [(5000, t, "user", "w " * (t % 7)) for t in range(200)]
    rows += [(5020, t, "user", "w " * (t % 7)) for t in range(150)]
    rows += rows[:4]  # repeated rows are repeated turns
    want = trie(rows)
    assert found(spark, rows, width=4, shard_rows=3, ordered_rows=40) == want
    assert max(v[1] for v in want.values()) == 27


def test_turnless_conversations_and_odd_rows(spark):
    # 21 has h = 3 turns of its own at most, and its family has no first conversation.
    rows = [(21, 0, "a", "x"), (22, None, None, None), (None, 1, "a", "lost"), (40, 0, "a", "y z"), (41, 0, "b", "q")]
    rows += [(60, 0, "a", "ß \x0b \x0d wörd " * 2000)]
    assert found(spark, rows) == trie(rows)
    alone = found(spark, [(21, 0, "a", "x")])
    assert alone in ({(21, 0): (None, 1, 0, 1, 0, digest("21"))}, trie([(21, 0, "a", "x")]))


def test_no_conversations(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 1, "a", "b")]) == {}
