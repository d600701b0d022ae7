import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import suffixes
from tests.llm.brute import repeats

KIND = "doc_id LONG, text STRING"


def corpus():
    rng = random.Random(3)

    def prose(n):
        return "".join(rng.choice("abcdefg hé") for _ in range(n))

    shared = [prose(700) for _ in range(3)]
    texts = [prose(rng.randrange(0, 1500)) for _ in range(25)]
    for k in range(30):
        s = shared[k % 3]
        lo, hi = sorted(rng.sample(range(len(s)), 2))
        texts.append(prose(rng.randrange(300)) + s[lo:hi] + prose(rng.randrange(300)))
        texts.append(prose(50) + s + prose(rng.randrange(5)))
    whole = prose(900)
    texts += [whole, whole, whole[:-1] + "!", whole[:450], whole[451:], "a" * 1000, "ab" * 600, "x" * 399, "x" * 400]
    texts += [prose(200) + shared[0][100:500], shared[0][100:499], None, "", "é" * 600, prose(60_000) + whole[100:800]]
    return list(enumerate(texts))


@pytest.mark.parametrize("group", [suffixes.GROUP, 2])
def test_removed_bytes_equal_brute_force(spark, group):
    rows = corpus()
    frame = spark.createDataFrame(rows, KIND).withColumn("kept", F.lit("clash")).withColumn("rid", F.lit(1)).repartition(4)
    got = {r.doc_id: r for r in suffixes.remove_repeats(frame, group=group).collect()}
    for (i, _), (size, gone, spans, kept) in zip(rows, repeats([t for _, t in rows]), strict=True):
        r = got[i]
        assert (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) == (size, gone, spans, hashlib.sha256(kept).hexdigest()), i
        assert (r.kept is None) == (gone == 0) and (gone == 0 or bytes(r.kept) == kept)


def test_odd_rows(spark):
    text = "0123456789" * 50 + "abc"
    rows = [(1, text), (1, text), (None, text), (2, "short")]
    got = suffixes.remove_repeats(spark.createDataFrame(rows, KIND)).collect()
    assert sorted((r.n_removed, len(r.spans)) for r in got) == [(0, 0), (503, 1), (503, 1), (503, 1)]
    single = suffixes.remove_repeats(spark.createDataFrame([(1, "x" * 399 + "y")], KIND)).first()
    assert single.n_removed == 0
    assert suffixes.remove_repeats(spark.createDataFrame([], KIND)).count() == 0


def test_sorted_suffixes_and_common_parts():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))).encode() for _ in range(200)]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    cut = [len(t) // 3 for t in texts]
    group = np.sort(np.array([k % 7 for k in range(200)]))
    of = suffixes.Suffixes(np.frombuffer(b"".join(texts), np.uint8), bounds, bounds[:-1] + cut)
    order = of.sort(group).tolist()
    for g in range(7):
        own = [k for k in range(200) if group[k] == g]
        assert [k for k in order if group[k] == g] == sorted(own, key=lambda k: (texts[k][cut[k] :], k))
    i, j = np.arange(100), np.arange(100, 200)
    for k, n in enumerate(of.common(i, j, False).tolist()):
        a, b = texts[k][: cut[k]][::-1], texts[100 + k][: cut[100 + k]][::-1]
        assert n == next((m for m, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_long_texts_have_the_anchors_of_their_windows(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 105, 20_000).astype(np.uint8)
    whole = {int(p) for a in suffixes.anchors(data, np.array([0, len(data)]), 400) for p in a[3]}
    monkeypatch.setattr(suffixes, "SEGMENT", 3000)
    parts = list(suffixes.anchors(data, np.array([0, len(data)]), 400))
    assert len(parts) > 5 and {int(p) for a in parts for p in a[3]} == whole
    assert sum(int(a[5].sum()) for a in parts) == len(data) - 399
