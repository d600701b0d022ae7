import random

import numpy as np
import pytest

from tallyline.llm.merkle import _siblings, _steps, append_log, document_manifest, fold, height, log_place
from tests.llm.brute import digest, merkle

SCHEMA = "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING"


def documents(n=150):
    rng = random.Random(4)
    docs = []
    for i in range(n):
        lang = "en" if i % 3 else rng.choice(["fr", "de", "Zü", "", None])
        text = rng.choice([None, "", f"Text {i}", "Üb ÄRGER Z" * rng.randrange(1, 30), "x" * 5000])
        docs.append((rng.randrange(-50, 500), rng.choice([None, "src"]), lang, rng.choice([None, i]), text))
    docs += [docs[0], docs[1], docs[1]]  # repeated rows
    docs += [(None, None, None, None, None), (None, "a", "en", 1, "NULL id"), (7, "s", "solo", 3, "ABC")]
    return docs


@pytest.mark.parametrize(("fan", "levels", "ordered"), [(8, 4, 1000), (2, 2, 1000), (3, 1, 20), (8, 1, 20)])
def test_proofs_equal_plain_trees(spark, fan, levels, ordered):
    docs = documents()
    frame = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' AS row", "'y' AS leaf", "'z' AS grp").repartition(5)
    got = document_manifest(frame, fan, levels, ordered)[1]
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = merkle(docs, fan)
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(((docs[i][0], *r) for i, r in want.items()), key=key)
    assert any(not r[-1] for r in want.values()) and any(r[-1] for r in want.values())


def test_no_documents_and_one(spark):
    manifest, got = document_manifest(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None and got.count() == 0
    manifest, got = document_manifest(spark.createDataFrame([(1, "s", "en", 1, "a")], SCHEMA))
    row = got.first()
    assert row.leaf == row.subroot == row.root == manifest.root == row.folded_root
    assert row.proof_sha256 == digest("") and row.verified


@pytest.mark.parametrize("fan", [2, 3, 8])
@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 27, 63, 64, 65, 100, 512])
def test_places_follow_from_sizes(fan, n):
    leaves = [digest(str(i)).encode() for i in range(n)]
    levels = height(n, fan)
    log = append_log(leaves, levels, fan)
    places = [log_place(level, np.arange(-(-n // fan**level)), n, fan) for level in range(levels + 1)]
    assert sorted(np.concatenate(places).tolist()) == list(range(len(log)))
    assert [log[p] for p in places[0]] == leaves
    for level in range(levels):
        nodes = [log[p] for p in places[level]]
        assert [log[p] for p in places[level + 1]] == [
            digest(b"".join(nodes[i : i + fan]).decode()).encode() for i in range(0, len(nodes), fan)]
    # Completion order: every node stands behind all below it.
    assert all(places[level + 1][j // fan] > p for level in range(levels) for j, p in enumerate(places[level].tolist()))
    steps = _steps(0, n, bytes.fromhex(b"".join(log).decode()), fan, 20)
    assert {fold(leaf.decode(), _siblings(steps, i, fan)) for i, leaf in enumerate(leaves)} == {log[-1].decode()}
