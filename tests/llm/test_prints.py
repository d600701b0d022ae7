import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm.prints import CUTS, GRID, Prefixes, common_extension, document_fingerprints, edited, fingerprint, likeness

SCHEMA = "doc_id LONG, text STRING"


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéöß𝄞 nrstl") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def plain(rows):
    """{doc_id: (n_chars, edited_sha256)} of rows with different ids."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (ident, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + nxt[:cut]
        out[ident] = len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(text), fingerprint(changed), fingerprint(nxt)
    return out


def test_equal_to_brute_force(spark):
    rows = [(i * 8 % 301 - 20, prose(i, i % 90)) for i in range(301)]
    rows += [(None, "no number"), (5000, None), (5001, ""), (5002, "ab"), (5003, "x" * 30000), (5004, prose(3, 9000))]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "2 AS kind", "3 AS n_chars").repartition(6)
    got = document_fingerprints(frame)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    want = plain(rows)
    seen = got.collect()
    assert len(seen) == len(rows)
    for r in seen:
        n, digest, own, changed, nxt = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, digest, own, changed)
        assert (r.near_edited, r.near_next) == (likeness(own, changed), likeness(own, nxt))


def test_copies_are_spread_and_alike(spark):
    rows = [(7, "the same text again and again")] * 400 + [(None, None)] * 100 + [(9, "another one")]
    got = document_fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(got) == 501
    assert sum(r.near_next == 1 for r in got) == 399 + 99
    assert {r.fingerprint for r in got if r.doc_id is None} == {"0"}
    alone = document_fingerprints(spark.createDataFrame([(1, "abcdef")], SCHEMA)).collect()
    assert [(r.n_chars, r.near_next) for r in alone] == [(6, 1.0)]
    assert document_fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_likeness_follows_the_common_part():
    for n in (40, 200, 2000, 30000):
        for seed in range(8):
            text, other = prose(seed, n // 5)[:n], prose(seed + 100, n // 5)
            assert likeness(fingerprint(text), fingerprint(other)) < 0.1
            half = len(text) // 2
            for changed, share in (
                (edited(text, other), 2 / 3), (text + other[:half], 0.8), (other[:half] + text, 0.8), (text[half:], 2 / 3),
            ):
                got = likeness(fingerprint(text), fingerprint(changed))
                assert share - 0.25 < got < share + 0.12, (n, seed, share, got)
                assert got == likeness(fingerprint(text), fingerprint(changed))
    assert likeness(fingerprint(""), fingerprint("")) == 1 and likeness(fingerprint("a"), fingerprint("")) == 0
    assert len(fingerprint(prose(1, 20000))) < 40 + 16 * 2 * GRID + 30 * CUTS


def test_a_part_moved_to_another_place_is_found():
    a, b, c = (prose(seed, 400) for seed in range(3))
    assert likeness(fingerprint(a + b + c), fingerprint(c + a + b)) > 0.75


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=30), st.text("ab", max_size=30), st.data())
def test_spans_and_extensions(x, y, data):
    a, b = Prefixes(x), Prefixes(y)
    i, j = data.draw(st.integers(0, len(x))), data.draw(st.integers(0, len(y)))
    want = 0
    while i + want < len(x) and j + want < len(y) and x[i + want] == y[j + want]:
        want += 1
    assert common_extension(a, i, b, j) == want
    end = data.draw(st.integers(i, len(x)))
    assert (a.span(i, end) == b.span(j, min(len(y), j + end - i))) == (x[i:end] == y[j : j + end - i])
    assert (fingerprint(x) == fingerprint(y)) == (x == y)
    assert 0 <= likeness(fingerprint(x), fingerprint(y)) <= 1
