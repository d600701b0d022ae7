import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import packing

TEXTS = ["", None, "hello world", "a <|endoftext|> b", "é日本語 \U0001f600", "word " * 5000, "x" * 3000, "hello world"]


def check(rows, texts, most=2048):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(packing.default_tokenizer()[0])
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in texts.items():
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for n, p in enumerate(sorted(by[i], key=lambda r: r.piece)):
            assert (p.piece, p.start) == (n, at) and p.length <= most and (n == 0 or p.length == most)
            assert zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    return held


def test_pieces_and_places(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id LONG, text STRING").withColumn("length", F.lit("clash"))
    rows = packing.pack_documents(frame, *packing.default_tokenizer()).collect()
    held = check(rows, dict(enumerate(TEXTS)))
    assert len(held) == -(-sum(r.length for r in rows) // 2048)


def test_fast_and_full_encoders_agree():
    from tallyline.llm.tokens import Encoder

    path, ranks = packing.default_tokenizer()
    fast, full = Encoder(path, ranks), Encoder(path)
    odd = ["it's  \t\n\r\n x", "don’t — “quoted” … €5", "ß Ä ñ ó ç œ ſ", "\x0b\x0c\x85 ", "1234567 89,0", "  ", "​zero"]
    for text in [t or "" for t in TEXTS] + odd:
        assert fast.ids(text) == full.ids(text), text


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.sort(np.random.default_rng(1).integers(1, 900, 3000))[::-1]
    limits = packing.Capacity(tokens=1000, documents=4, attention=600_000, weights=(1, 0.5, 0.5), rule=rule)
    fits = lengths[lengths**2 <= 600_000]
    bins, offsets = packing.best_fit(fits, limits)
    for b in np.unique(bins):
        own = fits[bins == b]
        assert own.sum() <= 1000 and len(own) <= 4 and (own**2).sum() <= 600_000
        assert sorted(offsets[bins == b]) == sorted(np.cumsum(own) - own)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([999]), limits)


def test_odd_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id LONG, text STRING")
    rows = packing.pack_documents(frame, *packing.default_tokenizer()).collect()
    assert len(rows) == 3 and len({r.offset for r in rows}) == 3
    assert packing.pack_documents(frame.limit(0), *packing.default_tokenizer()).count() == 0
