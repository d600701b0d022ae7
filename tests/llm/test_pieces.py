import math
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from tallyline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "x", " ", "a  b\n c\td ", " " * 40, "é€\U0001f600▁z 日本 \x00", "a" * 3000, "the " * 2000, "Hello world; it's 2024!\r\n", "﻿x"]


def test_decoding_is_lossless(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, ODD[3]), (90, None)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING").withColumn("ids", F.lit("clash"))
    got = pieces.sample_pieces(frame, PATH)
    assert all(r.lossless for r in got.collect())
    back = {r.doc_id: r.text for r in pieces.decode_pieces(got, PATH).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert pieces.sample_pieces(frame.limit(0), PATH).count() == 0


def test_rows_get_the_same_ids_however_they_are_partitioned(spark):
    frame = spark.createDataFrame([(i, "some words of a text " * (i % 7)) for i in range(60)], "doc_id LONG, text STRING")
    runs = [
        {r.doc_id: list(r.ids) for r in pieces.sample_pieces(frame.repartition(n), PATH, seed=s).collect()}
        for n, s in ((1, 0), (7, 0), (7, 1))
    ]
    assert runs[0] == runs[1] != runs[2]


def test_samples_follow_the_weights():
    import sentencepiece

    alpha, word = 1e-3, "hello"
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not model.is_byte(i) and not model.is_control(i)}

    def all_of(text):
        if not text:
            yield ()
        for k in range(1, len(text) + 1):
            if text[:k] in ids:
                for rest in all_of(text[k:]):
                    yield (ids[text[:k]], *rest)

    odds = {s: math.exp(sum(alpha * model.get_score(i) for i in s)) for s in all_of("▁" + word)}
    total, n = sum(odds.values()), 20_000
    seen = Counter(tuple(x.tolist()) for x in pieces.Lattice(PATH, alpha).encode([word] * n, np.arange(n).astype(np.uint64)))
    assert set(seen) <= set(odds)
    for s, w in odds.items():
        assert abs(seen[s] / n - w / total) < 0.02


def test_long_segments_use_the_same_weights():
    of = pieces.Lattice(PATH, 1e-4)
    texts, keys = ["internationalisation of everything"] * 300, np.arange(300).astype(np.uint64)
    plain = [x.tolist() for x in of.encode(texts, keys)]
    of.long = 2
    assert [x.tolist() for x in of.encode(texts, keys)] == plain


def test_no_weight_is_cut():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    least = min(model.get_score(i) for i in range(model.get_piece_size()))
    for alpha in (1e-3, 0.05, 1.0):
        of = pieces.Lattice(PATH, alpha)
        assert of.logs.min() == alpha * least and of.long * -of.logs.min() <= 600
    # With such weights only the best segmentations are ever drawn.
    got = {tuple(x.tolist()) for x in of.encode(["hello there"] * 50, np.arange(50).astype(np.uint64))}
    totals = [sum(model.get_score(i) for i in ids) for ids in got]
    assert max(totals) - min(totals) < 40 and {of.decode(np.array(ids)) for ids in got} == {"hello there"}
