import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import toxicity as tox
from tallyline.session import stored
from tests.llm.brute import near_duplicates, repeats
from tests.llm.test_packing import check

FOLDER = "/root/testdata/sf0.001"
BASE = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # Names that the stages use themselves, and a row that is there twice.
    docs = docs.withColumns({c: F.lit("own") for c in ("score", "kept", "spans", "row", "predicted", "key")})
    out = [stored(docs, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert df.where("score <> 'own' or kept <> 'own' or row <> 'own'").count() == 0


def test_toxic_documents_go(spark, stages):
    own = stages[0].select("doc_id", "text")
    scored = tox.toxicity(own, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    want = {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert set(texts(stages[1])) == want and len(want) < stages[0].count()


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    of = near_duplicates(list(before.items()))
    assert set(texts(stages[2])) == {i for i, (_, c) in of.items() if c == i}


def test_repeats_are_cut(stages):
    before = sorted(texts(stages[2]).items())
    after = texts(stages[3])
    for (i, text), (_, gone, _, kept) in zip(before, repeats([t for _, t in before], corpus_pipeline.REPEATED), strict=True):
        assert after[i] == (text if not gone else kept.decode("utf-8", "ignore"))


def test_passages_of_over_fifty_words_are_cut(spark):
    words = [f"word{k % 97}{'abcde'[k % 5]}" for k in range(400)]
    passage = " ".join(words[200:251])
    rows = [(k, f"own start {k} {' '.join(words[40 * k : 40 * k + 30])} {passage} own end {k}", "en", "s", 0) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    after = texts(corpus_pipeline.repeats(spark, docs, FOLDER))
    for k, text, *_ in rows:
        assert passage not in after[k] and len(after[k]) < len(text) - 200 and after[k].startswith(f"own start {k}") and after[k].endswith(str(k))


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    assert not any('oken = "' in (t or "") and 'oken = "[' not in t for t in after.values())
    for i in before:
        assert before[i] == after[i] or "[SECRET]" in after[i]


def test_all_that_is_left_is_packed(stages):
    check(stages[5].collect(), texts(stages[4]))


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 3000, None, None, 15000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stored(stage(spark, frame, FOLDER), "odd")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), "odd")
        assert docs.columns == BASE and docs.count() == 4
