"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.texts import NO_LETTER, lower_hashes, mix, small_batches, span_hash, text_blocks, word_spans
from tallyline.session import stored

#: Features are hashed into 2^18 places.
FEATURE_BITS = 18
#: Besides each whole word, its beginnings of so many bytes are features.
PREFIXES = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit.

    ``positives`` and ``unlabelled`` bound the documents that a model is fitted on; they are those
    with the least hash of the id. ``least_share`` and ``least_documents``: a feature must occur in
    so many of the positives. ``least_ratio``: logarithm of the share among the positives over the
    share among the unlabelled.
    """

    positives: int = 2500
    unlabelled: int = 6000
    least_share: float = 0.005
    least_documents: int = 3
    least_ratio: float = 1.0
    steps: int = 600
    batch: int = 128
    rate: float = 0.05
    first_weight: float = 0.1
    longest: float = 10.0
    seed: int = 10


@dataclass(frozen=True)
class Model:
    """Weight of each feature place, and the bias. ``weights`` is None where nothing could be learnt."""

    weights: np.ndarray | None
    bias: float = 0.0


def held_out(doc_id: Column | str) -> Column:
    """True for the ids that no label may be learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % 4 == 2


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block: places of the features, a row for each word, and the bounds of the texts in words."""
    shift = np.uint64(64 - FEATURE_BITS)
    for _, data, bounds in text_blocks(column):
        start, end, at = word_spans(data, bounds, NO_LETTER)
        sums = lower_hashes(data)
        places = np.empty((len(start), 1 + len(PREFIXES)), np.int64)
        places[:, 0] = mix(span_hash(sums, start, end)) >> shift
        for j, size in enumerate(PREFIXES, start=1):
            # A shorter word counts as its own beginning.
            begun = span_hash(sums, start, np.minimum(start + size, end))
            places[:, j] = mix(begun + np.uint64(size)) >> shift
        yield places, at


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: id, class, number of words, feature places and how often each occurs."""
    for batch in batches:
        words, places, times = [], [], []
        for found, at in _features(batch.column(2)):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                place, n = np.unique(found[lo:hi], return_counts=True)
                words.append(hi - lo)
                places.append(place.astype(np.int32))
                times.append(n.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(words, pa.int64()),
                pa.array(places, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32())),
            ],
            ["doc_id", "positive", "words", "places", "times"],
        )


def _least(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the least hash of the id."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def nnpu(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, positive: np.ndarray, n_cols: int, prior: float, fit: Fit
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by the non-negative risk estimator with logistic loss.

    ``rows``, ``cols``, ``values``: the non-zero features in row order; ``positive``: per row, True for a
    confirmed positive, False for unlabelled. The risk is
    ``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])``; where the second part of a batch falls
    below zero, the step goes against its gradient instead. The gradient of a row is cut to that of a
    row of length ``fit.longest``, so that no single odd text moves the weights far.
    """
    random = np.random.default_rng(fit.seed)
    ends = np.searchsorted(rows, np.arange(len(positive) + 1))
    length = np.sqrt(np.bincount(rows, values**2, len(positive)))
    cut = np.minimum(1.0, fit.longest / np.maximum(length, 1e-12))
    weights, bias = np.full(n_cols, fit.first_weight), 0.0
    seen, seen_bias = np.full(n_cols, 1e-8), 1e-8
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    parts_each = max(1, len(u) // fit.batch)
    for _ in range(-(-fit.steps // parts_each)):
        parts = zip(np.array_split(random.permutation(p), parts_each), np.array_split(random.permutation(u), parts_each), strict=True)
        for own_p, own_u in parts:
            if not len(own_p) or not len(own_u):
                continue
            picked = np.concatenate([own_p, own_u])
            sizes = ends[picked + 1] - ends[picked]
            which = np.repeat(np.arange(len(picked)), sizes)
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(ends[picked], sizes)
            z = np.bincount(which, weights[cols[at]] * values[at], len(picked)) + bias
            prob = 1 / (1 + np.exp(-z))
            is_p = np.arange(len(picked)) < len(own_p)
            negative = np.logaddexp(0, z[~is_p]).mean() - prior * np.logaddexp(0, z[is_p]).mean()
            if negative >= 0:
                slope = np.where(is_p, prior * (prob - 1 - prob) / len(own_p), prob / len(own_u))
            else:
                slope = np.where(is_p, prior * prob / len(own_p), -prob / len(own_u))
            slope *= cut[picked]
            step = np.bincount(cols[at], slope[which] * values[at], n_cols)
            seen += step**2
            weights -= fit.rate * step / np.sqrt(seen)
            seen_bias += slope.sum() ** 2
            bias -= fit.rate * slope.sum() / math.sqrt(seen_bias)
    return weights, bias


def fit_toxicity(docs: DataFrame, labels: DataFrame, fit: Fit | None = None, learn: Column | None = None) -> Model:
    """A model from the texts of ``docs`` and the confirmed toxic ones in ``labels``.

    Confirmed: ``toxic`` is 1 and ``learn`` holds (by default, all ids that are not held out). All
    documents count as unlabelled text. The class prior is the share of toxic rows among the
    labelled ones that may be learnt from. Features are picked by their shares in both classes,
    which Spark counts; only the picked ones of the bounded sample reach the driver.
    """
    fit = fit or Fit()
    small_batches(docs.sparkSession)
    learn = ~held_out("doc_id") if learn is None else learn
    own = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id is not null")
    ids = texts.select("doc_id")
    prior = own.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Model(None)
    confirmed = _least(own.where("toxic = 1").join(ids.distinct(), "doc_id", "left_semi").select("doc_id"), fit.positives)
    sample = confirmed.withColumn("positive", F.lit(True)).unionByName(
        _least(ids, fit.unlabelled).withColumn("positive", F.lit(False))
    )
    sample = stored(sample.coalesce(1), "sample")
    # At most positives + unlabelled rows of an id and a flag.
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "positive", "text")
    counted = stored(
        rows.mapInArrow(
            _counted, "doc_id long, positive boolean, words long, places array<int>, times array<int>"
        ),
        "features",
    )
    n = {r["positive"]: r["n"] for r in counted.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_p, n_u = n.get(True, 0), n.get(False, 0)
    if not n_p or not n_u:
        return Model(None)
    shares = counted.select("positive", F.explode("places").alias("place")).groupBy("place").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")
    )
    ratio = F.log((F.col("p") + 1) / F.lit(n_p + 2.0)) - F.log((F.col("u") + 1) / F.lit(n_u + 2.0))
    least = max(fit.least_documents, math.ceil(fit.least_share * n_p))
    picked = shares.where(F.col("p") >= least).select("place", ratio.alias("ratio")).where(F.col("ratio") >= fit.least_ratio)
    picked = picked.orderBy("place").toPandas()  # at most 2^FEATURE_BITS rows
    if not len(picked):
        return Model(None)
    chosen = F.broadcast(docs.sparkSession.createDataFrame(picked[["place"]].astype({"place": "int32"}), "place int"))
    hits = counted.select("doc_id", "positive", "words", F.explode(F.arrays_zip("places", "times")).alias("x"))
    hits = hits.select("doc_id", "positive", "words", F.col("x.places").alias("place"), F.col("x.times").alias("times"))
    hits = hits.join(chosen, "place").groupBy("doc_id", "positive").agg(
        F.max("words").alias("words"), F.sort_array(F.collect_list(F.struct("place", "times"))).alias("x")
    )
    kept = counted.select("doc_id", "positive").distinct().join(hits, ["doc_id", "positive"], "left")
    found = kept.select("doc_id", "positive", "words", F.col("x.place").alias("places"), F.col("x.times").alias("times"))
    sampled = sorted(found.collect(), key=lambda r: (r["positive"], r["doc_id"]))  # bounded by the sample
    of_place = picked["place"].to_numpy()
    ratios = picked["ratio"].to_numpy()
    cols = [np.searchsorted(of_place, r["places"] or []).astype(np.int64) for r in sampled]
    sizes = np.array([len(c) for c in cols])
    cols = np.concatenate(cols)
    times = np.concatenate([np.array(r["times"] or [], float) / math.sqrt(r["words"] or 1) for r in sampled])
    weights, bias = nnpu(
        np.repeat(np.arange(len(sampled)), sizes), cols, times * ratios[cols],
        np.array([r["positive"] for r in sampled]), len(of_place), prior, fit,
    )
    table = np.zeros(1 << FEATURE_BITS)
    table[of_place] = weights * ratios
    return Model(table, bias)


def _scored(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            if model.weights is None:
                scores.append(np.zeros(batch.num_rows))
            else:
                for places, at in _features(batch.column(1)):
                    sums = np.concatenate([[0.0], np.cumsum(model.weights[places].sum(axis=1))])
                    z = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(np.maximum(at[1:] - at[:-1], 1)) + model.bias
                    scores.append(1 / (1 + np.exp(-z)))
            columns = [*batch.columns, pa.array(np.concatenate(scores), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score"])

    return run


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """Per document: ``row`` (its columns but the text), ``text``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on).

    Only the words of the whole text count. Null, empty and wordless texts get the score of the bias
    alone; a model without weights scores all as 0. Null and repeated ids are scored row by row. The
    columns of a document are kept apart in ``row``, so none can clash with the results.
    """
    small_batches(docs.sparkSession)
    others = F.struct(*(c for c in docs.columns if c != "text")).alias("row")
    rows = docs.select(others, F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scored(model), T.StructType([*rows.schema, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit: Fit | None = None) -> DataFrame:
    """Fit on ``docs`` and ``labels`` and score all of ``docs``, with ``held_out`` per document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_toxicity(own, fit_toxicity(own, labels, fit), threshold).select("row.doc_id", "score", "predicted")
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
