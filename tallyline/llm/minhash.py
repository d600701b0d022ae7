"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.graph import connected_components
from tallyline.llm.texts import mix, shingle_sets, small_batches
from tallyline.session import stored

#: 32 bands of 4 minima: a pair of similarity 0.75 shares no band with probability 5e-6.
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Low bits kept of each minimum. Bit planes of 64 minima make a long: 4 planes x 2 longs.
BITS = 4
PLANES = BITS * MINIMA // 64
#: A pair goes on to the exact test if its estimate is at most this much below the threshold:
#: five standard deviations of the estimate for 128 minima.
SLACK = 0.2

_random = np.random.default_rng(4)
_FACTOR = _random.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _random.integers(0, 1 << 32, MINIMA, dtype=np.uint32)
_BAND = _random.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURE = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of ``MINIMA`` hash functions over a set of 64-bit hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(x), 512):
        np.minimum(least, (x[lo : lo + 512, None] * _FACTOR + _ADD).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, made of the whole minima and the number of the band."""
    keys = (least.astype(np.uint64) * _BAND).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed plane by plane."""
    bits = (least[None, :] >> np.arange(BITS, dtype=np.uint32)[:, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=1).view(np.int64).reshape(-1)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digest, bands, planes = [], [], [], []
        for found in shingle_sets(batch.column(1)):
            n.append(len(found))
            if len(found):
                least = minima(found)
                digest.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                bands.append(band_keys(least))
                planes.append(sketch(least))
            else:
                digest.append(None)
                bands.append(None)
                planes.append(None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array(digest, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(planes, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "bands", "sketch"],
        )


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, digest of the set, band keys and b-bit sketch of every document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_signatures, SIGNATURE)


def estimate(a: str, b: str) -> Column:
    """Estimated similarity of two sketches; equal low bits by chance are taken out."""
    odd = None
    for word in range(MINIMA // 64):
        differ = None
        for plane in range(BITS):
            at = plane * (MINIMA // 64) + word
            one = F.col(a)[at].bitwiseXOR(F.col(b)[at])
            differ = one if differ is None else differ.bitwiseOR(one)
        odd = F.bit_count(differ) if odd is None else odd + F.bit_count(differ)
    chance = 2.0**-BITS
    return (1 - odd / F.lit(float(MINIMA)) - chance) / (1 - chance)


def _linked(percent: int):
    """Rows whose two texts have sets with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a``, ``b``, those that are linked: sketch and size first, then the full sets."""
    x = nodes.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    y = nodes.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    near = (
        pairs.join(x, "a").join(y, "b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .where(estimate("sa", "sb") >= percent / 100 - SLACK)
        .select("a", "b").distinct()
    )
    near = stored(near, "near-pairs")
    rows = near.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"
    )
    return stored(rows.select("a", "b", "ta", "tb").mapInArrow(_linked(percent), "a long, b long"), "links")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, found in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)), strict=True):
            ids = pa.array(np.full(len(found), doc_id), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.view(np.int64))], ["doc_id", "shingle"])


def _held(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The shingles that more than one document of the table has, and how many each document has alone.

    ``doc_id``, ``shingle``, ``held`` (number of documents that have it); ``doc_id``, ``alone``.
    """
    rows = stored(texts.mapInArrow(_exploded, "doc_id long, shingle long"), "shingles")
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min("doc_id").alias("doc_id"))
    counts = stored(counts, "held")
    alone = counts.where("held = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone"))
    return rows.join(counts.where("held > 1").select("shingle", "held"), "shingle"), alone


def _rare_pairs(held: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can reach the threshold, found by their rarest shingles.

    Of two linked sets, the smaller one has all but a ``1 - 2p/(100+p)`` part in common with the other,
    the larger all but a ``1 - p/100`` part. So, with the shingles ordered by rarity, the first that
    they share is among the first so many of each; those that a document has alone come before all.
    """
    n = F.col("n_shingles")
    order = Window.partitionBy("doc_id").orderBy("held", "shingle")
    rows = held.join(nodes, "doc_id")
    rows = rows.withColumn("at", F.row_number().over(order) + F.col("alone"))
    rows = rows.where(F.col("at") <= n - F.ceil(n * percent / 100) + 1)
    few = rows.where(F.col("at") <= n - F.ceil(n * 2 * percent / (100 + percent)) + 1)
    cols = ("doc_id", "c", "n_shingles", "sketch", "shared", "at")
    x = few.select("shingle", *(F.col(c).alias(f"{c}_x") for c in cols))
    y = rows.select("shingle", *(F.col(c).alias(f"{c}_y") for c in cols))
    both = percent * (F.col("n_shingles_x") + F.col("n_shingles_y"))
    # Nothing rarer is in common, so no more than what follows can be.
    rest = F.least(F.col("n_shingles_x") - F.col("at_x"), F.col("n_shingles_y") - F.col("at_y")) + 1
    size_x, size_y = F.struct("n_shingles_x", "doc_id_x"), F.struct("n_shingles_y", "doc_id_y")
    pairs = x.join(
        y,
        (x["shingle"] == y["shingle"]) & (size_x < size_y) & (F.col("c_x") != F.col("c_y"))
        & ((100 + percent) * F.least("shared_x", "shared_y", rest) >= both)
        & (100 * F.col("n_shingles_x") >= percent * F.col("n_shingles_y"))
        & (estimate("sketch_x", "sketch_y") >= percent / 100 - SLACK),
    )
    return pairs.select(F.least("doc_id_x", "doc_id_y").alias("a"), F.greatest("doc_id_x", "doc_id_y").alias("b"))


def _with_components(buckets: DataFrame, component: DataFrame) -> DataFrame:
    """Buckets that still hold more than one component, with the component of each member."""
    rows = buckets.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    rows = rows.withColumn("c", F.coalesce("component_id", "doc_id")).select("key", "doc_id", "c")
    split = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
    return rows.join(split.select("key"), "key")


def _joined(component: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links.

    Only components are linked here, whatever their size; the nodes that have none stand for themselves.
    """
    for end in ("a", "b"):
        of_end = component.select(F.col("id").alias(end), F.col("component_id").alias("c"))
        links = links.join(of_end, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    joined = connected_components(stored(links.select("a", "b").distinct(), "component-links"))
    root = joined.select(F.col("id").alias("component_id"), F.col("component_id").alias("root"))
    members = component.join(root, "component_id", "left").select("id", F.coalesce("root", "component_id").alias("component_id"))
    return stored(members.union(joined.join(component, "id", "left_anti").select("id", "component_id")), "components")


def _further(
    apart: DataFrame, component: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, links_of: Callable
) -> DataFrame:
    """The components with the links between members of the same bucket that the least member does not show."""
    # A pair has no more shingles in common than either has with all the others that are left.
    held, alone = _held(texts.join(apart.select("doc_id").distinct(), "doc_id", "left_semi"))
    nodes = nodes.join(alone, "doc_id", "left").fillna(0, ["alone"])
    nodes = nodes.select("doc_id", "n_shingles", "sketch", "alone", (F.col("n_shingles") - F.col("alone")).alias("shared"))
    nodes = stored(nodes, "nodes")
    rows = apart.join(nodes.select("doc_id", (F.col("alone") / F.col("n_shingles")).alias("own")), "doc_id")
    centre = rows.groupBy("key").agg(F.min_by(F.struct("doc_id", "c"), F.struct("own", "doc_id")).alias("o"))
    centre = stored(centre, "centres")
    pairs = apart.join(centre, "key").where("c != o.c")
    component = _joined(
        component, links_of(pairs.select(F.least("o.doc_id", "doc_id").alias("a"), F.greatest("o.doc_id", "doc_id").alias("b")))
    )
    left = stored(_with_components(apart.select("key", "doc_id"), component).select("doc_id", "c").distinct(), "left")
    if left.isEmpty():
        return component
    return _joined(component, links_of(_rare_pairs(held, nodes.join(left, "doc_id"), percent)))


def minhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked if their sets of five-word shingles have at least ``percent`` per cent in
    common (intersection to union). Candidates share a band of minima; the b-bit sketches and the
    set sizes rule out most of those that are not near; the rest are confirmed on the full sets
    (as 64-bit hashes). Equal sets are one node from the start, so copies never meet as pairs.

    Within a bucket no list of all pairs is made. First every member is held against the least
    one. Where that leaves more than one component, members are held against the one that has
    the smallest share of shingles of its own. What is then still apart is joined on its rarest
    shingles, which every linked pair must share, between components only. So the result is that
    of all candidate pairs.

    Null or empty texts, and texts without words, have no shingles and are linked with nothing.
    Rows with the same ``doc_id`` count as one document. A row with a null id is returned unlinked,
    with a null component, and kept. Only the two columns named are read; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    signed = stored(signatures(docs, id_col, text_col), "signatures")
    named = signed.where("n_shingles > 0 and doc_id is not null")
    # Rows with the same digest have the same signature, so the least document needs no join to have it.
    same = (F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch"))
    classes = stored(named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *same), "classes")
    nodes = classes
    keys = nodes.select("doc_id", F.explode("bands").alias("key"))
    full = keys.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # As a table, so that the join can be split where a bucket holds very many documents.
    full = stored(full.select("key", "first"), "full-buckets")
    # Only members of buckets with company, each with the least member.
    buckets = stored(keys.join(full, "key"), "buckets")
    nodes = stored(nodes.join(buckets.select("doc_id").distinct(), "doc_id", "left_semi"), "nodes")
    near = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = stored(near.join(nodes.select("doc_id").distinct(), "doc_id", "left_semi"), "texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        return _confirmed(pairs.where("a != b").distinct(), nodes, texts, percent)

    links = confirm(buckets.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))

    component = connected_components(links)
    apart = stored(_with_components(buckets, component), "apart")
    if not apart.isEmpty():
        component = _further(apart, component, nodes, texts, percent, confirm)
    component = component.withColumnRenamed("id", "node")
    of_class = classes.select("digest", F.col("doc_id").alias("node")).join(component, "node", "left").select(
        "digest", F.coalesce("component_id", "node").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "digest").join(of_class, "digest", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component_id.alias("component_id"),
        F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``."""
    return minhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
