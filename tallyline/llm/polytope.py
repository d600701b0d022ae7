"""Near-duplicate vectors by cross-polytope hashing."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.graph import connected_components
from tallyline.llm.texts import mix, small_batches
from tallyline.session import stored

#: Part of the pairs at the very threshold that may share no bucket.
MISS = 1e-6
MOST_TABLES = 128
#: Members of a bucket that are held against each other in one task; larger buckets are cut into blocks.
BLOCK = 2048
#: Members of buckets that one task reads, and pairs that it compares at once.
ROWS_PER_TASK = 20_000
PAIRS = 1 << 15
#: Larger buckets are compared by products of matrices.
SMALL = 64
ROTATIONS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row, in place; the width is a power of two."""
    n, width = x.shape
    size = 1
    while size < width:
        y = x.reshape(n, width // (2 * size), 2, size)
        a, b = y[:, :, 0, :] + y[:, :, 1, :], y[:, :, 0, :] - y[:, :, 1, :]
        y[:, :, 0, :], y[:, :, 1, :] = a, b
        size *= 2
    return x


class Polytope:
    """``tables`` hash tables of ``hashes`` cross-polytope hashes each, for vectors of ``dims`` components."""

    def __init__(self, dims: int, hashes: int, tables: int):
        self.dims, self.hashes, self.tables = dims, hashes, tables
        self.width = 1 << max(1, (dims - 1).bit_length())
        random = np.random.default_rng(3)
        self.signs = random.choice(np.array([-1.0, 1.0]), (tables, hashes, ROTATIONS, self.width))

    def vertices(self, unit: np.ndarray, table: int, hash_: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest and second nearest vertex of each rotated vector, and by how much the second is behind."""
        x = np.zeros((len(unit), self.width))
        x[:, : self.dims] = unit
        for signs in self.signs[table, hash_]:
            x = hadamard(x * signs)
            x /= math.sqrt(self.width)
        size = np.abs(x)
        row = np.arange(len(x))
        first = size.argmax(axis=1)
        top = size[row, first]
        size[row, first] = -1.0
        second = size.argmax(axis=1)
        both = np.stack([first, second], axis=1)
        return 2 * both + (np.take_along_axis(x, both, axis=1) < 0), top - size[row, second]

    def table_keys(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Keys of the buckets of each vector in one table: vectors x (1 + hashes).

        Besides the bucket of all nearest vertices, one for each hash that takes its second nearest
        vertex instead.
        """
        out = np.empty((len(unit), 1 + self.hashes), np.int64)
        near = np.stack([self.vertices(unit, table, h)[0] for h in range(self.hashes)], axis=1)
        for probe in range(1 + self.hashes):
            key = np.full(len(unit), np.uint64(table + (self.dims << 16)))
            for h in range(self.hashes):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + near[:, h, int(probe == h + 1)].astype(np.uint64))
            out[:, probe] = key.view(np.int64)
        return out

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Keys of the buckets of each vector: vectors x tables x (1 + hashes)."""
        return np.stack([self.table_keys(unit, t) for t in range(self.tables)], axis=1)


def shape_for(dims: int, rows: int, cosine: float, miss: float = MISS) -> Polytope:
    """Hashes by the number of rows, and tables by how often pairs at the threshold meet in one.

    The rate is taken from 4000 random pairs at that very cosine. Where it asks for more than
    ``MOST_TABLES`` tables, fewer hashes are taken, so that pairs meet more often; with one hash there
    are as many tables as it asks for.
    """
    width = 1 << max(1, (dims - 1).bit_length())
    hashes = max(1, math.ceil(math.log(max(4 * rows, 2)) / math.log(2 * width)))
    random = np.random.default_rng(1)
    x = random.normal(size=(4000, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = random.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    y = cosine * x + math.sqrt(1 - cosine**2) * y
    while True:
        trial = Polytope(dims, hashes, 4)
        meet = (trial.keys(x)[:, :, :, None] == trial.keys(y)[:, :, None, :]).any(axis=(2, 3)).mean()
        tables = math.ceil(math.log(miss) / math.log(max(1 - meet, 1e-9))) if meet > 0 else math.inf
        if hashes == 1 or tables <= MOST_TABLES:
            break
        hashes -= 1
    if tables == math.inf:
        raise ValueError(f"pairs at cosine {cosine} do not meet in {dims} dimensions, so no number of tables finds them")
    return Polytope(dims, hashes, max(4, tables))


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x, x / np.linalg.norm(x, axis=1, keepdims=True)


def _bucketed(shape: Polytope) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = shape.keys(_vectors(batch.column(1))[1]).reshape(batch.num_rows, -1)
                rows = np.repeat(np.arange(len(keys)), keys.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(keys.reshape(-1))], ["node", "key"])

    return run


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least number that each of ``n`` nodes is linked with, over the links ``i``-``j``."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label


def _pairs_of(sizes: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each group, some at a time; groups by place of their first row and size."""
    for size in np.unique(sizes[sizes > 1]).tolist():
        i, j = np.triu_indices(size, 1)
        of_size = begin[sizes == size]
        step = max(1, PAIRS // len(i))
        for lo in range(0, len(of_size), step):
            at = of_size[lo : lo + step, None]
            for part in range(0, len(i), PAIRS):
                yield (at + i[part : part + PAIRS]).reshape(-1), (at + j[part : part + PAIRS]).reshape(-1)


def _near_in_large(
    unit: np.ndarray, sizes: np.ndarray, begin: np.ndarray, cosine: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within large groups that a product of matrices shows to be near; a little too many of them."""
    for at, size in zip(begin[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = unit[at : at + size]
        for lo in range(0, size, SMALL):
            p, q = np.nonzero(own[lo : lo + SMALL] @ own[lo:].T >= cosine - 1e-9)
            keep = p < q
            yield p[keep] + at + lo, q[keep] + at + lo


def _linked(shape: Polytope, cosine: float) -> Callable:
    """Per member of a task's buckets: how many vectors it is linked with that it meets here first, and
    one that it is joined with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by([(c, "ascending") for c in ("key", "a", "b", "node")]).combine_chunks()
        key, a, b, node, weight, first = (table.column(c).to_numpy() for c in ("key", "a", "b", "node", "weight", "first"))
        x, unit = _vectors(table.column("v").chunk(0))
        norm = np.sqrt((x * x).sum(axis=1))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(key)))
        left, right = [], []
        for p, q in chain(_pairs_of(np.where(sizes > SMALL, 0, sizes), begin), _near_in_large(unit, sizes, begin, cosine)):
            # Two blocks of one bucket: pairs within a block are for its own task.
            keep = (a[p] == b[p]) | (first[p] != first[q])
            p, q = p[keep], q[keep]
            near = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= cosine
            left.append(p[near])
            right.append(q[near])
        i, j = (np.concatenate([*z, np.zeros(0, np.int64)]).astype(np.int64) for z in (left, right))
        names, at = np.unique(node, return_inverse=True)
        if len(i):
            own = key[i]
            mine = np.ones(len(i), bool)
            open_ = np.arange(len(i))
            vector = np.unique(at, return_index=True)[1]
            # Near pairs meet early, so few vectors are hashed for the later tables.
            for t in range(shape.tables):
                used, place = np.unique(at[np.concatenate([i[open_], j[open_]])], return_inverse=True)
                keys = shape.table_keys(unit[vector[used]], t)
                p, q = keys[place[: len(open_)]], keys[place[len(open_) :]]
                shared = p[:, :, None] == q[:, None, :]
                meets = shared.any(axis=(1, 2))
                # The bucket a pair belongs to: in the first table where it meets, the least key.
                least = np.where(shared.any(axis=2), p, np.iinfo(np.int64).max).min(axis=1)
                mine[open_[meets & (least != own[open_])]] = False
                open_ = open_[~meets]
                if not len(open_):
                    break
            i, j = i[mine], j[mine]
        count = np.bincount(at[i], weight[j], len(names)) + np.bincount(at[j], weight[i], len(names))
        label = _labels(len(names), at[i], at[j])
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[has]), pa.array(count[has].astype(np.int64)), pa.array(names[label[has]])], ["node", "n", "other"]
        )

    return run


def vector_components(
    vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their cosine, in double precision, is at least ``cosine``. Candidates
    share a bucket of a cross-polytope hash table; each is checked. ``n_links``: other rows linked
    directly; ``component_id``: the least id reachable. Equal vectors are one node with a weight, so
    copies never meet as pairs. A pair that shares several buckets counts in the first only.

    Null or empty vectors, zero vectors and those with null or non-finite components are linked with
    nothing, as are vectors of different lengths with each other. A null id gives a null component
    and is kept; it counts as a link of others. Rows repeated with the same id and vector count one by
    one. Buckets with more than ``block`` members are cut into blocks that meet two by two.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2000)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    some = F.exists(vector_col, lambda x: x != 0)
    # Zeros of either sign are the same component.
    same = F.transform(vector_col, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(F.col(vector_col).isNotNull() & finite & some, same).alias("v"),
    )
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    rows = stored(rows, "vectors")
    nodes = rows.where("v is not null").groupBy("h", "v").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("v")), "nodes")
    sizes = nodes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # one row for each vector length
    found = None
    for row in sorted(sizes, key=lambda r: r["size"]):
        shape = shape_for(row["size"], row["n"], cosine)
        own = nodes.where(F.col("size") == row["size"])
        keys = stored(own.select("node", "v").mapInArrow(_bucketed(shape), "node long, key long").distinct(), "buckets")
        # As a table, so that the join can be split where a bucket holds very many vectors.
        full = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "full-buckets")
        blocks = F.ceil(F.col("n") / block).cast("int")
        dealt = keys.join(full, "key").withColumn("blocks", blocks)
        dealt = dealt.withColumn("first", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("second", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("key", "node", "first", F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b"))
        dealt = stored(dealt, "members")
        members = dealt.join(own.select("node", "weight", "v"), "node")
        tasks = max(1, -(-dealt.count() // ROWS_PER_TASK))
        part = members.repartition(tasks, "key", "a", "b").mapInArrow(_linked(shape, cosine), "node long, n long, other long")
        part = stored(part, "links")
        found = part if found is None else found.union(part)
    out = rows.select("vec_id", "h", "v")
    if found is None:
        counted = out.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))
    else:
        component = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
        links = found.groupBy("node").agg(F.sum("n").alias("n"))
        known = nodes.join(links, "node", "left").join(component.withColumnRenamed("id", "node"), "node", "left")
        known = known.withColumn("root", F.coalesce("component_id", "node"))
        least = known.groupBy("root").agg(F.min("least").alias("least_id"))
        known = stored(known.join(least, "root").select("h", "v", "weight", F.coalesce("n", F.lit(0)).alias("n"), "least_id"), "known")
        counted = out.join(known, ["h", "v"], "left").select(
            "vec_id", F.coalesce(F.col("n") + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("least_id", "vec_id")).alias("component_id"),
        )
    return counted.select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def op3_polytope_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``embeddings``."""
    return vector_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
