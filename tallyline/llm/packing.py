"""Packing of token sequences by vector best fit."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.texts import small_batches
from tallyline.llm.tokens import encoder
from tallyline.session import stored

#: Id put behind each document.
END = 0
#: Pieces that one task packs. A task leaves about one sequence that is not full.
PIECES_PER_TASK = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold, and what counts in the choice of one.

    ``tokens``; ``documents``: number of pieces; ``attention``: sum of the squared piece lengths.
    None means as much as the tokens allow. ``weights`` go with the three residuals, each as a
    share of its capacity. ``rule``: ``norm`` takes the sequence that the piece leaves with the
    least weighted residual norm, ``dot`` the one with the greatest weighted product of its
    residual and the piece.
    """

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        attention = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, documents, attention], np.int64)


def _piece_bounds(total: int, most: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: whole ones of ``most`` ids, a shorter one first."""
    first = total % most or most
    return [(0, first)] + [(at, most) for at in range(first, total, most)]


def _pieces(path: str, ranks_path: str | None, most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks_path).ids
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END], "<u4")
                for at, (start, length) in enumerate(_piece_bounds(len(ids), most)):
                    rows.append((doc_id, at, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(
    docs: DataFrame, path: str, ranks_path: str | None = None, most: int = 2048,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``most`` ids of all documents: their place in the document and a checksum.

    A document is the ids of its whole text (null: empty) and ``END``. Only longer documents are
    cut; all their pieces but the first are full.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(_pieces(path, ranks_path, most), PIECES)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Number of the sequence and offset there of each piece; the pieces are taken in the given order."""
    limits = capacity.limits()
    scale = np.array(capacity.weights) / limits.astype(float) ** 2
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    residual = np.empty((3, 1024), np.int64)
    names = np.empty(1024, np.int64)
    used, opened = 0, 0
    need = np.empty((3, 1), np.int64)
    for i, length in enumerate(lengths.tolist()):
        need[:, 0] = length, 1, length * length
        if (need[:, 0] > limits).any():
            raise ValueError(f"a piece of {length} tokens does not fit into an empty sequence")
        at = -1
        if used:
            fits = np.flatnonzero((residual[:, :used] >= need).all(axis=0))
            if len(fits):
                left = residual[:, fits]
                if capacity.rule == "norm":
                    at = fits[(scale @ ((left - need) ** 2)).argmin()]
                else:
                    at = fits[(scale @ (left * need)).argmax()]
        if at < 0:
            if used == residual.shape[1]:
                residual = np.concatenate([residual, np.empty_like(residual)], axis=1)
                names = np.concatenate([names, np.empty_like(names)])
            at, used = used, used + 1
            residual[:, at] = limits
            names[at] = opened
            opened += 1
        bins[i] = names[at]
        offsets[i] = limits[0] - residual[0, at]
        residual[:, at] -= need[:, 0]
        if not residual[:2, at].all():  # full: the last open one takes its place
            used -= 1
            residual[:, at], names[at] = residual[:, used], names[used]
    return bins, offsets


def _pack(capacity: Capacity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        # Longest first, then by place, so that a repeated task packs in the same way.
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(table.column("length").to_numpy(), capacity)
        first = TaskContext.get().partitionId() << 40
        table = table.append_column("sequence_id", pa.array(bins + first, pa.int64()))
        yield from table.append_column("offset", pa.array(offsets, pa.int64())).to_batches(10_000)

    return run


def pack(pieces: DataFrame, capacity: Capacity | None = None, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, packed by vector best fit.

    Each task packs a random share of the pieces, longest first, so its lengths are those of the
    whole table and nearly all its sequences come out full. Capacities hold in every sequence;
    offsets have no gaps. Pieces are dealt by a number of their row, so equal ones spread over the
    tasks too; ``pieces`` should be a stored table, whose rows keep their numbers in each reading. An empty table gives an
    empty result. One job counts the pieces while the plan is made.
    """
    capacity = capacity or Capacity()
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return pieces.repartition(tasks, F.xxhash64(F.monotonically_increasing_id())).mapInArrow(
        _pack(capacity), f"{kinds}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, path: str, ranks_path: str | None = None, capacity: Capacity | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """All documents as pieces in sequences: see ``token_pieces`` and ``pack``.

    Only the two columns named are read. Null text counts as empty and gives a piece with the end
    id alone; rows with a null or repeated id are packed like all others.
    """
    capacity = capacity or Capacity()
    most = capacity.tokens
    if capacity.attention is not None:
        most = min(most, int(capacity.attention**0.5))
    return pack(stored(token_pieces(docs, path, ranks_path, most, id_col, text_col), "pieces"), capacity)


def default_tokenizer() -> tuple[str, str]:
    """Files of the byte-level vocabulary with 50,257 ids: for ``tokenizers``, and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 2048 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), *default_tokenizer())
