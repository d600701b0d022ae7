"""Sampled SentencePiece encoding by forward filtering and backward sampling, and lossless decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.texts import mix, powers, small_batches

SPACE = 0x2581  # stands for a space in pieces
LITERAL = 0x110000  # the same character in a text: it is encoded by its bytes
#: Characters of a block; texts are encoded whole, a longer one is a block of its own.
BLOCK_CHARS = 1 << 19
#: Longer segments are filtered in logarithms, and shorter ones whose weights could leave the range of floats.
LONG = 48

_SLOT = np.uint64((1 << 20) - 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_loaded: dict[tuple[str, float], Lattice] = {}


class Lattice:
    """Pieces of a model with weights ``exp(alpha * score)``, and where texts fall apart.

    Two neighbouring characters that stand side by side in no piece are a border that no piece can
    cross, so the lattice of a text is a chain of short segments that are sampled one by one.
    """

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = []
        plain = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(name.replace(chr(SPACE), " ").encode())
                plain.append(i)
        chars = sorted({ord(c) for i in plain if len(names[i]) == 1 for c in names[i]})
        self.class_of = np.zeros(LITERAL + 1, np.int32)
        self.class_of[chars] = np.arange(1, len(chars) + 1)
        # A piece with a character that is no piece itself could not be reached from both sides.
        plain = [i for i in plain if all(self.class_of[ord(c)] for c in names[i])]
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for i in plain:
            known = self.class_of[[ord(c) for c in names[i]]]
            self.joined[known[:-1], known[1:]] = True
        self.longest = max(len(names[i]) for i in plain)
        random = np.random.default_rng(7)
        self.value_of = random.integers(1, 1 << 63, len(chars) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        joined = self.class_of[[ord(c) for i in plain for c in names[i]]]
        sums = self.sums(joined)
        ends = np.cumsum([len(names[i]) for i in plain])
        lengths = np.array([len(names[i]) for i in plain])
        hashes = self.hash(sums, ends - lengths, ends)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(plain, np.int32)[order]
        # Slots by the low bits of the hash; those of several pieces say -2 and are searched.
        low = (self.hashes & _SLOT).astype(np.int64)
        self.slots = np.full(int(_SLOT) + 1, -1, np.int32)
        self.slots[low] = np.arange(len(low))
        held, times = np.unique(low, return_counts=True)
        self.slots[held[times > 1]] = -2
        scores = np.array([model.get_score(i) for i in plain])[order]
        self.logs = alpha * scores
        # A segment of so many characters has no weight beyond e^600 or below e^-600, however it falls apart.
        self.long = min(LONG, int(600 / max(np.abs(self.logs).max(), 1e-9)))
        with np.errstate(over="ignore"):
            self.weights = np.exp(self.logs)

    def sums(self, classes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(classes) + 1, np.uint64)
        np.cumsum(self.value_of[classes] * powers(len(classes) + 1)[0][: len(classes)], out=out[1:])
        return out

    @staticmethod
    def hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * powers(len(sums))[1][start] + (end - start).astype(np.uint64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the pieces with these hashes, -1 where there is none."""
        at = self.slots[(hashes & _SLOT).astype(np.int64)]
        if (shared := at == -2).any():
            at[shared] = np.minimum(np.searchsorted(self.hashes, hashes[shared]), len(self.hashes) - 1)
        at[(self.hashes[at] != hashes) | (at < 0)] = -1
        return at

    def _filtered(self, sums: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward weights, and weights and places of the pieces by end and length, for segments of one length.

        The weights are logarithms if the segments are long.
        """
        n, most = len(start), min(self.longest, length)
        # The segments lie side by side, so that a step of all of them is one run of memory.
        place = np.full((length + 1, most + 1, n), -1, np.int32)
        at = start[None, :] + np.arange(length + 1)[:, None]
        upto, back = sums[at], powers(len(sums))[1][at]
        for size in range(1, most + 1):
            place[size:, size] = self.find(mix((upto[size:] - upto[:-size]) * back[:-size] + np.uint64(size)))
        if length <= self.long:
            weight = np.where(place >= 0, self.weights[place], 0.0)
            forward = np.zeros((length + 1, n))
            forward[0] = 1.0
            for end in range(1, length + 1):
                for size in range(1, min(most, end) + 1):
                    forward[end] += forward[end - size] * weight[end, size]
            return forward, weight, place
        log = np.where(place >= 0, self.logs[place], -np.inf)
        forward = np.full((length + 1, n), -np.inf)
        forward[0] = 0.0
        for end in range(1, length + 1):
            sizes = np.arange(1, min(most, end) + 1)
            forward[end] = np.logaddexp.reduce(forward[end - sizes] + log[end, sizes], axis=0)
        return forward, log, place

    def sample(self, classes: np.ndarray, start: np.ndarray, end: np.ndarray, random: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Start and id of the sampled pieces of segments of known characters.

        Equal segments are filtered once. Sampling goes back from the end: the last piece is drawn by
        the forward weight of what it leaves times its own, then the one before.
        """
        sums = self.sums(classes)
        hashes, lengths = self.hash(sums, start, end), end - start
        at, ids = [], []
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            order = np.argsort(hashes[own], kind="stable")
            found = hashes[own[order]]
            new = np.ones(len(own), bool)
            new[1:] = found[1:] != found[:-1]
            first, same = order[new], np.cumsum(new) - 1
            step = max(1, (1 << 20) // ((length + 1) * (min(self.longest, length) + 1)))
            cuts = np.searchsorted(same, np.arange(0, len(first) + step, step))
            for lo, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                rows = own[order[a:b]]
                which = same[a:b] - lo * step
                forward, weight, place = self._filtered(sums, start[own[first[lo * step : (lo + 1) * step]]], length)
                now = np.full(len(rows), length)
                for stop in range(length, 0, -1):
                    live = np.flatnonzero(now == stop)
                    if not len(live):
                        continue
                    most = min(self.longest, stop)
                    u = which[live]
                    # By length: what is left before the last piece, and that piece.
                    before, last = forward[stop - most : stop, u][::-1], weight[stop, 1 : most + 1, u].T
                    if length <= self.long:
                        odds = before * last
                    else:
                        odds = before + last
                        odds = np.exp(odds - odds.max(axis=0))
                    upto = np.cumsum(odds, axis=0)
                    drawn = random(start[rows[live]] + stop) * upto[-1]
                    pick = np.zeros(len(live), np.int64)
                    for bound in upto[:-1]:
                        pick += bound <= drawn
                    # Rounding may point behind the last possible piece.
                    if len(off := np.flatnonzero(odds[pick, np.arange(len(live))] == 0)):
                        pick[off] = most - 1 - (odds[::-1, off] > 0).argmax(axis=0)
                    now[live] = stop - 1 - pick
                    at.append(start[rows[live]] + now[live])
                    ids.append(self.ids[place[stop, pick + 1, u]])
        return np.concatenate(at), np.concatenate(ids)

    def encode(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Sampled ids of each text; ``keys`` (64 bits each) seed the draws of the rows."""
        if not texts:
            return []
        # Each text that is not empty has a space at its head.
        sizes = [len(t) + 1 if t else 0 for t in texts]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        if not bounds[-1]:
            return [np.zeros(0, np.int32) for _ in texts]
        codes = np.frombuffer("".join([f" {t}" for t in texts if t]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        codes[codes == SPACE] = LITERAL
        codes[codes == 0x20] = SPACE
        classes = self.class_of[codes]
        new = np.ones(len(codes), bool)
        new[1:] = ~self.joined[classes[:-1], classes[1:]]
        new[bounds[:-1][bounds[:-1] < len(codes)]] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(codes))
        known = classes[start] > 0
        row_of = np.repeat(np.arange(len(texts)), sizes)
        seeds = mix(keys.astype(np.uint64))

        def random(place: np.ndarray) -> np.ndarray:
            row = row_of[place - 1]
            own = (place - bounds[row]).astype(np.uint64)
            return (mix(seeds[row] + own * _GOLDEN) >> np.uint64(11)).astype(np.float64) / float(1 << 53)

        at, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        if known.any():
            a, b = self.sample(classes, start[known], end[known], random)
            at.append(a)
            ids.append(b)
        odd = start[~known]
        rank = [np.zeros(sum(len(a) for a in at), np.int64)]
        for place in odd.tolist():
            value = int(codes[place])
            raw = chr(SPACE if value == LITERAL else value).encode("utf-8", "surrogatepass")
            at.append(np.full(len(raw), place))
            ids.append(self.byte_ids[list(raw)])
            rank.append(np.arange(len(raw)))
        at_, ids_, rank_ = np.concatenate(at), np.concatenate(ids), np.concatenate(rank)
        # A character has at most four bytes.
        order = np.argsort(at_ * 4 + rank_)
        cuts = np.searchsorted(at_[order], bounds)
        ids_ = ids_[order]
        return [ids_[lo:hi] for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: bytes of the pieces, without the space that leads each text."""
        raw = b"".join([self.bytes_of[i] for i in ids.tolist()])
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def lattice(path: str, alpha: float) -> Lattice:
    """The lattice of this model in this process."""
    if (path, alpha) not in _loaded:
        _loaded[path, alpha] = Lattice(path, alpha)
    return _loaded[path, alpha]


def _encoded(path: str, alpha: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lattice(path, alpha)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            keys = batch.column(1).to_numpy().view(np.uint64)
            found, held, size, first = [], [], 0, 0
            for at, text in enumerate(texts):
                held.append(text)
                size += len(text)
                if size >= BLOCK_CHARS or at == len(texts) - 1:
                    found += of.encode(held, keys[first : at + 1])
                    held, size, first = [], 0, at + 1
            lossless = [of.decode(i) == t for i, t in zip(found, texts, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(lossless, pa.bool_())], ["doc_id", "ids", "lossless"])

    return run


def sample_pieces(
    docs: DataFrame, path: str, alpha: float = 1e-3, seed: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, sampled ``ids``, and ``lossless`` (whether they decode to the text).

    A segmentation is drawn with the probability of its weight, the product of ``exp(alpha * score)``
    of its pieces, among all segmentations of the whole text. The draws depend on the row key (id
    and ``seed``) and the place in the text only, so a row gets the same ids in every run, however
    it is partitioned. Characters without a piece are encoded by their bytes. Null and empty texts
    have no ids. Rows with a null id share one key; repeated rows get equal ids.
    """
    small_batches(docs.sparkSession)
    ident = F.col(id_col).cast("long")
    rows = docs.select(ident.alias("doc_id"), F.xxhash64(F.lit(seed), ident).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoded(path, alpha), "doc_id long, ids array<int>, lossless boolean")


def _decoded(path: str, alpha: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lattice(path, alpha)
        for batch in batches:
            texts = [of.decode(np.array(i if i is not None else [], np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decode_pieces(rows: DataFrame, path: str, alpha: float = 1e-3) -> DataFrame:
    """``doc_id`` and ``text`` of ``doc_id``, ``ids`` rows. Null ids decode to an empty text."""
    small_batches(rows.sparkSession)
    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        _decoded(path, alpha), "doc_id long, text string"
    )


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of all ``documents``."""
    import public_tokenizers

    return sample_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
