"""Fingerprints of texts from modular prefix hashes.

The prefix array of a text holds, for each place, the polynomial hash of all code points before it,
modulo two primes. Two lookups give the hash of any span, so spans can be held equal without reading
them, and the longest common extension of two places is found by binary search.

A fingerprint keeps the prefix hashes of a few places only: a grid from the head, a grid from the
tail, and cuts that the content itself names (least window hashes within a radius). Between kept
places it answers the same questions. The likeness of two fingerprints is the share of code points
in common spans: the longest common head and tail, and between them runs of chunks from cut to cut,
each extended by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.ordered import ordered_scan, position
from tallyline.session import work_dir

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)
#: Code points of the windows whose hashes choose the cuts, and the least distance to a better one.
WINDOW, RADIUS = 8, 4
#: Places kept at most: of each grid, and of the cuts.
GRID, CUTS = 16, 16
#: Common spans between head and tail count from this length on.
LEAST_SPAN = 8

_powers = [[np.ones(1, np.uint64) for _ in PRIMES], [np.ones(1, np.uint64) for _ in PRIMES]]


def _power_tables(n: int) -> list[list[np.ndarray]]:
    """Powers of the bases and of their inverses, for places up to ``n``."""
    while len(_powers[0][0]) <= n:
        for tables, sign in zip(_powers, (1, -1), strict=True):
            for q, (base, prime) in enumerate(zip(BASES, PRIMES, strict=True)):
                known = tables[q]
                step = np.uint64(pow(base, sign * len(known), prime))
                tables[q] = np.concatenate([known, known * step % np.uint64(prime)])
    return _powers


class Prefixes:
    """The modular prefix arrays of a text's code points."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = n = len(codes)
        powers, self.sums = _power_tables(n)[0], []
        for q, prime in enumerate(PRIMES):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(codes * powers[q][:n] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums % np.uint64(prime))

    def at(self, places: np.ndarray) -> np.ndarray:
        """The prefix hashes up to ``places``, both primes in one number."""
        return self.sums[0][places] | self.sums[1][places] << np.uint64(31)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of spans, the same wherever the span stands."""
        out, inverse = np.zeros(len(start), np.uint64), _power_tables(self.n)[1]
        for q, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            out |= (self.sums[q][end] + p - self.sums[q][start]) % p * inverse[q][start] % p << np.uint64(31 * q)
        return out

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Code points that agree from place ``i`` of ``a`` and ``j`` of ``b`` on."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def content_cuts(prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Places of least window hashes, and how often the radius can double with the place still least.

    Both follow from the text around a place alone, so an edit elsewhere leaves them as they are.
    """
    count = prefixes.n - WINDOW + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = np.arange(count)
    values = _mixed(prefixes.spans(places, places + WINDOW))
    least = np.ones(count, bool)
    for d in range(1, min(RADIUS, count - 1) + 1):
        # Of equal windows the first one counts.
        least[d:] &= values[d:] < values[:-d]
        least[:-d] &= values[:-d] <= values[d:]
    places, values = places[least], values[least]
    strength, alive, radius = np.zeros(len(places), np.int64), np.arange(len(places)), RADIUS
    while len(alive) > 1:
        radius *= 2
        at, value = places[alive], values[alive]
        near = np.diff(at) <= radius
        stays = np.ones(len(alive), bool)
        stays[1:] &= ~(near & (value[:-1] <= value[1:]))
        stays[:-1] &= ~(near & (value[1:] < value[:-1]))
        alive = alive[stays]
        strength[alive] += 1
    return places, strength


def _stride(n: int) -> int:
    step = 1
    while (n - 1) // step > GRID:
        step *= 2
    return step


def fingerprint(text: str) -> str:
    """Length, hash of the whole, head grid, tail grid and cuts; equal texts have equal ones.

    An empty text has ``0``. About 20 characters for each kept place, at most 48 places.
    """
    prefixes = Prefixes(text)
    n = prefixes.n
    if not n:
        return "0"
    grid = np.arange(_stride(n), n, _stride(n))
    places, strength = content_cuts(prefixes)
    level = 0
    while (strength >= level).sum() > CUTS:
        level += 1
    keep = strength >= level
    places, strength = places[keep], strength[keep]
    whole, head, tail, cuts = (prefixes.at(p).tolist() for p in (np.array([n]), grid, n - grid, places))
    return ":".join((
        f"{n:x}", f"{whole[0]:016x}", "".join(f"{h:016x}" for h in head), "".join(f"{h:016x}" for h in tail), f"{level:x}",
        ",".join(f"{p:x}.{s:x}.{h:016x}" for p, s, h in zip(places.tolist(), strength.tolist(), cuts, strict=True)),
    ))


class _Read:
    """A fingerprint's kept places and prefix hashes."""

    def __init__(self, text: str):
        n, whole, head, tail, level, cuts = text.split(":")
        self.n, self.whole, self.level = int(n, 16), int(whole, 16), int(level, 16)
        self.head, self.tail = ([int(h[i : i + 16], 16) for i in range(0, len(h), 16)] for h in (head, tail))
        self.step = _stride(self.n)
        self.cuts = [tuple(int(v, 16) for v in cut.split(".")) for cut in cuts.split(",")] if cuts else []

    def chunked(self, level: int, start: int, end: int) -> tuple[list[int], list[int]]:
        """Kept cuts of a level within a part, with their prefix hashes."""
        kept = [(p, h) for p, s, h in self.cuts if s >= level and start <= p <= end]
        return [p for p, _ in kept], [h for _, h in kept]


def _span(start: int, before: int, upto: int) -> tuple[int, int]:
    """The hash of a span out of its place and two prefix hashes."""
    inverse, out = _power_tables(start)[1], []
    for q, prime in enumerate(PRIMES):
        low, high = (before >> 31 * q) & 0x7FFFFFFF, (upto >> 31 * q) & 0x7FFFFFFF
        out.append((high - low) * int(inverse[q][start]) % prime)
    return out[0], out[1]


def _longest(limit: int, agree) -> int:
    """The largest number up to ``limit`` that agrees; all below it do."""
    low = 0
    while low < limit:
        mid = (low + limit + 1) // 2
        if agree(mid):
            low = mid
        else:
            limit = mid - 1
    return low


def likeness(first: str, second: str) -> float:
    """Share of code points in spans that two fingerprints have in common, from 0 to 1."""
    if first == second:
        return 1.0
    if "0" in (first, second):
        return 0.0
    a, b = _Read(first), _Read(second)
    step, shorter = max(a.step, b.step), min(a.n, b.n)
    most = (shorter - 1) // step
    head = step * _longest(most, lambda k: a.head[k * step // a.step - 1] == b.head[k * step // b.step - 1])

    def ends_alike(k: int) -> bool:
        (i, x), (j, y) = ((r.n - k * step, r.tail[k * step // r.step - 1]) for r in (a, b))
        return _span(i, x, a.whole) == _span(j, y, b.whole)

    tail = step * _longest((shorter - head) // step if head else most, ends_alike) if (shorter - head) >= step else 0
    level = max(a.level, b.level)
    (at, ah), (bt, bh) = a.chunked(level, head, a.n - tail), b.chunked(level, head, b.n - tail)
    chunks: dict[tuple, list[int]] = {}
    for j in range(len(bt) - 1):
        chunks.setdefault((bt[j + 1] - bt[j], _span(bt[j], bh[j], bh[j + 1])), []).append(j)
    used, common, i = [False] * len(bt), head + tail, 0
    while i < len(at) - 1:
        key = (at[i + 1] - at[i], _span(at[i], ah[i], ah[i + 1]))
        j = next((j for j in chunks.get(key, ()) if not used[j]), None)
        if j is None or key[0] < LEAST_SPAN:
            i += 1
            continue
        free = next((m for m in range(j, len(bt) - 1) if used[m]), len(bt) - 1)

        def agree(m: int, i: int = i, j: int = j) -> bool:
            return at[i + m] - at[i] == bt[j + m] - bt[j] and _span(at[i], ah[i], ah[i + m]) == _span(bt[j], bh[j], bh[j + m])

        m = _longest(min(len(at) - 1 - i, free - j), agree)
        common += at[i + m] - at[i]
        used[j : j + m] = [True] * m
        i += m
    return min(1.0, 2 * common / (a.n + b.n))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the head of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compared(text: str, own: str, following: str, of_next: str) -> tuple:
    changed = edited(text, following)
    of_changed = own if changed == text else fingerprint(changed)
    digest = sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return len(text), digest, own, of_changed, likeness(own, of_changed), likeness(own, of_next)


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [part.split()[0] for part in _RESULT.split(", ")]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_BATCH = 512


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, so that the shuffle carries about half of them."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([pack(t.as_py()) for t in texts], pa.binary()), *batch.columns[1:]], ["packed", *batch.schema.names[1:]])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One ordered range: each row beside the next, and the first and last ones for what lies beyond.

    Only the row before is held.
    """
    out: list[tuple] = []
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), *_TYPES]
    names = ["part", "kind", "doc_id", "text", *_NAMES]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    before, unpack = None, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for part, ident, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            row = (part.as_py(), ident.as_py(), unpack(text.as_py()).decode())
            own = fingerprint(row[2])
            if before is None:
                out.append((row[0], "first", row[1], row[2], len(row[2]), None, own, None, None, None))
            else:
                (at, number, held), known = before
                out.append((at, "row", number, None, *_compared(held, known, row[2], own)))
            before = row, own
            if len(out) >= _BATCH:
                yield flush()
    if before is not None:
        (at, number, held), known = before
        out.append((at, "last", number, held, len(held), None, known, None, None, None))
        yield flush()


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [batch.column(i).to_pylist() for i in range(5)]
        found = [_compared(text, own, nxt, other) for _, text, own, nxt, other in zip(*rows, strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * len(_TYPES)
        arrays = [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *_NAMES])


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its fingerprint, that of its edited text, and the likeness to that and to the next document.

    The next document is the one behind it by falling ``doc_id`` (null last, rows alike in it by a
    hash of their text); behind the last comes the first, so a row on its own is its own next one.
    Null texts are empty; two empty texts are alike (1), an empty and another one not (0). Columns
    beside ``doc_id`` and ``text`` are not looked at. No rows give no rows.

    The texts are shuffled once, compressed, into ordered ranges, and each range is read as a stream. What lies
    beyond its last row comes from the first row of the next range.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Exact copies of a row may be many; their numbers spread them over ranges.
    rows = docs.select(
        text.alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("copy"),
    ).mapInArrow(_packed, "packed binary, doc_id long, hash long, copy long")
    order = [F.desc_nulls_last("doc_id"), F.col("hash").asc(), F.col("copy").asc()]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ranges.select(F.spark_partition_id().alias("part"), "doc_id", "packed")
    # Written once, as ranges are cut anew whenever the plan is run.
    path = work_dir(docs.sparkSession, "prints")
    compared = marked.mapInArrow(_in_order, f"part int, kind string, doc_id long, text string, {_RESULT}")
    compared.write.option("compression", "zstd").parquet(path)
    found = docs.sparkSession.read.schema(compared.schema).parquet(path)
    firsts = found.where("kind = 'first'").select("part", F.col("text").alias("next"), F.col("fingerprint").alias("next_print"))
    numbers = ordered_scan(firsts.select("part"), [], ["part"], at=position())
    parts = numbers.count()
    behind = numbers.join(firsts, "part").select(F.pmod(F.col("at") - 1, F.lit(max(1, parts))).alias("at"), "next", "next_print")
    lasts = found.where("kind = 'last'").select("part", "doc_id", "text", "fingerprint").join(numbers, "part")
    edges = lasts.join(behind, "at").select("doc_id", "text", "fingerprint", "next", "next_print")
    inner = found.where("kind = 'row'").select("doc_id", *_NAMES)
    return inner.unionByName(edges.mapInArrow(_at_edges, f"doc_id long, {_RESULT}"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents``, held against their edited texts and their next documents."""
    return document_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
