"""Removal of long repeated byte strings by hash-compared suffix sorting.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. Each window of
``length`` bytes has an anchor: its part of ``GRAM`` bytes with the least hash. Equal windows have
equal anchors at the same place, so only windows around anchors that occur more than once are
looked at, and a text is represented by about one anchor for every ``length / 2`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.texts import byte_column, mix, powers, prefix_hashes, small_batches, span_hash
from tallyline.session import release, stored

LENGTH = 400
#: Bytes of an anchor.
GRAM = 48
#: Texts are cut into overlapping segments of so many bytes; a place in one takes 22 bits.
SEGMENT = 1 << 22
#: Different contexts of one anchor that are sorted in one task. Anchors with more are counted in
#: blocks of windows instead, of these sizes one after the other.
GROUP = 1024
BLOCKS = (48, 6, 1)
#: Contexts sorted in one task.
CONTEXTS_PER_TASK = 8_000

RESULTS = ("n_bytes", "n_removed", "spans", "kept", "kept_sha256")
ROWS = "gram long, context long, did long, rid long, place long, front int, windows int"


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` keys in a row."""
    n, size = len(keys) - width + 1, 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[:n], keys[width - size : width - size + n])


def _segments(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of the bytes with row numbers and bounds: many short texts, or a piece of a long one.

    Pieces overlap by ``length - 1`` bytes, so each window is in exactly one of them. The last array
    holds where each part starts in its text.
    """
    row, rows = 0, len(bounds) - 1
    while row < rows:
        size = bounds[row + 1] - bounds[row]
        if size > SEGMENT:
            for at in range(0, int(size) - length + 1, SEGMENT - length + 1):
                part = data[bounds[row] + at : min(bounds[row] + at + SEGMENT, bounds[row + 1])]
                yield np.array([row]), np.array([0, len(part)]), part, np.array([at])
            row += 1
            continue
        last = int(np.searchsorted(bounds, bounds[row] + (1 << 20), "right")) - 1
        last = min(max(last, row + 1), rows)
        yield (
            np.arange(row, last), bounds[row : last + 1] - bounds[row],
            data[bounds[row] : bounds[last]], np.zeros(last - row, np.int64),
        )
        row = last


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of the rows: row, hash of the anchor, hash of its context, place, bytes of the context
    before the anchor, number of windows.

    The context is what all windows of the anchor cover: ``length - 1`` bytes and one for each window.
    """
    width = length - GRAM + 1
    for rows, at, part, moved in _segments(data, bounds, length):
        if len(part) < length:
            continue
        sums = prefix_hashes(part)
        start = np.arange(len(part) - GRAM + 1)
        grams = mix(span_hash(sums, start, start + GRAM))
        keys = (grams & np.uint64(0xFFFFFFFFFFC00000)) | start.astype(np.uint64)
        least = (_window_minima(keys, width) & np.uint64(0x3FFFFF)).astype(np.int64)
        # Windows within one text only, in runs with the same anchor.
        room = np.zeros(len(least) + 1, np.int64)
        long = np.flatnonzero(at[1:] - at[:-1] >= length)
        room[at[long]] += 1
        np.add.at(room, at[long + 1] - length + 1, -1)
        valid = np.flatnonzero(np.cumsum(room)[:-1])
        if not len(valid):
            continue
        place = least[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(valid)) - 1
        begin, end, place = valid[first], valid[last] + length, place[first]
        context = mix(span_hash(sums, begin, end) + mix((place - begin).astype(np.uint64) << np.uint64(12) ^ (end - begin).astype(np.uint64)))
        text = np.searchsorted(at, begin, "right") - 1
        yield (
            rows[text], grams[place].view(np.int64), context.view(np.int64), place - at[text] + moved[text],
            (place - begin).astype(np.int32), (valid[last] - valid[first] + 1).astype(np.int32),
        )


def _anchor_rows(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, gram, context, place, front, windows in anchors(*byte_column(batch.column(2)), length):
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram), pa.array(context), batch.column(0).take(take), batch.column(1).take(take),
                        pa.array(place), pa.array(front), pa.array(windows),
                    ],
                    ["gram", "context", "did", "rid", "place", "front", "windows"],
                )

    return run


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: less to shuffle."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([squeeze(t) for t in texts], pa.binary())],
            ["did", "rid", "packed"],
        )


def _context_rows(length: int) -> Callable:
    """The bytes of the contexts that are asked for, from the packed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            asked = batch.column(3)
            rows = asked.flatten()
            which = np.repeat(np.arange(len(asked)), asked.value_lengths().to_numpy())
            texts = [unpack(packed) for packed in batch.column(2).to_pylist()]
            begin = rows.field("place").to_numpy() - rows.field("front").to_numpy()
            end = begin + rows.field("windows").to_numpy() + length - 1
            cut = [texts[k][a:b] for k, a, b in zip(which.tolist(), begin.tolist(), end.tolist(), strict=True)]
            take = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.field("gram"), rows.field("n"), batch.column(0).take(take), batch.column(1).take(take),
                    rows.field("place"), rows.field("front"), pa.array(cut, pa.binary()),
                ],
                ["gram", "n", "did", "rid", "place", "front", "bytes"],
            )

    return run


class Suffixes:
    """Contexts side by side in one buffer, compared by the hashes of their prefixes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, anchor: np.ndarray):
        self.data, self.bounds, self.anchor = data, bounds, anchor
        self.held = data.tobytes()
        self.sums = prefix_hashes(data)
        self.power = powers(len(data) + 1)[0]
        self.back = anchor - bounds[:-1]
        self.ahead = bounds[1:] - anchor

    def common(self, i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray:
        """Bytes that contexts ``i`` and ``j`` have in common from their anchors on, or before them.

        A binary search over the length, with one comparison of hashes in each step. The bytes
        themselves are compared in the end; where a hash has erred, they decide.
        """
        most = np.minimum(self.ahead[i], self.ahead[j]) if ahead else np.minimum(self.back[i], self.back[j])
        lo, hi = np.zeros(len(i), np.int64), most.copy()
        x, y = self.anchor[i], self.anchor[j]
        # Powers go with the distance, so both hashes are brought to the same place.
        while (open_ := lo < hi).any():
            mid = (lo + hi + 1) // 2
            if ahead:
                a, b = self.sums[x + mid] - self.sums[x], self.sums[y + mid] - self.sums[y]
                shift = x - y
            else:
                a, b = self.sums[x] - self.sums[x - mid], self.sums[y] - self.sums[y - mid]
                shift = x - y
            up = np.abs(shift)
            same = np.where(shift < 0, a * self.power[up], a) == np.where(shift > 0, b * self.power[up], b)
            lo = np.where(open_ & same, mid, lo)
            hi = np.where(open_ & ~same, mid - 1, hi)
        return lo

    def checked(self, i: int, j: int, n: int, ahead: bool) -> int:
        """``n``, or what is really in common if a hash has erred."""
        x, y = int(self.anchor[i]), int(self.anchor[j])
        a, b = (self.held[x : x + n], self.held[y : y + n]) if ahead else (self.held[x - n : x], self.held[y - n : y])
        if a == b:
            return n
        pairs = zip(a, b, strict=True) if ahead else zip(a[::-1], b[::-1], strict=True)
        return next(k for k, (p, q) in enumerate(pairs) if p != q)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the suffix from the anchor of ``i`` sorts before that of ``j``; ties by number."""
        n = self.common(i, j, True)
        end_i, end_j = n >= self.ahead[i], n >= self.ahead[j]
        last = len(self.data) - 1
        a = np.where(end_i, -1, self.data[np.minimum(self.anchor[i] + n, last)].astype(np.int64))
        b = np.where(end_j, -1, self.data[np.minimum(self.anchor[j] + n, last)].astype(np.int64))
        return np.where(a != b, a < b, i < j)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Numbers of the contexts in suffix order within their groups (given in order): a mergesort.

        In each round the runs of a group are merged two by two: the new place of an element is its
        own rank and its rank in the other run, found by binary search. All groups go at once.
        """
        n = len(group)
        order = np.arange(n)
        first = np.searchsorted(group, group)
        end = np.searchsorted(group, group, "right")
        pos = np.arange(n)
        size = 1
        while size < int((end - first).max(initial=0)):
            run = (pos - first) // size
            mine = first + run * size
            other = np.where(run % 2 == 0, mine + size, mine - size)
            lo = np.minimum(other, end)
            stop = np.minimum(other + size, end)
            start = lo.copy()
            while (open_ := lo < stop).any():
                at = np.flatnonzero(open_)
                mid = (lo[at] + stop[at]) // 2
                less = self.before(order[mid], order[at])
                lo[at] = np.where(less, mid + 1, lo[at])
                stop[at] = np.where(less, stop[at], mid)
            new = np.empty(n, np.int64)
            new[np.minimum(mine, np.where(run % 2 == 0, mine, other)) + (pos - mine) + (lo - start)] = order
            order = new
            size *= 2
        return order


def repeated_windows(suffixes: Suffixes, group: np.ndarray, once: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Runs of windows that another context of the same group has too: context, first and last start.

    Starts count from the beginning of the context. Only contexts marked ``once`` are asked for; the
    windows of the others are known to be repeated. From each context the suffix order is walked
    up and down while the common part behind the anchor can still make up a window; of those met,
    only one that reaches further back than all before it adds windows.
    """
    order = suffixes.sort(group)
    n = len(order)
    near = np.zeros(n + 1, np.int64)  # common bytes of neighbours in the order
    if n > 1:
        near[1:n] = np.where(group[1:] == group[:-1], suffixes.common(order[:-1], order[1:], True), -1)
    near[0] = near[n] = -1
    found = []
    for step in (1, -1):
        at = np.flatnonzero(once[order])
        here = at.copy()
        reach = np.full(len(at), 1 << 30)
        back = np.full(len(at), -1)
        while len(at):
            reach = np.minimum(reach, near[here + 1] if step > 0 else near[here])
            alive = (reach >= GRAM) & (reach + suffixes.back[order[at]] >= length)
            at, here, reach, back = at[alive], here[alive] + step, reach[alive], back[alive]
            if not len(at):
                break
            i, j = order[at], order[here]
            left = suffixes.common(i, j, False)
            for k in np.flatnonzero((left > back) & (left + reach >= length)).tolist():
                p, q = int(i[k]), int(j[k])
                x = suffixes.checked(p, q, int(left[k]), False)
                y = suffixes.checked(p, q, int(reach[k]), True)
                if x + y >= length:
                    a = int(suffixes.back[p])
                    found.append((p, a - x, a + y - length))
            back = np.maximum(back, left)
            more = back < suffixes.back[i]
            at, here, reach, back = at[more], here[more], reach[more], back[more]
    return found


def _sorted_groups(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        table = pa.Table.from_batches(batches).sort_by("gram").combine_chunks()
        data, bounds = byte_column(table.column("bytes").chunk(0))
        data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        front = table.column("front").to_numpy().astype(np.int64)
        found = repeated_windows(
            Suffixes(data, bounds, bounds[:-1] + front), table.column("gram").to_numpy(),
            table.column("n").to_numpy() == 1, length,
        )
        which = np.array([x[0] for x in found], np.int64)
        begin = table.column("place").to_numpy()[which] - front[which]
        yield pa.RecordBatch.from_arrays(
            [
                table.column("did").combine_chunks().take(pa.array(which)), table.column("rid").combine_chunks().take(pa.array(which)),
                pa.array(begin + np.array([x[1] for x in found], np.int64), pa.int64()),
                pa.array(begin + np.array([x[2] for x in found], np.int64) + length, pa.int64()),
            ],
            ["did", "rid", "start", "end"],
        )

    return run


def _blocks(length: int, size: int) -> Callable:
    """The open windows of contexts in blocks of ``size``, by how far the anchor is behind the start of a window.

    ``core``: hash of what all windows of such a block share, also where a context has only some of
    them; ``full``: hash of all that the windows at hand cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            open_ = batch.column("open")
            n, least, most = (open_.flatten().field(c).to_numpy() for c in ("n", "least", "most"))
            context = np.repeat(np.arange(len(open_)), open_.value_lengths().to_numpy())
            data, bounds = byte_column(batch.column("bytes"))
            data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
            sums = prefix_hashes(data)
            count = most // size - least // size + 1
            which = np.repeat(np.arange(len(count)), count)
            block = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + (least // size)[which]
            lo, hi = np.maximum(least[which], block * size), np.minimum(most[which], block * size + size - 1)
            row = context[which]
            anchor = bounds[:-1][row] + batch.column("front").to_numpy()[row]
            core = span_hash(sums, anchor - block * size, anchor - block * size - size + 1 + length)
            full = span_hash(sums, anchor - hi, anchor - lo + length)
            own = mix(batch.column("gram").to_numpy()[row].view(np.uint64) + block.astype(np.uint64))
            range_ = (lo.astype(np.uint64) << np.uint64(12)) + hi.astype(np.uint64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mix(core + own).view(np.int64)), pa.array(mix(full + mix(own + range_)).view(np.int64)),
                    pa.array(n[which]), *(batch.column(c).take(take) for c in ("gram", "did", "rid", "place")),
                    pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                ],
                ["core", "full", "n", "gram", "did", "rid", "place", "least", "most"],
            )

    return run


def _crowded_spans(contexts: DataFrame, length: int) -> list[DataFrame]:
    """Repeated windows of contexts whose anchors have very many of them, without bringing these together.

    Windows go by blocks, ever smaller ones. A block that occurs as a whole more than once has only
    repeated windows. One whose core no other block shares has none. The different blocks that share
    a core are cut into smaller ones. All is done by counts of hashes, which are combined before the
    shuffle.
    """
    context = ["gram", "did", "rid", "place"]
    contexts = stored(contexts, "crowded-contexts")
    least = (F.col("front") - F.octet_length("bytes") + length).cast("int")
    whole = F.struct("n", least.alias("least"), F.col("front").cast("int").alias("most"))
    rows = contexts.withColumn("open", F.array(whole))
    found = []
    for size in BLOCKS:
        rows = rows.select(*context, "front", "bytes", "open")
        kinds = "core long, full long, n long, gram long, did long, rid long, place long, least int, most int"
        blocks = stored(rows.mapInArrow(_blocks(length, size), kinds), "blocks")
        different = stored(
            blocks.groupBy("core", "full").agg(F.sum("n").alias("n"), F.min(F.struct(*context, "least", "most")).alias("at")),
            "different-blocks",
        )
        again = blocks.where("n = 1").join(different.where("n > 1").select("full").distinct(), "full", "left_semi")
        start, end = F.col("place") - F.col("most"), F.col("place") - F.col("least") + F.lit(length)
        found.append(again.select("did", "rid", start.alias("start"), end.alias("end")))
        shared = stored(different.groupBy("core").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("core"), "cores")
        left = different.join(shared, "core", "left_semi").select("n", "at.*")
        left = left.groupBy(*context).agg(F.collect_list(F.struct("n", "least", "most")).alias("open"))
        rows = contexts.join(left, context)
    return found


def _merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed runs and the remaining bytes of the packed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        spans, rest = [], []
        for packed, wanted in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            text = unpack(packed)
            own = _merged(wanted.values.field("start").to_pylist(), wanted.values.field("end").to_pylist())
            parts, at = [], 0
            for start, end in own:
                parts.append(text[at:start])
                at = end
            parts.append(text[at:])
            spans.append([{"start": a, "end": b} for a, b in own])
            rest.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(rest, pa.binary()), pa.array([hashlib.sha256(r).hexdigest() for r in rest], pa.string()),
            ],
            ["did", "rid", "spans", "kept", "kept_sha256"],
        )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP
) -> DataFrame:
    """The columns of ``docs``, and ``n_bytes``, ``n_removed``, ``spans``, ``kept``, ``kept_sha256``.

    A column of ``docs`` with one of these names gives way to the result.

    Texts are taken as UTF-8 bytes, null as empty. A byte is removed if it lies in a string of
    ``length`` bytes that starts at another place too, in the same document or in another; places may
    overlap, and strings are judged on the input. ``spans``: the maximal removed runs (``start``,
    ``end``). ``kept``: the remaining bytes, which need not be whole characters; null where nothing
    was removed. Texts shorter than ``length`` are never touched. Repeated rows are places of their
    own, so copies of a long enough text go altogether. Rows with a null id are treated like all
    others.

    Steps: anchors of all texts; those that occur once drop out by a count. An anchor whose whole
    context occurs more than once has only repeated windows. What is left are anchors at the edges
    of repeated strings: their contexts are fetched from the texts and suffix-sorted, or, if an
    anchor has more than ``group`` different contexts, counted in ever smaller blocks of windows.
    """
    if length <= GRAM:
        raise ValueError(f"length must exceed {GRAM}")
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    # Rows with the same id and text have the same key, and so the same result.
    key = ["did", "rid"]
    own_key = [F.coalesce(ident, F.lit(-(2**63))), F.xxhash64(ident.isNull(), text)]
    texts = docs.select(*(c.alias(k) for c, k in zip(own_key, key, strict=True)), text.alias("text"))
    texts = texts.where(F.octet_length("text") >= length)

    every = stored(texts.mapInArrow(_anchor_rows(length), ROWS), "anchors")
    # Kept as a table, so that the join below can be split where one anchor has very many rows.
    often = every.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram")
    often = stored(often, "repeated-grams")
    rows = stored(every.join(often, "gram", "left_semi"), "repeated-anchors")
    release(every)
    release(often)
    contexts = rows.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "rid", "place", "front", "windows")).alias("at")
    )
    contexts = stored(contexts, "contexts")
    whole = rows.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    begin = F.col("place") - F.col("front")
    whole = whole.select(*key, begin.alias("start"), (begin + F.col("windows") + F.lit(length - 1)).alias("end"))

    several = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
    several = stored(several, "edge-grams")
    edges = contexts.join(several, "gram").select("gram", "n", "different", "at.*")
    edges = stored(edges, "edges")
    packed = texts.mapInArrow(_squeezed, "did long, rid long, packed binary")
    # Repeated rows have the same bytes; one of them is enough.
    packed = stored(packed.join(rows.select(*key).distinct(), key, "left_semi").dropDuplicates(key), "packed")
    asked = edges.groupBy(*key).agg(F.collect_list(F.struct("gram", "n", "place", "front", "windows")).alias("asked"))
    bytes_of = packed.join(asked, key).select(*key, "packed", "asked").mapInArrow(
        _context_rows(length), "gram long, n long, did long, rid long, place long, front int, bytes binary"
    )
    crowded = several.where(F.col("different") > group).select("gram")
    bytes_of = stored(bytes_of, "context-bytes")
    tasks = max(1, -(-edges.count() // CONTEXTS_PER_TASK))
    release(edges)
    spans = "did long, rid long, start long, end long"
    few = bytes_of.join(crowded, "gram", "left_anti").select(bytes_of.columns)
    parts = few.repartition(tasks, "gram").mapInArrow(_sorted_groups(length), spans)
    many = bytes_of.join(crowded, "gram", "left_semi").select(bytes_of.columns)
    spans_of = [whole, parts]
    if not crowded.isEmpty():
        spans_of += _crowded_spans(many, length)
    everything = reduce(DataFrame.unionByName, spans_of)

    removed = everything.groupBy(*key).agg(
        F.collect_list(F.struct("start", "end")).alias("found")
    )
    cut = packed.join(removed, key).select(*key, "packed", "found").mapInArrow(
        _cut, "did long, rid long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string"
    ).withColumnsRenamed({"did": "_did", "rid": "_rid"})
    # Size and digest are taken before the join, so that it need not carry texts nobody asks for.
    own = docs.select(*(c for c in docs.columns if c not in RESULTS)).withColumns({
        "_own_did": own_key[0], "_own_rid": own_key[1],
        "n_bytes": F.octet_length(text).cast("long"), "_sha256": F.sha2(text.cast("binary"), 256),
    })
    out = own.join(cut, (F.col("_own_did") == F.col("_did")) & (F.col("_own_rid") == F.col("_rid")), "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>"))
    return out.select(
        *(c for c in docs.columns if c not in RESULTS), "n_bytes",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        spans.alias("spans"), "kept", F.coalesce("kept_sha256", "_sha256").alias("kept_sha256"),
    )


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes removed from all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
