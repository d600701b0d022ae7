"""The prefix trie of conversations, from sorted matrices of turn ids.

A conversation is cut into rows of ``TURNS`` turns: its number, the number of the row, a hash of all
that stands before, and two 60-bit ids for each turn. The rows are range-partitioned by (row number,
hash before, ids, conversation), so all that share a prefix stand side by side. Each range is one
padded matrix: a lexicographic sort, then the changes from row to row, column by column, or-ed from
the left. A change at a turn that is there starts a node, and ``reduceat`` over these starts gives a
node's sums. Only the nodes on the way of a range's first and last row can go on in another range;
their parts are added up afterwards.

Sums over subtrees need no walk from the leaves up. Each node is represented by its smallest
member, so a conversation stands for the end of its own path, from some depth on. With that depth
and the words before it known for each conversation, leaves, children and saved tokens are all sums
over a node's members:

* a leaf counts at its representative;
* a child of a node at depth d counts at the member that represents it: the one whose own part
  begins at d + 1 or above and that goes on behind d;
* the words of distinct nodes are those of all members less the parts that others represent.

The first pass over the matrices finds the representatives, the second one adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.merkle import CRC32_SQL
from tallyline.operators.ordered import ordered_scan, position, running_sum
from tallyline.session import stored

#: Turns in one row of a matrix.
TURNS = 32
#: Rows of one matrix; the ranges are about as large.
SHARD_ROWS = 16_384
#: Turns of one conversation that are numbered in one task; longer ones are cut into ranges.
ORDERED_ROWS = 32_768
#: Fixed values of the rebuilding: conversations that share a first one, and their shared turns.
FAMILY, SHARED = 20, 4
ID_MASK = (1 << 60) - 1
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = sha256(b"").hexdigest()
_KEY = ("depth", "key1", "key2")


def turn_ids(role: Column | str, text: Column | str) -> tuple[Column, Column]:
    """Two 60-bit numbers out of the SHA-256 of a turn; null is empty."""
    role, text = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return tuple(F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16))


def placed_turns(conversations: DataFrame, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """``conv_id, at, id1, id2, words`` per turn, numbered from 0; turns alike in number stand by their ids."""
    id1, id2 = turn_ids("role", "text")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", id1.alias("id1"), id2.alias("id2"), words.alias("words")
    )
    return ordered_scan(rows, ["conv_id"], ["turn", "id1", "id2"], ordered_rows, at=position()).drop("turn")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and all conversations with their ``len``.

    A conversation takes the first h turns of its family's first one, and its own behind its first h.
    """
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("h"),
    )
    bases = convs.where("conv_id = base").select("base", F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    convs = stored(convs, "conversations")
    behind = placed.join(convs.select("conv_id", "h", "taken"), "conv_id").where("at >= h").select(
        "conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "id1", "id2", "words"
    )
    heads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("at") < SHARED)).withColumnRenamed("conv_id", "base")
    shared = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("at < taken").select(
        "conv_id", "at", "id1", "id2", "words"
    )
    return behind.unionByName(shared), convs.select("conv_id", "len")


def matrix_rows(turns: DataFrame, convs: DataFrame, width: int = TURNS, ordered_rows: int = ORDERED_ROWS) -> DataFrame:
    """Rows of ``width`` turns: ``conv_id, k, p1, p2, ids, words, before``; a turnless conversation has one row.

    A turn's two numbers hold its depth too, so the sum of the numbers before a row stands for all
    turns before it: 120 bits in all.
    """
    mask = F.lit(ID_MASK).cast("long")
    numbers = (F.xxhash64("at", "id1", "id2").bitwiseAND(mask), F.xxhash64("id2", "at", "id1").bitwiseAND(mask))
    marked = turns.select("conv_id", "at", numbers[0].alias("x1"), numbers[1].alias("x2"), "words")
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(f"s_{c}") for c in ("x1", "x2")]
    rows = marked.groupBy("conv_id", F.floor(F.col("at") / F.lit(width)).cast("long").alias("k")).agg(
        # At most ``width`` turns.
        F.array_sort(F.collect_list(F.struct("at", "x1", "x2", "words"))).alias("t"), *wide, F.sum("words").alias("s_words")
    )
    scanned = ordered_scan(
        rows, ["conv_id"], ["k"], ordered_rows, x1=running_sum("s_x1"), x2=running_sum("s_x2"), w=running_sum("s_words")
    )
    modulus = F.lit(1 << 60).cast("decimal(38,0)")
    before = [F.pmod((F.col(c) - F.col(f"s_{c}")).cast("decimal(38,0)"), modulus).cast("long") for c in ("x1", "x2")]
    cut = scanned.select(
        "conv_id", "k", before[0].alias("p1"), before[1].alias("p2"),
        F.flatten(F.transform("t", lambda t: F.array(t["x1"], t["x2"]))).alias("ids"),
        F.col("t.words").alias("words"), (F.col("w") - F.col("s_words")).cast("long").alias("before"),
    )
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    turnless = convs.where("len = 0").select(
        "conv_id", zero.alias("k"), zero.alias("p1"), zero.alias("p2"), none.alias("ids"), none.alias("words"), zero.alias("before")
    )
    return cut.unionByName(turnless)


class _Matrix:
    """The rows of one range, sorted, as padded matrices, with the starts of nodes column by column."""

    def __init__(self, table: pa.Table, width: int):
        lists, words = (table.column(c).combine_chunks() for c in ("ids", "words"))
        if isinstance(lists, pa.ChunkedArray):
            lists, words = lists.chunk(0), words.chunk(0)
        sizes = np.diff(words.offsets.to_numpy())
        there = np.arange(int(sizes.max(initial=0))) < sizes[:, None]
        ids, self.width = lists.flatten().to_numpy().reshape(-1, 2), width
        # -1 is below all ids, so a shorter row stands before those that go on.
        first, second, spoken = (np.full(there.shape, fill, np.int64) for fill in (-1, -1, 0))
        first[there], second[there], spoken[there] = ids[:, 0], ids[:, 1], words.flatten().to_numpy()
        plain = {c: table.column(c).to_numpy() for c in table.column_names if c not in ("ids", "words")}
        keys = [plain["conv_id"]]
        for j in reversed(range(first.shape[1])):
            keys += [second[:, j], first[:, j]]
        order = np.lexsort([*keys, plain["p2"], plain["p1"], plain["k"]])
        self.plain = {c: v[order] for c, v in plain.items()}
        self.first, self.second, self.spoken, self.sizes = first[order], second[order], spoken[order], sizes[order]

    def nodes(self) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
        """Per column: its number (-1 for the root), the rows that groups start at, and columns of each row's node."""
        k, p1, p2 = (self.plain[c] for c in ("k", "p1", "p2"))
        n, changed = len(k), np.ones(len(k), bool)
        roots = int(np.searchsorted(k, 0, "right"))
        if roots:
            zero = np.zeros(n, np.int64)
            yield -1, np.array([0, roots] if roots < n else [0]), {
                "depth": zero, "key1": zero, "key2": zero, "up1": zero, "up2": zero, "path": zero,
            }
        changed[1:] = (k[1:] != k[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
        key1, key2, path = p1.copy(), p2.copy(), self.plain["before"].copy()
        for j in range(self.first.shape[1]):
            a, b = self.first[:, j], self.second[:, j]
            changed[1:] |= (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            up1, up2 = key1, key2
            key1, key2 = (up1 + a) & ID_MASK, (up2 + b) & ID_MASK
            yield j, np.flatnonzero(changed), {
                "depth": k * self.width + j + 1, "key1": key1, "key2": key2, "up1": up1, "up2": up2, "path": path,
            }
            path = path + self.spoken[:, j]

    def kept(self, j: int, starts: np.ndarray) -> np.ndarray:
        """Which groups are nodes: those of rows that reach the column, and the root's in column -1."""
        return self.sizes[starts] > j if j >= 0 else self.plain["k"][starts] == 0


def _gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _open(starts: np.ndarray, n: int) -> np.ndarray:
    """Groups at an edge of the range, which may go on beyond it."""
    return (starts == 0) | (np.append(starts[1:], n) == n)


def _represented(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _gathered(batches)
        if table is None:
            return
        matrix = _Matrix(table, width)
        conv, length, n = matrix.plain["conv_id"], matrix.plain["len"], table.num_rows
        for j, starts, of_row in matrix.nodes():
            keep = matrix.kept(j, starts)
            found = {c: of_row[c][starts][keep] for c in ("depth", "key1", "key2", "up1", "up2", "path")}
            found["open"] = _open(starts, n)[keep]
            found["n"] = np.diff(np.append(starts, n))[keep]
            found["conv_id"] = np.minimum.reduceat(conv, starts)[keep]
            found["deepest"] = np.maximum.reduceat(length, starts)[keep]
            yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in found.items()})

    return run


_NODES = "depth long, key1 long, key2 long, up1 long, up2 long, path long, open boolean, n long, conv_id long, deepest long"


def _ends(matrix: _Matrix, starts: np.ndarray, keep: np.ndarray, opened: np.ndarray, depth: np.ndarray):
    """Per node the digest of the conversations that end there; for open nodes their numbers as text, and the first."""
    conv, length = matrix.plain["conv_id"], matrix.plain["len"]
    ending = length == depth
    counts = np.add.reduceat(ending.astype(np.int64), starts)
    digests, chunks, firsts = [], [], []
    stops = np.append(starts[1:], len(conv))
    for g in np.flatnonzero(keep).tolist():
        text, first = "", None
        if counts[g]:
            # Rows with one path stand by conv_id, so these do as well.
            own = conv[starts[g] : stops[g]][ending[starts[g] : stops[g]]]
            text, first = ",".join(map(str, own.tolist())), int(own[0])
        digests.append(NO_ENDS if not text else sha256(text.encode()).hexdigest())
        chunks.append(text if opened[g] and text else None)
        firsts.append(first)
    return digests, chunks, firsts


def _added(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _gathered(batches)
        if table is None:
            return
        matrix = _Matrix(table, width)
        plain, n = matrix.plain, table.num_rows
        conv, top, length = plain["conv_id"], plain["top"], plain["len"]
        for j, starts, of_row in matrix.nodes():
            keep, opened = matrix.kept(j, starts), _open(starts, n)
            if not keep.any():
                continue
            depth = of_row["depth"]
            least = np.minimum.reduceat(conv, starts)
            # The row of each group's smallest member.
            at = np.flatnonzero(conv == np.repeat(least, np.diff(np.append(starts, n))))
            at = at[np.searchsorted(at, starts)]
            found = {c: of_row[c][starts][keep] for c in ("depth", "key1", "key2", "path")}
            found["open"] = opened[keep]
            found["n"] = np.diff(np.append(starts, n))[keep]
            found["conv_id"] = least[keep]
            for c in ("top", "shared", "parent"):
                found[f"own_{c}"] = plain[c][at][keep]
            sums = {"leaves": plain["leaf"], "children": (top <= depth) & (depth < length), "elsewhere": plain["shared"]}
            for c, v in sums.items():
                found[c] = np.add.reduceat(v.astype(np.int64), starts)[keep]
            arrays = {c: pa.array(v) for c, v in found.items()}
            digests, chunks, firsts = _ends(matrix, starts, keep, opened, depth)
            arrays |= {"ends": pa.array(digests, pa.string()), "chunk": pa.array(chunks, pa.string()), "first_end": pa.array(firsts, pa.int64())}
            yield pa.RecordBatch.from_pydict(arrays)

    return run


_SUMS = (
    "depth long, key1 long, key2 long, path long, open boolean, n long, conv_id long, own_top long, own_shared long, "
    "own_parent long, leaves long, children long, elsewhere long, ends string, chunk string, first_end long"
)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's chunks, which come in order; only one chunk is held at a time."""
    node, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            **{c: pa.array([v], pa.int64()) for c, v in zip(_KEY, node, strict=True)}, "ends": pa.array([digest.hexdigest()], pa.string()),
        })

    for batch in batches:
        keys = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _KEY), strict=True)
        for key, chunk in zip(keys, batch.column(batch.schema.get_field_index("chunk")), strict=True):
            if key != node:
                if node is not None:
                    yield done()
                node, digest = key, sha256()
            else:
                digest.update(b",")
            digest.update(chunk.as_py().encode())
    if node is not None:
        yield done()


def _ranged(rows: DataFrame, shard_rows: int) -> DataFrame:
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // shard_rows))
    # The conversation comes last, so that copies are dealt out too.
    return rows.repartitionByRange(n, "k", "p1", "p2", "ids", "conv_id")


def _whole(parts: DataFrame, **sums: Column) -> DataFrame:
    """Closed nodes as they are, open ones added up over the ranges they lie in."""
    names = [c for c in parts.columns if c not in _KEY and c != "open"]
    over = parts.where("open").groupBy(*_KEY).agg(*[sums.get(c, F.min(c)).alias(c) for c in names])
    return parts.where("not open").select(*_KEY, *names).unionByName(over)


def _representatives(rows: DataFrame, convs: DataFrame, width: int, shard_rows: int) -> DataFrame:
    """Per conversation ``len, top, shared, leaf, parent``.

    ``top`` is the depth down to which smaller conversations represent its path (-1 for the root's
    own), ``shared`` the words down to there, ``parent`` the conversation that represents that
    depth; ``leaf`` says whether its last turn is a leaf it represents.
    """
    parts = stored(_ranged(rows, shard_rows).mapInArrow(_represented(width), _NODES), "nodes")
    nodes = _whole(parts, n=F.sum("n"), deepest=F.max("deepest"))
    chains = nodes.groupBy("conv_id").agg(
        F.min(F.struct("depth", "up1", "up2", "path")).alias("begin"), F.max(F.col("deepest") == F.col("depth")).alias("leaf")
    )
    chains = stored(chains.select("conv_id", "leaf", "begin.*"), "chains")
    # A chain hangs on a node with two members or more. Most hang on the root, which needs no join.
    shared = nodes.where("n > 1").select(*_KEY, F.col("conv_id").alias("parent"))
    at = {"depth": F.col("depth") - 1, "key1": F.col("up1"), "key2": F.col("up2")}
    hanging = chains.where("depth > 1").select("conv_id", *[c.alias(name) for name, c in at.items()])
    parents = hanging.join(shared, list(_KEY)).select("conv_id", "parent")
    least = convs.agg(F.min("conv_id").alias("c")).first()["c"]
    known = chains.join(parents, "conv_id", "left").select(
        "conv_id", "leaf", (F.col("depth") - 1).alias("top"), F.col("path").alias("shared"),
        F.coalesce("parent", F.lit(least).cast("long")).alias("parent"),
    )
    totals = rows.groupBy("conv_id").agg(F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)).alias("total"))
    # Copies of a smaller conversation represent nothing: all of their path is shared.
    return convs.join(totals, "conv_id").join(known, "conv_id", "left").select(
        "conv_id", F.col("len").cast("long").alias("len"), F.coalesce("leaf", F.lit(False)).alias("leaf"),
        F.coalesce("top", F.col("len")).cast("long").alias("top"), F.coalesce("shared", "total").alias("shared"),
        F.coalesce("parent", "conv_id").alias("parent"),
    )


def prefix_trie(
    turns: DataFrame, convs: DataFrame, width: int = TURNS, shard_rows: int = SHARD_ROWS, ordered_rows: int = ORDERED_ROWS
) -> DataFrame:
    """The nodes of the trie of ``turns`` (``conv_id, at, id1, id2, words``); ``convs`` names all conversations with ``len``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. No conversations give no rows. Conversations may be of any
    length and be repeated any number of times: rows have ``width`` turns and matrices about
    ``shard_rows`` rows.
    """
    rows = stored(matrix_rows(turns, convs, width, ordered_rows).join(convs, "conv_id").withColumn("len", F.col("len").cast("long")), "rows")
    known = _representatives(rows, convs, width, shard_rows)
    second = stored(rows.drop("len").join(known, "conv_id"), "rows")
    parts = stored(_ranged(second, shard_rows).mapInArrow(_added(width), _SUMS), "parts")
    chunks = parts.where("open and chunk is not null").select(*_KEY, "first_end", "chunk")
    chained = chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "first_end").mapInArrow(
        _chained, "depth long, key1 long, key2 long, ends string"
    )
    own = F.struct("conv_id", "own_top", "own_shared", "own_parent").alias("own")
    held = parts.select(*_KEY, "open", "path", "n", own, "leaves", "children", "elsewhere", "ends")
    over = _whole(held.where("open"), **{c: F.sum(c) for c in ("n", "leaves", "children", "elsewhere")})
    over = over.drop("ends").join(chained, list(_KEY), "left").withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS)))
    nodes = held.where("not open").drop("open").unionByName(over)
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("own.own_top") + 1, F.col("own.conv_id")).otherwise(F.col("own.own_parent"))
    saved = F.col("elsewhere") - F.col("own.own_shared") - (F.col("n") - 1) * F.col("path")
    return nodes.select(
        F.col("own.conv_id").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame, width: int = TURNS, shard_rows: int = SHARD_ROWS, ordered_rows: int = ORDERED_ROWS
) -> DataFrame:
    """The prefix trie of the rebuilt conversations (see ``rebuilt`` and ``prefix_trie``).

    Turns stand by ``turn``, null first; turns alike in it by the digest of role and text, so repeated
    rows are repeated turns. Null roles and texts are empty ones. Rows without a ``conv_id`` belong to
    no conversation and are left out. Columns beside the four are not looked at.
    """
    placed = stored(placed_turns(conversations, ordered_rows), "turns")
    turns, convs = rebuilt(placed)
    return prefix_trie(turns, convs, width, shard_rows, ordered_rows)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all ``conversations``."""
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = f"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS p,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32_SQL.format('conv_id')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
r AS (
  SELECT c.conv_id, 0 AS side, o.p, role, text FROM c JOIN o ON o.conv_id = c.base AND o.p < c.h
  UNION ALL SELECT c.conv_id, 1, o.p, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.p >= c.h),
t AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER w) AS key,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY side, p ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, 0 AS depth, '' AS key, 0 AS words FROM c UNION ALL SELECT * FROM t),
l AS (SELECT conv_id, max(depth) AS len FROM m GROUP BY 1),
n AS (
  SELECT depth, key, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM m JOIN l ON l.conv_id = m.conv_id GROUP BY 1, 2),
up AS (
  SELECT n.depth, n.key, p.key AS parent, q.conv_id AS parent_conv_id
  FROM n JOIN m p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN n q ON q.depth = p.depth AND q.key = p.key),
kids AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n FROM up GROUP BY 1, 2),
s AS (
  SELECT a.depth, a.key, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM n JOIN m a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN kids ON kids.depth = n.depth AND kids.key = n.key
  GROUP BY 1, 2)
SELECT n.conv_id AS conv_id, CAST(n.depth AS BIGINT) AS depth, up.parent_conv_id AS parent_conv_id, n.n_convs AS n_convs,
       coalesce(kids.n, 0) AS n_children, s.n_leaves AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM n JOIN s ON s.depth = n.depth AND s.key = n.key
LEFT JOIN up ON up.depth = n.depth AND up.key = n.key LEFT JOIN kids ON kids.depth = n.depth AND kids.key = n.key"""
