"""Merkle manifests: trees of digests kept as postorder logs, with proofs read by closed-form positions.

The leaves of a group are numbered in order and cut into aligned blocks of ``fan ** levels``. One
builder per block appends every node at the moment it is complete, so its log is the postorder of
the block's subtree. Block roots are the leaves of the next round, until one block is left for each
group; the roots of the groups go through the same rounds once more.

No index goes with a log. A node's place follows from the sizes of the subtrees before it
(``log_place``), and so the siblings on the way from a leaf to its block's root are looked up
directly. What lies above a block is one short path per block, handed down round by round.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.ordered import ordered_scan, position
from tallyline.session import stored

#: Fixed value of the manifest: nodes in one run.
FAN = 8
#: Levels that one builder adds, so its block has at most 4096 leaves.
LEVELS = 4
#: Rows of one group that are numbered in one task; larger groups are cut into ranges.
ORDERED_ROWS = 32_768
SIZE = 32


def leaf_digest(*columns: Column | str) -> Column:
    """Hex SHA-256 of the columns: ``-`` for null, else UTF-8 bytes, ``:`` and the value as text."""
    parts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def height(leaves: int, fan: int = FAN) -> int:
    """Levels above ``leaves`` nodes until one is left."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // fan)
        levels += 1
    return levels


def log_place(level: int, index: np.ndarray, leaves: int, fan: int = FAN) -> np.ndarray:
    """Place in a postorder log of the nodes ``index`` of a level (leaves are level 0).

    A node is written behind its last leaf and the ``level - 1`` nodes that this leaf completes
    before it. Before leaf ``i`` stand ``i`` leaves and, for each level, the ``i // fan ** m`` nodes
    that are complete by then. The last run may be short: its last leaf is the last one there is.
    """
    last = np.minimum((index + 1) * fan**level, leaves) - 1
    place, step = last.copy(), fan
    while step < leaves:
        place += last // step
        step *= fan
    return place + level


def append_log(leaves: Sequence[bytes], levels: int, fan: int = FAN) -> list[bytes]:
    """All nodes over ``leaves`` (hex digests) up to the root ``levels`` above, in completion order."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = sha256(b"".join(runs[level])).hexdigest().encode()
        runs[level].clear()
        log.append(node)
        runs[level + 1].append(node)

    for leaf in leaves:
        log.append(leaf)
        runs[0].append(leaf)
        level = 0
        while level < levels and len(runs[level]) == fan:
            close(level)
            level += 1
    for level in range(levels):
        if runs[level]:
            close(level)
    return log


def _levels_of(block: int, leaves: int, fan: int, levels: int) -> int:
    """A first block that is not full is all there is of its group, and ends at its own root."""
    return height(leaves, fan) if block == 0 and leaves < fan**levels else levels


def _built(fan: int, levels: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block, n = table.column("block")[0].as_py(), table.num_rows
        log = append_log([d.hex().encode() for d in table.column("digest").to_pylist()], _levels_of(block, n, fan, levels), fan)
        return pa.table({
            "grp": table.column("grp")[:1], "block": pa.array([block], pa.int64()), "leaves": pa.array([n], pa.int64()),
            "log": pa.array([bytes.fromhex(b"".join(log).decode())], pa.binary()),
            "root": pa.array([bytes.fromhex(log[-1].decode())], pa.binary()),
        })

    return run


def _steps(block: int, leaves: int, log: bytes, fan: int, levels: int) -> list[list[str]]:
    """Per level of a block its runs, each as the joined hex digests of its nodes."""
    nodes, out = np.frombuffer(log, f"V{SIZE}"), []
    for level in range(_levels_of(block, leaves, fan, levels)):
        size = -(-leaves // fan**level)
        text = nodes[log_place(level, np.arange(size), leaves, fan)].tobytes().hex()
        wide = 2 * SIZE * fan
        out.append([text[i : i + wide] for i in range(0, len(text), wide)])
    return out


def _split(run: str, own: int) -> tuple[str, str]:
    return run[: 2 * SIZE * own], run[2 * SIZE * (own + 1) :]


def _siblings(steps: list[list[str]], index: int, fan: int) -> list[tuple[str, str]]:
    """What stands left and right of a leaf's ancestors, and of itself, in their runs."""
    out = []
    for runs in steps:
        out.append(_split(runs[index // fan], index % fan))
        index //= fan
    return out


def _pack(path: Sequence[tuple[str, str]]) -> bytes:
    return b"".join(bytes([len(a) // (2 * SIZE), len(b) // (2 * SIZE)]) + bytes.fromhex(a + b) for a, b in path)


def _unpack(path: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(path):
        left, right = SIZE * path[at], SIZE * path[at + 1]
        at += 2
        out.append((path[at : at + left].hex(), path[at + left : at + left + right].hex()))
        at += left + right
    return out


def fold(digest: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def _handed_down(fan: int, levels: int) -> Callable:
    def run(elements: pa.Table, above: pa.Table) -> pa.Table:
        block, n = above.column("block")[0].as_py(), above.column("leaves")[0].as_py()
        steps = _steps(block, n, above.column("log")[0].as_py(), fan, levels)
        rest = above.column("path")[0].as_py()
        at = elements.column("at").to_pylist()
        paths = [_pack(_siblings(steps, i - block * fan**levels, fan)) + rest for i in at]
        subroot = above.column("subroot")[0].as_py()
        return pa.table({
            "grp": elements.column("grp"), "block": pa.array(at, pa.int64()), "path": pa.array(paths, pa.binary()),
            "subroot": pa.array([subroot] * len(at), pa.binary()),
        })

    return run


def _proven(fan: int, levels: int) -> Callable:
    def run(leaves: pa.Table, above: pa.Table) -> pa.Table:
        block, n = above.column("block")[0].as_py(), above.column("leaves")[0].as_py()
        steps = _steps(block, n, above.column("log")[0].as_py(), fan, levels)
        upper = _unpack(above.column("path")[0].as_py())
        proofs, folded = [], []
        for at, digest, changed in zip(*(leaves.column(c).to_pylist() for c in ("at", "digest", "changed")), strict=True):
            path = _siblings(steps, at - block * fan**levels, fan) + upper
            proofs.append(sha256("".join(a + b for a, b in path).encode()).hexdigest())
            folded.append(fold((changed or digest).hex(), path))
        return pa.table({
            "row": leaves.column("row"), "leaf": pa.array([d.hex() for d in leaves.column("digest").to_pylist()], pa.string()),
            "subroot": pa.array([above.column("subroot")[0].as_py().hex()] * len(proofs), pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string()),
        })

    return run


_LOG = "grp string, block long, leaves long, log binary, root binary"
_PATH = "grp string, block long, path binary, subroot binary"


@dataclass(frozen=True)
class Manifest:
    """The logs of all rounds, lowest first, beside the elements they are built from, and the root.

    ``logs`` tables have ``grp, block, leaves, log, root``: the digests of a block, 32 bytes each,
    in postorder. ``root`` is None for a manifest without leaves.
    """

    rounds: list[tuple[DataFrame, DataFrame]]
    top: list[tuple[DataFrame, DataFrame]]
    names: DataFrame
    root: str | None
    fan: int
    levels: int


def _grown(elements: DataFrame, fan: int, levels: int) -> list[tuple[DataFrame, DataFrame]]:
    rounds = []
    while True:
        elements = elements.withColumn("block", F.floor(F.col("at") / F.lit(fan**levels)).cast("long"))
        parts = elements.select("grp", "block", "at", "digest").groupBy("grp", "block")
        logs = stored(parts.applyInArrow(_built(fan, levels), _LOG), "merkle-log")
        rounds.append((elements, logs))
        if not logs.agg(F.max("block").alias("b")).first()["b"]:
            return rounds
        elements = logs.select("grp", F.col("block").alias("at"), F.col("root").alias("digest"))


def build_manifest(
    rows: DataFrame, group: Column | str, order: Sequence[str], fan: int = FAN, levels: int = LEVELS,
    ordered_rows: int = ORDERED_ROWS,
) -> Manifest:
    """The manifest of ``rows``, which have ``row``, ``leaf`` and ``changed`` (hex digests or null) and what ``order`` names.

    Groups stand in the order of their names, null first, bytewise. Rows alike in ``order`` stand in
    the order of their leaves; null comes first. A group may hold any share of the rows: it is numbered by
    ranges, and no task has more than a block of it. Logs and elements are stored tables.
    """
    name = F.col(group) if isinstance(group, str) else group
    # "-" sorts before "=", so null comes before every name.
    named = rows.withColumn("grp", F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit("-")))
    # Texts are read and hashed once; counts, ranges and windows go over digests.
    named = stored(named, "merkle-rows")
    placed = ordered_scan(named, ["grp"], [*order, "leaf"], ordered_rows, at=position())
    leaves = stored(placed.select(
        "grp", "at", F.unhex("leaf").alias("digest"), F.unhex("changed").alias("changed"), "row",
    ), "merkle-leaves")
    rounds = _grown(leaves, fan, levels)
    subroots = rounds[-1][1].select(F.lit("").alias("all"), F.col("grp").alias("name"), "root")
    numbered = ordered_scan(subroots, ["all"], ["name"], ordered_rows, at=position())
    names = stored(numbered.select(F.col("all").alias("grp"), "at", F.col("root").alias("digest"), "name"), "merkle-groups")
    top = _grown(names, fan, levels)
    row = top[-1][1].select(F.lower(F.hex("root")).alias("root")).first()
    return Manifest(rounds, top, names, row["root"] if row else None, fan, levels)


def _descend(manifest: Manifest, rounds: list[tuple[DataFrame, DataFrame]], above: DataFrame) -> DataFrame:
    """Paths of the elements of the lowest of ``rounds``, from those of the blocks of the highest."""
    for elements, logs in reversed(rounds):
        blocks = logs.drop("root").join(above, ["grp", "block"])
        asked = elements.select("grp", "block", "at")
        above = asked.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block")).applyInArrow(
            _handed_down(manifest.fan, manifest.levels), _PATH
        )
    return above


def extract_proofs(manifest: Manifest) -> DataFrame:
    """Per leaf ``row, leaf, subroot, proof_sha256, folded_root``.

    ``folded_root`` comes from the changed leaf, where there is one, and the stored siblings.
    """
    none = F.lit(b"")
    highest = manifest.top[-1][1].select("grp", "block", none.alias("path"), none.alias("subroot"))
    of_groups = _descend(manifest, manifest.top, highest).select(F.col("block").alias("at"), "path")
    above = manifest.names.join(of_groups, "at").select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), "path", F.col("digest").alias("subroot")
    )
    above = _descend(manifest, manifest.rounds[1:], above)
    leaves, logs = manifest.rounds[0]
    blocks = logs.drop("root").join(above, ["grp", "block"])
    kind = leaves.schema["row"].dataType.simpleString()
    return leaves.groupBy("grp", "block").cogroup(blocks.groupBy("grp", "block")).applyInArrow(
        _proven(manifest.fan, manifest.levels),
        f"row {kind}, leaf string, subroot string, proof_sha256 string, folded_root string",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def document_manifest(docs: DataFrame, fan: int = FAN, levels: int = LEVELS, ordered_rows: int = ORDERED_ROWS) -> tuple[Manifest, DataFrame]:
    """The manifest of documents, a tree per ``lang`` by ``doc_id``, and the proof of each row.

    Rows with a null or repeated ``doc_id`` are leaves like any other, null first, alike ones by
    digest. Where 3 divides the CRC-32 of the decimal ``doc_id``, the leaf is folded with its text
    lower-cased (A to Z); a null ``doc_id`` or text stays. Null columns are ``-`` in the leaf, empty
    texts are values of no bytes. Columns beside the five are not looked at. No rows give no rows.
    """
    ident = F.col("doc_id").cast("string")
    tampered = F.crc32(ident) % 3 == 0
    columns = ("doc_id", "source", "lang", "n_chars")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "lang",
        leaf_digest(*columns, "text").alias("leaf"),
        F.when(tampered, leaf_digest(*columns, F.translate("text", _UPPER, _LOWER))).alias("changed"),
    )
    manifest = build_manifest(rows, "lang", ["doc_id"], fan, levels, ordered_rows)
    found = extract_proofs(manifest)
    root = F.lit(manifest.root).cast("string")
    return manifest, found.select(
        F.col("row").alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``documents``, checked against its tampered text."""
    return document_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))[1]


#: CRC-32 of a decimal number; the polynomial is a fixed value.
CRC32_SQL = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)))"""


def _sql() -> str:
    def enc(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    plain, changed = (
        f"sha256({' || '.join(enc(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})" for text in ("text", lowered)
    )
    # Eight levels hold 16 million leaves of a language, two more 64 languages.
    parts = [f"""d AS (SELECT doc_id, lang, {plain} AS h,
  CASE WHEN {CRC32_SQL.format('doc_id')} % 3 = 0 THEN {changed} END AS c FROM documents)""",
        """t0 AS (SELECT doc_id, lang, h, c, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS p,
  count(*) OVER (PARTITION BY lang) AS n FROM d)""",
        "f0 AS (SELECT doc_id, lang, p AS leaf_at, p, h, coalesce(c, h) AS cur, '' AS proof FROM t0)"]

    def level(k: int, tree: str, fold: str) -> None:
        parts.append(f"""{tree}{k + 1} AS (SELECT lang, p // 8 AS p, (any_value(n) + 7) // 8 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h
  FROM {tree}{k} GROUP BY lang, p // 8)""")
        parts.append(f"""{fold}{k + 1} AS (SELECT any_value(f.doc_id) AS doc_id, f.lang AS lang, leaf_at, any_value(f.p) // 8 AS p, any_value(f.h) AS h,
  CASE WHEN any_value(s.n) = 1 THEN any_value(cur) ELSE sha256(string_agg(CASE WHEN s.p = f.p THEN cur ELSE s.h END, '' ORDER BY s.p)) END AS cur,
  any_value(proof) || coalesce(string_agg(s.h, '' ORDER BY s.p) FILTER (s.p <> f.p), '') AS proof
  FROM {fold}{k} f JOIN {tree}{k} s ON s.lang IS NOT DISTINCT FROM f.lang AND s.p // 8 = f.p // 8
  GROUP BY f.lang, leaf_at)""")

    for k in range(8):
        level(k, "t", "f")
    parts.append("""r AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM t8)""")
    parts.append("u0 AS (SELECT 0 AS lang, p, n, subroot AS h FROM r)")
    parts.append("""g0 AS (SELECT f.doc_id, 0 AS lang, r.lang AS own, f.leaf_at AS own_at, r.p AS p, f.h AS h, f.cur AS cur, f.proof AS proof, r.subroot AS subroot,
  row_number() OVER (ORDER BY f.lang, f.leaf_at) AS leaf_at FROM f8 f JOIN r ON r.lang IS NOT DISTINCT FROM f.lang)""")
    for k in range(2):
        level(k, "u", "g")
    parts.append("""x AS (SELECT g2.doc_id AS doc_id, g2.h AS leaf, subroot, (SELECT h FROM u2) AS root, sha256(g2.proof) AS proof_sha256, g2.cur AS folded_root
  FROM g2 JOIN g0 ON g0.leaf_at = g2.leaf_at)""")
    return f"WITH {', '.join(parts)} SELECT *, folded_root = root AS verified FROM x"


OP11_SQL = _sql()
