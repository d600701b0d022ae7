"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = _WORD.findall(low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(rows, percent=75):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    for i, found in sets.items():
        for s in found:
            holders[s].append(i)
    common = defaultdict(int)
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x):
                common[held[y], held[x]] += 1
    links = [
        (a, b) for (a, b), n in common.items()
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)
    ]
    of = components(sets, links)
    return {i: (len(sets[i]), of[i]) for i in sets}


def repeats(texts, length=400):
    """[(n_bytes, n_removed, n_spans, kept bytes)] of the texts."""
    from collections import Counter

    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i : i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[hash(d[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        flags = bytes(gone)
        spans = sum(1 for i, g in enumerate(flags) if g and (i == 0 or not flags[i - 1]))
        out.append((len(d), sum(flags), spans, bytes(c for c, g in zip(d, flags, strict=True) if not g)))
    return out


def digest(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def merkle(rows, fan=8):
    """{number of the row: (leaf, subroot, root, proof, folded, verified)} of (doc_id, source, lang, n_chars, text) rows."""
    import zlib

    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def low(text):
        return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    def grow(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
        return levels

    def way(levels, at):
        for level in levels[:-1]:
            run = level[at // fan * fan : at // fan * fan + fan]
            yield run[: at % fan], run[at % fan + 1 :]
            at //= fan

    groups = defaultdict(list)
    for i, (doc, source, lang, n, text) in enumerate(rows):
        groups[(lang is not None, (lang or "").encode())].append((doc is not None, doc or 0, leaf((doc, source, lang, n, text)), i))
    trees = {g: (grow([m[2] for m in sorted(held)]), sorted(held)) for g, held in groups.items()}
    names = sorted(trees)
    top, out = grow([trees[g][0][-1][0] for g in names]), {}
    for place, g in enumerate(names):
        levels, held = trees[g]
        for at, (_, _, own, i) in enumerate(held):
            path = [*way(levels, at), *way(top, place)]
            doc, source, lang, n, text = rows[i]
            cur = own
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                cur = leaf((doc, source, lang, n, low(text)))
            for left, right in path:
                cur = digest("".join([*left, cur, *right]))
            proof = digest("".join("".join(left + right) for left, right in path))
            out[i] = (own, levels[-1][0], top[-1][0], proof, cur, cur == top[-1][0])
    return out


def trie(rows):
    """{(conv_id, depth): (parent, members, children, leaves, saved, ends)} of (conv_id, turn, role, text) rows."""
    import zlib

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - int(abs(c) % 20 * (1 if c >= 0 else -1)), [])[:h] + turns[h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c in sorted(made):
        path = tuple(made[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d < len(path):
                kids[path[:d]].add(path[: d + 1])
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, held in members.items():
        words = len(_WORD.findall(path[-1][1].encode())) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(held) - 1) * words
    return {
        (held[0], len(path)): (
            members[path[:-1]][0] if path else None, len(held), len(kids[path]), leaves[path], saved[path],
            digest(",".join(str(c) for c in held if len(made[c]) == len(path))),
        )
        for path, held in members.items()
    }
