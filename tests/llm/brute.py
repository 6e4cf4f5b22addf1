"""The operators' contracts restated the plain way, over rows held in memory."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def roots(nodes, pairs):
    """Smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """The sharing as the contract tells it: stop at the cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, free = {}, set(names)
    left = share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            got |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            got[s] = most * sizes[s]
            left -= got[s]
        free -= over
    return got


def simhash(text) -> int:
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(fps: dict) -> dict:
    ids = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 4]
    return roots(ids, pairs)


def quality(text) -> tuple:
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


def without_repeats(docs: dict, size: int = 20) -> dict:
    """doc_id -> (n_words, n_removed, kept text)."""
    seen, out = set(), {}
    for d in sorted(docs):
        w = words(docs[d])
        gone = set()
        for i in range(len(w) - size + 1):
            window = tuple(w[i : i + size])
            if window in seen:
                gone.update(range(i, i + size))
            seen.add(window)
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def crc32(ids) -> int:
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


def check_packing(rows, ids_of, capacity=2048) -> int:
    """Bins used, after checking that rows hold every document whole and every bin is gapless.

    ``rows``: (doc_id, piece, start, length, crc, sequence_id, offset); ``ids_of``: doc_id -> ids.
    """
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for d, piece, start, length, crc, sequence, offset in rows:
        by_doc[d].append((piece, start, length, crc))
        by_bin[sequence].append((offset, length))
    assert by_doc.keys() == ids_of.keys()
    for d, found in by_doc.items():
        ids, at = ids_of[d], 0
        found.sort()
        assert [p[0] for p in found] == list(range(len(found)))
        for k, (_, start, length, crc) in enumerate(found):
            assert start == at and crc == crc32(ids[start : start + length])
            assert length <= capacity and (k == 0 or length == capacity)
            at += length
        assert at == len(ids)
        assert len(found) == -(-len(ids) // capacity)
    for found in by_bin.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_bin)


def repair(rows) -> tuple:
    """The contract of conversation repair over rows (turn, role, text): damage done, any order.

    Suffix by suffix: best[state] is the cheapest (cost, letters, output roles) from here to the end.
    """
    import functools

    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    fault, seen = [], set()
    for _, role, text in rows:
        last = text.strip(" \t\n\x0b\x0c\r")[-1:]
        kind = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
        fault.append(kind)
        seen.add((role, text))
    letters = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i: int, state: str, put: int):
        """put: inserts since the last row; more than two are never of use."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        steps = []
        if put < 2:
            steps += [(3, "I", x, i, put + 1) for x in "ua"]
        if i < len(rows):
            cut = 3 * (fault[i] == "truncated")
            steps.append((4, "D", "", i + 1, 0))
            if fault[i] in ("", "truncated"):
                steps.append((cut, "K", letters[i], i + 1, 0))
                steps += [(3 + cut, "R", x, i + 1, 0) for x in "ua"]
        for cost, letter, role, j, n in steps:
            after = state if letter == "D" else moves.get((state, role))
            if after is not None and (rest := best(j, after, n)):
                found.append((cost + rest[0], letter + rest[1], (role, *rest[2])))
        return min(found, default=None)

    cost, audit, roles = best(0, "", 0)
    out, i = [], 0
    for letter, role in zip(audit, roles):
        name = {"u": "user", "a": "assistant"}.get(role)
        if letter == "I":
            out.append(f"{name}:")
            continue
        if letter != "D":
            out.append(f"{rows[i][1] if letter == 'K' else name}:{rows[i][2]}")
        i += 1
    counts = [sum(f == k for f in fault) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damage(conv, turn, role, text) -> list:
    role, text = role if role is not None else " ", text if text is not None else " "
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    harm = zlib.crc32(key.encode()) % 20
    text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
    role = "user" if harm == 4 else role
    return [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)


def hard_negatives(rows) -> Counter:
    """Every score by plain integers, rows (vec_id, vector, label)."""
    taken = []
    for vec_id, vector, label in rows:
        if None in (vec_id, label) or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        taken.append((vec_id, label, [math.floor(256 * x) for x in vector]))
    out = []
    for k, (vec_id, label, q) in enumerate(taken):
        if vec_id % 50:
            continue
        scored = [
            (-sum(map(int.__mul__, q, v)), other, its == label)
            for j, (other, its, v) in enumerate(taken)
            if j != k and len(v) == len(q)
        ]
        for p, positive, _ in sorted(x for x in scored if x[2])[:5]:
            inside = sorted(x for x in scored if not x[2] and -50 * p <= -100 * x[0] <= -95 * p)
            out += [(vec_id, positive, r, n, -p, -s) for r, (s, n, _) in enumerate(inside[:3], 1)]
    return Counter(out)


def multiset(rows) -> Counter:
    return Counter(map(tuple, rows))
