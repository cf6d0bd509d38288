"""Plain answers for small tables, written from the rules alone."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring(rows, size=50):
    """rows: (doc_id, text) -> bag of (doc_id, n_words, n_removed, sha)."""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: float("inf") if i is None else i
    least = {}
    for i, w in split:
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            least[key] = min(least.get(key, float("inf")), order(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if least[tuple(w[p : p + size])] < order(i):
                gone[p : p + size] = [True] * size
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def suffixes(rows, size=400):
    """rows: (doc_id, text) -> bag of (doc_id, n_bytes, n_removed, n_spans, sha)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = defaultdict(int)
    for _, b in data:
        for p in range(len(b) - size + 1):
            count[b[p : p + size]] += 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if count[b[p : p + size]] > 1:
                gone[p : p + size] = b"\1" * size
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def quality_base(rows):
    """rows: (doc_id, text) -> bag of (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        places = defaultdict(list)
        for p in range(len(w) - 2):
            places[tuple(w[p : p + 3])].append(p)
        again = {q for ps in places.values() if len(ps) > 1 for p in ps for q in (p, p + 1, p + 2)}
        bad = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again), bad))
    return out


def conversations(rows):
    """rows: (conv_id, turn, role, text) -> bag of (conv_id, n_turns, turns sha, loss_chars, loss sha)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is None, t or 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(said), sha(said)))
    return out


def contained(docs, items, size=5, threshold=0.8):
    """docs: (doc_id, text), items: (item_id, text) with distinct sets -> bag of (doc_id, item_id, n_shingles, n_shared)."""
    def shingles(t):
        w = re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", (t or "").lower())
        return {tuple(w[p : p + size]) for p in range(max(1, len(w) - size + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in items]
    out = []
    for d, t in docs:
        mine = shingles(t)
        for i, s in sets:
            if s and len(s & mine) >= threshold * len(s) - 1e-9:
                out.append((d, i, len(s), len(s & mine)))
    return out


def near_duplicates(rows, size=4, percent=85):
    """rows: (doc_id, text) -> bag of (doc_id, n_shingles, component_id)."""
    sets = []
    for _, t in rows:
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(t or "")]
        sets.append({tuple(w[p : p + size]) for p in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * min(len(sets[x]), len(sets[y])) >= percent * max(len(sets[x]), len(sets[y])):
                shared = len(sets[x] & sets[y])
                if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                    root[find(x)] = find(y)
    least = {}
    order = lambda i: (1 << 63) - 1 if i is None else i
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), 1 << 63), order(i))
    return [(i, len(sets[x]), least[find(x)]) for x, (i, _) in enumerate(rows)]


def clusters(rows, size=64, clusters=8, rounds=10, scale=1024):
    """rows: (vec_id, vector) -> bag of (vec_id, cluster, distance, cluster_inertia, inertia, centroid sha)."""
    points = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            points.append((i, [math.floor(scale * x) for x in v]))
    key = lambda p: (sha(f"3:{'' if p[0] is None else p[0]}"), p[1])
    centroids = [p for _, p in sorted(points, key=key)[:clusters]]
    apart = lambda p, c: sum((x - y) ** 2 for x, y in zip(p, c, strict=True))
    for n in range(rounds + 1):
        best = [min((apart(p, c), k) for k, c in enumerate(centroids)) for _, p in points]
        if n < rounds:
            for k in range(len(centroids)):
                mine = [p for (_, p), b in zip(points, best, strict=True) if b[1] == k]
                if mine:
                    centroids[k] = [sum(xs) // len(mine) for xs in zip(*mine, strict=True)]
    part = defaultdict(int)
    for d, k in best if points else []:
        part[k] += d
    whole = sum(part.values())
    return [
        (i, k, d, part[k], whole, sha(",".join(map(str, centroids[k]))))
        for (i, _), (d, k) in zip(points, best if points else [], strict=True)
    ]


def trie(rows):
    """rows: (conv_id, turn, role, text) -> list of (conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends sha)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [v[2:] for v in sorted(vs)] for c, vs in by.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - int(math.fmod(c, 5)), [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    out = []
    children = defaultdict(list)
    for n in members:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) if children[n] else 1
        saved[n] = sum(saved[x] for x in children[n]) + ((len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0)
        ends = ",".join(str(c) for c in sorted(members[n]) if built[c] == n)
        parent = min(members[n[:-1]]) if n else None
        out.append((min(members[n]), len(n), parent, len(members[n]), len(children[n]), leaves[n], saved[n], sha(ends)))
    return out
