"""The operators' results worked out plainly, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def shingles(ws, width):
    if not ws:
        return []
    return [tuple(ws)] if len(ws) < width else [tuple(ws[i : i + width]) for i in range(len(ws) - width + 1)]


def dedup(rows):
    """doc_id -> (keep_id, group_size, sha256) of rows with unique ids."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[lower(text)].append(doc)
    return {doc: (max(ids), len(ids), hashlib.sha256(text.encode()).hexdigest()) for text, ids in groups.items() for doc in ids}


def jaccard(rows):
    """Row number -> (set size, row number of the first row of its component); rows in the order of their ids."""
    sets = [frozenset(shingles(words(text), 4)) for _, text in rows]
    lists, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, own in enumerate(sets):
        shared = Counter(o for s in own for o in lists[s])
        for o, n in shared.items():
            if 100 * n >= 85 * (len(own) + len(sets[o]) - n):
                a, b = find(k), find(o)
                parent[max(a, b)] = min(a, b)
        for s in own:
            lists[s].append(k)
    return [(len(own), find(k)) for k, own in enumerate(sets)]


def repeats(texts, length):
    """Per text: removed byte flags."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def leaks(docs, items):
    """(doc, item) -> best similarity of a window of the item's size, if 0.8 or more."""
    out = {}
    queries = [(item, words(query)) for item, query in items if words(query)]
    for doc, text in docs:
        w = words(text)
        own_shingles = {n: set(shingles(w, n)) for n in {min(5, len(q)) for _, q in queries}} if w else {}
        for item, q in queries:
            width = min(5, len(q))
            bag = Counter(shingles(q, width))
            if not w or own_shingles[width].isdisjoint(bag):
                continue
            for at in range(max(1, len(w) - len(q) + 1)):
                own = Counter(shingles(w[at : at + len(q)], width))
                s = sum((own & bag).values()) / sum((own | bag).values())
                if s >= 0.8 and s > out.get((doc, item), 0):
                    out[doc, item] = s
    return out


def fill(items, total):
    """items: (weight, cap); the amounts of a total shared by weight, none above its cap."""
    amount, open_ = {}, set(range(len(items)))
    while open_:
        level = (total - sum(amount.values())) / sum(items[k][0] for k in open_)
        full = [k for k in open_ if items[k][0] * level >= items[k][1]]
        if not full:
            return [amount.get(k, items[k][0] * level) for k in range(len(items))]
        for k in full:
            amount[k] = items[k][1]
            open_.discard(k)
    return [amount[k] for k in range(len(items))]


def mix(rows):
    """rows: (doc, source, text) -> list of (size, source size, target, copies)."""
    size = [len(WORD.findall(t or "")) for _, _, t in rows]
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    sums = {s: sum(n for n, r in zip(size, rows) if r[1] == s) for s in sources}
    targets = dict(zip(sources, fill([((5, 2, 1)[k % 3], 2 * sums[s]) for k, s in enumerate(sources)], 1.5 * sum(size))))
    copies = [0] * len(rows)
    for s in sources:
        own = [k for k, r in enumerate(rows) if r[1] == s and size[k]]
        classes = sorted({size[k].bit_length() for k in own})
        total = {b: sum(size[k] for k in own if size[k].bit_length() == b) for b in classes}
        share = fill([((64 - b) * total[b], 2 * total[b]) for b in classes], targets[s])
        expected = {b: x / total[b] for b, x in zip(classes, share)}
        quota = targets[s] - sum(int(expected[b] + 1e-12) * total[b] for b in classes)
        ranked = []
        for k in own:
            e = expected[size[k].bit_length()]
            copies[k], part = int(e + 1e-12), e - int(e + 1e-12)
            if part > 1e-12:
                u = (int(hashlib.md5(str(rows[k][0] if rows[k][0] is not None else "").encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                ranked.append(((u / (1 - u)) / (part / (1 - part)), k))
        upto = 0
        for _, k in sorted(ranked):
            upto += size[k]
            if upto - size[k] / 2 <= quota:
                copies[k] += 1
    return [(size[k], sums[r[1]], targets[r[1]], copies[k]) for k, r in enumerate(rows)]
