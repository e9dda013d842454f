"""Brute-force versions of the operators, over small lists of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = defaultdict(set)
    for i, t in items:
        w = cut(t)
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[j:j + n])].add(str(i))
    sizes = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, found = cut(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j:j + n])) in grams:
                    hit.update(range(j, j + n))
                    found |= grams[g]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def spans(docs, size=100):
    """Rows with distinct ids; ascending doc_id."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: x[0]):
        b = (t or "").encode()
        mark = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i:i + size]
            if s in seen:
                mark[i:i + size] = b"\1" * size
            seen.add(s)
        kept = bytes(x for x, m in zip(b, mark) if not m)
        runs = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        out.append((d, len(b), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def exact(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    return {d: (max(groups[t or ""]), len(groups[t or ""]), d == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for d, t in docs}


def repair_cost(roles):
    """Least cost by search over all sequences of final roles, merges and insertions."""
    from heapq import heappop, heappush
    step = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
    heap, best = [(0, 0, 0)], {}
    while heap:
        cost, i, s = heappop(heap)
        if best.get((i, s), cost + 1) <= cost:
            continue
        best[i, s] = cost
        if i == len(roles):
            return cost
        for n in step[s]:
            heappush(heap, (cost + 2 * (n != roles[i]), i + 1, n))
            heappush(heap, (cost + 3, i, n))  # an empty message
        if s:
            heappush(heap, (cost + 1 + 2 * (s != roles[i]), i + 1, s))
    return None


def ids_of(text, end):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    global _TOK
    _TOK = globals().get("_TOK") or Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(_TOK.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def crc(a):
    return zlib.crc32(a.tobytes())


__all__ = ["Counter"]
