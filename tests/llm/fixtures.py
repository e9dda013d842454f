"""Small document tables: plain, awkward, empty."""

import random

EXTRA = ["h", "row", "cid", "a", "b", "shard", "sequence_id", "kept", "_id", "n"]


def corpus(seed=3, n=60):
    """Texts with exact and near copies, shared passages, awkward and very long ones."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice(["th", "an", "er", "on", "ñe", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocab).capitalize() if rng.random() < 0.1 else rng.choice(vocab) for _ in range(k))
    passage = text(60)
    docs = [(i, text(rng.randint(30, 150))) for i in range(n)]
    for i in range(0, n, 6):
        docs[i] = (i, docs[i][1] + ". " + passage + "\n" + text(10))
    base = text(120)
    for i in range(1, n, 5):
        w = base.split()
        w[rng.randrange(len(w))] = "changed"
        docs[i] = (i, " ".join(w))
    docs[7] = (7, docs[2][1])
    docs[13] = (13, docs[2][1])
    docs += [(n, None), (n + 1, ""), (n + 2, "   \n "), (n + 3, "ab cd"), (n + 4, "AB  cd"), (n + 5, "a" * 500), (n + 6, "a" * 350),
             (n + 7, "x " * 5000), (n + 8, text(3000)), (n + 9, "é" * 120 + "\x00\x01 end"), (n + 10, passage)]
    return docs, passage


def frame(spark, docs, extra=True):
    cols = EXTRA if extra else []
    rows = [(d, t, "en", "s", 1, *[None] * len(cols)) for d, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                                 + "".join(f", {c} string" for c in cols))


def empty(spark):
    return frame(spark, [], False)


#: repeated rows, a null id, and one id with two texts
def awkward():
    t = "one two three four five six seven eight nine ten " * 12
    return [(1, t), (1, t), (2, t), (None, t), (None, None), (3, "other words here"), (3, "yet another text of words"), (4, None)]
