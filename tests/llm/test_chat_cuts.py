"""The rows of a repair do not depend on where the table is cut."""

import itertools

import numpy as np
import pandas as pd

from lectern.llm import chat

NAMES = ["odd", "system", "user", "assistant"]


def test_documented_order():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            best = None
            for way in itertools.product((1, 2, 3), repeat=n):
                steps = list(zip((0, *way), roles, way))
                if all((s, q) in chat.MOVES for s, _, q in steps):
                    costs = [int(chat.STEPS[r][s][q]) for s, r, q in steps]
                    key = (sum(costs), [(q != r, c, q) for (_, r, q), c in zip(steps, costs)], way)
                    best = key if best is None else min(best, key)
            cost, states = chat.repair(list(roles))
            assert (cost, tuple(states.tolist())) == (best[0], best[2]), roles


def test_same_rows_wherever_cut(spark, monkeypatch):
    rng = np.random.default_rng(8)
    convs = [rng.integers(0, 4, rng.integers(1, 14)).tolist() for _ in range(60)] + [[2, 0, 3], [2, 1, 1]] * 5
    turns = [(c, i, NAMES[r], f"t{c}.{i}") for c, rs in enumerate(convs) for i, r in enumerate(rs)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")

    def rows(stretch, per_part):
        monkeypatch.setattr(chat, "STRETCH", stretch)
        return chat.format_chat(df, rows=per_part).drop("seq").toPandas().sort_values(["conv_id", "turn"], ignore_index=True)

    whole = rows(1 << 12, 1 << 20)
    for stretch, per_part in ((3, 1 << 20), (2, 1 << 20), (1 << 12, 25)):
        pd.testing.assert_frame_equal(rows(stretch, per_part), whole)
    after = [chat.ROLES.index(x) for x in whole["role"]]
    assert after == [int(q) for rs in convs for q in chat.repair(rs)[1]]
