"""Chat formatting: minimum-cost role repair over a legal-turn automaton.

A legal conversation is an optional system turn, then user and assistant in turn, beginning
with user.  Each source turn is kept, relabelled (cost 2), or merged into the message before it
(cost 1, same final role); an empty message may be put before it (cost 3 each).  Dynamic
programming finds the cheapest repair; among equals, the one that prefers keeping, then merging,
then relabelling, then inserting at the earliest turn.  The repaired sequence is rendered as

    <|im_start|>role\\ntext<|im_end|>\\n

States are the role of the message that a turn is in: 0 before the first, 1 system, 2 user,
3 assistant.  A stretch of turns is a 4 x 4 matrix of least costs between states, and matrices
of neighbouring stretches combine by (min, +) products; so a conversation of any length may lie
over many partitions.  Turns are range-partitioned in order, each partition reduces its stretch
of each conversation to a matrix, the few matrices of a conversation that crosses partitions are
chained to the least costs from each stretch's end on; each stretch tells by the order above in
which state a way from each state leaves it, so the states between stretches, and with them the
rows, are the same wherever a conversation is cut.  Each stretch then traces its turns.  Output is one
row per source turn, with the piece of rendered text that it contributes, so that no row or task
holds a conversation: the pieces in order of (conv_id, seq) are the rendered conversations.

Null or unknown roles cost a relabelling to any role (human, gpt and the like are read as
aliases); null text is empty; turns order by turn, then role and a hash of the text, nulls first;
repeated rows are turns of their own; rows with a null conv_id are one conversation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import materialise, parts_for

ROLES = ["", "system", "user", "assistant"]
#: fixed values: other names of the roles
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant",
           "ai": "assistant", "developer": "system"}
MERGE, RELABEL, INSERT = 1, 2, 3
ROWS = 200_000
_INF = 1 << 40


def _moves():
    """For (state, final role): (cost besides relabelling, merged, inserted roles)."""
    step = {0: [1, 2], 1: [2], 2: [3], 3: [2]}
    out = {}
    for s in range(4):
        for r in (1, 2, 3):
            options = []
            if s == r:
                options.append((MERGE, True, []))
            # a path of legal messages from s to r; those on the way are empty
            front = [(n, []) for n in step[s]]
            for _ in range(3):
                options += [(INSERT * len(way), False, way) for n, way in front if n == r]
                front = [(m, [*way, n]) for n, way in front for m in step[n]]
            if options:
                out[s, r] = min(options, key=lambda o: (o[0], not o[1], len(o[2])))
    return out


MOVES = _moves()


def _step(role: int) -> np.ndarray:
    """4 x 4 costs of a turn from state to state."""
    m = np.full((4, 4), _INF, np.int64)
    for (s, r), (cost, _, _) in MOVES.items():
        m[s, r] = cost + (RELABEL if r != role else 0)
    return m


STEPS = np.stack([_step(r) for r in range(4)])


def stretch_cost(roles: np.ndarray) -> np.ndarray:
    """Least costs between states over a stretch of turns, by halving."""
    m = STEPS[roles]
    while len(m) > 1:
        even = m[:len(m) // 2 * 2]
        pair = np.minimum((even[0::2, :, :, None] + even[1::2, None, :, :]).min(2), _INF)
        m = np.concatenate([pair, m[len(even):]])
    return m[0]


def best_states(roles: np.ndarray, entry: int, rest: np.ndarray) -> np.ndarray:
    """States after each turn of the cheapest way from ``entry`` on, where ``rest`` is the least
    cost of what follows by the last state; among equals a lower rank of (relabel, state) from
    the front."""
    n = len(roles)
    to_end = np.full((n + 1, 4), _INF, np.int64)
    to_end[n] = rest
    for i in range(n - 1, -1, -1):
        to_end[i] = np.minimum((STEPS[roles[i]] + to_end[i + 1][None, :]).min(1), _INF)
    out = np.empty(n, np.int64)
    s = entry
    for i in range(n):
        r = int(roles[i])
        total = STEPS[r][s] + to_end[i + 1]
        ties = np.flatnonzero(total == total.min())
        out[i] = min(ties.tolist(), key=lambda q: (q != r, STEPS[r][s][q], q))
        s = int(out[i])
    return out


def repair(roles: list[int]) -> tuple[int, np.ndarray]:
    """(cost, states) of a whole conversation."""
    r = np.array(roles, np.int64)
    if not len(r):
        return 0, r
    return int(stretch_cost(r)[0].min()), best_states(r, 0, np.zeros(4, np.int64))


#: turns of a stretch; a conversation is chained from one matrix per stretch
STRETCH = 1 << 12
_LOW = -(1 << 63)
_STRETCHES = "conv long, lo long, n int, hi long, cost long, m array<long>"
_RESTS = "conv long, lo long, rest array<long>, cost long, ends boolean"
_EXITS = "conv long, lo long, rest array<long>, cost long, ends boolean, exits array<int>"
_STATES = "conv long, lo long, entry int, rest array<long>, cost long, ends boolean"
_OUT = "conv long, seq long, turn long, role string, source_role string, action string, n_inserted int, conv_cost long, rendered string"


def _ordered(turns: DataFrame, rows: int) -> DataFrame:
    role = F.lower(F.trim(turns["role"]))
    pairs = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    code = F.array_position(F.array(*[F.lit(r) for r in ROLES[1:]]), F.coalesce(F.try_element_at(pairs, role), role))
    t = turns.select(F.coalesce(turns["conv_id"].cast("long"), F.lit(_LOW)).alias("conv"),
                     F.coalesce(turns["turn"].cast("long"), F.lit(_LOW)).alias("turn"), turns["role"].alias("source_role"),
                     F.coalesce(turns["text"], F.lit("")).alias("text"), F.coalesce(code, F.lit(0)).cast("int").alias("code"))
    # ranges over the turns too, so that a conversation may be cut anywhere between two of them
    keys = ["conv", "turn", "source_role", F.xxhash64("text")]
    numbered = (t.repartitionByRange(parts_for(t, rows), *keys).sortWithinPartitions(*keys, "text")
                .withColumn("seq", F.monotonically_increasing_id()))
    return materialise(numbered, "turns").withColumn("lo", F.col("seq") - F.pmod("seq", F.lit(STRETCH)))


def _stretches(pdf: pd.DataFrame) -> pd.DataFrame:
    """A matrix for each conversation's turns in a stretch."""
    pdf = pdf.sort_values("seq")
    conv, code, seq = pdf["conv"].to_numpy(), pdf["code"].to_numpy(), pdf["seq"].to_numpy()
    cut = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    out = []
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(conv)).tolist()):
        m = stretch_cost(code[a:b])
        out.append((int(conv[a]), int(pdf["lo"].iloc[0]), b - a, int(seq[b - 1]), int(m[0].min()), m.ravel().tolist()))
    return pd.DataFrame(out, columns=["conv", "lo", "n", "hi", "cost", "m"])


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Least costs from the end of each stretch on, of a conversation that has several."""
    pdf = pdf.sort_values("lo")
    to_end = [np.zeros(4, np.int64)]
    for m in reversed(pdf["m"].to_list()):
        to_end.append(np.minimum((np.array(m, np.int64).reshape(4, 4) + to_end[-1][None, :]).min(1), _INF))
    to_end.reverse()
    ends = [False] * (len(pdf) - 1) + [True]
    return pd.DataFrame({"conv": pdf["conv"], "lo": pdf["lo"], "rest": [x.tolist() for x in to_end[1:]], "cost": int(to_end[0][0]), "ends": ends})


def _exits(rows: pd.DataFrame, rests: pd.DataFrame) -> pd.DataFrame:
    """For each state before a stretch of a conversation that has several, the state after it."""
    rows = rows.sort_values("seq")
    conv, code = rows["conv"].to_numpy(), rows["code"].to_numpy()
    exits = [[int(best_states(code[conv == c], s, np.array(rest, np.int64))[-1]) for s in range(4)]
             for c, rest in zip(rests["conv"].tolist(), rests["rest"])]
    return rests.assign(exits=exits)[["conv", "lo", "rest", "cost", "ends", "exits"]]


def _enter(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state before each stretch of a conversation that has several."""
    pdf = pdf.sort_values("lo")
    entry = [0]
    for exits in pdf["exits"]:
        entry.append(int(exits[entry[-1]]))
    return pdf.assign(entry=entry[:-1])[["conv", "lo", "entry", "rest", "cost", "ends"]]


def _trace(rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
    """The pieces of rendered text of a stretch's turns."""
    rows = rows.sort_values("seq")
    known = states.set_index("conv")
    conv, code, text = rows["conv"].to_numpy(), rows["code"].to_numpy(), rows["text"].to_list()
    cut = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]]) if len(rows) else []
    close, out = "<|im_end|>\n", []
    for a, b in zip(cut, np.append(cut[1:], len(conv))):
        k = known.loc[conv[a]]
        after = best_states(code[a:b], int(k["entry"]), np.array(k["rest"], np.int64))
        before = np.r_[int(k["entry"]), after[:-1]]
        for i, s, r in zip(range(a, b), before.tolist(), after.tolist()):
            _, joined, way = MOVES[s, r]
            head = "" if s == 0 or joined else close  # the message before ends here
            head += "".join(f"<|im_start|>{ROLES[w]}\n{close}" for w in way)
            head += "\n" if joined else f"<|im_start|>{ROLES[r]}\n"
            action = "merge" if joined else "insert" if way else "keep"
            if r != code[i]:
                action = "relabel" if action == "keep" else f"{action}+relabel"
            tail = close if i == b - 1 and k["ends"] else ""
            out.append((ROLES[r], action, len(way), int(k["cost"]), head + text[i] + tail))
    got = pd.DataFrame(out, columns=["role", "action", "n_inserted", "conv_cost", "rendered"], index=rows.index)
    return pd.concat([rows[["conv", "seq", "turn", "source_role"]], got], axis=1)[
        ["conv", "seq", "turn", "role", "source_role", "action", "n_inserted", "conv_cost", "rendered"]]


def format_chat(turns: DataFrame, rows: int = ROWS) -> DataFrame:
    """Per source turn: conv_id, seq (its place in the order of all turns), turn, role, source_role,
    action, n_inserted, conv_cost (of its conversation's repair), rendered."""
    ordered = _ordered(turns, rows)
    marks = materialise(ordered.select("conv", "lo", "seq", "code").groupBy("lo").applyInPandas(_stretches, _STRETCHES), "stretches")
    # only conversations that lie in several stretches are chained, from one row per stretch
    parts = marks.groupBy("conv").agg(F.count(F.lit(1)).alias("parts"))
    marks = marks.join(parts, "conv")
    one = marks.filter("parts = 1").select("conv", "lo", F.lit(0).alias("entry"), F.expr("array(0L, 0L, 0L, 0L)").alias("rest"), "cost",
                                          F.lit(True).alias("ends"))
    rests = materialise(marks.filter("parts > 1").select("conv", "lo", "m").groupBy("conv").applyInPandas(_chain, _RESTS), "rests")
    cut = ordered.select("conv", "lo", "seq", "code").join(rests.select("conv", "lo"), ["conv", "lo"], "left_semi")
    exits = cut.groupBy("lo").cogroup(rests.groupBy("lo")).applyInPandas(_exits, _EXITS)
    states = one.unionByName(exits.groupBy("conv").applyInPandas(_enter, _STATES))
    out = ordered.groupBy("lo").cogroup(states.groupBy("lo")).applyInPandas(_trace, _OUT)
    null = lambda c, name: F.when(F.col(c) != _LOW, F.col(c)).alias(name)
    return out.select(null("conv", "conv_id"), "seq", null("turn", "turn"), "role", "source_role", "action", "n_inserted",
                      "conv_cost", "rendered")
