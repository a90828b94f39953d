import functools
import random
import re

import pytest

from arealis.llm import chat

COSTS = chat.Costs()


def least_cost(roles):
    @functools.lru_cache(None)
    def go(i, state):
        if i == len(roles):
            return COSTS.insert * len(chat.automaton(COSTS).tail[chat.STATES.index(state)])
        ways = []
        for role in chat.ROLES:
            change = 0 if role == roles[i] else COSTS.relabel
            if role in chat.LEGAL[state]:
                ways.append(change + go(i + 1, role))
            if role == state:
                ways.append(change + COSTS.merge + go(i + 1, role))
            ways += [change + COSTS.insert + go(i + 1, role) for x in chat.LEGAL[state] if role in chat.LEGAL[x]]
        return min(ways)

    return go(0, None)


def test_least_cost_and_legal_order(spark):
    rng = random.Random(1)
    said = {c: [rng.choice(["user", "assistant", "system", None, "tool", "User "]) for _ in range(rng.choice([1, 2, 3, 8]) if c else 700)] for c in range(60)}
    rows = [(c, i, r, f"t{i}") for c, roles in said.items() for i, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repaired = chat.repair_roles(df).cache()
    assert repaired.count() == len(rows)
    # conversation 0 is most of the table and lies in several partitions
    for r in chat.render(repaired).collect():
        roles = [x for x in re.findall(r"<\|(\w+)\|>\n", r["rendered"]) if x != "end"]
        assert all(y in chat.LEGAL[x] for x, y in zip([None, *roles], roles, strict=False)) and roles[-1] == "assistant"
        given = said[r["conv_id"]]
        assert re.findall(r"t\d+", r["rendered"]) == [f"t{i}" for i in range(len(given))]
        if len(given) < 100:
            assert r["cost"] == pytest.approx(least_cost(tuple((x or "").strip().lower() for x in given)))


def test_awkward_turns(spark):
    rows = [(None, 1, "user", "a"), (None, 2, None, None), (1, None, "user", "late"), (1, 1, "system", ""), (1, 1, "system", ""), (2, 1, "USER", "x" * 200_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, code int, conv string")
    out = {r["conv_id"]: r["rendered"] for r in chat.render(chat.repair_roles(df)).collect()}
    assert out[None] == "<|user|>\na<|end|>\n<|assistant|>\n<|end|>\n" and out[1].index("late") > 0 and out[2].endswith("<|assistant|>\n<|end|>\n")
    assert chat.repair_roles(df.limit(0)).count() == 0
