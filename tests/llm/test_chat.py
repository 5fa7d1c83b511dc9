import random

import pytest

from quillmart.llm import chat


def cheapest(roles):
    """Cost by trying every repair."""
    best = [chat.FAR]

    def go(i, state, cost):
        if cost >= best[0]:
            return
        if i == len(roles):
            best[0] = cost
            return
        role = roles[i]
        for as_role in chat.ROLES:
            if role == as_role or (role is None and as_role != "system"):
                label = 0
            else:
                label = chat.SYSTEM if role is None or "system" in (role, as_role) else chat.RELABEL
            for empty in (None, "user", "assistant"):
                at, total = state, cost + label
                if empty:
                    if (at, empty) not in chat._LEGAL:
                        continue
                    at, total = chat._AFTER[empty], total + chat.INSERT
                if (at, as_role) in chat._LEGAL:
                    go(i + 1, chat._AFTER[as_role], total)
                if not empty and at == chat._AFTER[as_role]:
                    go(i + 1, at, total + chat.MERGE)

    go(0, chat.START, 0)
    return best[0]


def legal(text):
    at = chat.START
    for line in text.split("\n"):
        if line.startswith("<|") and line != "<|end|>":
            assert (at, line[2:-2]) in chat._LEGAL, text
            at = chat._AFTER[line[2:-2]]


def test_cost_is_the_least_and_the_result_legal():
    rng = random.Random(3)
    for _ in range(200):
        roles = [rng.choice([*chat.ROLES, None]) for _ in range(rng.randint(1, 6))]
        total = chat.costs(roles)[chat.START]
        assert total.min() == cheapest(roles)
        rows = chat.render(roles, chat.path(roles, chat.START, int(total.argmin())), chat.START, ["t"] * len(roles), True, True)
        assert sum(r[3] for r in rows) == total.min()
        legal("".join(r[4] for r in rows))


@pytest.mark.parametrize("parts", [1, 7])
def test_a_conversation_over_many_partitions(spark, clash, parts):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "human", "?", None]), f"m{t}") for t in range(400)]
    rows += [(2, 0, "assistant", "hi"), (2, 0, "assistant", "hi"), (None, None, None, None), (3, 0, "user", ""), (3, 1, "user", "y" * 100000)]
    df = clash(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chat.repair(df, "conv_id", "turn", "role", "text").toPandas().sort_values(["part", "piece"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv in (1, 2, 3):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3]))
        got = out[out.conv_id == conv] if "conv_id" in out else out[out.conv == conv]
        assert got.cost.sum() == chat.costs([chat.normal(r[2]) for r in own])[chat.START].min()
        text = "".join(got.rendered)
        legal(text)
        assert text.endswith(chat.FOOTER) and [m for m in got.turn.dropna()] == [r[1] for r in own]
        assert all(f"m{t}" in text for t in range(400)) or conv != 1
    assert out[out.conv.isna()].rendered.tolist() == ["<|user|>\n<|end|>\n"]
    assert chat.repair(df.limit(0), "conv_id", "turn", "role", "text").count() == 0


def test_ties_go_to_the_first_states_from_the_end():
    # user, assistant, system, user: merging the last turn and keeping it cost 7 in all either way
    roles = ["user", "assistant", "system", "user"]
    states = chat.path(roles, chat.START, chat.AFTER_USER)
    same = [s for s in __import__("itertools").product(range(chat.STATES), repeat=3)
            if all((a, b) in chat.MOVES[r] for a, b, r in zip((chat.START, *s), (*s, chat.AFTER_USER), roles))]
    cost = lambda s: sum(chat.MOVES[r][a, b][0] for a, b, r in zip((chat.START, *s), (*s, chat.AFTER_USER), roles))
    cheapest = min(map(cost, same))
    assert tuple(states[:3]) == min((s for s in same if cost(s) == cheapest), key=lambda s: s[::-1])
