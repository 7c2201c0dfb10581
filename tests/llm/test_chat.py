import random
import re

import pytest

from clickloom.llm import chat


def least_cost(roles):
    """Least cost over all ways, by trying them all with memory of the state only."""
    cost = {chat.START: 0}
    for role in map(chat.role_state, roles):
        after = {}
        for s, c in cost.items():
            for x in chat.choices(s, role):
                after[x[1]] = min(after.get(x[1], 10**9), c + x[0])
        cost = after
    return min(c + chat.INSERT * len(chat.closing(s)) for s, c in cost.items())


def check(rows, got):
    """Costs are least, renderings legal, and all texts stand in them in order."""
    names = {c for c, *_ in rows}
    assert {None if c != c else c for c in got.conv_id} == names
    for conv in names:
        mine = [r for r in rows if r[0] == conv]
        part = got[got.conv_id.isna() if conv is None else got.conv_id == conv].sort_values("part")
        assert part.turns.sum() == len(mine) and part.last_part.tolist() == [False] * (len(part) - 1) + [True]
        order = sorted(mine, key=lambda r: (r[1] is not None, r[1] or 0))
        if len({r[1] for r in mine}) == len(mine):
            assert part.cost.sum() == least_cost([r[2] for r in order])
        text = "".join(part.rendered)
        roles = re.findall(r"<\|(system|user|assistant)\|>", text)
        roles = roles[1:] if roles[0] == "system" else roles
        assert roles and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(roles)) and roles[-1] == "assistant"
        assert text.endswith("<|end|>\n")
        if len({r[1] for r in mine}) == len(mine):
            assert re.findall(r"t-?\d+", text) == [r[3] for r in order if r[3]]


@pytest.mark.parametrize("stretch", [2, 128])
def test_repair(spark, monkeypatch, stretch):
    monkeypatch.setattr(chat, "STRETCH", stretch)
    rng = random.Random(stretch)
    roles = ["user", "assistant", "system", " User ", "tool", None]
    rows = [
        (c, t, rng.choice(roles), f"t{t}" if rng.random() < 0.9 else None)
        for c in range(25) for t in range(rng.choice([1, 2, 3, 5, 9, 30]))
    ]
    rows += [(None, 0, "user", "t0"), (None, 1, "user", "t1"), (77, None, "user", "t9"), (77, 3, "user", "t3")]
    rows += [(78, 1, "user", "same")] * 3
    got = chat.repaired(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    check(rows, got.toPandas())


def test_legal_conversations_cost_nothing(spark):
    rows = [(1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    (row,) = chat.repaired(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert (row.cost, row.merged, row.relabelled, row.inserted) == (0, 0, 0, 0)
    assert row.rendered == "<|system|>\na<|end|>\n<|user|>\nb<|end|>\n<|assistant|>\nc<|end|>\n"


def test_matrices_combine():
    rng = random.Random(4)
    roles = [rng.choice(["user", "assistant", "system", None]) for _ in range(24)]
    parts = [chat.stretch_matrix(roles[i : i + 5]) for i in range(0, 24, 5)]
    assert [min(x, chat.FAR) for x in chat.combined(parts)] == [min(x, chat.FAR) for x in chat.stretch_matrix(roles)]


def test_tables(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role").collect()]
    got = chat.repaired(turns).toPandas()
    assert got.turns.sum() == len(rows) and got.conv_id.nunique() == len({c for c, *_ in rows})
    for conv, g in got.groupby("conv_id"):
        assert g.cost.sum() == least_cost([r for c, t, r in sorted(rows) if c == conv])
    assert chat.repaired(turns.limit(0)).count() == 0
