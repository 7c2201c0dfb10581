"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, ending with
the assistant. A dynamic programme over this automaton decides for every turn to keep its role,
to take another role, to be merged into the turn before, or to be preceded by an empty turn, so
that the whole costs least, and renders the outcome.

What a stretch of turns costs from each state to each state is a small matrix, and matrices of
neighbouring stretches combine. A conversation is cut into stretches of bounded length; their
matrices are combined level by level, the best states at the ends of the stretches come back
down, and each stretch is repaired on its own. A conversation of any length is spread over tasks.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.text import by_slice
from clickloom.operators.ordering import with_rank
from clickloom.session import freeze

#: Turns of a stretch, and stretches combined at a time.
STRETCH = 128
ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn. The conversation may end in some of them.
START, STATES = 0, 4
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
ENDS = (0, 3)
#: Costs: another role, a role that is none of the three, a merge of equal and of different
#: roles, an empty turn.
RELABEL, UNKNOWN, MERGE, MERGE_OTHER, INSERT = 3, 1, 1, 4, 2
FAR = 1 << 40


def role_state(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) + 1 if name in ROLES else 0


def choices(state: int, role: int) -> list[tuple[int, int, str, int]]:
    """(cost, next state, action, inserted state) of a turn with ``role`` (0: unknown) after ``state``."""
    def label(to: int) -> tuple[int, str]:
        if role == to:
            return 0, "keep"
        return (UNKNOWN, "relabel") if role == 0 else (RELABEL, "relabel")

    out = [(*label(to)[:1], to, label(to)[1], 0) for to in NEXT[state]]
    for middle in NEXT[state]:
        out += [(INSERT + label(to)[0], to, label(to)[1], middle) for to in NEXT[middle]]
    if state:
        out.append((MERGE if role in (0, state) else MERGE_OTHER, state, "merge", 0))
    return out


CHOICES = {(s, r): choices(s, r) for s in range(STATES) for r in range(STATES)}


def closing(state: int) -> list[int]:
    """Empty turns that lead from ``state`` to a legal end."""
    added = []
    while state not in ENDS:
        state = NEXT[state][-1]
        added.append(state)
    return added


def stretch_matrix(roles: list[str | None]) -> list[int]:
    """Least cost from state to state (row by row) over a stretch."""
    out = []
    for begin in range(STATES):
        cost = [0 if s == begin else FAR for s in range(STATES)]
        for role in map(role_state, roles):
            after = [FAR] * STATES
            for s in range(STATES):
                for c, to, _, _ in CHOICES[s, role]:
                    after[to] = min(after[to], cost[s] + c)
            cost = after
        out += cost
    return out


def combined(matrices: list[list[int]]) -> list[int]:
    total = matrices[0]
    for m in matrices[1:]:
        total = [
            min(total[4 * i + k] + m[4 * k + j] for k in range(STATES))
            for i, j in product(range(STATES), repeat=2)
        ]
    return total


def states_between(matrices: list[list[int]], begin: int, end: int) -> list[int]:
    """States before, between and after the matrices on a cheapest way from begin to end."""
    costs = [[0 if s == begin else FAR for s in range(STATES)]]
    for m in matrices:
        last = costs[-1]
        costs.append([min(last[i] + m[4 * i + j] for i in range(STATES)) for j in range(STATES)])
    way = [end]
    for last, m in zip(costs[-2::-1], matrices[::-1]):
        way.append(min(range(STATES), key=lambda i: (last[i] + m[4 * i + way[-1]], i)))
    return way[::-1]


def best_end(matrix: list[int]) -> int:
    """Final state of the whole conversation that is cheapest with the turns needed to close it."""
    return min(range(STATES), key=lambda s: (matrix[4 * START + s] + INSERT * len(closing(s)), s))


def opened(state: int, before: int) -> str:
    return ("<|end|>\n" if before else "") + f"<|{ROLES[state - 1]}|>\n"


def repair(turns: list, begin: int, end: int, last: bool) -> tuple[int, int, int, int, str]:
    """(cost, merged, relabelled, inserted, rendered) of the turns (role, text) of a stretch.

    Renderings of stretches follow each other without anything between.
    """
    states = states_between([stretch_matrix([r]) for r, _ in turns], begin, end)
    cost = merged = relabelled = inserted = 0
    out = []
    for (role, text), s, to in zip(turns, states, states[1:]):
        c, _, action, middle = min(
            (x for x in CHOICES[s, role_state(role)] if x[1] == to), key=lambda x: (x[0], x[2], x[3])
        )
        cost += c
        if middle:
            out.append(opened(middle, s))
            inserted, s = inserted + 1, middle
        merged, relabelled = merged + (action == "merge"), relabelled + (action == "relabel")
        out.append(("\n" if action == "merge" else opened(to, s)) + (text or ""))
    if last:
        state = end
        for added in closing(end):
            out.append(opened(added, state))
            cost, inserted, state = cost + INSERT, inserted + 1, added
        out.append("<|end|>\n" if state else "")
    return cost, merged, relabelled, inserted, "".join(out)


def _each(fn):
    """by_slice's function that maps lists of columns row by row."""
    def make():
        def run(*columns):
            rows = [fn(*r) for r in zip(*columns)]
            return list(zip(*rows)) if rows else [[]] * 99
        return run
    return make


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, part, last_part, turns, cost, merged, relabelled, inserted, rendered): one row
    for each stretch of a conversation, almost always one; its renderings in order of ``part``
    are the conversation's.

    Turns are ordered by ``turn`` (NULL first, ties by role, then a hash of the text). Roles are
    compared without case and outer blanks; NULL and other roles may become any. NULL text is
    empty. Rows of NULL conv_id are one conversation; repeated rows are turns of their own. Other
    columns are not read; an empty table gives no rows.
    """
    keyed = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"),
        "conv_id", "turn", "role", "text",
    )
    ranked = with_rank(keyed, ["k"], [F.col("turn"), F.col("role"), F.xxhash64("text")], "at")
    stretches = freeze(
        ranked.groupBy("k", "conv_id", F.expr(f"at div {STRETCH}").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    )
    roles = stretches.select("k", "part", F.expr("transform(turns, t -> t.role)").alias("roles"))
    level = freeze(by_slice(
        roles, ["k", "part", "roles"], _each(lambda k, part, r: (k, part, stretch_matrix(r))),
        "k string, part bigint, matrix array<bigint>",
    ))
    levels = []
    while not level.where("part > 0").isEmpty():
        grouped = freeze(
            level.groupBy("k", F.expr(f"part div {STRETCH}").alias("part"))
            .agg(F.array_sort(F.collect_list(F.struct("part", "matrix"))).alias("below"))
        )
        levels.append(grouped)
        level = freeze(by_slice(
            grouped.select("k", "part", F.expr("transform(below, b -> b.matrix)").alias("m")), ["k", "part", "m"],
            _each(lambda k, part, m: (k, part, combined(m))), "k string, part bigint, matrix array<bigint>",
        ))
    ends = by_slice(
        level, ["k", "part", "matrix"], _each(lambda k, part, m: (k, part, START, best_end(m), True)),
        "k string, part bigint, begin int, end int, last boolean",
    )
    for grouped in levels[::-1]:
        inside = by_slice(
            grouped.join(ends, ["k", "part"]).select(
                "k", F.expr("transform(below, b -> b.part)").alias("parts"),
                F.expr("transform(below, b -> b.matrix)").alias("m"), "begin", "end", "last"),
            ["k", "parts", "m", "begin", "end", "last"],
            _each(lambda k, parts, m, begin, end, last: (k, _spread(parts, m, begin, end, last))),
            "k string, parts array<struct<part: bigint, begin: int, end: int, last: boolean>>",
        )
        ends = inside.select("k", F.explode("parts").alias("p")).select("k", "p.*")
    return by_slice(
        stretches.join(ends, ["k", "part"]).withColumn("pairs", F.expr("transform(turns, t -> struct(t.role, t.text))")),
        ["conv_id", "part", "pairs", "begin", "end", "last"],
        _each(lambda conv, part, pairs, begin, end, last: (
            conv, part, last, len(pairs), *repair([tuple(p.values()) for p in pairs], begin, end, last))),
        "conv_id bigint, part bigint, last_part boolean, turns bigint, cost bigint, merged bigint, "
        "relabelled bigint, inserted bigint, rendered string",
    )


def _spread(parts: list, matrices: list, begin: int, end: int, last: bool) -> list[dict]:
    way = states_between(matrices, begin, end)
    return [
        {"part": p, "begin": a, "end": b, "last": last and i == len(parts) - 1}
        for i, (p, a, b) in enumerate(zip(parts, way, way[1:]))
    ]
