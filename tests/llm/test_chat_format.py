"""Role repair against a brute-force search over repaired sequences; rendering and edge cases."""

import heapq
import random
import re

import pytest

from paddock.llm import chat_format as cf
from paddock.llm.queries import op2_chat_format

from ..conftest import SF_SMALL


def cheapest(roles):
    """Least cost of a legal sequence, by uniform-cost search over single edits (an independent formulation)."""
    heap, seen = [(0.0, 0, 0)], set()
    while heap:
        cost, i, state = heapq.heappop(heap)
        if i == len(roles) and state == 3:
            return cost
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for nxt in {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}[state]:
            heapq.heappush(heap, (cost + 3, i, nxt))                                   # an empty message
            if i < len(roles):
                heapq.heappush(heap, (cost + (0 if roles[i] == nxt else 2 if roles[i] else 0.5), i + 1, nxt))
        if i < len(roles) and state and roles[i] in (0, state):
            heapq.heappush(heap, (cost + (1 if roles[i] else 1.5), i + 1, state))      # merged
    return None


def legal(rendered):
    roles = re.findall(r"<\|(system|user|assistant)\|>\n", rendered)
    body = roles[1:] if roles[:1] == ["system"] else roles
    return bool(body) and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(body)) and body[-1] == "assistant"


def check(rows, run=None):
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    for conv in by.values():
        conv.sort(key=lambda r: r.position)
        assert [r.position for r in conv] == list(range(len(conv)))
        text = "".join(r.rendered for r in conv)
        assert legal(text) and text.endswith(cf.CLOSED)
    return by


def test_matrices_agree_with_search():
    rng = random.Random(0)
    for _ in range(300):
        roles = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        cuts = sorted(rng.sample(range(len(roles) + 1), rng.randint(0, min(3, len(roles)))))
        runs = [r for r in (roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)], strict=True)) if r]
        states, cost = cf.settle([cf.run_matrix(r) for r in runs])
        assert cost == cheapest(roles)
        spent = cf.ENDING[states[-1]]
        for r, a, b in zip(runs, states[:-1], states[1:], strict=True):
            assert cf.run_matrix(r)[a, b] < cf.BIG
            spent += cf.run_matrix(r)[a, b]
            assert len(cf.edits(r, a, b)) == len(r)
        assert spent == cost


def test_query_against_brute_force(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    rows = op2_chat_format(spark, SF_SMALL).collect()
    assert len(rows) == len(turns)
    roles = {}
    for t in sorted(turns, key=lambda t: (t.conv_id, t.turn)):
        roles.setdefault(t.conv_id, []).append(cf.ROLES.index(t.role) if t.role in cf.ROLES[1:] else 0)
    for conv, some in check(rows).items():
        assert {r.conversation_cost for r in some} == {cheapest(roles[conv])}


@pytest.mark.parametrize("run", [2, 512])
def test_long_conversations_nulls_ties_and_clashing_columns(spark, run):
    rng = random.Random(3)
    names = ["system", "user", "assistant", None, " User ", "tool"]
    rows = [(1, i, rng.choice(names), None if i % 7 == 0 else f"t{i}") for i in range(40)]
    rows += [(2, 0, "assistant", "only")] + [(3, None, "user", ""), (3, None, "user", ""), (3, 5, "user", "x")]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (4, 1, "system", "s"), (4, 1, "system", "s")]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, run int, position int")
    got = cf.repair(turns.repartition(3), run=run).collect()
    assert len(got) == len(rows)
    by = check(got)
    number = lambda r: cf.ROLES.index((r or "").strip().lower()) if (r or "").strip().lower() in cf.ROLES[1:] else 0
    assert {r.conversation_cost for r in by[1]} == {cheapest([number(r[2]) for r in rows[:40]])}
    assert {r.conversation_cost for r in by[None]} == {0.0}
    assert "".join(r.rendered for r in by[None]) == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert by[2][0].conversation_cost == cheapest([3]) == 3.0
    assert "".join(r.rendered for r in by[2]) == "<|user|>\n<|end|>\n<|assistant|>\nonly<|end|>\n"
    assert cf.repair(turns.limit(0), run=run).collect() == []
