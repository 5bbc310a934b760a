"""Chat formatting with minimum-cost role repair.

Legal conversations are those of a small automaton: at most one system message, first; then user and
assistant in turn, user first; assistant last.  A conversation that isn't legal is repaired by dynamic
programming over the automaton's states: each turn may stay, be relabelled (also where its role is
missing), be merged into the message before it when both have the same role, or be preceded by an empty
message; the cheapest sequence of such edits is taken, ties in a fixed order.  The repaired sequence is rendered.

Costs of a run of turns form a matrix (state before x state after), and runs combine by the min-plus product,
which is associative.  So turns are handled in runs of ``RUN`` turns: each run yields its matrix, the
runs' states are settled from those matrices (one small row a run), and each run then finds its
own turns' edits between its settled states.  A conversation that holds a third of all rows is as many runs,
over as many tasks, as its size asks for.

Defined results
* turns are ordered by ``turn`` (null first), then role and text; a conversation without an id is one under
  the null id; null text is empty text; roles are compared trimmed and in lower case, and unknown or null
  ones are relabelled;
* an assistant turn that must be last but isn't there is appended, empty;
* repeated rows are turns of their own; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from paddock.llm.common import materialise

RUN = 512  # turns of a run

# The automaton: its states are the role of the message so far, 0 before the first.
ROLES = ("", "system", "user", "assistant")
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
LAST = 3  # a conversation ends after an assistant message
STAY, MERGE, RELABEL, FILL, INSERT = 0.0, 1.0, 2.0, 0.5, 3.0  # FILL: a role that is missing or unknown
BIG = np.inf


def steps(role: int) -> list[tuple[int, int, float, tuple[int, ...], int, str]]:
    """(state before, state after, cost, inserted roles, role, action) of every way to take a turn of a role (0:
    unknown), the cheapest first and ties in this order."""
    found = []
    for before in range(len(ROLES)):
        if before and (role == before or not role):
            found.append((before, before, MERGE if role else MERGE + FILL, (), before, "merge"))
        # Up to two empty messages may stand before the turn: more never helps, two messages bring back any state.
        paths = [((), before)]
        for path, at in paths:
            for taken in NEXT[at]:
                cost = INSERT * len(path) + (STAY if taken == role else RELABEL if role else FILL)
                action = "keep" if taken == role else "relabel"
                found.append((before, taken, cost, path, taken, action))
                if len(path) < 2:
                    paths.append(((*path, taken), taken))
    return sorted(found, key=lambda s: (s[2], len(s[3]), s[1], s[0], s[3]))


STEPS = {role: steps(role) for role in range(len(ROLES))}


def matrix(role: int) -> np.ndarray:
    m = np.full((len(ROLES), len(ROLES)), BIG)
    for before, after, cost, *_ in STEPS[role]:
        m[before, after] = min(m[before, after], cost)
    return m


MATRIX = {role: matrix(role) for role in STEPS}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus: cheapest way through ``a`` and then ``b``."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def run_matrix(roles: list[int]) -> np.ndarray:
    m = np.where(np.eye(len(ROLES), dtype=bool), 0.0, BIG)
    for role in roles:
        m = product(m, MATRIX[role])
    return m


def ending() -> np.ndarray:
    """Cost of ending a conversation in a state: nothing after an assistant message, else inserted messages."""
    cost, todo = np.full(len(ROLES), BIG), [(LAST, 0.0)]
    for state, c in todo:
        if c < cost[state]:
            cost[state] = c
            todo += [(before, c + INSERT) for before, after in NEXT.items() if state in after]
    return cost


ENDING = ending()


def closing(state: int) -> list[int]:
    """Roles of the empty messages that end a conversation from a state."""
    out = []
    while state != LAST:
        state = min(NEXT[state], key=lambda s: (ENDING[s], s))
        out.append(state)
    return out


def settle(matrices: list[np.ndarray]) -> tuple[list[int], float]:
    """States between a conversation's runs (one more than runs) on a cheapest way, and its cost."""
    rest = [ENDING]
    for m in reversed(matrices):
        rest.append((m + rest[-1][None, :]).min(axis=1))
    rest.reverse()
    states = [0]
    for m, after in zip(matrices, rest[1:], strict=True):
        states.append(int(np.argmin(m[states[-1]] + after)))
    return states, float(rest[0][0])


def edits(roles: list[int], first: int, last: int) -> list[tuple[tuple[int, ...], int, str]]:
    """(inserted roles, role, action) of every turn of a run on a cheapest way from state to state."""
    rest = np.full((len(roles) + 1, len(ROLES)), BIG)
    rest[-1, last] = 0
    for i in range(len(roles) - 1, -1, -1):
        rest[i] = (MATRIX[roles[i]] + rest[i + 1][None, :]).min(axis=1)
    out, state = [], first
    for i, role in enumerate(roles):
        step = min((s for s in STEPS[role] if s[0] == state), key=lambda s: s[2] + rest[i + 1, s[1]])
        out.append((step[3], step[4], step[5]))
        state = step[1]
    return out


# --- rendering -----------------------------------------------------------------------------------

def opened(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSED = "<|end|>\n"


def render_run(texts: list[str], changes: list[tuple[tuple[int, ...], int, str]], first: int) -> list[str]:
    """What every turn adds to the rendered conversation; the concatenation over all turns, plus what ``tail``
    adds at the end, is the conversation."""
    out, state = [], first
    for text, (inserted, role, action) in zip(texts, changes, strict=True):
        if action == "merge":
            out.append("\n" + text)
        else:
            head = CLOSED if state else ""
            head += "".join(opened(r) + CLOSED for r in inserted)
            out.append(head + opened(role) + text)
        state = role
    return out


def tail(state: int) -> str:
    return CLOSED + "".join(opened(r) + CLOSED for r in closing(state))


# --- the Spark side --------------------------------------------------------------------------------

def grouped(df: DataFrame, keys: list[str], order: list[str], each: Callable[[list[dict]], list[tuple]],
            schema: T.StructType) -> DataFrame:
    """``each`` on the rows of every group in order.  Groups are small and many, so a task takes them one after the
    other from its sorted rows instead of being called for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow, strict=True)], schema=arrow)

        held: list[dict] = []
        out: list[tuple] = []
        for rows in batches:
            for row in rows.to_pylist():
                if held and any(row[k] != held[0][k] for k in keys):
                    out += each(held)
                    held = []
                    if len(out) >= 1024:
                        yield batch(out)
                        out = []
                held.append(row)
        if held:
            out += each(held)
        if out:
            yield batch(out)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def repair(turns: DataFrame, run: int = RUN, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per turn, repaired: ``conv_id``, ``position`` (from 0), ``turn``, ``role``, ``action``, ``inserted`` (roles of
    the empty messages before it), ``rendered`` (its part of the conversation), ``conversation_cost``."""
    spark = turns.sparkSession
    clean = F.trim(F.lower(F.col(role)))
    number = F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES[1:]]), clean), F.lit(0)).cast("int")
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), number.alias("number"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Position in the conversation: turns are counted by slices of their numbers, and ranked within a slice
    # (slices are as long as a run, so equal numbers apart no slice is large).
    rows = materialise(spark, rows.withColumn("slice", F.floor(F.col("turn") / run)), "turns")
    counts = rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("conv_id", "slice", F.coalesce(F.sum("n").over(
        Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy("turn", "number", "text")) - 1
    b = before.select(F.col("conv_id").alias("c"), F.col("slice").alias("s"), "before")
    placed = (rows.withColumn("within", within).join(b, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("slice").eqNullSafe(F.col("s")))
              .withColumn("position", F.col("before") + F.col("within"))
              .select("conv_id", "position", "turn", "number", "text", F.floor(F.col("position") / run).alias("run")))
    placed = materialise(spark, placed, "placed-turns")

    conv_type = placed.schema["conv_id"].dataType

    def schema(*fields: tuple[str, str]) -> T.StructType:
        rest = T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
        return T.StructType([T.StructField("conv_id", conv_type), *rest.fields])

    def measure(rows: list[dict]) -> list[tuple]:
        m = run_matrix([r["number"] for r in rows])
        return [(rows[0]["conv_id"], rows[0]["run"], m.ravel().tolist())]

    runs = grouped(placed.select("conv_id", "run", "position", "number"), ["conv_id", "run"], ["position"], measure,
                   schema(("run", "bigint"), ("m", "array<double>")))

    def walk(rows: list[dict]) -> list[tuple]:
        states, cost = settle([np.array(r["m"], float).reshape(len(ROLES), -1) for r in rows])
        return [(r["conv_id"], r["run"], states[i], states[i + 1], i == len(rows) - 1, cost) for i, r in enumerate(rows)]

    settled = materialise(spark, grouped(runs, ["conv_id"], ["run"], walk, schema(
        ("run", "bigint"), ("first", "int"), ("last", "int"), ("ends", "boolean"), ("cost", "double"))), "settled-runs")
    s = settled.select(F.col("conv_id").alias("c"), F.col("run").alias("r"), "first", "last", "ends", "cost")
    known = placed.join(s, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r"))).drop("c", "r")

    def finish(rows: list[dict]) -> list[tuple]:
        one = rows[0]
        changes = edits([r["number"] for r in rows], one["first"], one["last"])
        rendered = render_run([r["text"] for r in rows], changes, one["first"])
        if one["ends"]:
            rendered[-1] += tail(one["last"])
        return [(r["conv_id"], r["position"], r["turn"], ROLES[c[1]], c[2], [ROLES[x] for x in c[0]], text, one["cost"])
                for r, c, text in zip(rows, changes, rendered, strict=True)]

    return grouped(known, ["conv_id", "run"], ["position"], finish, schema(
        ("position", "bigint"), ("turn", "bigint"), ("role", "string"), ("action", "string"), ("inserted", "array<string>"),
        ("rendered", "string"), ("conversation_cost", "double")))
