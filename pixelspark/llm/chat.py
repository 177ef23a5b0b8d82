"""Chat formatting by minimum-cost role repair.

A legal conversation is at most one system turn, then user and assistant turns by turns, an assistant's last. The states of
the automaton are the role that spoke last. A recorded turn may be kept, relabelled, or merged into the turn before it, and empty
turns may be inserted before it and at the end; dynamic programming over the states finds the repair of least cost.

A conversation may hold a third of all rows, so it is cut: all turns are sorted into ranges, and a range of one conversation
is a min-plus matrix from the state before it to the state after it. Matrices of a conversation compose in order, and each
range then finds its own part of the path. What crosses tasks is a few numbers for each range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Other names of the roles; what is in neither list is an unknown role.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "model": "assistant", "gpt": "assistant", "developer": "system"}
UNKNOWN = 4
INFINITE = 1 << 40


class Costs(NamedTuple):
    """What a repair costs; giving a role to a turn of an unknown one is not a relabelling."""

    merge: int = 2
    insert: int = 3
    relabel: int = 5
    name: int = 1


class Step(NamedTuple):
    cost: int
    action: str
    inserted: str


class Repair:
    """The automaton with its costs; vectors of costs by state are kept less their minimum, so few differ and steps are remembered."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.steps = {(r, p, x): self._step(r, p, x) for r in range(1, 5) for p in range(4) for x in range(1, 4)}
        self.end = (INFINITE, 2 * costs.insert, costs.insert, 0)
        self.appended = ("", "user,assistant", "assistant", "")
        self.known: dict[tuple, tuple] = {}

    def _step(self, r: int, p: int, x: int) -> Step | None:
        """The cheapest way for a turn of role ``r`` to become one of role ``x`` after state ``p``; None if there is none."""
        c = self.costs
        named = 0 if r == x else c.name if r == UNKNOWN else c.relabel
        word = "keep" if r == x else "relabel"
        ways = []
        if p == x:
            ways.append(Step(named + c.merge, "merge" if r == x else "relabel+merge", ""))
        if x == SYSTEM:
            ways += [Step(named, word, "")] if p == START else []
        elif x == USER:
            ways.append(Step(named + c.insert, word, "assistant") if p == USER else Step(named, word, ""))
        else:
            ways.append(Step(named, word, "") if p == USER else Step(named + c.insert, word, "user"))
        return min(ways, key=lambda w: w.cost, default=None)

    def forward(self, vector: tuple[int, ...], r: int) -> tuple[tuple[int, ...], int, tuple[int, ...]]:
        """(costs after a turn less their minimum, that minimum, best state before by state after: the smallest of equals)."""
        got = self.known.get((vector, r))
        if got is None:
            cost, back = [INFINITE], [START]
            for x in range(1, 4):
                ways = [(min(INFINITE, vector[p] + s.cost), p) for p in range(4) if (s := self.steps[r, p, x]) is not None]
                best = min(ways, default=(INFINITE, START))
                cost.append(best[0])
                back.append(best[1])
            low = min(cost)
            got = self.known[vector, r] = (tuple(INFINITE if v >= INFINITE else v - low for v in cost), low, tuple(back))
        return got

    def matrix(self, roles: list[int]) -> list[int]:
        """Least costs from each state to each, by rows."""
        out: list[int] = []
        for p in range(4):
            vector, total = tuple(0 if q == p else INFINITE for q in range(4)), 0
            for r in roles:
                vector, low, _ = self.forward(vector, r)
                total += low
            out += [min(INFINITE, v + total) for v in vector]
        return out

    def backs(self, vector: tuple[int, ...], roles: list[int]) -> tuple[list[tuple[int, ...]], tuple[int, ...]]:
        out = []
        for r in roles:
            vector, _, back = self.forward(vector, r)
            out.append(back)
        return out, vector

    def last(self, vector: tuple[int, ...]) -> int:
        """The state that a best path ends in."""
        return min(range(4), key=lambda q: (vector[q] + self.end[q], q))

    def path(self, backs: list[tuple[int, ...]], q: int) -> list[int]:
        """The states before, between and after the turns of a range that is left in state ``q``."""
        out = [q]
        for back in reversed(backs):
            q = back[q]
            out.append(q)
        return out[::-1]

    def begun(self, roles: list[int], states: list[int]) -> list[int]:
        """Turns that each recorded turn begins, inserted ones included."""
        taken = [self.steps[t] for t in zip(roles, states, states[1:])]
        return [(s.inserted != "") + (not s.action.endswith("merge")) for s in taken]


def role_code() -> Column:
    name = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    code = F.lit(UNKNOWN)
    for alias, role in [*ALIASES.items(), *((r, r) for r in ROLES[1:])]:
        code = F.when(name == alias, F.lit(ROLES.index(role))).otherwise(code)
    return code


KEY = ["chunk", "anon", "conv"]


def in_order() -> list[str | Column]:
    """Conversations, and the turns of each one."""
    return ["anon", "conv", F.col("turn").isNull(), "turn", "code", "role", "digest", "nth"]


def _by_range(rows: DataFrame, out: str, each: Callable[[dict], dict]) -> DataFrame:
    """``each`` on the columns of every range of a conversation, in order; rows of a range lie in one task."""
    names = rows.columns
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = pa.schema([(f.name, {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(),
                                  "array<bigint>": pa.list_(pa.int64())}[f.dataType.simpleString()])
                        for f in rows.sparkSession.createDataFrame([], out).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> dict:
            return each(pa.Table.from_batches(held).to_pydict())

        def batch_of(found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x for f in found for x in f[c.name]], c.type) for c in fields], schema=fields)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = [np.asarray(batch.column(names.index(c)).to_numpy(zero_copy_only=False), np.int64) for c in KEY]
            cuts = [0, *(np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in key])) + 1).tolist(), batch.num_rows]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                if held and any(held[-1].column(names.index(c))[0] != part.column(names.index(c))[0] for c in KEY):
                    found.append(done())
                    held = []
                held.append(part)
            yield batch_of(found)
        if held:
            yield batch_of([done()])

    return rows.repartition(n, "chunk").sortWithinPartitions("chunk", *in_order()).mapInArrow(run, out)


def _matrices(rows: DataFrame, costs: Costs) -> DataFrame:
    def each(c: dict) -> dict:
        return {k: c[k][:1] for k in KEY} | {"matrix": [Repair(costs).matrix(c["code"])]}

    return _by_range(rows, "chunk int, anon boolean, conv long, matrix array<bigint>", each)


def _entries(matrices: DataFrame, costs: Costs) -> DataFrame:
    """Costs by state before each range; one small row for each range of a conversation that has several."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        vector, out = np.array([0, INFINITE, INFINITE, INFINITE]), []
        for m in part["matrix"]:
            out.append(vector.tolist())
            vector = np.minimum(INFINITE, (vector[:, None] + np.array(m).reshape(4, 4)).min(0))
            vector = np.where(vector >= INFINITE, INFINITE, vector - vector.min())
        return part[KEY].assign(entry=out)

    return matrices.groupBy("anon", "conv").applyInPandas(run, "chunk int, anon boolean, conv long, entry array<bigint>")


def _turned(rows: DataFrame, costs: Costs) -> DataFrame:
    """By state after each range: the state before it, the turns begun in it, and the cost."""

    def each(c: dict) -> dict:
        r, roles = Repair(costs), c["code"]
        backs, vector = r.backs(tuple(c["entry"][0]), roles)
        paths = [r.path(backs, q) if vector[q] < INFINITE else None for q in range(4)]
        return {k: c[k][:1] for k in KEY} | {"entry": c["entry"][:1], "leave": [list(vector)],
                                             "came": [[p[0] if p else -1 for p in paths]],
                                             "begun": [[sum(r.begun(roles, p)) if p else 0 for p in paths]]}

    return _by_range(rows, "chunk int, anon boolean, conv long, entry array<bigint>, leave array<bigint>, came array<bigint>, begun array<bigint>", each)


def _exits(turned: DataFrame, costs: Costs) -> DataFrame:
    """The state after each range on the path, the turns begun before it, and whether it is the last."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("chunk")
        q, states = Repair(costs).last(tuple(part["leave"].iloc[-1])), []
        for came in part["came"].iloc[::-1]:
            states.append(q)
            q = int(came[q])
        states.reverse()
        begun = [int(b[s]) for b, s in zip(part["begun"], states)]
        return part[KEY].assign(entry=part["entry"], leaves=states, base=[0, *accumulate(begun[:-1])], final=[False] * (len(part) - 1) + [True])

    return turned.groupBy("anon", "conv").applyInPandas(run, "chunk int, anon boolean, conv long, entry array<bigint>, leaves int, base long, final boolean")


PLAN = ("anon boolean, conv long, turn long, role string, digest string, nth long, new_role string, action string, inserted string, appended string, "
        "out_turn long, cost long")


def _plan(rows: DataFrame, costs: Costs) -> DataFrame:
    def each(c: dict) -> dict:
        r, roles, whole = Repair(costs), c["code"], c["entry"][0] is None
        backs, vector = r.backs((0, INFINITE, INFINITE, INFINITE) if whole else tuple(c["entry"][0]), roles)
        states = r.path(backs, r.last(vector) if whole else c["leaves"][0])
        taken = [r.steps[t] for t in zip(roles, states, states[1:])]
        ends = whole or c["final"][0]
        n, q = len(roles), states[-1]
        base = 0 if whole else c["base"][0]
        return {k: c[k] for k in ("anon", "conv", "turn", "role", "digest", "nth")} | {
            "new_role": [ROLES[x] for x in states[1:]], "action": [s.action for s in taken], "inserted": [s.inserted for s in taken],
            "appended": [""] * (n - 1) + [r.appended[q] if ends else ""],
            "out_turn": [base + k - 1 for k in accumulate(r.begun(roles, states))],
            "cost": [s.cost for s in taken[:-1]] + [taken[-1].cost + (r.end[q] if ends else 0)],
            "last": [False] * (n - 1) + [ends]}

    return _by_range(rows, f"{PLAN}, last boolean", each)


def repaired(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row per recorded turn with its place in the repaired conversation.

    conv_id, turn, role, text as recorded; copies, the number of rows equal in these four, which are one turn recorded
    again where conversation and number are given; rows without one of these are turns of their own, which ``nth`` tells
    apart (0 for the others) and which follow each other in its order; new_role; action (keep, relabel, merge, relabel+merge); inserted and appended, the roles of empty turns
    put before it and after the conversation; out_turn, its turn there, from 0; cost; last.

    Turns go by number, those without one last; equal numbers by role (system, user, assistant, others by name), then
    by the digest of the text. Of paths of equal cost the one wins that, from the end backwards, has the smallest state
    (system, user, assistant) where they differ; tasks and their number have no part in it. Rows without conv_id are one
    conversation. A null role is an unknown one, a null text stays null. No rows give no rows; other columns are not read.
    """
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    folded = taken.where(known).groupBy(*taken.columns).agg(F.count(F.lit(1)).alias("copies")).withColumn("nth", F.lit(0).cast("long"))
    single = taken.where(~known).withColumn("copies", F.lit(1).cast("long")).withColumn("nth", F.monotonically_increasing_id() + 1)
    turns = stored(folded.unionByName(single).withColumn("digest", F.coalesce(F.md5("text"), F.lit(""))), "turns")
    narrow = turns.select(F.col("conv_id").isNull().alias("anon"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
                          "turn", "role", "digest", "nth", role_code().alias("code"))
    ranged = stored(narrow.repartitionByRange(n, *in_order()).withColumn("chunk", F.spark_partition_id()), "ranges")
    conv = F.struct("anon", "conv")
    ends = (ranged.groupBy("chunk").agg(F.min(conv).alias("a"), F.max(conv).alias("b"))
            .select("chunk", F.explode(F.array_distinct(F.array("a", "b"))).alias("c")).select("chunk", "c.anon", "c.conv"))
    cut = ends.join(ends.groupBy("anon", "conv").count().where("count > 1").drop("count"), ["anon", "conv"])
    entries = stored(_entries(_matrices(ranged.join(cut, KEY, "left_semi"), costs), costs), "entries")
    exits = stored(_exits(_turned(ranged.join(entries, KEY), costs), costs), "exits")
    plan = _plan(ranged.join(exits, KEY, "left").select(*ranged.columns, "entry", "leaves", "base", "final"), costs)
    t, p = turns.alias("t"), plan.alias("p")
    same = ((F.col("t.conv_id").isNull() == F.col("p.anon")) & (F.coalesce("t.conv_id", F.lit(0)) == F.col("p.conv"))
            & F.col("t.turn").eqNullSafe(F.col("p.turn")) & F.col("t.role").eqNullSafe(F.col("p.role")) & (F.col("t.digest") == F.col("p.digest"))
            & (F.col("t.nth") == F.col("p.nth")))
    return t.join(p, same).select("t.conv_id", "t.turn", "t.role", "t.text", "t.copies", "p.new_role", "p.action", "p.inserted", "p.appended",
                                  "p.out_turn", "p.cost", "p.last", "t.nth")


def rendered(turns: DataFrame, head: str = "<|{role}|>\n", foot: str = "<|end|>\n", joint: str = "\n") -> DataFrame:
    """The repaired turns with ``piece``: pieces one after another, in the order of the turns, are the rendered conversation.

    A piece closes the turn before it, holds inserted turns, and opens its own; merged texts follow a joint; the last piece
    closes the conversation. So no conversation is gathered in one row. Texts go in as they are, null as empty.
    """
    before, after = head.split("{role}")
    opened = lambda role: F.concat(F.lit(before), role, F.lit(after))
    blanks = lambda names: F.when(F.col(names) == "", "").otherwise(
        F.array_join(F.transform(F.split(names, ","), lambda r: F.concat(opened(r), F.lit(foot))), ""))
    first = (F.col("out_turn") == F.when(F.col("inserted") == "", 0).otherwise(1))
    opening = F.concat(F.when(first, "").otherwise(foot), blanks("inserted"), opened(F.col("new_role")))
    closing = F.when(F.col("last"), F.concat(F.lit(foot), blanks("appended"))).otherwise("")
    return turns.withColumn("piece", F.concat(F.when(F.col("action").endswith("merge"), joint).otherwise(opening),
                                              F.coalesce("text", F.lit("")), closing))
