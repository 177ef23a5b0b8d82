"""Role repair against trying every edit, however the turns are dealt over tasks."""

import itertools
import random

import pytest

from pixelspark.llm import chat
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, action string, out_turn long, chunk int, conv boolean"


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", 9, 1, True) for r in rows], SCHEMA)


def order(r):
    name = (r["role"] or "").strip().lower()
    name = chat.ALIASES.get(name, name)
    code = chat.ROLES.index(name) if name in chat.ROLES[1:] else chat.UNKNOWN
    return (r["turn"] is None, r["turn"], code, r["role"] or "")


def by_conversation(rows):
    rows = sorted(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["out_turn"], *order(r)))
    return {k: list(g) for k, g in itertools.groupby(rows, key=lambda r: r["conv_id"])}


def legal(turns):
    roles = []
    for r in turns:
        roles += [x for x in r["inserted"].split(",") if x]
        if r["action"].endswith("merge"):
            assert roles[-1] == r["new_role"]
        else:
            roles.append(r["new_role"])
        assert r["out_turn"] == len(roles) - 1
    roles += [x for x in turns[-1]["appended"].split(",") if x]
    body = roles[1:] if roles[0] == "system" else roles
    assert body == ["user", "assistant"] * (len(body) // 2) and body
    return roles


def written(turns):
    """The rendered text from the actions alone."""
    out, is_open = "", False
    for r in turns:
        if r["action"].endswith("merge"):
            out += "\n" + (r["text"] or "")
            continue
        out += "<|end|>\n" if is_open else ""
        out += "".join(f"<|{x}|>\n<|end|>\n" for x in r["inserted"].split(",") if x)
        out += f"<|{r['new_role']}|>\n" + (r["text"] or "")
        is_open = True
    return out + "<|end|>\n" + "".join(f"<|{x}|>\n<|end|>\n" for x in turns[-1]["appended"].split(",") if x)


def test_every_short_conversation_costs_the_least(spark):
    kinds = ("system", "user", "assistant", "tool")
    made = [p for n in range(1, 5) for p in itertools.product(kinds, repeat=n)]
    found = by_conversation(chat.rendered(chat.repaired(talks(spark, [(i, j, role, f"{i}.{j}") for i, p in enumerate(made) for j, role in enumerate(p)]))).collect())
    for i, p in enumerate(made):
        turns = sorted(found[i], key=lambda r: r["turn"])
        legal(turns)
        assert sum(r["cost"] for r in turns) == brute.chat_costs(p), p
        assert "".join(r["piece"] for r in turns) == written(turns)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_a_long_conversation_over_many_tasks(spark, parts):
    r = random.Random(5)
    rows = [(7, j, r.choice(("user", "user", "assistant", "assistant", "system", "tool", None)), f"t{j}") for j in range(3000)]
    rows += [(c, j, r.choice(("user", "assistant")), "a") for c in (*range(7), *range(8, 20)) for j in range(r.randint(1, 6))]
    roles = [x[2] for x in rows[:3000]]
    # one task's way: the same automaton over the whole list
    plain = chat.Repair(chat.Costs())
    codes = [chat.ROLES.index(x) if x in chat.ROLES[1:] else chat.UNKNOWN for x in roles]
    backs, vector = plain.backs((0, *[chat.INFINITE] * 3), codes)
    states = plain.path(backs, plain.last(vector))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = by_conversation(chat.rendered(chat.repaired(talks(spark, rows))).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sum(map(len, found.values())) == len(rows)
    turns = sorted(found[7], key=lambda x: x["turn"])
    assert [chat.ROLES.index(t["new_role"]) for t in turns] == states[1:]
    assert sum(t["last"] for t in turns) == 1 and turns[-1]["last"]
    legal(turns)
    assert "".join(t["piece"] for t in turns) == written(turns)


def test_awkward_rows(spark):
    long = "word " * 200_000
    rows = [(None, 0, "user", "a"), (None, 1, "user", None), (1, None, "assistant", "z"), (1, 0, " Human ", ""), (1, 0, "user", "q"),
            (2, 0, None, long), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "gpt", None), (3, 1, "gpt", ""), (0, 5, "system", "only")]
    got = chat.rendered(chat.repaired(talks(spark, rows)))
    found = by_conversation(got.collect())
    assert sum(r["copies"] for g in found.values() for r in g) == len(rows)
    for turns in found.values():
        legal(sorted(turns, key=order) if len({r["turn"] for r in turns}) == len(turns) else turns)
    assert [(r["action"], r["new_role"]) for r in found[2]] == [("relabel", "user")] and found[2][0]["piece"].startswith("<|user|>\nword ")
    assert found[0][0]["appended"] == "user,assistant"
    assert found[0][0]["piece"] == "<|system|>\nonly<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert {r["copies"] for r in found[3]} == {1, 2} and len(found[3]) == 3
    assert found[1][-1]["turn"] is None and not found[1][-1]["appended"]
    assert chat.rendered(chat.repaired(talks(spark, []))).collect() == []


def test_unnumbered_repeats_are_turns_of_their_own(spark):
    """Two equal turns without a number, or without a conversation, are both rendered; numbered ones were recorded twice."""
    rows = [(1, 0, "user", "go on?"), (1, None, "user", "yes"), (1, None, "user", "yes"), (None, 3, "user", "hm"), (None, 3, "user", "hm"),
            (2, 0, "user", "yes"), (2, 0, "user", "yes")]
    extra = spark.createDataFrame([(*r, 1, "a", 2, "b") for r in rows], "conv_id long, turn long, role string, text string, nth int, copies string, digest int, code string")
    got = chat.rendered(chat.repaired(extra)).collect()
    for conv, text, times in ((1, "yes", 2), (None, "hm", 2), (2, "yes", 1)):
        turns = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["out_turn"], order(r), r["nth"]))
        assert "".join(r["piece"] for r in turns).count(text) == times
        legal(turns)
    assert {r["copies"] for r in got if r["conv_id"] == 2} == {2}
