"""The prefix trie against a plain one, with small shards, bands and queues, and awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from pixelspark.llm import prefix_trie, queries
from pixelspark.llm.prefix_trie import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string, d long, words string, pid int, leaves long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1, 2) for r in rows], SCHEMA)


def plain(rows):
    """The nodes of the trie; turns of equal number must be equal rows."""
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members, ends, children = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(turns.get(c - c % 20 if c >= 0 else c + -c % 20, [])[:h] + turns[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
        ends[seq].append(c)
    total = {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0)
        below = [total[x] for x in children[k]]
        total[k] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), *total[k],
                   hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k, m in members.items())


def result(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


def made(n, longest, seed=0):
    r = random.Random(seed)
    texts = [None, "", " ", "a", "b c", "one two\nthree", "x\u0085 y z ", "end \u0085"]
    rows = [(c, t if r.random() < 0.9 else t, r.choice(("user", "assistant", None)) if t > 2 else "user", r.choice(texts) if t > 1 else r.choice(texts[3:5]))
            for c in range(n) for t in range(r.choice((1, 2, 3, 5, longest)))]
    r.shuffle(rows)
    return rows


def test_query(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.op12_prefix_trie(spark, data)) == plain(rows)


@pytest.mark.parametrize("shard,band,room", [(50_000, 1024, 100), (6, 2, 1), (40, 3, 4), (0, 4, 2)])
def test_shards_and_bands(spark, shard, band, room):
    rows = made(90, 17)
    assert result(prefix_trie.prefix_trie(frame(spark, rows), shard, band, room)) == plain(rows)


def test_awkward_rows(spark):
    rows = [(0, None, "user", "hi"), (0, 1, "user", "there"), (0, 2, None, None), (None, 0, "user", "lost"), (3, 0, "user", "hi"), (3, 0, "user", "hi"),
            (25, 0, "user", "no base"), (60, 0, "user", "hi"), (61, 5, "user", "hi"), (-3, 0, "user", "below"), (-3, 1, "user", "zero"), (-3, 2, "user", "and on")]
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == plain(rows)


def test_one_long_conversation_and_one_first_turn(spark):
    """A third of all rows in one conversation, another third the same conversation again and again."""
    rows = [(0, t, "user", f"w{t % 3} x") for t in range(400)]
    rows += [(c, t, "user", ("same", "again", "thrice", "over and out")[t]) for c in range(20, 120) for t in range(4)]
    rows += [(c, t, "user", f"t{c % 7} {t}") for c in range(120, 220) for t in range(4)]
    assert result(prefix_trie.prefix_trie(frame(spark, rows), 30, 8, 10)) == plain(rows)


def test_empty_table(spark):
    got = prefix_trie.prefix_trie(frame(spark, []))
    assert got.count() == 0 and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]


def test_queue_spills():
    r = random.Random(1)
    queue, want = SpillingQueue(5), collections.defaultdict(lambda: [0, 0])
    for _ in range(500):
        key, a, b = (r.randint(0, 30), r.randint(-2, 2)), r.randint(0, 9), r.randint(0, 9)
        queue.push((*key, a, b))
        want[key][0] += a
        want[key][1] += b
    assert queue.spilled > 10
    assert all(queue.take(k) == tuple(want[k]) for k in sorted(want)) and not queue.runs and not queue.heap
