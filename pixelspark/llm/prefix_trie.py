"""The trie of conversation prefixes, its totals passed upwards by time-forward processing.

A node is a distinct sequence of first turns. Its name is the exclusive or of 2 x 64 hash bits of every (depth, role, text)
in it, so names come from running totals, and a conversation may span tasks. ``rows`` holds one row per conversation and
depth, nodes are grouped from it; texts are hashed and counted where they are read and never move.

A total over a subtree is passed from child to parent. Nodes are sorted by reverse level order; a node's message lies in a
priority queue, ordered like the nodes, until the parent's turn has come, and the queue writes sorted runs to disk when it
is full. That is done in shards. A subtree of at most ``shard`` conversation turns is one shard. What lies above them is few
nodes (at each depth at most all turns by ``shard``), but may be as deep as the longest conversation; it is cut at every
``band``-th depth. Totals of shard roots then form a tree of their own, which is processed in the same way, and what comes
out of it is added to the nodes that the roots hang on, before these are processed once more.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import stored, text_or_empty

#: Conversations share the first turns of one in GROUP, up to HEADS - 1 of them.
GROUP, HEADS = 20, 4
SHARD = 50_000
BAND = 1024
#: Messages that a queue holds in memory.
ROOM = 200_000
#: Parts that the rows of a node with many turns below it are dealt to.
SALT = 32
#: Ids in a piece of a text that is hashed.
IDS = 1024
KEY = ["d", "p1", "p2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    parts = F.split(F.regexp_replace(F.concat(F.lit(" "), text), r"[\x20\x09-\x0D]+", " "), " ")
    return F.size(parts) - 1 - (text.rlike(r"[\x20\x09-\x0D]\z") | (text == "")).cast("int")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pid (a part of a conversation), turn, g1, g2 (hash of role and text), words; parts are in the order of turns."""
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("g1"),
        F.xxhash64(F.lit(2), text, role).alias("g2"), words(text).cast("long").alias("words"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "g1", "g2"]
    return stored(rows.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, convs). rows: conv_id, pid, d, g1, g2, words of each rebuilt turn; convs: conv_id, n, its rebuilt length."""
    turns = turn_rows(conversations)
    parts = turns.groupBy("pid", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("own")).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    convs = convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % HEADS))
    first = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = stored(convs.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("base_own", F.lit(0))))
                   .select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), "convs")
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    start = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(convs.select("conv_id", "h", "m"), "conv_id")
    inside = Window.partitionBy("pid", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "g1", "g2")
    placed = turns.join(start, ["pid", "conv_id"]).withColumn("pos", F.row_number().over(inside) + F.col("before"))
    kept = ["conv_id", "pid", "d", "g1", "g2", "words"]
    own = placed.where("pos > h").withColumn("d", F.col("m") + F.col("pos") - F.col("h")).select(*kept)
    heads = placed.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEADS)).select(F.col("conv_id").alias("base"), "pos", "g1", "g2", "words")
    shared = (convs.select("conv_id", "base", "m").join(heads, "base").where("pos <= m")
              .withColumn("pid", F.lit(-1)).withColumn("d", F.col("pos").cast("long")).select(*kept))
    return stored(own.unionByName(shared), "rebuilt"), convs.select("conv_id", "n")


def path_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, n, d, p1, p2 (node), q1, q2 (its parent), words for each conversation and each depth from 0."""
    rows, convs = rebuilt(conversations)
    rows = rows.withColumn("e1", F.xxhash64("d", "g1", "g2")).withColumn("e2", F.xxhash64(F.lit(7), "g2", "d", "g1"))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    start = rows.groupBy("pid", "conv_id").agg(F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"))
    start = start.select("pid", "conv_id", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    upto = Window.partitionBy("pid", "conv_id").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.join(start, ["pid", "conv_id"])
    here = here.select("conv_id", "d", "words", "e1", "e2", *[F.bit_xor(f"e{i}").over(upto).bitwiseXOR(F.col(f"o{i}")).alias(f"p{i}") for i in (1, 2)])
    here = here.select("conv_id", "d", "p1", "p2", F.col("p1").bitwiseXOR(F.col("e1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("q2"), "words")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv_id", zero.alias("d"), zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"), zero.alias("words"))
    return stored(here.unionByName(root).join(convs, "conv_id"), "paths")


class SpillingQueue:
    """Messages in order of their keys; what memory has no room for waits in sorted runs on disk, which end with the task."""

    def __init__(self, room: int = ROOM):
        self.room, self.heap, self.runs, self.spilled = room, [], [], 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.room:
            self.heap.sort()
            run = self._run(self.heap)
            next(run)  # writes
            heapq.heappush(self.runs, (next(run), self.spilled, run))
            self.heap, self.spilled = [], self.spilled + 1

    @staticmethod
    def _run(messages: list[tuple], block: int = 4096) -> Iterator[tuple]:
        with tempfile.TemporaryFile() as f:
            blocks = range(0, len(messages), block)
            for a in blocks:
                pickle.dump(messages[a:a + block], f)
            del messages
            yield ()
            f.seek(0)
            for _ in blocks:
                yield from pickle.load(f)

    def take(self, key: tuple) -> tuple[int, int]:
        """Sums of the messages under a key, which is the least that is left."""
        leaves = saved = 0
        k = len(key)
        while self.heap and self.heap[0][:k] == key:
            m = heapq.heappop(self.heap)
            leaves, saved = leaves + m[k], saved + m[k + 1]
        while self.runs and self.runs[0][0][:k] == key:
            m, number, run = self.runs[0]
            leaves, saved = leaves + m[k], saved + m[k + 1]
            follows = next(run, None)
            if follows is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (follows, number, run))
        return leaves, saved


def time_forward(nodes: DataFrame, room: int = ROOM) -> DataFrame:
    """d, p1, p2, leaves, saved with ``leaves`` and ``saved`` summed over what lies below a node in its shard.

    ``nodes``: KEY, q1, q2 (parent), leaves, saved, and the key of the shard's root: sd, s1, s2. A root sends no message.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(room)
        for batch in batches:
            leaves, saved = [], []
            for d, p1, p2, q1, q2, own, kept, sd in zip(*(c.to_pylist() for c in batch.columns)):
                more, gain = queue.take((-d, p1, p2))
                own, kept = own + more, kept + gain
                leaves.append(own)
                saved.append(kept)
                if d > sd:
                    queue.push((1 - d, q1, q2, own, kept))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=[*KEY, "leaves", "saved"])

    sorted_ = nodes.repartition("sd", "s1", "s2").sortWithinPartitions(F.desc("d"), "p1", "p2")
    return sorted_.select(*KEY, "q1", "q2", "leaves", "saved", "sd").mapInArrow(run, "d long, p1 long, p2 long, leaves long, saved long")


def attached(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the totals of ``roots`` (d, q1, q2, leaves, saved) added to those that are their parents."""
    sums = roots.groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.sum("leaves").alias("ml"), F.sum("saved").alias("ms"))
    return (nodes.join(sums, KEY, "left").withColumn("leaves", F.col("leaves") + F.coalesce("ml", F.lit(0)))
            .withColumn("saved", F.col("saved") + F.coalesce("ms", F.lit(0))).drop("ml", "ms"))


def upper_totals(nodes: DataFrame, paths: DataFrame, stride: int, band: int, room: int) -> DataFrame:
    """Totals of a tree whose depths are multiples of ``stride`` / ``band``: cut at the multiples of ``stride``.

    ``nodes``: KEY, q1, q2, conv_id (a member), leaves, saved. The ancestor of a node at a depth is that of its member.
    """
    above = paths.where(F.col("d") % stride == 0).select("conv_id", F.col("d").alias("sd"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    nodes = stored(nodes.withColumn("sd", F.col("d") - F.col("d") % stride).join(above, ["conv_id", "sd"]), "upper")
    step = stride // band
    level = lambda df: df.withColumn("d", F.expr(f"d div {step}")).withColumn("sd", F.expr(f"sd div {step}"))
    real = lambda df: df.withColumn("d", F.col("d") * step)
    local = stored(real(time_forward(level(nodes), room)), "local")
    if nodes.where("sd > 0").isEmpty():
        return local
    roots = nodes.where("d = sd").select(*KEY, "conv_id").join(local, KEY)
    up = paths.select("conv_id", F.col("d").alias("e"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    roots = roots.withColumn("e", F.col("d") - stride).join(up, ["conv_id", "e"], "left").drop("e")
    totals = upper_totals(roots, paths, stride * band, band, room)
    hang = nodes.where("d = sd and d > 0").select(*KEY, "q1", "q2").join(totals, KEY).withColumn("d", F.expr(f"d div {step}"))
    return real(time_forward(attached(level(nodes), hang), room))


def subtree_totals(nodes: DataFrame, paths: DataFrame, shard: int, band: int, room: int) -> DataFrame:
    """KEY, leaves, saved, top (whether the parent is a node with more than ``shard`` turns below it)."""
    heavy = nodes.where(F.col("weight") > shard)
    salted = heavy.select(*KEY, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    deepest = paths.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALT)).cast("int")).join(salted, [*KEY, "salt"]).groupBy("conv_id").agg(F.max("d").alias("heavy"))
    roots = (paths.select("conv_id", *KEY).join(deepest, "conv_id", "left").where(F.col("d") == F.coalesce(F.col("heavy") + 1, F.lit(0)))
             .select("conv_id", F.col("d").alias("sd"), F.col("p1").alias("s1"), F.col("p2").alias("s2")))
    light = stored(nodes.where(F.col("weight") <= shard).join(roots, "conv_id"), "light")
    low = stored(time_forward(light, room), "low")
    if heavy.isEmpty():
        return low.withColumn("top", F.lit(False))
    hang = light.where("d = sd").select(*KEY, "q1", "q2").join(low, KEY)
    high = upper_totals(attached(heavy.select(*KEY, "q1", "q2", "conv_id", "leaves", "saved"), hang), paths, band, band, room)
    low = low.join(light.select(*KEY, (F.col("d") == F.col("sd")).alias("top")), KEY)
    return low.unionByName(high.withColumn("top", F.col("d") > 0))


def end_hashes(paths: DataFrame) -> DataFrame:
    """KEY, ends_sha256 of nodes at which conversations end: SHA-256 of their ids, ascending and joined by commas.

    A hash is a chain, so the ids of one node end in one task; they get there as texts of IDS ids that were joined in many.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for d, p1, p2, c in zip(*(x.to_pylist() for x in batch.columns)):
                if (d, p1, p2) != key or len(ids) == IDS:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = (d, p1, p2), []
                ids.append(c)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*KEY, "first", "text"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, ids[0], ",".join(map(str, ids)))], names=[*KEY, "first", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for d, p1, p2, text in zip(*(x.to_pylist() for x in batch.columns)):
                if (d, p1, p2) == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = (d, p1, p2), hashlib.sha256()
                state.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*KEY, "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=[*KEY, "ends_sha256"])

    ends = paths.where("d = n").select(*KEY, "conv_id")
    pieces = (ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(join, "d long, p1 long, p2 long, first long, text string"))
    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "text")
            .mapInArrow(hashed, "d long, p1 long, p2 long, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, shard: int = SHARD, band: int = BAND, room: int = ROOM) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are in the order of ``turn``, null first, and of a hash of role and text where it is equal; repeated rows are
    repeated turns. Null roles and texts count as empty. Rows without conv_id belong to no conversation. An empty table gives an
    empty result: there is no conversation that starts with the root. Other columns are not read.
    """
    paths = path_rows(conversations)
    nodes = paths.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
                                    F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.sum(F.col("n") - F.col("d") + 1).alias("weight"))
    up = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(up, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    totals = subtree_totals(nodes, paths, shard, band, room).withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})
    done = nodes.drop("leaves", "saved").join(totals, KEY).join(end_hashes(paths), KEY, "left")
    # only the children of nodes with many turns below them may be many: those are dealt by salt
    parts = F.when(F.col("weight") > shard, F.sequence(F.lit(1), F.lit(SALT))).otherwise(F.array(F.lit(0)))
    parent = nodes.select((F.col("d") + 1).alias("d"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.explode(parts).alias("salt"))
    done = done.withColumn("salt", F.when(F.col("top"), 1 + F.pmod("p1", F.lit(SALT)).cast("int")).otherwise(F.lit(0)))
    return done.join(parent, ["d", "q1", "q2", "salt"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
