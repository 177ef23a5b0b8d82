"""Connected components of a link table by alternating star operations; links stay in Spark throughout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import stored


#: Links that one task contracts by itself.
TASK_LINKS = 1_000_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: every id but the smallest of its component, and that smallest id."""
    ids, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    parent = list(range(len(ids)))
    for a, b in zip(code[:len(u)].tolist(), code[len(u):].tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    for i in range(len(parent)):  # a parent is never larger, so its own root is known
        parent[i] = parent[parent[i]]
    root = np.array(parent, np.int64)
    some = np.flatnonzero(root != np.arange(len(ids)))
    return ids[some], ids[root[some]]


def _in_tasks(edges: DataFrame, tasks: int) -> DataFrame:
    """Each task turns the links it reads into stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in contracted(u, v)], names=["u", "v"])

    return edges.repartition(tasks).mapInArrow(run, "u long, v long")


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (u, v): the smallest id that links lead to, in either direction.

    Tasks of up to TASK_LINKS links first contract theirs to stars. While there is more than one task, large-star sends
    each node's larger neighbours to the smallest it knows and small-star the smaller ones and itself. Both are a grouped
    minimum (combined before the shuffle, so a hub costs no task more) and an equality join; the links shrink to stars in
    a number of rounds that grows with the logarithm of a component's size. Rounds are written to the shared folder.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
    seen = None
    while True:
        tasks = max(1, -(-edges.count() // TASK_LINKS))
        edges = _in_tasks(edges, tasks)
        if tasks == 1:
            edges = stored(edges, "links")
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_min_neighbour(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.join(_min_neighbour(large), "u")
        small = down.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            down.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "links")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def forest(linked: np.ndarray, group: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the groups of ``rows`` and ``cols`` as far as ``linked`` does; ``group`` is brought up to date.

    At most one link per join, never all pairs.
    """
    out: list[tuple[int, int]] = []
    while True:
        open_ = linked & (group[rows][:, None] != group[cols][None, :])
        hit = np.flatnonzero(open_.any(1))
        if not len(hit):
            return out
        for i, j in zip(hit, open_[hit].argmax(1)):
            a, b = group[rows[i]], group[cols[j]]
            if a != b:
                out.append((int(rows[i]), int(cols[j])))
                group[group == max(a, b)] = min(a, b)
