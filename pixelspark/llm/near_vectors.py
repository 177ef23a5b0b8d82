"""Near copies of vectors by an epsilon grid order join.

Vectors of unit length with cosine >= c are at most sqrt(2 - 2c) apart. The vectors are turned to their principal
directions, a grid of that width is laid over the leading ones, and the vectors are sorted by cell. The sorted sequence
is cut into intervals with a bounding box each; pairs of intervals are refined from the whole sequence down, level by
level, and a pair whose boxes are farther apart than the width is left out with all its parts. What remains is compared
in double precision, block by block. A task returns the number of links of each vector and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import stored
from pixelspark.llm.components import components, forest

DIMENSIONS = 8
#: A further direction that keeps vectors of different lengths farther apart than any width.
APART = 8.0
LEAF = 2048
BLOCK = 256
FAN = 16
#: Intervals on each side of a task.
DEAL = 4
#: About as many rows of each length are those on which the principal directions are fitted; they only decide the order, never a link.
FIT_ROWS = 4096
#: Room for rounding in distances between boxes.
SLACK = 1e-6


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (double), k1, k2 and ``ok``: false for vectors that link with nothing.

    Those are null, empty or zero vectors, vectors with null or non-finite components, and rows without an id.
    """
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0) & F.col(vec_id).isNotNull()
    clean = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), clean.alias("vec"), F.coalesce(ok, F.lit(False)).alias("ok"))
            .withColumn("k1", F.xxhash64(F.lit(1), "vec")).withColumn("k2", F.xxhash64(F.lit(2), "vec")))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal(x: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Leading principal directions of the rows, as columns."""
    return np.linalg.eigh(np.cov(x.T).reshape(x.shape[1], x.shape[1]))[1][:, ::-1][:, :dimensions]


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def bases(reps: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of each vector length, from about FIT_ROWS rows taken by their hash."""
    width = F.size("vec")
    rows = {r["width"]: r["count"] for r in reps.groupBy(width.alias("width")).count().collect()}
    out = {w: np.zeros((w, DIMENSIONS)) for w in rows}
    if rows:
        share = F.element_at(F.create_map(*[F.lit(x) for w, n in rows.items() for x in (w, int(min(1.0, FIT_ROWS / n) * (1 << 30)))]), width)
        fit = reps.where(F.pmod("k2", F.lit(1 << 30)) < share).select("k1", "k2", "vec").toArrow().sort_by([("k1", "ascending"), ("k2", "ascending")])
        some = fit.column("vec").combine_chunks()
        widths = np.diff(some.offsets.to_numpy())
        for w in rows:
            x = some.filter(pa.array(widths == w))
            if len(x) > 1:
                found = principal(unit(matrix(x)))
                out[w][:, :found.shape[1]] = found
    return out


def by_width(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of each vector length."""
    widths = np.diff(batch.column(column).offsets.to_numpy())
    for w in np.unique(widths).tolist():
        yield w, batch.filter(pa.array(widths == w))


def leaves(reps: DataFrame, basis: dict[int, np.ndarray], width: float, kind: str) -> DataFrame:
    """The grid-ordered sequence in intervals of up to LEAF vectors, in rows of up to BLOCK of one length: leaf, block, low and
    high corner in the leading directions, ids, number of copies and vectors (as ``kind``). Lengths follow each other."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, b in by_width(batch, 1):
                cell = np.clip(np.floor(unit(matrix(b.column(1))) @ basis[w] / width), -127, 127).astype(np.int16) + 128
                key = [w.to_bytes(4, "big") + c.tobytes() for c in cell.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(key, pa.binary())], names=[*b.schema.names, "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None

        def block(t: pa.Table) -> pa.RecordBatch:
            nonlocal done
            one = t.combine_chunks().to_batches()[0]
            raw = matrix(one.column(1)).astype(kind)
            z = np.concatenate([unit(raw) @ basis[raw.shape[1]], np.full((len(raw), 1), APART * raw.shape[1])], 1)
            row = pa.RecordBatch.from_pydict({
                "leaf": pa.array([part << 32 | done // (LEAF // BLOCK)], pa.int64()), "block": pa.array([done % (LEAF // BLOCK)], pa.int32()),
                "low": pa.array([z.min(0)], pa.list_(pa.float64())), "high": pa.array([z.max(0)], pa.list_(pa.float64())),
                "ids": pa.array([one.column(0).to_numpy()], pa.list_(pa.int64())),
                "copies": pa.array([one.column(2).to_numpy()], pa.list_(pa.int64())), "data": pa.array([raw.tobytes()], pa.binary())})
            done += 1
            return row

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            widths = np.diff(held.column(1).combine_chunks().offsets.to_numpy())
            starts = np.concatenate([[0], np.flatnonzero(np.diff(widths)) + 1]) if len(widths) else []
            for a, b in zip(starts, [*starts[1:], len(widths)]):
                whole = b if b < len(widths) else a + (b - a) // BLOCK * BLOCK  # the last length may go on
                for i in range(a, whole, BLOCK):
                    yield block(held.slice(i, min(BLOCK, whole - i)))
                if b == len(widths):
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield block(held)

    placed = reps.select("rep", "vec", "copies", "k1").mapInArrow(place, "rep long, vec array<double>, copies long, k1 long, cell binary")
    ordered = placed.repartitionByRange("cell", "k1").sortWithinPartitions("cell", "k1")
    return ordered.mapInArrow(cut, "leaf long, block int, low array<double>, high array<double>, ids array<long>, copies array<long>, data binary")


def near_intervals(boxes: DataFrame, width: float) -> DataFrame:
    """Pairs (a, b), a <= b, of places in the sequence of leaves whose boxes are within ``width``: pairs of intervals refined
    level by level.

    ``boxes``: at, low, high. An interval of one level holds FAN of the level below.
    """
    lows, highs = corners("low", F.min), corners("high", F.max)
    level = boxes
    n, levels = boxes.count(), [level]
    while n > 1:
        level = level.withColumn("at", F.floor(F.col("at") / FAN)).groupBy("at").agg(lows.alias("low"), highs.alias("high"))
        levels.append(level)
        n = -(-n // FAN)
    gap = "aggregate(zip_with(zip_with(a_low, b_high, (x, y) -> x - y), zip_with(b_low, a_high, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D)), 0D, (s, x) -> s + x * x)"
    pairs = levels[-1].select(F.col("at").alias("a"), F.col("at").alias("b"))
    for level in levels[-2::-1]:
        part = level.select("at", F.floor(F.col("at") / FAN).alias("up"), "low", "high")
        a, b = (part.select(*[F.col(c).alias(f"{s}_{c}") for c in part.columns]) for s in "ab")
        pairs = (pairs.join(a, F.col("a") == F.col("a_up")).join(b, F.col("b") == F.col("b_up"))
                 .where((F.col("a_at") <= F.col("b_at")) & (F.expr(gap) <= (width + SLACK) ** 2))
                 .select(F.col("a_at").alias("a"), F.col("b_at").alias("b")))
    return pairs


def corners(column: str, of) -> Column:
    return F.array(*[of(F.col(column)[i]) for i in range(DIMENSIONS + 1)])


def sequence(blocks: DataFrame) -> DataFrame:
    """leaf, at (its place in the sequence), low, high. Places are counted by the parts of the sequence, a row for each part."""
    part = F.shiftright("leaf", 32)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy(part.alias("part")).agg((F.max("leaf").bitwiseAND(F.lit(0xFFFFFFFF)) + 1).alias("n"))
    first = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    boxes = blocks.groupBy("leaf").agg(corners("low", F.min).alias("low"), corners("high", F.max).alias("high")).withColumn("part", part)
    return boxes.join(first, "part").select("leaf", (F.col("first") + F.col("leaf").bitwiseAND(F.lit(0xFFFFFFFF))).alias("at"), "low", "high")


def compare(table: pa.Table, cosine: float, width: float, kind: str) -> pa.Table:
    """Links between the leaves of two sides (or within one): rows (id, other, links); forest links have links 0."""
    rows = sorted(table.select(["side_a", "side_b", "side", "leaf", "block", "low", "high", "ids", "copies", "data"]).to_pylist(), key=lambda r: (r["side"], r["leaf"], r["block"]))
    ids = np.concatenate([r["ids"] for r in rows]).astype(np.int64)
    copies = np.concatenate([r["copies"] for r in rows]).astype(np.int64)
    size = [len(r["ids"]) for r in rows]
    ends = np.cumsum(size)
    x = [unit(np.frombuffer(r["data"], kind).reshape(n, -1)) for r, n in zip(rows, size)]
    low, high = np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])
    group, links, edges = np.arange(len(ids)), np.zeros(len(ids), np.int64), []
    same = rows[0]["side_a"] == rows[0]["side_b"]
    side = np.array([r["side"] for r in rows])
    for i in range(len(rows)):
        gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i]))
        near = (gap * gap).sum(1) <= (width + SLACK) ** 2
        for j in (i + np.flatnonzero(near & (same | (side[i:] != side[i])))).tolist():
            linked = x[i] @ x[j].T >= cosine
            if i == j:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            p, q = (np.arange(ends[k] - size[k], ends[k]) for k in (i, j))
            links[p] += linked @ copies[q]
            if i != j:
                links[q] += linked.T @ copies[p]
            edges += forest(linked, group, p, q)
    hit = np.flatnonzero(links)
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pa.table({"id": np.concatenate([ids[hit], ids[e[:, 0]]]), "other": pa.array(np.concatenate([np.zeros(len(hit), np.int64), ids[e[:, 1]]]), mask=np.arange(len(hit) + len(e)) < len(hit)),
                     "links": np.concatenate([links[hit], np.zeros(len(e), np.int64)])})


def near_duplicates(df: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row: vec_id, n_links (other rows linked directly), component_id, kept (first of its component).

    Copies of a vector are compared once, by their smallest id. Vectors of each length are compared among themselves; one of
    another length never links. Invalid ones form components of their own. Rows that share a vec_id count as one place in
    the graph. An empty table gives an empty result; other columns are not read.

    A task takes DEAL intervals from each of two places of the sequence, so an interval is sent once for every DEAL of those
    that may hold a partner.
    """
    spark = df.sparkSession
    kind = "<f4" if df.schema[vector].dataType.simpleString() == "array<float>" else "<f8"
    rows = stored(valid_vectors(df, vec_id, vector), "vectors")
    reps = stored(rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")), "copies")
    basis = bases(reps)
    if not basis:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = float(np.sqrt(2 - 2 * cosine))
    blocks = stored(leaves(reps, basis, width, kind), "leaves")
    places = stored(sequence(blocks), "boxes")
    side = lambda c: F.floor(F.col(c) / DEAL)
    pairs = near_intervals(places.drop("leaf"), width)
    both = pairs.select("a", "b", side("a").alias("side_a"), side("b").alias("side_b"))
    of = [both.select("side_a", "side_b", F.col(c).alias("at"), F.col(f"side_{c}").alias("side")) for c in "ab"]
    sides = of[0].union(of[1]).distinct().join(places.select("at", "leaf"), "at").drop("at")
    task = sides.join(blocks, "leaf").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "side_a", "side_b")
    found = stored(task.groupBy("side_a", "side_b").applyInArrow(lambda t: compare(t, cosine, width, kind), "id long, other long, links long"), "found")
    links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    member = components(found.where("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v")))
    of = (reps.select("k1", "k2", "rep", "copies").join(links, "rep", "left")
          .join(member.withColumnRenamed("id", "rep"), "rep", "left")
          .select("k1", "k2", F.lit(True).alias("ok"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                  F.coalesce("component_id", "rep").alias("component_id")))
    out = rows.select("vec_id", "k1", "k2", "ok").join(of, ["k1", "k2", "ok"], "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
