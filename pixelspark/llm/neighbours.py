"""Nearest neighbours by inner product: inverted lists searched by an adaptive dimension scan.

Distinct vectors are dealt to lists by their nearest centroid. A list is stored in pieces of up to PIECE vectors; a piece
holds the vectors turned by a random rotation, in blocks of COLUMNS dimensions, and the vectors as they are. After a random
rotation the first d of D dimensions are a fair sample of a distance, so a distance is read block by block, and a candidate
is abandoned as soon as the distance so far, (1 + CONFIDENCE / sqrt(d)) above its share, rejects the hypothesis that it is
below the one that it has to beat. For an inner product of more than t that one is |q|^2 + |x|^2 - 2 t, which differs by
candidate. Candidates that pass all blocks get their exact product from the vectors as they are.

A query first searches the list that it would lie in; the worst of the nearest found there is the t with which its other
lists are searched. How many lists a query probes is chosen where the lists are fitted, as the least number that finds
RECALL of the nearest neighbours within the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import stored

#: Bytes of vectors, over all lengths, on which centroids are fitted, and the most vectors of one length.
FIT_BYTES, FIT_ROWS = 16 << 20, 32_768
LISTS = 1024
ROUNDS = 8
TRIALS = 256
RECALL = 0.98
PIECE = 2048
CHUNK = 256
COLUMNS = 16
CONFIDENCE = 2.1
#: Queries that meet a piece in one group.
BUNDLE = 1024
#: Room for rounding in the tests, as a share of the squared lengths.
SLACK = 1e-5


@dataclass(frozen=True)
class Lists:
    """The fitted index of one vector length; vectors are divided by ``scale`` before they are turned."""

    scale: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def turned(self, x: np.ndarray) -> np.ndarray:
        return x / self.scale @ self.rotation

    def nearest(self, z: np.ndarray) -> np.ndarray:
        return nearest_centre(z, self.centres)


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (double), k1, k2 (its hash) of each distinct row that takes part."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    clean = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return (df.where(F.col(vec_id).isNotNull() & v.isNotNull() & good).select(F.col(vec_id).cast("long").alias("vec_id"), clean.alias("vec"))
            .withColumn("k1", F.xxhash64(F.lit(1), "vec")).withColumn("k2", F.xxhash64(F.lit(2), "vec")).dropDuplicates(["vec_id", "k1", "k2"]))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def nearest_centre(z: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(z[a:a + 4096] @ centres.T - half).argmax(1) for a in range(0, len(z), 4096)] or [np.zeros(0, np.int64)])


def fit_lists(x: np.ndarray, rows: int, scale: float, limit: int, seed: int = 7) -> Lists:
    """Rotation, centroids and number of probes from a sample of the ``rows`` vectors of one length."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    z = x / scale @ rotation
    k = int(max(1, min(LISTS, round(rows ** 0.5), len(z))))
    centres = z[rng.permutation(len(z))[:k]]
    for _ in range(ROUNDS):
        at = nearest_centre(z, centres)
        n = np.bincount(at, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, at, z)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    at, some = nearest_centre(z, centres), rng.permutation(len(z))[:TRIALS]
    found = np.zeros(k)
    order = probe_order(z[some], at[some], centres, k)
    for i, lists in zip(some, order):
        score = z @ z[i]
        score[i] = -np.inf
        near = np.argsort(-score)[:min(limit, len(z) - 1)]
        rank = np.empty(k, np.int64)
        rank[lists] = np.arange(k)
        found += np.bincount(rank[at[near]], minlength=k)
    share = np.cumsum(found) / max(1, found.sum())
    return Lists(scale, rotation, centres, int(min(k, np.searchsorted(share, RECALL) + 1)))


def probe_order(z: np.ndarray, own: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """The lists that each query probes: its own, then those whose centroids have the largest products with it."""
    score = z @ centres.T
    score[np.arange(len(z)), own] = np.inf
    return np.argsort(-score, axis=1, kind="stable")[:, :probes]


def fitted(reps: DataFrame, limit: int) -> dict[int, Lists]:
    """The lists of each vector length. One row per length comes to the driver, and a sample bounded by FIT_BYTES."""
    width = F.size("vec")
    sizes = reps.groupBy(width.alias("width")).agg(F.count(F.lit(1)).alias("rows"), F.max(F.expr("array_max(transform(vec, x -> abs(x)))")).alias("scale")).collect()
    if not sizes:
        return {}
    want = {s["width"]: min(1.0, max(256, min(FIT_ROWS, FIT_BYTES // len(sizes) // (8 * s["width"]))) / s["rows"]) for s in sizes}
    cut = F.element_at(F.create_map(*[F.lit(x) for w, share in want.items() for x in (w, int(share * (1 << 30)))]), width)
    sample = reps.where(F.pmod("k2", F.lit(1 << 30)) < cut).select("k1", "k2", "vec").toArrow()
    rows = sample.column("vec").combine_chunks()
    order = np.lexsort((sample.column("k2").to_numpy(), sample.column("k1").to_numpy()))  # alike however the rows arrive
    rows = rows.take(pa.array(order))
    widths = np.diff(rows.offsets.to_numpy())
    return {s["width"]: fit_lists(matrix(rows.filter(pa.array(widths == s["width"])), s["width"]), s["rows"], s["scale"], limit)
            if (widths == s["width"]).any() else Lists(s["scale"], np.eye(s["width"]), np.zeros((1, s["width"])), 1) for s in sizes}


def by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of each vector length in a batch; ``vec`` is the first column."""
    widths = np.diff(batch.column(0).offsets.to_numpy())
    for w in np.unique(widths).tolist():
        yield w, batch.filter(pa.array(widths == w))


def index_pieces(reps: DataFrame, model) -> DataFrame:
    """The index: piece, width, list, ids (of the copies of each vector), raw vectors and rotated column blocks."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, b in by_width(batch):
                lists = Lists(*model.value[w])
                at = lists.nearest(lists.turned(matrix(b.column(0), w)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(at), w, np.int32)), pa.array(at.astype(np.int32))],
                                                 names=[*b.schema.names, "width", "list"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None

        def piece(t: pa.Table, w: int, at: int) -> pa.RecordBatch:
            nonlocal made
            raw = matrix(t.column("vec").combine_chunks(), w)
            z = Lists(*model.value[w]).turned(raw).astype("<f4")
            row = {"piece": pa.array([part << 32 | made]), "width": pa.array([w], pa.int32()), "list": pa.array([at], pa.int32()),
                   "ids": pa.array([t.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))), "raw": pa.array([raw.astype("<f8").tobytes()], pa.binary()),
                   "columns": pa.array([[np.ascontiguousarray(z[:, c:c + COLUMNS]).tobytes() for c in range(0, w, COLUMNS)]], pa.list_(pa.binary()))}
            made += 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = held.column("width").to_numpy().astype(np.int64) << 32 | held.column("list").to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1]) if len(key) else np.zeros(0, np.int64)
            for a, b in zip(starts, [*starts[1:], len(key)]):
                whole = b if b < len(key) else a + (b - a) // PIECE * PIECE  # the last list may go on
                for i in range(a, whole, PIECE):
                    yield piece(held.slice(i, min(PIECE, whole - i)), int(key[a] >> 32), int(key[a] & 0xFFFFFFFF))
                if b == len(key):
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield piece(held, held.column("width")[0].as_py(), held.column("list")[0].as_py())

    placed = reps.select("vec", "ids", "k1", "k2").mapInArrow(place, "vec array<double>, ids array<long>, k1 long, k2 long, width int, list int")
    order = ["width", "list", "k1", "k2"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        cut, "piece long, width int, list int, ids array<array<long>>, raw binary, columns array<binary>")


def probed(queries: DataFrame, model) -> DataFrame:
    """k1, k2, vec of each query once for each list that it probes: width, list, and ``own`` for the list it lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, b in by_width(batch):
                lists = Lists(*model.value[w])
                for a in range(0, b.num_rows, 1024):
                    part = b.slice(a, 1024)
                    z = lists.turned(matrix(part.column(0), w))
                    at = probe_order(z, lists.nearest(z), lists.centres, lists.probes)
                    n = at.shape[1]
                    for c in range(0, n, 16):
                        some = at[:, c:c + 16]
                        again = part.take(pa.array(np.repeat(np.arange(len(z)), some.shape[1])))
                        own = np.zeros(some.shape, bool)
                        own[:, 0] = c == 0
                        yield pa.RecordBatch.from_arrays([*again.columns, pa.array(np.full(some.size, w, np.int32)), pa.array(some.ravel().astype(np.int32)),
                                                          pa.array(own.ravel())], names=[*again.schema.names, "width", "list", "own"])

    return queries.select("vec", "k1", "k2").mapInArrow(run, "vec array<double>, k1 long, k2 long, width int, list int, own boolean")


def scan(piece: dict, queries: np.ndarray, least: np.ndarray, lists: Lists, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, product) of up to ``keep`` best candidates of each query in a piece, products of at least ``least``."""
    w, scale2 = piece["width"], lists.scale * lists.scale
    raw = np.frombuffer(piece["raw"], "<f8").reshape(-1, w)
    blocks = [np.frombuffer(c, "<f4").reshape(len(raw), -1) for c in piece["columns"]]
    first = np.array([min(i) for i in piece["ids"]], np.int64)
    z = lists.turned(queries)
    nq, nx = (z * z).sum(1), ((raw / lists.scale) ** 2).sum(1)
    top_q, top_x, top_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    beat = least / scale2
    for a in range(0, len(raw), CHUNK):
        b = min(a + CHUNK, len(raw))
        far = nq[:, None] + nx[a:b] - 2 * beat[:, None]
        room = SLACK * (nq[:, None] + nx[a:b])
        qi, xi, seen, d = None, None, np.zeros((len(z), b - a)), 0
        for k, block in enumerate(blocks[:-1]):
            part = z[:, k * COLUMNS:(k + 1) * COLUMNS]
            d += part.shape[1]
            bound = d / w * (1 + CONFIDENCE / np.sqrt(d)) ** 2
            if qi is None:
                x = block[a:b].astype(np.float64)
                seen += (part * part).sum(1)[:, None] + (x * x).sum(1) - 2 * part @ x.T
                alive = seen <= bound * far + room
                if alive.mean() < 0.2:
                    qi, xi = np.nonzero(alive)
                    seen, far, room = seen[qi, xi], far[qi, xi], room[qi, xi]
            else:
                gap = part[qi] - block[a + xi]
                seen = seen + (gap * gap).sum(1)
                alive = seen <= bound * far + room
                qi, xi, seen, far, room = qi[alive], xi[alive], seen[alive], far[alive], room[alive]
        if qi is None:
            qi, xi = np.nonzero(seen <= far + room)
        if not len(qi):
            continue
        xi = xi + a
        score = np.concatenate([np.einsum("ij,ij->i", queries[qi[i:i + 65536]], raw[xi[i:i + 65536]]) for i in range(0, len(qi), 65536)])
        hit = score >= least[qi]
        top_q, top_x, top_s = np.concatenate([top_q, qi[hit]]), np.concatenate([top_x, xi[hit]]), np.concatenate([top_s, score[hit]])
        order = np.lexsort((first[top_x], -top_s, top_q))
        top_q, top_x, top_s = top_q[order], top_x[order], top_s[order]
        start = np.searchsorted(top_q, np.arange(len(z)))
        place = np.arange(len(top_q)) - start[top_q]
        some = place < keep
        worst = np.flatnonzero(place == keep - 1)
        least = least.copy()
        least[top_q[worst]] = np.maximum(least[top_q[worst]], top_s[worst])
        beat = least / scale2
        top_q, top_x, top_s = top_q[some], top_x[some], top_s[some]
    return top_q, top_x, top_s


def searched(pieces: DataFrame, probes: DataFrame, model, keep: int) -> DataFrame:
    """k1, k2 (of the query), score, ids of the best candidates in each piece of the lists probed.

    ``probes`` has ``least``, the product that is to be reached. Groups are a piece and a bundle of about BUNDLE queries: the
    number of bundles comes from the counted queries of a list, so neither side of a group grows with a list.
    """
    count = probes.groupBy("width", "list").agg(F.ceil(F.count(F.lit(1)) / BUNDLE).cast("int").alias("bundles"))
    meet = pieces.select("piece", "width", "list").join(count, ["width", "list"])
    right = probes.join(meet, ["width", "list"]).withColumn("bundle", F.pmod(F.xxhash64("k1", "k2"), "bundles").cast("int"))
    left = (pieces.join(meet.select("piece", "bundles"), "piece").withColumn("bundle", F.explode(F.sequence(F.lit(0), F.col("bundles") - 1)))
            .select(F.col("piece").alias("part"), F.col("bundle").alias("share"), "width", "ids", "raw", "columns"))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out = {"k1": [], "k2": [], "score": [], "ids": []}
        if a.num_rows and b.num_rows:
            piece = a.slice(0, 1).to_pylist()[0]
            lists = Lists(*model.value[piece["width"]])
            k1, k2, least = (b.column(c).to_numpy() for c in ("k1", "k2", "least"))
            q, x, s = scan(piece, matrix(b.column("vec").combine_chunks(), piece["width"]), least, lists, keep)
            out = {"k1": k1[q], "k2": k2[q], "score": s, "ids": [piece["ids"][i] for i in x.tolist()]}
        return pa.table({"k1": pa.array(out["k1"], pa.int64()), "k2": pa.array(out["k2"], pa.int64()), "score": pa.array(out["score"], pa.float64()),
                         "ids": pa.array(out["ids"], pa.list_(pa.int64()))})

    return (left.groupBy("part", "share").cogroup(right.select("piece", "bundle", "k1", "k2", "vec", "least").groupBy("piece", "bundle"))
            .applyInArrow(run, "k1 long, k2 long, score double, ids array<long>"))


def best(hits: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), F.array_min("ids"))
    return hits.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep).drop("_n")


def nearest(df: DataFrame, limit: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``limit`` rows nearest by inner product to each row whose id is divisible by ``every``.

    Equal products go by the smaller id. Rows whose vector is null, empty, zero or holds null or non-finite components, and
    rows without an id, take no part. Vectors of different lengths are never compared. Rows that repeat id and vector
    count once; an id with several vectors stands for each of them, and is never its own neighbour. Copies of a vector are
    one entry of the index that carries its ``limit`` + 1 smallest ids, since no others can be among the nearest. An empty
    table gives an empty result; other columns are not read.
    """
    spark, keep = df.sparkSession, limit + 1
    rows = stored(usable(df, vec_id, vector), "vectors")
    copy = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    reps = stored(rows.withColumn("_n", copy).where(F.col("_n") <= keep).groupBy("k1", "k2")
                  .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec")), "copies")
    model = spark.sparkContext.broadcast({w: (x.scale, x.rotation, x.centres, x.probes) for w, x in fitted(reps, keep).items()})
    pieces = stored(index_pieces(reps, model), "index")
    asked = rows.where(F.col("vec_id") % every == 0)
    probes = stored(probed(asked.dropDuplicates(["k1", "k2"]), model), "probes")
    home = stored(best(searched(pieces, probes.where("own").withColumn("least", F.lit(float("-inf"))), model, keep), keep), "home")
    floor = home.groupBy("k1", "k2").agg(F.when(F.count(F.lit(1)) >= keep, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
    away = searched(pieces, probes.where("not own").join(floor, ["k1", "k2"]), model, keep)
    rows_of = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "id")
    found = (best(home.unionByName(away), keep).select("k1", "k2", "score", F.explode("ids").alias("id"))
             .withColumn("_n", F.row_number().over(rows_of)).where(F.col("_n") <= keep)
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score"))).alias("near")))
    other = F.slice(F.filter("near", lambda x: x["id"] != F.col("vec_id")), 1, limit)
    return (asked.select("vec_id", "k1", "k2").join(found, ["k1", "k2"]).select(F.col("vec_id").alias("query_id"), F.posexplode(other).alias("at", "x"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))
