"""Best-fit packing of token sequences by a linear grouping scheme.

Lengths never exceed the capacity, so their histogram has a fixed size whatever the corpus. The scheme works on the
histogram: lengths above ``small`` are cut into groups of equal cardinality and rounded up to the largest of their group;
configurations of the few rounded sizes are filled as far as a subset sum allows and used as often as the demand
permits; actual lengths then take the slots, and small lengths go where the least room is left. The plan says which
rank of which length goes where; ranks are counted in Spark, so nothing whole passes through one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pixelspark.llm.common import list_array, slices, stored, strings
from pixelspark.llm.words import WordEncoder

CAPACITY = 4096
GROUPS = 1024
SMALL = CAPACITY // 8
#: Rows of one length that are numbered by one task.
RANKED_ROWS = 200_000


def pieces(docs: DataFrame, model: bytes, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token ids of each text with ``end_id`` behind them, cut into pieces of ``capacity``.

    One row per piece: doc_id, piece, start, length, ids_crc32 and, ``with_ids``, ids. Null texts count as empty, so
    every row has a piece. Rows with a doc_id that occurs twice are treated apart. Other columns are not read.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    fields = [d.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(shipped.value)
        for batch in slices(batches, "text"):
            ids, n = encoder.encode(strings(batch))
            ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
            n = n + 1
            k = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), k)
            no = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            length = np.minimum(n[row] - no * capacity, capacity)
            ends = np.cumsum(length)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends - length, ends)]
            out = [batch.column(0).take(pa.array(row)).cast(arrow[0].type), pa.array(no.astype(np.int32)), pa.array(no * capacity),
                   pa.array(length), pa.array(crc, pa.int64())]
            if with_ids:
                out.append(list_array(ids.view("<i4"), length).cast(arrow[5].type))
            yield pa.RecordBatch.from_arrays(out, schema=arrow)

    return d.mapInArrow(run, schema)


def grouped(counts: np.ndarray, small: int, groups: int) -> list[list[tuple[int, int]]]:
    """Large lengths, longest first, in groups of equal cardinality: lists of (length, count). A length may be split."""
    large = [(n, int(counts[n])) for n in range(len(counts) - 1, small, -1) if counts[n]]
    size = -(-sum(c for _, c in large) // groups)
    out, room = [], 0
    for n, c in large:
        while c:
            if not room:
                out.append([])
                room = size
            took = min(c, room)
            out[-1].append((n, took))
            c, room = c - took, room - took
    return out


def best_configuration(sizes: list[int], demand: list[int], capacity: int) -> dict[int, int]:
    """Counts of each size: the largest size in demand, and what fills the rest as far as possible."""
    first = next(i for i, d in enumerate(demand) if d)
    room = capacity - sizes[first]
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for i, (s, d) in enumerate(zip(sizes, demand)):
        for _ in range(min(d - (i == first), room // s)):
            new = reach | reach << s & mask
            if new == reach:
                break
            steps.append((i, reach))
            reach = new
    total, uses = reach.bit_length() - 1, {first: 1}
    for i, before in reversed(steps):
        if not before >> total & 1:
            uses[i] = uses.get(i, 0) + 1
            total -= sizes[i]
    return uses


def pack_plan(counts: np.ndarray, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> np.ndarray:
    """Where the documents of each length go: rows (length, rank, count, sequence, per sequence, offset).

    ``counts[n]`` is the number of documents of length n, 1 <= n <= capacity. The document of a length with rank
    rank + j, 0 <= j < count, goes to sequence + j div (per sequence) at offset + (j mod per sequence) * length.
    """
    rank = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    sequence = 0

    def put(n: int, count: int, at: int, per: int, offset: int) -> None:
        rows.append((n, int(rank[n]), count, at, per, offset))
        rank[n] += count

    def leave(room: int, at: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append((at, count))

    stock = grouped(counts, small, groups)
    sizes, demand = [g[0][0] for g in stock], [sum(c for _, c in g) for g in stock]
    while any(demand):
        uses = best_configuration(sizes, demand, capacity)
        times = min(demand[i] // k for i, k in uses.items())
        slots = [i for i, k in sorted(uses.items()) for _ in range(k)]
        lanes = []
        for i in slots:
            lane, need = [], times
            while need:
                n, c = stock[i][0]
                took = min(c, need)
                lane.append([n, took])
                need -= took
                stock[i][0] = (n, c - took)
                if c == took:
                    stock[i].pop(0)
            demand[i] -= times
            lanes.append(lane)
        done = 0
        while done < times:
            step = min(lane[0][1] for lane in lanes)
            offset = 0
            for lane in lanes:
                n = lane[0][0]
                put(n, step, sequence + done, 1, offset)
                offset += n
                lane[0][1] -= step
                if not lane[0][1]:
                    lane.pop(0)
            leave(capacity - offset, sequence + done, step)
            done += step
        sequence += times
    for n in range(min(small, capacity), 0, -1):
        left = int(counts[n])
        while left:
            k = bisect.bisect_left(order, n)
            if k == len(order):
                opened = -(-left // (capacity // n))
                leave(capacity, sequence, opened)
                sequence += opened
                continue
            room = order[k]
            at, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], order[k]
            per = room // n
            full = min(count, left // per)
            offset = capacity - room
            if full:
                put(n, full * per, at, per, offset)
                leave(room - per * n, at, full)
                left -= full * per
            if full < count and left:
                put(n, left, at + full, left, offset)
                leave(room - left * n, at + full, 1)
                full, left = full + 1, 0
            leave(room, at + full, count - full)
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def numbered(df: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """``rank`` from 0 among the rows of a group. ``most`` is the size of the largest group; large ones are split by a hash."""
    parts = max(1, -(-most // RANKED_ROWS))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(parts)))
    inside = Window.partitionBy(group, "_salt").orderBy(*order)
    before = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy(group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return (salted.withColumn("rank", F.row_number().over(inside) - F.lit(1)).join(offsets, [group, "_salt"])
            .withColumn("rank", F.col("rank") + F.col("_before")).drop("_salt", "_before"))


def pack(items: DataFrame, capacity: int = CAPACITY, small: int | None = None, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length, 1 <= length <= capacity.

    ``items`` should be stored: it is read for the histogram and again for the ranks. An empty table gives an empty one.
    """
    hist = items.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in hist:
        counts[n] = c
    plan = pack_plan(counts, capacity, capacity // 8 if small is None else small, groups)
    key = plan[:, 0] << 44 | plan[:, 1]
    shipped = items.sparkSession.sparkContext.broadcast((key, plan))
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in items.columns]
    ranked = numbered(items, "length", order, int(counts.max()))
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    arrow = to_arrow_schema(schema)
    names = items.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, plan = shipped.value
        for b in batches:
            if not b.num_rows:
                continue
            col = dict(zip(b.schema.names, b.columns))
            n, r = col["length"].to_numpy(), col["rank"].to_numpy()
            p = plan[np.searchsorted(key, n << 44 | r, "right") - 1]
            j = r - p[:, 1]
            out = [col[c].cast(arrow.field(c).type) for c in names]
            yield pa.RecordBatch.from_arrays([*out, pa.array(p[:, 3] + j // p[:, 4]), pa.array(p[:, 5] + j % p[:, 4] * n)], schema=arrow)

    return ranked.select(*names, F.col("rank").cast("long").alias("rank")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, model: bytes, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents and their places; the pieces are stored once in the shared folder."""
    return pack(stored(pieces(docs, model, end_id, capacity), "pieces"), capacity)
