"""Token ids in files of patched frame-of-reference blocks.

A file row is a page: whole documents, in ascending doc_id order, of together about ``PAGE_IDS`` ids. Its ids lie in
blocks of ``BLOCK``: the block minimum is subtracted, the rest is packed at the width that ``PERCENTILE`` per cent of
the block need, and ids that need more are stored in an exception list (place, value). ``index`` holds start, minimum,
width and number of exceptions of each block, so a block can be read alone. Parquet carries the pages: its writer
commits whole tasks, so a lost executor leaves no half file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import shared_folder, slices, strings
from pixelspark.llm.words import WordEncoder

BLOCK = 256
PERCENTILE = 90
PAGE_IDS = 1 << 16
INDEX = np.dtype([("start", "<u4"), ("low", "<u4"), ("width", "u1"), ("extra", "<u2")])
PAGE = "part int, page int, n_ids long, doc_ids array<long>, doc_lens array<long>, index binary, payload binary"


def _places(start: np.ndarray, length: int) -> np.ndarray:
    return start[:, None] + np.arange(length)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, bytes]:
    """(index, payload) of the ids; the last block is filled up with its last id."""
    if len(ids) == 0:
        return b"", b""
    full = np.concatenate([ids, np.full(-len(ids) % BLOCK, ids[-1])]).astype(np.int64).reshape(-1, BLOCK)
    low = full.min(1)
    rest = full - low[:, None]
    k = max(0, -(-BLOCK * percentile // 100) - 1)
    width = np.ceil(np.log2(np.partition(rest, k, axis=1)[:, k] + 1)).astype(np.int64)
    over = rest >> width[:, None] > 0
    extra = over.sum(1)
    size = BLOCK // 8 * width + 5 * extra
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    low_bits = np.where(over, 0, rest).astype("<u4").view(np.uint8).reshape(-1, BLOCK, 4)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(low_bits[rows], axis=2, count=int(w), bitorder="little").reshape(len(rows), -1)
        out[_places(start[rows], BLOCK // 8 * w)] = np.packbits(bits, axis=1, bitorder="little")
    at, place = np.nonzero(over)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(extra) - extra, extra)
    first = start[at] + BLOCK // 8 * width[at]
    out[first + nth] = place
    out[_places(first + extra[at] + 4 * nth, 4)] = rest[at, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    index = np.zeros(len(low), INDEX)
    index["start"], index["low"], index["width"], index["extra"] = start, low, width, extra
    return index.tobytes(), out.tobytes()


def unpack_blocks(index: bytes, payload: bytes, n: int) -> np.ndarray:
    """The ids again, as little-endian unsigned 32-bit integers."""
    idx, raw = np.frombuffer(index, INDEX), np.frombuffer(payload, np.uint8)
    start, width, extra = (idx[c].astype(np.int64) for c in ("start", "width", "extra"))
    out = np.zeros((len(idx), BLOCK), np.int64)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.zeros((len(rows), BLOCK, 32), np.uint8)
        bits[:, :, :w] = np.unpackbits(raw[_places(start[rows], BLOCK // 8 * w)], axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        out[rows] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    at = np.repeat(np.arange(len(idx)), extra)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(extra) - extra, extra)
    first = start[at] + BLOCK // 8 * width[at]
    if len(at):
        out[at, raw[first + nth]] = raw[_places(first + extra[at] + 4 * nth, 4)].view("<u4").ravel()
    return (out + idx["low"].astype(np.int64)[:, None]).ravel()[:n].astype("<u4")


def write_tokens(docs: DataFrame, path: str, model: bytes, end_id: int) -> None:
    """Encode whole texts, put ``end_id`` behind each and write the pages in ascending doc_id order.

    Texts, not ids, are sorted: the range bounds then come from a scan and nothing is encoded twice. Null texts count
    as empty; a null doc_id comes first; equal doc_ids follow each other in the order of their texts' hashes.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    d = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
         .withColumn("tie", F.xxhash64("text")))
    ordered = d.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, page = WordEncoder.of(shipped.value), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, n = encoder.encode(strings(batch))
            ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
            n = n + 1
            ends = np.cumsum(n)
            cut = np.flatnonzero(np.diff((ends - 1) // PAGE_IDS, append=-1)) + 1
            for a, b in zip([0, *cut[:-1]], cut):
                lo, hi = int(ends[a] - n[a]), int(ends[b - 1])
                index, payload = pack_blocks(ids[lo:hi])
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "page": pa.array([page], pa.int32()), "n_ids": pa.array([hi - lo]),
                    "doc_ids": pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                    "doc_lens": pa.array([n[a:b]], pa.list_(pa.int64())), "index": pa.array([index], pa.binary()),
                    "payload": pa.array([payload], pa.binary())})
                page += 1

    ordered.select("doc_id", "text").mapInArrow(run, PAGE).write.parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages with ``first``, the number of ids before each in the whole corpus."""
    pages = spark.read.schema(PAGE).parquet(path)
    parts = pages.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    bounds = parts.select("part", F.coalesce(F.sum("_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (pages.select("part", "page", "n_ids").withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
              .join(bounds, "part").select("part", "page", (F.col("_in") + F.col("_before")).alias("first")))
    return pages.join(firsts, ["part", "page"])


def read_documents(pages: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document from the blocks: doc_id, start, n_tokens, ids_crc32 and, ``with_ids``, ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack_blocks(r["index"], r["payload"], r["n_ids"])
                n = np.array(r["doc_lens"], np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                cols = {"doc_id": pa.array(r["doc_ids"], pa.int64()), "start": pa.array(r["first"] + ends - n), "n_tokens": pa.array(n),
                        "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends - n, ends)], pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(ends - n, ends)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(cols)

    return pages.select("first", "n_ids", "doc_ids", "doc_lens", "index", "payload").mapInArrow(run, schema)


def token_files(docs: DataFrame, model: bytes, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files (by default to a new shared folder) and read the documents back from them."""
    spark = docs.sparkSession
    path = path or shared_folder(spark, "tokens")
    write_tokens(docs, path, model, end_id)
    return read_documents(read_pages(spark, path))
