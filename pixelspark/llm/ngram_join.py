"""Jaccard join of documents on word n-grams as a blocked sparse matrix product.

The product of the document by n-gram incidence matrix with its transpose holds the overlap of every two documents. The
size bound says which blocks of it can hold a link: two sets of together s n-grams with Jaccard at least t differ in at
most s (1 - t) / (1 + t) of them. So documents are blocked by size, and only blocks of neighbouring size classes meet;
the columns of a class are dealt by hash into more blocks than a link can have differences, and a pair that differs in
every column block is discarded before any product: what is left agrees in a whole block. There are some blocks more
than that, so a document may leave out those made only of common n-grams, such as a passage that many documents share;
which n-grams are common is counted over all documents and only steers the search. Documents joined by such
agreements are multiplied for good, in tiles of bounded size: the overlap counts add up column block by column block,
and a pair is discarded as soon as its count and what is still to come stay below its bound.

Exact copies of a set are multiplied once; similarities below 0.8 are not taken. Tiles give links as spanning forests, so no group is written out as pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelspark.llm.common import slices, stored, strings
from pixelspark.llm.components import components, forest
from pixelspark.llm.words import split_words

#: Column blocks that may hold nothing but common n-grams and then say nothing: so many, and one for each so many differences.
SPARE_BLOCKS, SPARE_SHARE = 1, 5
#: N-grams fall into 2 ** 32 cells, counted by ranges of cells; above this count, and four times the mean, a cell is
#: common. A range names so many at most, the commonest: the list has a bound, and what it leaves out costs time only.
RANGES, COMMON, NAMED = 1024, 4, 1024
TILE_DOCS, TILE_GRAMS, TILE_COLUMNS = 768, 450_000, 4096
#: Classes of ratio 9 : 10 that linked sizes can lie apart, for similarities of 0.8 and more.
CLASSES_APART = 3
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(_U)
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


def gram_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of the texts one after another, number per text).

    Words are cut at ASCII white space after lower-casing A-Z. A text of fewer words is one n-gram; one without words
    has none.
    """
    vocabulary, codes, counts = split_words(texts)
    known = pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(_U)
    empty = np.array([w == "" for w in vocabulary.to_pylist()], bool)
    doc = np.repeat(np.arange(len(texts)), counts)
    if empty.any():
        keep = ~empty[codes]
        codes, doc = codes[keep], doc[keep]
    h = known[codes]
    n = np.bincount(doc, minlength=len(texts))
    ends = np.cumsum(n)
    left = (ends[doc] if len(doc) else ends[:0]) - np.arange(len(doc))  # words from here to the end of the text
    gram, short = mix(h), n[doc] < words
    for k in range(1, words):
        follow = np.zeros(len(h), _U)
        follow[:max(0, len(h) - k)] = h[k:]
        gram = np.where(left > k, mix(gram * _U(0x9E3779B97F4A7C15) + follow + _U(k)), gram)
    first = np.zeros(len(h), bool)
    first[(ends - n)[n > 0]] = True
    use = np.where(short, first, left >= words)
    doc, gram = doc[use], gram[use]
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    return gram[new], np.bincount(doc[new], minlength=len(texts))


def size_classes(most: int, num: int, den: int) -> np.ndarray:
    """First size of each class; sizes that can be linked lie in one class or in two neighbours."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * den // num + 1)
    return np.array(out, np.int64)


def cell(gram: np.ndarray) -> np.ndarray:
    return (gram >> _U(32)).astype(np.uint32)


def common_cells(docs: DataFrame, words: int) -> np.ndarray:
    """The cells of n-grams that many documents hold, in order; at most RANGES * NAMED.

    Each task sends its cells as sorted, packed steps, a few bytes for every n-gram; a range of cells is counted in one
    array of fixed size.
    """
    width = (1 << 32) // RANGES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cells = np.sort(cell(gram_sets(strings(batch), words)[0]))
            at = np.searchsorted(cells, np.arange(RANGES + 1, dtype=np.int64) * width)
            some = np.flatnonzero(np.diff(at))
            blobs = [zlib.compress(np.diff(cells[at[r]:at[r + 1]], prepend=np.uint32(r * width)).tobytes(), 1) for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(blobs, pa.binary())], names=["range", "cells"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, now = np.zeros(width, np.int64), None

        def common() -> pa.RecordBatch:
            hit = np.flatnonzero(seen > max(COMMON, 4 * seen.mean()))
            hit = hit[np.argsort(-seen[hit], kind="stable")[:NAMED]] + now * width
            return pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int64))], names=["cell"])

        for batch in batches:
            for r, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if r != now:
                    if now is not None:
                        yield common()
                    seen[:], now = 0, r
                at, times = np.unique(np.cumsum(np.frombuffer(zlib.decompress(blob.as_py()), np.uint32), dtype=np.int64), return_counts=True)
                seen[at] += times
        if now is not None:
            yield common()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = id_and_text(docs).mapInArrow(pack, "range int, cells binary").repartition(n, "range").sortWithinPartitions("range")
    found = packed.mapInArrow(count, "cell long").toArrow().column(0)
    return np.sort(found.to_numpy()).astype(np.uint32)


def block_signatures(gram: np.ndarray, n: np.ndarray, num: int, den: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of the sets one after another, number per set): one per column block and size class of partners."""
    first = size_classes(int(n.max(initial=1)), num, den)
    doc = np.repeat(np.arange(len(n)), n)
    spread, value = mix(gram + _U(1)), mix(gram ^ _U(0xA5A5A5A5A5A5A5A5))
    cells = cell(gram)
    found = np.searchsorted(common, cells)
    rare = np.ones(len(gram), bool) if not len(common) else common[np.minimum(found, len(common) - 1)] != cells
    own = np.searchsorted(first, n, "right") - 1
    out, owner = [], []
    for role in (0, 1):
        group = own - role
        ok = (n > 0) & (group >= 0)
        top = first[np.minimum(np.maximum(group, 0) + 1, len(first) - 1)] - 1
        differ = (top + top * den // num) * (den - num) // (den + num)
        spare = np.where(differ > 0, SPARE_BLOCKS + differ // SPARE_SHARE, 0)
        m = np.where(ok, differ + 1 + spare, 0)
        at = np.cumsum(m) - m
        use = ok[doc]
        key = at[doc[use]] + (spread[use] % m[doc[use]].astype(_U)).astype(np.int64)
        total = int(m.sum())
        v = value[use]
        high = np.bincount(key, (v >> _U(32)).astype(np.float64), total).astype(np.int64).astype(_U)
        low = np.bincount(key, (v & _U(0xFFFFFFFF)).astype(np.float64), total).astype(np.int64).astype(_U)
        size = np.bincount(key, minlength=total)
        of = np.repeat(np.arange(len(n)), m)
        place = np.arange(total) - at[of]
        says = np.bincount(key, rare[use], total) > 0
        blank = np.bincount(of[~says], minlength=len(n))
        keep = says | (blank > spare)[of]
        sig = mix(mix(high * _U(0x9E3779B97F4A7C15) + low) + mix((place << 32 | group[of]).astype(_U)) + size.astype(_U))
        out.append(sig[keep])
        owner.append(of[keep])
    sig, of = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return sig[order].view(np.int64), np.bincount(of, minlength=len(n))


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def hashed(docs: DataFrame, words: int, *more: str) -> DataFrame:
    """doc_id, n (set size), k1 and k2 (128 bits that name the set) of every row, and the columns ``more`` (long)."""
    names = ["doc_id", "n", "k1", "k2", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            gram, n = gram_sets(strings(batch), words)
            k1, k2 = set_keys(gram, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(k1), pa.array(k2), *(batch.column(c) for c in more)], names=names)

    return id_and_text(docs, *more).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def signatures(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(sig, doc_id): the block signatures of every row with an id."""
    common = docs.sparkSession.sparkContext.broadcast(common_cells(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sigs, per = block_signatures(*gram_sets(strings(batch), words), num, den, common.value)
            ids = np.repeat(batch.column(0).to_numpy(), per)
            yield pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(ids)], names=["sig", "doc_id"])

    return id_and_text(docs).where("doc_id is not null").mapInArrow(run, "sig long, doc_id long")


def set_keys(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the n-grams of each set."""
    ends = np.concatenate([[0], np.cumsum(n)])
    return tuple(np.diff(np.concatenate([np.zeros(1, _U), np.cumsum(mix(gram ^ _U(s)), dtype=_U)])[ends]).view(np.int64) for s in (0x1234567, 0x89ABCDEF01))


def multiply(a: list[np.ndarray], b: list[np.ndarray] | None, num: int, den: int) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (or of ``a`` itself) are linked: overlap counts, column block by column block."""
    sets = a + (b or [])
    n = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), n)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[column] > 1
    column = (np.cumsum(seen > 1) - 1)[column]
    k = len(a)
    p, q = np.arange(k), np.arange(k) if b is None else np.arange(k, len(sets))
    size = n[p][:, None] + n[q][None, :]
    need = -(-num * size // (num + den))  # the overlap of a link
    open_ = np.minimum(n[p][:, None], n[q][None, :]) >= need
    if b is None:
        open_ &= np.arange(k)[:, None] < np.arange(k)[None, :]
    order = np.argsort(column[common], kind="stable")
    row, column = row[common][order], column[common][order]
    to_come = np.bincount(row, minlength=len(sets))
    overlap = np.zeros(open_.shape, np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, TILE_COLUMNS):
        if not open_.any():
            break
        x, y = np.searchsorted(column, (start, start + TILE_COLUMNS))
        block = np.zeros((len(sets), min(TILE_COLUMNS, int(column[-1]) + 1 - start)), np.float32)
        block[row[x:y], column[x:y] - start] = 1
        i, j = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
        overlap[np.ix_(i, j)] += (block[p[i]] @ block[q[j]].T).astype(np.int64)
        to_come -= np.bincount(row[x:y], minlength=len(sets))
        open_ &= overlap + np.minimum(to_come[p][:, None], to_come[q][None, :]) >= need
    return open_ & (overlap >= need)


TILE = ("comp", "ca", "ba", "cb", "bb")


def tiles(wanted: DataFrame) -> DataFrame:
    """The tiles (comp, ca, ba, cb, bb: two blocks of a group) of each wanted set, and its own block c, b.

    From sizes alone. A group that fits in one tile is one block; others are cut by size class and, within it, by hash.
    """
    sized = wanted.withColumn("c", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(10 / 9))).cast("int"))
    by_class = sized.groupBy("comp", "c").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("grams"))
    parts = lambda d, g: F.ceil(F.greatest(F.col(d) / TILE_DOCS, F.col(g) / TILE_GRAMS)).cast("int")
    total = by_class.groupBy("comp").agg(F.sum("docs").alias("all_docs"), F.sum("grams").alias("all_grams"))
    plan = (by_class.join(total, "comp").withColumn("one", parts("all_docs", "all_grams") <= 1)
            .select("comp", "c", F.when(F.col("one"), F.lit(0)).otherwise(F.col("c")).alias("cc"),
                    F.when(F.col("one"), F.lit(1)).otherwise(parts("docs", "grams")).alias("parts")))
    placed = (sized.join(plan, ["comp", "c"]).withColumn("b", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
              .select("comp", F.col("cc").alias("c"), "b", "rep", "k1", "k2"))
    blocks = plan.select("comp", F.col("cc").alias("c"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("b")).distinct()
    left, right = (blocks.select("comp", F.col("c").alias(f"c{s}"), F.col("b").alias(f"b{s}")) for s in "ab")
    near = F.col("cb") - F.col("ca")
    pairs = left.join(right, "comp").where(((near > 0) & (near <= F.lit(CLASSES_APART))) | ((F.col("ca") == F.col("cb")) & (F.col("ba") <= F.col("bb"))))
    sides = pairs.withColumn("side", F.explode(F.array_distinct(F.array(F.struct(F.col("ca").alias("c"), F.col("ba").alias("b")),
                                                                       F.struct(F.col("cb").alias("c"), F.col("bb").alias("b"))))))
    return sides.select(*TILE, "side.c", "side.b").join(placed, ["comp", "c", "b"])


def tile_sets(docs: DataFrame, tiled: DataFrame, words: int) -> DataFrame:
    """The wanted sets in each of their tiles, with their n-grams made again from the texts."""
    own = F.struct(*TILE, "c", "b")
    each = tiled.groupBy("rep", "k1", "k2").agg(F.collect_list(own).alias("tiles"))
    joined = id_and_text(docs).withColumnRenamed("doc_id", "rep").join(each, "rep")
    names = [*TILE, "c", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            gram, n = gram_sets(strings(batch), words)
            k1, k2 = set_keys(gram, n)
            same = np.flatnonzero((k1 == batch.column(2).to_numpy()) & (k2 == batch.column(3).to_numpy()))
            ends = np.concatenate([[0], np.cumsum(n)])
            per = batch.column(4).take(pa.array(same))
            flat, count = per.flatten(), np.diff(per.offsets.to_numpy())
            ids = batch.column(0).take(pa.array(np.repeat(same, count)))
            for a in range(0, len(ids), 64):  # a set may be in many tiles: few of its copies at a time
                rows = np.repeat(same, count)[a:a + 64]
                some = flat.slice(a, 64)
                yield pa.RecordBatch.from_arrays([*(some.field(c) for c in names), ids.slice(a, 64),
                                                  pa.array([gram[ends[i]:ends[i + 1]].tobytes() for i in rows], pa.binary())], names=[*names, "rep", "grams"])

    return joined.select("rep", "text", "k1", "k2", "tiles").mapInArrow(run, "comp long, ca int, ba int, cb int, bb int, c int, b int, rep long, grams binary")


def tile_links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v): spanning forests of the links in each tile."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *TILE).sortWithinPartitions(*TILE, "c", "b")

    def one(held: list[dict]) -> list[tuple[int, int]]:
        t = held[0]
        second = [(t["ca"], t["ba"]) != (r["c"], r["b"]) for r in held]
        held = [r for r, s in zip(held, second) if not s] + [r for r, s in zip(held, second) if s]
        k, sets = len(held) - sum(second), [np.frombuffer(r["grams"], _U) for r in held]
        ids = np.array([r["rep"] for r in held], np.int64)
        if (t["ca"], t["ba"]) == (t["cb"], t["bb"]):
            linked, p, q = multiply(sets, None, num, den), np.arange(k), np.arange(k)
        elif 0 < k < len(sets):
            linked, p, q = multiply(sets[:k], sets[k:], num, den), np.arange(k), np.arange(k, len(sets))
        else:
            return []
        return [(int(ids[i]), int(ids[j])) for i, j in forest(linked, np.arange(len(ids)), p, q)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key = None

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            links: list[tuple[int, int]] = []
            for r in batch.to_pylist():
                here = tuple(r[c] for c in TILE)
                if here != key and held:
                    links += one(held)
                    held = []
                key = here
                held.append(r)
            yield out(links)
        if held:
            yield out(one(held))

    return rows.mapInArrow(run, "u long, v long")


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, rows: DataFrame | None = None) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, the smallest doc_id reachable by links.

    Linked are sets with Jaccard similarity of at least num / den. Texts that are null, empty or without words have
    empty sets and link with nothing. Rows with equal texts link whatever their ids; rows without an id are joined to
    their copies only and never stand for them. Rows that share a doc_id count as one document in the graph. An empty
    table gives an empty result; other columns are not read. ``rows`` is what ``hashed`` gives, where it is known.
    """
    if 10 * num < 8 * den:
        raise ValueError("a similarity of 0.8 or more is needed")
    if rows is None:
        rows = stored(hashed(docs, words), "sets")
    real = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    before = F.lag("doc_id").over(Window.partitionBy("sig").orderBy("doc_id"))
    agree = stored(signatures(docs, words, num, den).select("doc_id", before.alias("other")).where("other is not null and other != doc_id")
                   .select(F.col("doc_id").alias("u"), F.col("other").alias("v")).distinct(), "agree")
    groups = components(agree).select(F.col("id").alias("rep"), F.col("component_id").alias("comp"))
    keys = real.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    members = keys.join(groups, "rep")
    several = members.groupBy("comp").count().where("count > 1").select("comp")
    wanted = stored(members.join(several, "comp"), "wanted")
    member = components(tile_links(tile_sets(docs, tiles(wanted), words), num, den))
    of = (keys.join(member.withColumnRenamed("id", "rep"), "rep", "left")
          .select("k1", "k2", F.lit(True).alias("some"), F.coalesce("component_id", "rep").alias("component_id")))
    # rows that share an id but not a text stand at one place
    out = rows.select("doc_id", "n", "k1", "k2", (F.col("n") > 0).alias("some")).join(of, ["k1", "k2", "some"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows that stay: one of each component of linked sets, and every row whose set is empty.

    The graph is that of the sets, whatever ids their rows have: each set is numbered by the smallest id of its rows,
    nulls last, then by its key, and the first set of a component stays. Of the rows of that set one with that id stays.
    Rows without an id are linked like others; texts that share an id but do not link all stay. Columns stay as they are.
    """
    row = ["_r1", "_r2"]
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    full = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # the row in one struct, so that no column of it meets one of ours
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), id_.alias("doc_id"), text.alias("text"), full.alias("_full"),
                        *[F.xxhash64(F.lit(k), id_, text).alias(c) for k, c in enumerate(row)]).where("_full").drop("_full")
    sets = stored(hashed(keyed, words, *row), "sets")
    first = sets.groupBy("k1", "k2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *row)).alias("at"), F.first("n").alias("n"))
    chosen = first.select("at.*", "k1", "k2", "n").orderBy("none", "doc_id", "k1", "k2")
    chosen = stored(chosen.select(F.monotonically_increasing_id().alias("_set"), *row, "n", "k1", "k2"), "chosen")
    # copies are folded before the shuffle, so that many rows with one id and text meet no task
    one = stored(keyed.dropDuplicates(row).join(chosen, row).drop(*row), "one")
    found = jaccard_components(one.select(F.col("_set").alias("doc_id"), "text"), words, num, den, one.select(F.col("_set").alias("doc_id"), "n", "k1", "k2"))
    stays = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_set"))
    return one.join(stays, "_set", "left_semi").select("_row.*").union(docs.where(~full).select(*docs.columns))
