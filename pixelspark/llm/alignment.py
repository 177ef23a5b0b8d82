"""Two tokenizers over the same bytes, aligned by merge-path partitioning.

The byte offsets at which the tokens of A and of B end are two sorted sequences. A diagonal of their merge grid is the set
of places at which a given number of ends has been merged; a binary search along it tells how many of them come from A. So
diagonals at equal distances cut the merge into pieces of equal work that know nothing of each other, however the ends lie.
A piece emits one overlap for each end in it: the tokens of A and B that hold the bytes before that end. An end that both
have may be split between two pieces; these are stitched, as are groups that begin in one piece and end in another.

A task works through slices of whole texts and writes a row per slice, with the links of each document as counts over the
slice's distinct id pairs. Pair counts of the corpus are grouped from those, each slice asks for those it holds, and the
documents get their sums. Nothing is broadcast but the vocabularies. What a slice has found goes through Spark in packed form,
and the counts that it has asked for come back as rows in order behind it: no step there gathers a group in memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.byte_bpe import units
from pixelspark.llm.common import arrow_batches, list_array, per_worker, ragged, slices, stored, strings
from pixelspark.llm.words import byte_letters

#: Merged ends in a piece; bytes of text in a slice; bytes of units and ids that an encoder keeps;
#: bytes of texts in a batch, several slices; bytes of a row group of slices.
WORK = 1 << 16
SLICE = 1 << 20
STORE_BYTES = 24 << 20
BATCH_BYTES = 8 << 20
GROUP_BYTES = 8 << 20
#: Words encoded in one call.
JOINED = 2000
SPACE = "▁"
AFTER = (b",", b"|", b";", b"")


class Aligner:
    """Encodes texts by A (a byte-level tokenizers file and its pattern) and B (a sentencepiece model), units between spaces once each.

    Neither splits a text otherwise than its units if these are cut before single spaces between other characters: A's
    pattern ends there, and no piece of B has a space behind another character (checked). Texts with longer runs of white
    space, and those with a unit that B does not give back byte for byte, are encoded whole.
    """

    def __init__(self, model_a: bytes, pattern: str, model_b: bytes):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        letter = {c: b for b, c in byte_letters().items()}
        file = json.loads(model_a)
        special = {t["content"] for t in file["added_tokens"]}
        ranks = {bytes(letter[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in special}  # ids are in merge order
        self.a = Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size_a[list(ranks.values())] = [len(t) for t in ranks]
        self.b = SentencePieceProcessor(model_proto=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        spelled = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_b = np.array([len(s) for s in spelled], np.int64)
        self.at_b = np.cumsum(self.size_b) - self.size_b
        self.bytes_b = np.frombuffer(b"".join(spelled), np.uint8)
        self.by_units = not any(SPACE in p.lstrip(SPACE) for i, p in enumerate(pieces) if not self.b.is_control(i))
        digits = [str(i).encode() for i in range(max(len(self.size_a), len(spelled)))]
        self.written = pa.array([d + a for d in digits for a in AFTER], pa.large_binary())
        self._empty()

    @classmethod
    def of(cls, model_a: bytes, pattern: str, model_b: bytes) -> Aligner:
        return per_worker(("align", hash(model_a), pattern, hash(model_b)), lambda: cls(model_a, pattern, model_b))

    def _empty(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = [np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)]
        self.used, self.held = [0, 0], 0
        self.start, self.length = np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)

    def _add(self, words: list[str]) -> None:
        for i in range(0, len(words), JOINED):
            part = words[i:i + JOINED]
            if not self._add_joined(part):
                for w in part:
                    if not self._add_joined([w]):  # a word that B does not give back
                        self._keep([w], [np.zeros(0, np.int32)] * 2, [np.array([-1])] * 2)

    def _add_joined(self, words: list[str]) -> bool:
        """Words encoded in one text; ids are dealt to them by the bytes they stand for. False if B gives other bytes."""
        raw = (text := " ".join(words)).encode()
        ids = [self.a.encode_to_numpy(" " + text).astype(np.int64), np.array(self.b.encode(text, num_threads=1), np.int64)]
        if self.spell(ids[1]).tobytes() != b" " + raw:
            return False
        ends = np.cumsum([1 + (len(w) if w.isascii() else len(w.encode())) for w in words])
        n = [np.diff(np.searchsorted(np.cumsum(size[i]), ends, "right"), prepend=0) for size, i in zip((self.size_a, self.size_b), ids)]
        self._keep(words, ids, n)
        return True

    def _keep(self, words: list[str], ids: list[np.ndarray], n: list[np.ndarray]) -> None:
        have = len(self.index)
        while have + len(words) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros((max(1024, len(x)), 2), np.int64)]) for x in (self.start, self.length))
        for side in (0, 1):
            used, new = self.used[side], len(ids[side])
            while used + new > len(self.flat[side]):
                self.flat[side] = np.concatenate([self.flat[side], np.zeros_like(self.flat[side])])
            self.flat[side][used:used + new] = ids[side]
            self.start[have:have + len(words), side] = used + np.cumsum(n[side]) - n[side]
            self.length[have:have + len(words), side] = n[side]
            self.used[side] += new
        self.index.update(zip(words, range(have, have + len(words))))
        self.held += sum(map(len, words)) + 100 * len(words)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes_b[ragged(self.at_b[ids], self.size_b[ids])]

    def whole(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of one text; none where the bytes of its tokens are not a space and the text."""
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
        return (a, b) if text and self.spell(np.array(b, np.int64)).tobytes() == b" " + text.encode() else ([], [])

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: (ids of all texts one after another, ids per text)."""
        if self.held + 4 * sum(self.used) > STORE_BYTES:
            self._empty()
        pieces, codes, counts = units(texts)
        words = pieces.to_pylist()
        bad = np.fromiter((not w or w[-1].isspace() or w[0].isspace() for w in words), bool, len(words)) | (not self.by_units)
        self._add([w for w, no in zip(words, bad) if not no and w not in self.index])
        place = np.fromiter((self.index.get(w, -1) for w in words), np.int64, len(words))
        bad |= (place < 0) | (self.length[place, 0] < 0 if len(self.length) else True)
        odd = np.zeros(len(texts), bool)
        odd[np.repeat(np.arange(len(texts)), counts)[bad[codes]]] = True
        plain = place[codes][~np.repeat(odd, counts)]
        alone = {i: self.whole(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        out = []
        for side in (0, 1):
            n = self.length[plain, side]
            ids = self.flat[side][ragged(self.start[plain, side], n)]
            per = np.zeros(len(codes), np.int64)
            per[~np.repeat(odd, counts)] = n
            ends = np.concatenate([[0], np.cumsum(per)])[np.concatenate([[0], np.cumsum(counts)])]
            lengths = np.diff(ends)
            if alone:
                parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
                for i, both in alone.items():
                    parts[i] = np.array(both[side], np.int32)
                    lengths[i] = len(both[side])
                ids = np.concatenate(parts)
            out.append((ids.astype(np.int64), lengths))
        return out


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> np.ndarray:
    """(from a, from b) of the first k ends of the merge, for every multiple k of ``work`` and all; of equal ends, a's is first."""
    k = np.unique(np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b)))
    low, high = np.maximum(0, k - len(b)), np.minimum(k, len(a))
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return np.stack([low, k - low], 1)
        mid = (low[open_] + high[open_]) // 2
        more = a[mid] <= b[k[open_] - mid - 1]
        low[open_], high[open_] = np.where(more, mid + 1, low[open_]), np.where(more, high[open_], mid)


def overlaps(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(end, token of A, token of B, whether both end) for each end in a piece that starts with tokens i and j."""
    end = np.sort(np.concatenate([a, b]), kind="stable")
    end = end[np.concatenate([[True], end[1:] != end[:-1]])] if len(end) else end
    p, q = np.searchsorted(a, end), np.searchsorted(b, end)
    both = np.zeros(len(end), bool)
    inside = (p < len(a)) & (q < len(b))
    both[inside] = a[p[inside]] == b[q[inside]]
    return end, p + i, q + j, both


def stitched(a: np.ndarray, b: np.ndarray, work: int = WORK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The overlaps of all pieces in order; an end that a piece shares with the one before is given by that one."""
    cuts = diagonals(a, b, work)
    before = None
    for (i, j), (k, m) in zip(cuts[:-1], cuts[1:]):
        now = overlaps(a[i:k], b[j:m], i, j)
        if before is not None:
            if before[0][-1] == now[0][0]:
                before[3][-1] = True
                now = tuple(x[1:] for x in now)
            yield before
        before = now if len(now[0]) else None
    if before is not None:
        yield before


class Digest:
    """Writes groups as pieces give them, and hashes document by document; tokens of open groups wait for the next piece."""

    def __init__(self, coder: Aligner, ids: list[np.ndarray], ends_a: np.ndarray, ends_b: np.ndarray):
        self.coder, self.ids, self.ends = coder, ids, (ends_a, ends_b)
        self.done, self.doc, self.hash = [0, 0], 0, hashlib.sha256()
        self.out: list[str] = []

    def feed(self, tok_a: np.ndarray, tok_b: np.ndarray) -> None:
        """The last tokens of the groups that end here: everything up to the last of them is written."""
        if not len(tok_a):
            return
        n_a, n_b = np.diff(tok_a, prepend=self.done[0] - 1), np.diff(tok_b, prepend=self.done[1] - 1)
        groups = np.arange(len(tok_a))
        last_doc = np.isin(tok_b, self.ends[1] - 1)
        order_a = np.arange(n_a.sum()) + np.repeat(np.cumsum(n_b) - n_b, n_a)
        order_b = np.arange(n_b.sum()) + np.repeat(np.cumsum(n_a), n_b)
        code = np.empty(len(order_a) + len(order_b), np.int64)
        close_a, close_b = np.zeros(len(order_a), np.int64), np.zeros(len(order_b), np.int64)
        close_a[np.cumsum(n_a) - 1] = 1
        close_b[np.cumsum(n_b) - 1] = np.where(last_doc, 3, 2)
        code[order_a] = 4 * self.ids[0][self.done[0]:tok_a[-1] + 1] + close_a
        code[order_b] = 4 * self.ids[1][self.done[1]:tok_b[-1] + 1] + close_b
        text = self.coder.written.take(pa.array(code))
        at, data = np.frombuffer(text.buffers()[1], np.int64)[:len(code) + 1], memoryview(text.buffers()[2])
        stop = np.cumsum(n_a + n_b)
        start = 0
        for g in groups[last_doc].tolist():
            self.hash.update(data[start:at[stop[g]]])
            self.out.append(self.hash.hexdigest())
            self.hash, start = hashlib.sha256(), at[stop[g]]
        self.hash.update(data[start:at[len(code)]])
        self.done = [int(tok_a[-1]) + 1, int(tok_b[-1]) + 1]


def align(coder: Aligner, texts: pa.Array, work: int = WORK) -> dict:
    """Counts, digests and links of the texts: each link as (document, place of its id pair) with the number of times."""
    (ids_a, n_a), (ids_b, n_b) = coder.encode(texts)
    a, b = np.cumsum(coder.size_a[ids_a]), np.cumsum(coder.size_b[ids_b])
    some = np.flatnonzero(n_a)
    ends_a, ends_b = np.cumsum(n_a)[some], np.cumsum(n_b)[some]
    stop = a[ends_a - 1]
    n_links, n_groups = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    digest, keys, docs = Digest(coder, [ids_a, ids_b], ends_a, ends_b), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for end, p, q, both in stitched(a, b, work):
        doc = some[np.searchsorted(stop, end)]
        n_links += np.bincount(doc, minlength=len(texts))
        n_groups += np.bincount(doc[both], minlength=len(texts))
        digest.feed(p[both], q[both])
        keys.append(ids_a[p] << 32 | ids_b[q])
        docs.append(doc)
    pair = pa.array(np.concatenate(keys)).dictionary_encode()
    code = pair.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs = pair.dictionary.to_numpy()
    of = pa.array(np.concatenate(docs) * len(pairs) + code).value_counts()
    order = np.argsort(of.field(0).to_numpy())
    sha = np.full(len(texts), "", object)
    sha[some] = digest.out
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "sha": sha, "pairs": pairs,
            "totals": np.bincount(code, minlength=len(pairs)), "where": of.field(0).to_numpy()[order], "times": of.field(1).to_numpy()[order]}


def packed(columns: dict[str, pa.Array]) -> bytes:
    """A record batch of its own, compressed."""
    batch, sink = pa.RecordBatch.from_pydict(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(data: pa.Buffer) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as got:
        return got.read_next_batch()


def narrow(x: np.ndarray) -> pa.Array:
    """Numbers from zero up, in as few bytes as the largest needs."""
    return pa.array(x.astype(np.min_scalar_type(int(x.max(initial=0)))))


def packed_links(where: np.ndarray, times: np.ndarray) -> bytes:
    """Links in ascending order of ``where``, document * number of pairs + pair: the steps between them, and how often each."""
    return packed({"step": narrow(np.diff(where, prepend=0)), "times": narrow(times)})


def link_sums(links: pa.RecordBatch, n_docs: int, count: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best links, sum of counts) of each document; ``count`` and ``best`` of the slice's pairs."""
    n_best, sums = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    if links.num_rows:
        doc, pair = np.divmod(np.cumsum(links.column(0).to_numpy().astype(np.int64)), len(count))
        times = links.column(1).to_numpy().astype(np.int64)
        np.add.at(n_best, doc, times * best[pair])
        np.add.at(sums, doc, times * count[pair])
    return n_best, sums


PER_DOC = ("n_a", "n_b", "n_groups", "n_links", "sha")
SLICE_ROW = "slice long, pairs array<long>, totals array<long>, docs binary, links binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def aligned_slices(docs: DataFrame, model_a: bytes, pattern: str, model_b: bytes, work: int = WORK) -> DataFrame:
    """A row per slice of texts, SLICE_ROW. ``docs`` holds doc_id and PER_DOC, ``links`` is as ``packed_links`` gives it."""
    shipped = docs.sparkSession.sparkContext.broadcast((model_a, pattern, model_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Aligner.of(*shipped.value), TaskContext.get().partitionId()
        for made, batch in enumerate(slices(batches, "text", SLICE)):
            got = align(coder, strings(batch), work)
            row = {"slice": pa.array([part << 32 | made])}
            for name in ("pairs", "totals"):
                row[name] = list_array(got[name].astype(np.int64), np.array([len(got[name])]))
            ids = batch.column(0).take(pa.array(np.arange(batch.num_rows)))
            row["docs"] = pa.array([packed({"doc_id": ids} | {name: pa.array(got[name]) for name in PER_DOC})], pa.binary())
            row["links"] = pa.array([packed_links(got["where"], got["times"])], pa.binary())
            yield pa.RecordBatch.from_pydict(row)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SLICE_ROW)


def pair_counts(parts: DataFrame) -> DataFrame:
    """pair (id of A << 32 | id of B), count over the corpus, best (whether it is the highest count of its B id)."""
    counts = (parts.select(F.explode(F.arrays_zip("pairs", "totals")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
              .agg(F.sum("x.totals").alias("count")).withColumn("b", F.expr("pair & 4294967295L")))
    high = counts.groupBy("b").agg(F.max("count").alias("high"))
    return counts.join(high, "b").select("pair", "count", (F.col("count") == F.col("high")).alias("best"))


def alignment(docs: DataFrame, model_a: bytes, pattern: str, model_b: bytes, work: int = WORK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    Texts that are null or empty, or that the tokens of A or B do not give back byte for byte with a space before them, have
    no tokens: zeros and ''. Repeated rows give repeated rows and count as often. An empty table gives an empty result; other
    columns are not read.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        parts = stored(aligned_slices(docs, model_a, pattern, model_b, work), "slices", GROUP_BYTES)
    table = stored(pair_counts(parts), "pairs")
    found = parts.select("slice", F.posexplode("pairs").alias("at", "pair")).join(table, "pair").select("slice", "at", "count", "best")
    heads = parts.select("slice", F.lit(-1).alias("at"), "docs", "links")

    def closed(head: pa.RecordBatch, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        docs, links = (unpacked(head.column(name)[0].as_buffer()) for name in ("docs", "links"))
        count, best = (np.concatenate([np.zeros(0, np.int64), *(r.column(name).to_numpy(zero_copy_only=False) for r in rows)]).astype(np.int64)
                       for name in ("count", "best"))
        n_best, sums = link_sums(links, docs.num_rows, count, best)
        return pa.RecordBatch.from_arrays([*docs.columns[:-1], pa.array(n_best), pa.array(sums), docs.columns[-1]],
                                          names=[x.split()[0] for x in RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rows = None, []
        for batch in batches:
            first = np.flatnonzero(batch.column("at").to_numpy() < 0).tolist()
            for a, b in zip([-1, *first], [*first, batch.num_rows]):
                if a >= 0:
                    if head is not None:
                        yield closed(head, rows)
                    head, rows = batch.slice(a, 1), []
                if a + 1 < b:
                    rows.append(batch.slice(a + 1, b - a - 1).select(["count", "best"]))
        if head is not None:
            yield closed(head, rows)

    return (heads.unionByName(found, allowMissingColumns=True).repartition("slice").sortWithinPartitions("slice", "at")
            .mapInArrow(run, RESULT))
