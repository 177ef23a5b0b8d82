"""Token counts by finite-state transducers and a prefix scan over chunk maps.

The merges of a BPE vocabulary with word ends are compiled into a deterministic transducer whose transitions carry the
number of tokens they emit. White space returns the machine to its start state, so the map of a chunk, from the state
before it to the state behind it and the tokens emitted, is known up to the unread word at each end: ``head``, the
symbols before the first white space, whose count depends on the state the chunk is entered in; ``count``, the tokens in
between, which do not; and ``tail``, the symbols that lead from the start state to the state at the end. Two maps compose
into one by running the tail and the head between them; composition is associative, so the chunks of a text are
combined pairwise in a tree of logarithmic depth. Maps compose only at ASCII white space: a chunk without any is passed
on as its own text, so a long text without white space (Chinese, base64, minified code) is run from end to end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import per_worker, slices, strings
from pixelspark.llm.transducer import MergeTransducer
from pixelspark.llm.words import SIMPLE, byte_letters, split_words

WORD_END = "</w>"
CHUNK = 1 << 16
BLANKS = " \t\n\x0b\x0c\r"


def compile_counts(model: bytes) -> MergeTransducer:
    """The counting transducer of a tokenizers file: a symbol is a byte, or 256 more where a word ends."""
    bpe = json.loads(model)["model"]
    byte = {c: chr(b) for b, c in byte_letters().items()}

    def symbols(token: str) -> str | None:
        end = token.endswith(WORD_END)
        plain = token[:-len(WORD_END)] if end else token
        if not plain or any(c not in byte for c in plain):
            return None
        s = "".join(byte[c] for c in plain)
        return s[:-1] + chr(ord(s[-1]) + 256) if end else s

    tokens = {s: i for t, i in bpe["vocab"].items() if (s := symbols(t)) is not None}
    merges = {}
    for rank, pair in enumerate(bpe["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        merges[bpe["vocab"][a], bpe["vocab"][b]] = (rank, bpe["vocab"][a + b])
    return MergeTransducer(tokens, merges)


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the machine; ``open`` where it holds no white space, and then all of it is ``head``."""

    head: str
    count: int
    tail: str
    open: bool


class Counter:
    """Counts the tokens of texts; each distinct word of a slice runs through the transducer once."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        lib = Tokenizer.from_buffer(model)
        self.normalize, self.pre = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        self.added = sorted((t.content for t in lib.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.byte = {ord(c): chr(b) for b, c in byte_letters().items()}
        self.machine = compile_counts(model)

    @classmethod
    def of(cls, model: bytes) -> Counter:
        return per_worker(("counts", hash(model)), lambda: cls(model))

    def run(self, pieces: pa.Array) -> np.ndarray:
        """Tokens of pre-tokens, given as bytes."""
        d = pieces.dictionary_encode()
        size = pc.binary_length(d.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        n = self.machine.count(np.frombuffer(b"".join(d.dictionary.to_pylist()), np.uint8), size, 256)
        return n[d.indices.to_numpy(zero_copy_only=False)]

    def words(self, words: pa.Array) -> np.ndarray:
        """Tokens of each of the words: texts without ASCII white space and without A-Z."""
        cut = pc.extract_regex(words, SIMPLE)
        simple = cut.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(words), np.int64)
        cut = cut.drop_null()
        a, b = (pc.struct_field(cut, k).cast(pa.large_binary()) for k in ("word", "tail"))
        odd = [[p.translate(self.byte).encode("latin-1") for p, _ in self.pre(self.normalize(w))] if w else []
               for w in words.filter(pa.array(~simple)).to_pylist()]
        n = self.run(pa.concat_arrays([a, b, pa.array([p for o in odd for p in o], pa.large_binary())]))
        k = len(a)
        out[simple] = n[:k] + n[k:2 * k]
        of = np.repeat(np.flatnonzero(~simple), [len(o) for o in odd])
        np.add.at(out, of, n[2 * k:])
        return out

    def word(self, word: str) -> int:
        return int(self.words(pa.array([word], pa.large_string()))[0]) if word else 0

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.open and b.open:
            return ChunkMap(a.head + b.head, 0, "", True)
        if a.open:
            return ChunkMap(a.head + b.head, b.count, b.tail, False)
        if b.open:
            return ChunkMap(a.head, a.count, a.tail + b.head, False)
        return ChunkMap(a.head, a.count + self.word(a.tail + b.head) + b.count, b.tail, False)

    def maps(self, chunks: list[str]) -> list[ChunkMap]:
        """The map of each chunk; their inner words are counted together, each distinct one once."""
        cut = []
        for c in chunks:
            first = min((k for k in map(c.find, BLANKS) if k >= 0), default=-1)
            cut.append((c, "", "", True) if first < 0 else (c[:first], c[first:(last := max(map(c.rfind, BLANKS)) + 1)], c[last:], False))
        words, codes, counts = split_words(pa.array([c[1] for c in cut], pa.large_string()))
        ends = np.concatenate([[0], np.cumsum(self.words(words)[codes])])[np.concatenate([[0], np.cumsum(counts)])]
        return [ChunkMap(h, int(n), t, o) for (h, _, t, o), n in zip(cut, np.diff(ends))]

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """All maps composed, pair by pair."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, texts: pa.Array, chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text. Added tokens are cut out of the raw text first; each counts one."""
        marked = np.zeros(len(texts), bool)
        for t in self.added:
            marked |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        text, spans, extra = pc.ascii_lower(texts).to_pylist(), [], np.zeros(len(texts), np.int64)
        chunks: list[str] = []
        for i, t in enumerate(text):
            for part in self._parts(texts[i].as_py()) if marked[i] else (t,):
                if part is None:
                    extra[i] += 1
                elif part:
                    cut = [part[a:a + chunk] for a in range(0, len(part), chunk)]
                    spans.append((i, len(chunks), len(chunks) + len(cut)))
                    chunks += cut
        maps = self.maps(chunks)
        done = [self.scan(maps[a:b]) for _, a, b in spans]
        ends = self.words(pa.array([w for m in done for w in (m.head, m.tail)], pa.large_string())).reshape(-1, 2).sum(1)
        np.add.at(extra, [i for i, _, _ in spans], ends + [m.count for m in done])
        return extra

    def _parts(self, text: str) -> Iterator[str | None]:
        """Text between added tokens, and None for each of them."""
        hits = [(k, len(t)) for t in self.added if (k := text.find(t)) >= 0]
        while hits:
            k, n = min(hits)
            yield text[:k].translate(_LOWER)
            yield None
            text = text[k + n:]
            hits = [(k, len(t)) for t in self.added if (k := text.find(t)) >= 0]
        yield text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def token_counts(docs: DataFrame, model: bytes, limit: int) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of each whole text; null counts as empty.

    Repeated rows give repeated rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(shipped.value)
        for batch in slices(batches, "text"):
            texts = strings(batch)
            n = counter.count(texts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_bytes": pc.binary_length(texts).cast(pa.int64()), "n_tokens": pa.array(n),
                "over_limit": pa.array(n > limit)})

    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"))
