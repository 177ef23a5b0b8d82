"""Byte-level BPE: encoding by the merge transducer, decoding through an incremental UTF-8 state machine."""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelspark.llm.common import per_worker, ragged, slices, strings
from pixelspark.llm.transducer import MergeTransducer, rank_merges

DECODE_BYTES = 1 << 16
#: Pieces of letters and then punctuation that no contraction starts with: two matches.
LETTERS = "^(?P<word> ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<tail>[.,;:!?*#$%&]*)$"


def read_ranks(model: bytes) -> dict[str, int]:
    """Rank file to tokens; a byte is the character of the same number."""
    rows = (line.split() for line in model.splitlines() if line.strip())
    return {base64.b64decode(t).decode("latin-1"): int(i) for t, i in rows}


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(pieces between spaces, code of each piece, pieces per text)."""
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten().dictionary_encode()
    return flat.dictionary, flat.indices.to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


class ByteEncoder:
    """Encodes texts; the matches of the pattern in each distinct piece run through the transducer.

    No match of the pattern begins in one piece and ends in another if pieces are cut before single spaces that stand
    between other characters. Texts with longer runs of white space go through the pattern whole.
    """

    def __init__(self, model: bytes, pattern: str):
        tokens = read_ranks(model)
        self.find = regex.compile(pattern).findall
        self.machine = MergeTransducer(tokens, rank_merges(tokens))
        spelled = [b""] * (max(tokens.values()) + 1)
        for t, i in tokens.items():
            spelled[i] = t.encode("latin-1")
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    @classmethod
    def of(cls, model: bytes, pattern: str) -> ByteEncoder:
        return per_worker(("bytes", hash(model), pattern), lambda: cls(model, pattern))

    def _ids(self, pieces: pa.Array, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces one after another, ids per piece). ``blank``: pieces with white space inside."""
        cut = pc.extract_regex(pieces, LETTERS)
        simple = cut.is_valid().to_numpy(zero_copy_only=False)
        cut = cut.drop_null()
        odd = self._matches(pieces, np.flatnonzero(~simple & ~blank), np.flatnonzero(~simple & blank))
        flat = pa.concat_arrays([pc.struct_field(cut, "word"), pc.struct_field(cut, "tail"), pa.array([m for _, one in odd for m in one], pa.large_string())])
        k = np.flatnonzero(simple)
        owner = np.concatenate([k, k, np.repeat([i for i, _ in odd], [len(m) for _, m in odd]).astype(np.int64)])
        flat = flat.dictionary_encode()
        words = flat.dictionary.cast(pa.large_binary())
        ids, n = self.machine.ids(np.frombuffer(b"".join(words.to_pylist()), np.uint8), pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
        order = np.argsort(owner, kind="stable")
        code = flat.indices.to_numpy(zero_copy_only=False)[order]
        return ids[ragged((np.cumsum(n) - n)[code], n[code])], np.bincount(owner[order], n[code], len(pieces)).astype(np.int64)

    def _matches(self, pieces: pa.Array, joined: np.ndarray, single: np.ndarray) -> list[tuple[int, list[str]]]:
        """The pattern's matches in these pieces; those without white space are searched in one text, a line each."""
        out, k, one = [], 0, []
        for m in self.find("\n".join(pieces.take(pa.array(joined)).to_pylist()) + "\n") if len(joined) else ():
            if m == "\n":
                out.append((int(joined[k]), one))
                k, one = k + 1, []
            else:
                one.append(m)
        return out + [(i, self.find(pieces[i].as_py())) for i in single.tolist()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        pieces, codes, counts = units(texts)
        bad = np.fromiter((not w or w[-1].isspace() for w in pieces.to_pylist()), bool, len(pieces))
        starts = np.cumsum(counts) - counts
        first = np.zeros(len(codes), bool)
        first[starts[counts > 0]] = True
        whole = np.zeros(len(texts), bool)
        whole[np.repeat(np.arange(len(texts)), counts)[bad[codes]]] = True
        skip = np.repeat(whole, counts)
        keys, where = np.unique((codes.astype(np.int64) * 2 + first)[~skip], return_inverse=True)
        spaced = pc.binary_join_element_wise(pa.array(np.where(keys & 1, "", " "), pa.large_string()), pieces.take(pa.array(keys >> 1)), pa.scalar("", pa.large_string()))
        inner = pc.match_substring_regex(pieces, r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]").to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(whole)
        blank = np.concatenate([inner[keys >> 1], np.ones(len(odd), bool)])
        ids, size = self._ids(pa.concat_arrays([spaced, texts.take(pa.array(odd))]), blank)
        begin = np.cumsum(size) - size
        k, n_units = len(keys), np.zeros(len(codes), np.int64)
        n_units[~skip] = size[where]
        ends = np.concatenate([[0], np.cumsum(n_units)])[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(ends)
        out = ids[ragged(begin[where], size[where])]
        if not len(odd):
            return out, lengths
        parts = [out[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for i, a, n in zip(odd, begin[k:], size[k:]):
            parts[i] = ids[a:a + n]
        lengths[odd] = size[k:]
        return np.concatenate(parts), lengths

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after another."""
        return self.bytes[ragged(self.at[ids], self.size[ids])]


class Utf8Stream:
    """Bytes in, text out: an incremental state machine keeps the bytes of a character that is not complete yet."""

    def __init__(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, data: bytes) -> str:
        return self.machine.decode(data)

    def end(self) -> str:
        return self.machine.decode(b"", final=True)


def decode_stream(data: memoryview, block: int = DECODE_BYTES) -> Iterator[str]:
    stream = Utf8Stream()
    for a in range(0, len(data), block):
        yield stream.feed(data[a:a + block])
    yield stream.end()


def round_trip(docs: DataFrame, model: bytes, pattern: str, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """Encode each whole text and decode the ids again: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, text).

    Null text counts as empty; repeated rows give repeated rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids
              + ", text string" * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteEncoder.of(shipped.value, pattern)
        for batch in slices(batches, "text"):
            ids, n = coder.encode(strings(batch))
            ends = np.cumsum(n)
            raw, spelled = memoryview(ids.astype("<u4").tobytes()), coder.spell(ids)
            stop = np.concatenate([[0], np.cumsum(coder.size[ids])])[ends]
            held, data = memoryview(spelled.tobytes()), []
            a = b = 0
            for e, f in zip(ends.tolist(), stop.tolist()):
                text = hashlib.sha256()
                parts = []
                for s in decode_stream(held[b:f]):
                    text.update(s.encode())
                    if with_text:
                        parts.append(s)
                data.append((hashlib.sha256(raw[4 * a:4 * e]).hexdigest(), text.hexdigest(), "".join(parts)))
                a, b = e, f
            cols = {"doc_id": batch.column(0), "n_tokens": pa.array(n), "ids_sha256": pa.array([x[0] for x in data]),
                    "decoded_sha256": pa.array([x[1] for x in data])}
            if with_ids:
                cols["ids"] = pa.array([ids[x - y:x].astype(np.int64) for x, y in zip(ends, n)], pa.list_(pa.int64()))
            if with_text:
                cols["text"] = pa.array([x[2] for x in data])
            yield pa.RecordBatch.from_pydict(cols)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
