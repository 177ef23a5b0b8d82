"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Holds for tokenizers whose pre-tokens never cross white space and that drop it (``word_bpe_49k.json``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pixelspark.llm.common import per_worker, ragged

CACHE_WORDS = 500_000
JOINED_WORDS = 20_000
#: Lower-case letters that no normal form changes, then punctuation that no contraction starts with: two pre-tokens.
SIMPLE = "^(?P<word>[a-z\u00e0-\u00f6\u00f8-\u00ff]+)(?P<tail>[.,;:!?*#$%&]*)$"


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, words per text) after lower-casing A-Z; cut at ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten().dictionary_encode()
    counts = np.diff(lists.offsets.to_numpy())
    return flat.dictionary, flat.indices.to_numpy(zero_copy_only=False), counts


class WordEncoder:
    """Encodes texts; a store maps words to their ids and is emptied when it has passed its bound.

    Added tokens are searched in the raw text before anything else, so texts that hold the first
    two characters of one go through the library whole.
    """

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_buffer(model)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.marks = sorted({t.content[:2] for t in self.lib.get_added_tokens_decoder().values()})
        self.letters = {b: c for b, c in byte_letters().items()}
        self._empty()

    @classmethod
    def of(cls, model: bytes) -> WordEncoder:
        return per_worker(("words", len(model), hash(model)), lambda: cls(model))

    def _empty(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.length, self.used = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def _keep(self, words: list[str], ids: np.ndarray, n: np.ndarray) -> None:
        have = len(self.index)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while have + len(words) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[have:have + len(words)] = self.used + np.cumsum(n) - n
        self.length[have:have + len(words)] = n
        self.used += len(ids)
        self.index.update(zip(words, range(have, have + len(words))))

    def _add_joined(self, words: list[str]) -> None:
        """Any words: encoded in one text, ids given back by their offsets."""
        for a in range(0, len(words), JOINED_WORDS):
            part = words[a:a + JOINED_WORDS]
            starts = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
            e = self.lib.encode(" ".join(part), add_special_tokens=False)
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            n = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(part))
            self._keep(part, np.array(e.ids, np.uint32), n)

    def _add_simple(self, words: list[str]) -> None:
        """Single pre-tokens: straight to the library's model."""
        tokenize, table = self.lib.model.tokenize, self.letters
        made = [[t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(table))] if w else [] for w in words]
        n = np.fromiter(map(len, made), np.int64, len(made))
        self._keep(words, np.fromiter((i for m in made for i in m), np.uint32, int(n.sum())), n)

    def _find(self, words: pa.Array, add) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) in the store of each word; unknown ones are added."""
        d = words.dictionary_encode()
        u = d.dictionary.to_pylist()
        add([w for w in u if w not in self.index])
        where = np.fromiter(map(self.index.__getitem__, u), np.int64, len(u))[d.indices.to_numpy(zero_copy_only=False)]
        return self.start[where], self.length[where]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids per word)."""
        if len(self.index) > CACHE_WORDS:
            self._empty()
        cut = pc.extract_regex(words, SIMPLE)
        simple = cut.is_valid().to_numpy(zero_copy_only=False)
        start, length = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        if simple.any():
            cut = cut.drop_null()
            for j, name in enumerate(("word", "tail")):
                start[simple, j], length[simple, j] = self._find(pc.struct_field(cut, name), self._add_simple)
        if not simple.all():
            start[~simple, 0], length[~simple, 0] = self._find(words.filter(pa.array(~simple)), self._add_joined)
        return self.flat[ragged(start.ravel(), length.ravel())], length.sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        odd = np.zeros(len(texts), bool)
        for m in self.marks:
            odd |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts) if odd.any() else texts
        words, codes, counts = split_words(plain)
        flat, size = self._distinct(words)
        n = size[codes]
        ids = flat[ragged((np.cumsum(size) - size)[codes], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        lengths = np.diff(ends)
        if not odd.any():
            return ids, lengths
        parts = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
        for i in np.flatnonzero(odd):
            parts[i] = np.array(self.lib.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts).astype(np.uint32), np.array([len(p) for p in parts], np.int64)
