"""Alignment of two tokenizers against a merge by hand with the libraries' own ids."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pixelspark.llm import alignment, queries
from pixelspark.llm.words import byte_letters
from tests.llm.test_llm import LONG, empty, frame, odd_texts

A, B = queries.vocabulary(queries.ALIGN_A), queries.vocabulary(queries.ALIGN_B)
ODD = ["a ▁b", "▁", "x  y", "<s> a</s> <unk>", "<0x41> <|endoftext|>", "nul\0x", " lead", "trail ", "\ta b", "中文 \U0001f600 test", "a\nb c", "x" * 3000]


def by_hand(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each text."""
    lib, pieces = Tokenizer.from_buffer(A), SentencePieceProcessor(model_proto=B)
    lib.encode_special_tokens = True
    letter = {c: b for b, c in byte_letters().items()}
    counts, rows = collections.Counter(), []
    for text in texts:
        a, b, spell_a, spell_b = [], [], [], []
        if text:
            a, b = lib.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            spell_a = [bytes(letter[c] for c in lib.id_to_token(i)) for i in a]
            spell_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
                a, b = [], []
        links, groups, ga, gb, i, j, x, y = [], [], [], [], 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = x + len(spell_a[i]), y + len(spell_b[j])
            if end_a <= end_b:
                ga, i, x = ga + [a[i]], i + 1, end_a
            if end_b <= end_a:
                gb, j, y = gb + [b[j]], j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        counts.update(links)
        rows.append((a, b, links, groups))
    high = {}
    for (_, b), n in counts.items():
        high[b] = max(high.get(b, 0), n)
    return [(len(a), len(b), len(g), len(k), sum(counts[x] == high[x[1]] for x in k), sum(counts[x] for x in k),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, k, g in rows]


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("work", [3, 1 << 16])
def test_odd_texts(spark, work):
    texts = [t for t in odd_texts() if t != LONG] + ODD + ["the same row"] * 3
    got = alignment.alignment(frame(spark, texts), A, public_tokenizers.PATTERN, B, work)
    assert result(got) == [(i, *w) for i, w in enumerate(by_hand(texts))]


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d, *w) for (d, _), w in zip(docs, by_hand([t for _, t in docs])))
    assert result(queries.op13_alignment(spark, data)) == want


def test_long_text_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE", 1000)
    monkeypatch.setattr(alignment, "STORE_BYTES", 1000)
    texts = [LONG, "short one", None, "", LONG[:5000].replace(" ", "\n\n")]
    got = alignment.alignment(frame(spark, texts, [3, 3, None, 1, 2]), A, public_tokenizers.PATTERN, B, 50)
    none = sorted((tuple(r) for r in got.collect()), key=str)
    assert none == sorted(((i, *w) for i, w in zip([3, 3, None, 1, 2], by_hand(texts))), key=str)


def test_empty_table(spark):
    got = alignment.alignment(empty(spark), A, public_tokenizers.PATTERN, B)
    assert got.count() == 0 and ", ".join(f"{n} {t}" for n, t in got.dtypes).replace("bigint", "long") == alignment.RESULT


def test_pieces_of_equal_work():
    r = np.random.default_rng(2)
    for n, m in ((500, 3), (0, 40), (300, 300), (1, 1)):
        a, b = (np.sort(r.choice(1000, k, replace=False)) for k in (n, m))
        cuts = alignment.diagonals(a, b, 16)
        assert cuts[0].tolist() == [0, 0] and cuts[-1].tolist() == [n, m]
        assert (np.diff(cuts.sum(1)) <= 16).all() and (np.diff(cuts, axis=0) >= 0).all()
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for i, j in cuts:
            assert sum(s == 0 for _, s in merged[:i + j]) == i
