"""Slices of the alignment: packed rows in small row groups, counts that come back as rows in order."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pixelspark.llm import alignment
from tests.llm.test_alignment import A, B, by_hand
from tests.llm.test_llm import frame

WORDS = [f"{w}{i}" for i in range(40) for w in ("alpha", "beta", "gamma-delta", "Épsilon", "zeta ", "eta,")]
TEXTS = [" ".join(WORDS[k % 7:k * 5]) for k in range(60)] + ["", None, "one"] * 10 + [" ".join(WORDS)] * 5


@pytest.fixture
def stored_slices(monkeypatch):
    """The stored tables by name."""
    kept, write = {}, alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, name, *a: kept.setdefault(name, write(df, name, *a)))
    return kept


def aligned(spark, texts):
    return alignment.alignment(frame(spark, texts).coalesce(1), A, public_tokenizers.PATTERN, B)


def test_stored_slices_are_small(spark, monkeypatch, stored_slices):
    """At most 4 bytes a link, and row groups that a reader can decode at once; they took 12 bytes, in one row group of up to 128 MB."""
    monkeypatch.setattr(alignment, "SLICE", 2000)
    monkeypatch.setattr(alignment, "GROUP_BYTES", 20_000, raising=False)
    aligned(spark, TEXTS * 6).collect()
    files = [pq.ParquetFile(f.removeprefix("file:")) for f in stored_slices["slices"].inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 100
    assert max(g.total_byte_size for g in groups) < 60_000
    monkeypatch.setattr(alignment, "SLICE", 1 << 20)
    row = alignment.aligned_slices(frame(spark, TEXTS * 6).coalesce(1), A, public_tokenizers.PATTERN, B).collect()[0]
    n = len(alignment.unpacked(pa.py_buffer(row["links"])).column(0))
    assert n > 20_000 and len(row["links"]) < 4 * n


def test_no_step_gathers_a_slice_in_memory(spark):
    plan = aligned(spark, TEXTS)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan


def test_batches_of_texts_are_bounded(spark, monkeypatch, stored_slices):
    """A batch was 10,000 rows of any length; the session's own setting is as before behind it."""
    monkeypatch.setattr(alignment, "BATCH_BYTES", 20_000, raising=False)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    aligned(spark, TEXTS * 6).collect()
    assert stored_slices["slices"].count() > 10 and spark.conf.get(key) == before


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_counts_of_a_slice_in_several_batches(spark, monkeypatch, rows):
    monkeypatch.setattr(alignment, "SLICE", 3000)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    texts = TEXTS if rows > 1 else TEXTS[:12] + TEXTS[58:68]
    try:
        spark.conf.set(key, rows)
        got = sorted(tuple(r) for r in aligned(spark, texts).collect())
    finally:
        spark.conf.set(key, before)
    assert got == [(i, *w) for i, w in enumerate(by_hand(texts))]


def test_packed_links_of_far_documents():
    """Steps beyond 32 bits: pairs by the thousand and documents without links between others."""
    r = np.random.default_rng(3)
    n_docs, n_pairs = 900_000, 60_000
    doc, pair = np.sort(r.choice([0, 5, 899_999], 500)), r.integers(0, n_pairs, 500)
    where, at = np.unique(doc * n_pairs + pair, return_index=True)
    doc, pair, times = doc[at], pair[at], r.integers(1, 70_000, len(at))
    count, best = r.integers(1, 1 << 40, n_pairs), r.integers(0, 2, n_pairs)
    links = alignment.unpacked(pa.py_buffer(alignment.packed_links(where, times)))
    n_best, sums = alignment.link_sums(links, n_docs, count, best)
    for d in (0, 5, 899_999, 7):
        assert sums[d] == (times * count[pair])[doc == d].sum() and n_best[d] == (times * best[pair])[doc == d].sum()
    none = alignment.unpacked(pa.py_buffer(alignment.packed_links(where[:0], times[:0])))
    assert [x.tolist() for x in alignment.link_sums(none, 2, count[:0], best[:0])] == [[0, 0], [0, 0]]
