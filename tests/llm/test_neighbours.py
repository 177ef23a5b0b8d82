"""Nearest neighbours against brute force: recall, exact products, ties, copies, several lengths, awkward rows."""

import collections

import numpy as np
import pytest

from pixelspark.llm import neighbours, queries
from pixelspark.llm.neighbours import Lists, fit_lists, scan

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score double, k1 string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, 1.5, "x") for i, v in rows], SCHEMA)


def exact(rows, limit, every):
    """query to [(vec_id, product)], nearest first, over distinct (id, vector) rows."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = collections.defaultdict(list)
    for q, x in rows:
        if q % every == 0:
            near = sorted((-float(np.dot(x, y)), i) for i, y in rows if i != q and len(y) == len(x))
            out[q] += [(i, -s) for s, i in near[:limit]]
    return out


def got(df):
    out, ranks = collections.defaultdict(list), collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        ranks[r["query_id"]].append(r["rank"])
    for q, n in ranks.items():  # an id with two vectors asks twice
        assert n in (list(range(1, len(n) + 1)), sorted([*range(1, len(n) // 2 + 1)] * 2)), q
    return out


def test_query_recall(spark, data):
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    want = exact([tuple(r) for r in df.select("vec_id", "embedding").collect()], 20, 20)
    have = got(queries.op11_nearest_neighbours(spark, data))
    assert have.keys() == want.keys() and all(len(have[q]) == len(want[q]) for q in want)
    hits = sum(len({i for i, _ in have[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    x = dict(df.select("vec_id", "embedding").collect())
    for q, near in have.items():
        for i, s in near:
            assert s == pytest.approx(float(np.dot(x[q], x[i])), abs=1e-12)


def test_awkward_rows(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 24))
    rows = [(i, base[i % 40].tolist()) for i in range(200)]  # five copies of each: ties everywhere
    rows += [(300 + i, r.standard_normal(3).tolist()) for i in range(30)]  # another length
    rows += [(400, [1.0]), (500, [1e150, -1e150]), (520, [1.0, 2.0])]
    rows += [(600, None), (620, []), (640, [0.0, 0.0]), (660, [None, 1.0]), (680, [float("nan"), 1.0]), (700, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    rows += [rows[0], rows[0], (20, base[7].tolist())]  # repeated rows, an id with two vectors
    have, want = got(neighbours.nearest(frame(spark, rows), 6, 20)), exact(rows, 6, 20)
    assert 400 not in have and not {600, 620, 640, 660, 680, 700} & have.keys()
    assert have[500] == [(520, -1e150)]
    for q in want:
        if q not in (20, 400):
            assert [i for i, _ in have[q]] == [i for i, _ in want[q]], q
    assert len(have[20]) == 12 and not any(i == 20 for i, _ in have[20])


def test_fewer_than_asked_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.5])]
    assert got(neighbours.nearest(frame(spark, rows), 20, 20))[0] == [(1, 1.0), (2, -1.0)]
    df = neighbours.nearest(frame(spark, []), 20, 20)
    assert df.count() == 0 and df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]


def test_negative_ids_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PIECE", 16)
    monkeypatch.setattr(neighbours, "BUNDLE", 4)
    monkeypatch.setattr(neighbours, "LISTS", 2)
    monkeypatch.setattr(neighbours, "RECALL", 1.0)
    r = np.random.default_rng(5)
    rows = [(i - 100, r.standard_normal(40).tolist()) for i in range(300)]
    have, want = got(neighbours.nearest(frame(spark, rows), 7, 5)), exact(rows, 7, 5)
    hits = sum(len({i for i, _ in have[q]} & {i for i, _ in want[q]}) for q in want)
    assert have.keys() == want.keys() and hits >= 0.97 * 7 * len(want)


def test_scan_abandons_only_what_is_far():
    """Dimension scan of one piece: nearly all of the true nearest stay, and most products are never formed."""
    r = np.random.default_rng(0)
    x = r.standard_normal((1500, 96)) * r.uniform(0.5, 2, (1500, 1))
    lists = fit_lists(x, len(x), float(np.abs(x).max()), 21)
    assert np.allclose(lists.rotation @ lists.rotation.T, np.eye(96)) and 1 <= lists.probes <= len(lists.centres)
    z = lists.turned(x).astype("<f4")
    piece = {"width": 96, "raw": x.astype("<f8").tobytes(), "ids": [[i] for i in range(len(x))],
             "columns": [np.ascontiguousarray(z[:, c:c + neighbours.COLUMNS]).tobytes() for c in range(0, 96, neighbours.COLUMNS)]}
    q = x[:40] + 0.3 * r.standard_normal((40, 96))
    rows, cols, score = scan(piece, q, np.full(40, -np.inf), Lists(lists.scale, lists.rotation, lists.centres, 1), 10)
    truth = q @ x.T
    kept = sum(len(set(cols[rows == i]) & set(np.argsort(-truth[i])[:10])) for i in range(40))
    assert kept >= 390 and np.allclose(score, truth[rows, cols])
