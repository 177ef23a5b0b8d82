"""Small tiles go through the texture kernels together and give what each gives alone."""

import numpy as np

from pixelspark.operators import ranking
from pixelspark.operators import texture as tex
from pixelspark.operators.ranking import percentiles


def test_texture_of_a_stack_is_that_of_its_tiles():
    q = np.random.default_rng(1).integers(0, 8, (40, 5, 4)).astype(float)
    steps = [(0, 1), (-1, 1)]
    together = tex.window_props(q, 3, steps, tex.PROPS, 8)
    for k, tile in enumerate(q):
        for a, b in zip(together, tex.window_props(tile, 3, steps, tex.PROPS, 8)):
            np.testing.assert_array_equal(a[k], b)


def test_pairs_of_a_stack_are_those_of_its_tiles():
    a = np.random.default_rng(2).integers(0, 4, (9, 6, 5)).astype(float)
    a[2, 1, 1] = np.nan
    steps = [(0, 1), (1, 0), (-1, 2)]
    at, *columns = tex.stack_pair_counts(a, steps)
    for k, tile in enumerate(a):
        alone = tex.pair_counts(tile, (slice(0, 6), slice(0, 5)), steps)
        for got, want in zip(columns, alone):
            np.testing.assert_array_equal(got[at == k], want)


def test_percentiles_of_whole_and_of_spread_groups(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k % 7 or None, float(v), int(n)) for k, v, n in zip(range(300), rng.integers(0, 30, 300), rng.integers(1, 5, 300))]
    df = spark.createDataFrame([*rows, (1, None, 2)], "g int, v double, n long")
    run = lambda w: sorted(map(str, percentiles(df, ["g"], "v", {"a": 0.1, "b": 0.5, "c": 1.0}, w).collect()))
    whole = run(None), run("n")
    assert len(whole[0]) == 7
    monkeypatch.setattr(ranking, "GROUP_ROWS", 42)
    mixed = run(None), run("n")
    monkeypatch.setattr(ranking, "GROUP_ROWS", -1)
    assert whole == mixed == (run(None), run("n"))


def test_percentiles_of_whole_groups_take_one_exchange(spark):
    df = spark.range(100).selectExpr("id % 5 AS g", "cast(id AS double) AS v")
    plan = ranking._percentiles_whole(df, ["g"], "v", {"m": 0.5}, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
