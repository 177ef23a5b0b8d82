"""Groups that one task may hold give what larger ones give, with fewer exchanges."""

import re

import numpy as np
import pytest

from pixelspark.operators import correlation as co
from pixelspark.operators import prep, ranking
from pixelspark.schema import IL


@pytest.fixture
def tied(spark):
    """Three channels with ties, NULL and NaN, and labels of 12, 1 and 3 pixels, one of them 0."""
    rng = np.random.default_rng(4)
    at = [(y, x) for y in range(4) for x in range(4)]
    rows = [(7, c, y, x, float(v)) for c in range(3) for (y, x), v in zip(at, rng.integers(0, 4, 16))]
    rows[3] = (*rows[3][:4], None)
    rows[20] = (*rows[20][:4], float("nan"))
    px = spark.createDataFrame(rows, "image_id long, channel int, y int, x int, value double")
    labels = spark.createDataFrame([(7, y, x, 0 if i < 12 else 1 if i == 12 else 2) for i, (y, x) in enumerate(at)], "image_id long, y int, x int, label int")
    return px, labels


def _rows(df):
    return sorted((tuple(None if v is None else "nan" if v != v else round(v, 9) for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("method", ["spearman", "kendall"])
def test_correlation_of_whole_and_of_spread_objects(tied, monkeypatch, method):
    run = lambda: _rows(co.channel_correlation(*tied, [0, 1, 2], method))
    whole = run()
    monkeypatch.setattr(ranking, "GROUP_ROWS", 2)
    mixed = run()
    monkeypatch.setattr(ranking, "GROUP_ROWS", -1)
    assert whole == mixed == run() and len(whole) == 9


def test_rounds_of_whole_and_of_spread_objects(tied, monkeypatch):
    run = lambda: _rows(co.permutation_rounds(*tied, [0, 1, 2], 3)) + _rows(co.permute_within_label(*tied, [0, 1, 2], 2))
    whole = run()
    monkeypatch.setattr(ranking, "GROUP_ROWS", 2)
    assert whole == run()


def test_small_objects_are_exchanged_once_for_their_ranks(spark, tied):
    wide = co.wide_channels(tied[0], [0, 1, 2]).join(tied[1], ["image_id", "y", "x"])
    plan = co.correlate_whole(co.spread(wide, *IL), [0, 1, 2], "kendall")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(image_id#\d+L?, label#", plan)) == 1
    rounds = co._permuted_whole(*tied, [0, 1, 2], 3, 42)
    plan = co.correlate_whole(rounds, [0, 1, 2], "spearman", 1, ["round"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 3


def test_substrings_of_names_are_not_aggregated(spark):
    files = spark.createDataFrame([("abab",), ("abab",), ("c",), (None,)], "name string")
    conditions = spark.createDataFrame([("ab",), ("c",)], "condition string")
    found = prep.match_names(files, conditions).select("condition", "name")
    assert sorted(map(tuple, found.collect())) == [("ab", "abab"), ("c", "c")]
    assert not re.search(r"Aggregate \[name#\d+, condition#\d+\]", found._jdf.queryExecution().optimizedPlan().toString())
