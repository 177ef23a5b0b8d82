"""Rows that must not be lost: missing background, NULL flags and values, empty conditions."""

from pixelspark.operators import background, labels, prep, qc


def test_pixels_without_background_are_kept(spark, grid):
    px = grid({1: [[10.0, 20.0], [30.0, 40.0]]})
    bg = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, 2.0)], "channel int, y int, x int, value double")
    got = {(r["y"], r["x"]): r["value"] for r in background.correct_pixels(px, bg, strict=False).collect()}
    assert got == {(0, 0): 9.0, (0, 1): 18.0, (1, 0): None, (1, 1): None}


def test_null_flags_are_kept(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "image_id long, flag int")
    assert sorted(r["image_id"] for r in qc.unflagged(df).collect()) == [1, 3]


def test_null_values_are_not_saturated(spark, grid):
    px = grid({1: [[0.0, 5.0], [None, 255.0]]})
    assert sorted((r["value"] for r in labels.drop_saturated(px, 0, 255).collect()), key=str) == [5.0, None]


def test_an_empty_condition_is_part_of_every_name(spark):
    files = spark.createDataFrame([("ab",), ("c",)], "name string")
    conditions = spark.createDataFrame([("",), ("b",)], "condition string")
    got = sorted(tuple(r) for r in prep.match_names(files, conditions).select("condition", "name").collect())
    assert got == [("", "ab"), ("", "c"), ("b", "ab")]
