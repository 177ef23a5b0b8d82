"""Labels, shapes, correlations and table preparation on small examples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelspark.functions import text as tx
from pixelspark.operators import correlation as co
from pixelspark.operators import labels as lb
from pixelspark.operators import measure, prep, shape
from pixelspark.plans import screening as plan
from pixelspark.sources import files as fs
from pixelspark.sources import tables as src

RNG = np.random.default_rng(5)


@pytest.fixture(scope="module")
def lab(grid):
    return lambda a, image=1: grid({image: a}, "label", "int").where("label > 0")


def row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_match_labels_rules(lab):
    container = [[1, 1, 1, 2, 2, 2, 0, 0]] * 2
    contained = [[10, 0, 11, 11, 0, 0, 12, 12], [10, 0, 0, 0, 0, 13, 0, 0]]
    m = {r.label: (r.container, r.status) for r in lb.match_mapping(lab(container), lab(contained)).collect()}
    assert m == {10: (1, "single"), 11: (1, "taken"), 12: (None, "outside"), 13: (2, "single")}
    out = lb.match_labels(lab(container), lab(contained))
    assert sorted((r.y, r.x, r.label) for r in out.collect()) == [(0, 0, 1), (1, 0, 1), (1, 5, 2)]
    with pytest.raises(Exception, match="one-to-one"):
        lb.match_labels(lab(container), lab(contained), strict=True).collect()


def test_square_and_ring(lab):
    square = np.zeros((5, 5), int)
    square[1:4, 1:4] = 4
    s = row(shape.object_shape(lab(square)))
    assert (s.area, s.area_bbox, s.extent, s.euler_number, s.area_filled, s.area_convex, s.solidity) == (9, 9, 1.0, 1, 9, 9, 1.0)
    assert (s["centroid-0"], s["centroid-1"], s.eccentricity) == (2.0, 2.0, 0.0)
    assert s.perimeter == pytest.approx(8.0)
    ring = np.ones((5, 5), int)
    ring[1:4, 1:4] = 0
    r = row(shape.object_shape(lab(ring)))
    assert (r.area, r.area_filled, r.euler_number, r.area_convex) == (16, 25, 0, 25)


def test_diagonal_gap_is_open(lab):
    a = np.array([[0, 1, 1], [1, 0, 1], [1, 1, 1]])
    assert row(shape.filled_area(lab(a))).area_filled == 7
    a[0, 0] = 1
    assert row(shape.filled_area(lab(a))).area_filled == 9


def _fill(a):
    """Flood the background of the box from outside, 8 ways."""
    p = np.pad(a > 0, 1)
    out = np.zeros(p.shape, bool)
    stack = [(0, 0)]
    while stack:
        y, x = stack.pop()
        if 0 <= y < p.shape[0] and 0 <= x < p.shape[1] and not p[y, x] and not out[y, x]:
            out[y, x] = True
            stack += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return int((~out).sum())


def _convex(a):
    """Convex area and Feret diameter from all side midpoints by half-plane tests."""
    ys, xs = np.nonzero(a)
    pts = np.unique(np.concatenate([np.column_stack(p) for p in ((ys - .5, xs), (ys + .5, xs), (ys, xs - .5), (ys, xs + .5))]), axis=0)
    inside = np.ones(a.shape, bool)
    gy, gx = np.mgrid[:a.shape[0], :a.shape[1]]
    for i in range(len(pts)):
        for j in range(len(pts)):
            d = pts[j] - pts[i]
            side = d[0] * (pts[:, 1] - pts[i, 1]) - d[1] * (pts[:, 0] - pts[i, 0])
            if i != j and (side >= -1e-9).all():
                inside &= d[0] * (gx - pts[i, 1]) - d[1] * (gy - pts[i, 0]) >= -1e-9
    far = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1)).max()
    return int(inside.sum()), far


def test_random_objects_against_brute_force(grid):
    images = {i: (RNG.random((9, 11)) > 0.4).astype(int) for i in range(25)}
    got = {r.image_id: r for r in shape.object_shape(grid(images, "label", "int").where("label > 0")).collect()}
    for i, a in images.items():
        area, far = _convex(a)
        assert (got[i].area_filled, got[i].area_convex) == (_fill(a), area), i
        assert got[i].feret_diameter_max == pytest.approx(far)
        p = np.pad(a, 1)
        quad = p[:-1, :-1] + p[1:, :-1] + p[:-1, 1:] + p[1:, 1:]
        diag = ((p[:-1, :-1] == p[1:, 1:]) & (p[1:, :-1] == p[:-1, 1:]) & (quad == 2)).sum()
        assert got[i].euler_number == ((quad == 1).sum() - (quad == 3).sum() - 2 * diag) // 4


def test_porous_objects_across_tiles(grid):
    images = {i: (RNG.random((14, 17)) > 0.45).astype(int) for i in range(12)}
    spiral = np.ones((13, 13), int)
    y, x, dy, dx = 1, 1, 0, 1
    while True:
        spiral[y, x] = 0
        ahead = spiral[y + 2 * dy, x + 2 * dx] if 0 <= y + 2 * dy < 13 and 0 <= x + 2 * dx < 13 else 0
        if not ahead or not spiral[y + dy, x + dx] or not (0 < y + dy < 12 and 0 < x + dx < 12):
            dy, dx = dx, -dy
            if not spiral[y + dy, x + dx] or not spiral[y + 2 * dy, x + 2 * dx]:
                break
        y, x = y + dy, x + dx
    images[90], images[91] = spiral, spiral.copy()
    images[91][1, 0] = 0
    px = grid(images, "label", "int").where("label > 0")
    got = {r.image_id: r.area_filled for r in shape.filled_area(px, block=3).collect()}
    assert got == {i: _fill(a) for i, a in images.items()}


def test_two_labels_side_by_side_do_not_mix(lab):
    a = np.zeros((4, 8), int)
    a[:, :4], a[:, 4:] = 1, 2
    for r in shape.object_shape(lab(a)).collect():
        assert (r.area, r.euler_number, r.perimeter) == (16, 1, pytest.approx(12.0))


def test_edge_area_and_pairs(lab, grid):
    a = np.zeros((6, 6), int)
    a[0, :3], a[2:4, 2:4], a[5, 5] = 1, 2, 3
    size = src.fov_shape(grid({1: np.zeros((6, 6))}))
    assert {r.label for r in lb.exclude_edge_labels(lab(a), size).collect()} == {2}
    assert {r.label for r in lb.filter_area(lab(a), 2, 3).collect()} == {1}
    b = np.zeros((6, 6), int)
    b[2, 2], b[0, 5] = 7, 8
    cells, nuclei = lb.drop_unpaired(lab(a), lab(b))
    assert {r.label for r in cells.collect()} == {2} and {r.label for r in nuclei.collect()} == {7}
    assert lb.subtract_mask(lab(a), lab(b)).count() == a.astype(bool).sum() - 1
    assert row(lb.object_loss(lab(a), lab(a).where("label = 2"))).asDict() == {"image_id": 1, "n_before": 3, "n_after": 1}


def _kendall(a, b):
    i, j = np.triu_indices(len(a), 1)
    s = np.sign(a[i] - a[j]) * np.sign(b[i] - b[j])
    n1, n2 = (a[i] != a[j]).sum(), (b[i] != b[j]).sum()
    return s.sum() / np.sqrt(float(n1) * float(n2)) if n1 and n2 else None


def _ranks(v):
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations_against_brute_force(grid, lab, method):
    """One label holds nearly all pixels, with ties, next to small and constant ones."""
    shape_ = (24, 24)
    labels = np.ones(shape_, int)
    labels[0, :5], labels[1, :2], labels[2, 0] = 2, 3, 4
    a = RNG.integers(0, 40, shape_).astype(float)
    b = np.round(a / 3 + RNG.normal(size=shape_) * 4)
    a[1, :2] = 9
    got = {r.label: r.coeff for r in co.channel_correlation(grid({1: [a, b]}), lab(labels), [0, 1], method).collect()}
    for label in (1, 2, 3, 4):
        u, v = a[labels == label], b[labels == label]
        if method == "spearman":
            u, v = _ranks(u), _ranks(v)
        if method == "kendall":
            want = _kendall(u, v)
        else:
            want = np.corrcoef(u, v)[0, 1] if len(u) > 1 and np.ptp(u) and np.ptp(v) else None
        assert got[label] == (pytest.approx(want) if want is not None else None), label


def test_min_periods_and_wide(grid, lab):
    labels = [[1, 1, 1, 2, 2]]
    px = grid({1: [[[1, 2, 4, 1, 2]], [[2, 4, 9, 3, 1]]]})
    long = co.channel_correlation(px, lab(labels), [0, 1], "pearson", min_periods=3)
    wide = {r.label: r["pearson_coeff_0_1"] for r in co.wide_correlation(long, [0, 1], "pearson").collect()}
    assert wide[2] is None and wide[1] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1])


def test_permutation_keeps_label_values(grid, lab):
    labels = (np.arange(64).reshape(8, 8) % 3) + 1
    a, b = RNG.normal(size=(8, 8)).round(3), RNG.normal(size=(8, 8)).round(3)
    got = co.permute_within_label(grid({1: [a, b]}), lab(labels), [0, 1], 2).toPandas()
    for k in (1, 2, 3):
        for rnd in (0, 1):
            part = got[(got["label"] == k) & (got["round"] == rnd)]
            assert sorted(part["c0"]) == sorted(a[labels == k]) and sorted(part["c1"]) == sorted(b[labels == k])
    first, second = (got[got["round"] == r].sort_values(["label", "slot"])["c0"].tolist() for r in (0, 1))
    assert first != second


def test_names():
    assert len(tx.SYMBOLS) == 29


def test_text_columns(spark):
    df = spark.createDataFrame([("a-b c+1",), ("Well07",), ("x",)], "s string")
    got = df.select(tx.normalize_text(F.col("s")).alias("n"), tx.normalize_text(F.col("s"), ["-"], "__", True).alias("m"),
                    tx.trailing_number(F.col("s")).alias("t"), tx.split_text_number(F.col("s")).alias("p")).collect()
    assert [r.n for r in got] == ["a_bc_1", "Well07", "x"] and got[0].m == "a__bc+1"
    assert [r.t for r in got] == [1, 7, None]
    assert got[1].p == ("Well", "07") and got[2].p == (None, None)


def test_name_fields(spark):
    df = spark.createDataFrame([("exp_A.7_x_well12",)], "s string")
    fields = {"a": (0, None, None, None), "b": (1, ".", 1, "try_int"), "c": (1, ".", 5, None), "d": (-1, None, None, None), "e": "lit"}
    assert row(df.select(*tx.parse_name(F.col("s"), fields))).asDict() == {"a": "exp", "b": "7", "c": "A.7", "d": "well12", "e": "lit"}


def test_latest_and_listing(spark, tmp_path):
    names = ["20240101_a.csv", "20250101_b.csv", "20250101_c.csv", ".20260101_h.csv", "20230101_z.xlsx", "nodate.csv"]
    for n in names:
        (tmp_path / n).write_text("x")
    cat = fs.file_catalog(spark, str(tmp_path))
    files = spark.createDataFrame([(n,) for n in names], "name string")
    visible = fs.list_inputs(files, "csv")
    date = fs.name_date(F.col("name"))
    assert row(fs.latest_file(visible, date)).name == "20250101_c.csv"
    assert row(fs.latest_file(visible, date, newest=False)).name == "20240101_a.csv"
    assert sorted(r.name for r in fs.latest_files(visible, date).collect()) == ["20250101_b.csv", "20250101_c.csv"]
    assert fs.latest_files(visible.where("false"), date).count() == 0
    assert {r.name for r in cat.collect()} >= {"20240101_a.csv", "nodate.csv"}
    assert fs.latest_file(cat, F.col("modified")).count() == 1


def test_split_is_exact_and_refuses_overwrite(spark):
    df = spark.range(101).toDF("k")
    out = prep.train_test_split(df, ["k"], 0.3)
    assert out.where("is_train = 0").count() == 31 and out.count() == 101
    with pytest.raises(ValueError):
        prep.train_test_split(out, ["k"])
    assert prep.sample_rows(df, ["k"], 0.5).count() == 51
    with pytest.raises(ValueError):
        prep.require_rows(df.where("k < 0"))
    assert prep.require_rows(df) is df


def test_layout_and_names(spark):
    layout = spark.createDataFrame([("e", 1, "b"), ("e", 1, "a"), ("e", 2, "c")], "experiment string, well int, treatment string")
    fov = spark.createDataFrame([("e", "well1"), ("e", "well3")], "experiment string, well string")
    got = {r.well: r.treatment for r in prep.layout_lookup(fov, layout, drop_well_number=True).collect()}
    assert got == {"well1": "a", "well3": None}
    assert prep.layout_missing(fov, layout).count() == 1
    files = spark.createDataFrame([("x_well1_bg.tif",), ("x_well12_bg.tif",)], "name string")
    cond = spark.createDataFrame([("well1",), ("well12",), ("nope",)], "condition string")
    rep = {r.condition: (r.n_files, r.ok) for r in prep.match_report(files, cond).collect()}
    assert rep == {"well1": (2, False), "well12": (1, True), "nope": (0, False)}


def test_writers(spark, tmp_path, grid):
    px = grid({1: RNG.normal(size=(4, 4)), 2: RNG.normal(size=(4, 4))})
    src.write_image_table(px, f"{tmp_path}/px", {"unit": "um"})
    back = src.read_pixels(spark, f"{tmp_path}/px", spark.createDataFrame([(1,)], "image_id long"), [0], px.schema)
    assert back.count() == 16
    src.write_table(px, f"{tmp_path}/csv", "csv")
    assert src.read_fov_table(spark, f"{tmp_path}/csv", px.schema).count() == 32
    for step in ("a", "b"):
        src.write_run_params(spark, f"{tmp_path}/run", "r1", step, {"x": 1, "y": None})
    assert spark.read.parquet(f"{tmp_path}/run").count() == 4


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, grid, lab):
    labels = np.ones((6, 6), int)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src.write_bucketed(grid({1: RNG.normal(size=(6, 6))}), "t_px", 4, f"{tmp_path}/px")
        src.write_bucketed(lab(labels), "t_lab", 4, f"{tmp_path}/lab")
        out = measure.label_pixels(spark.table("t_px"), spark.table("t_lab"))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 36
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE IF EXISTS t_px")
        spark.sql("DROP TABLE IF EXISTS t_lab")


def test_workflow_with_stored_background(spark, tmp_path, grid):
    """Background written, read back and joined without shuffling the pixels."""
    images = {i: RNG.integers(1000, 2000, size=(6, 6)) for i in range(8)}
    px = grid(images)
    flagged = plan.quality_table(px.select("image_id").distinct(), px, [0], {"mean_over_std": (1.0, None), "plls": (None, 50.0)}, smooth=3)
    assert flagged.where("flag = 0").count() > 0
    model = plan.background_model(px, flagged, fit="polyfit", kx=1, ky=1)
    src.write_image_table(model, f"{tmp_path}/bg")
    stored = spark.read.parquet(f"{tmp_path}/bg")
    out = plan.correct(px, stored, offset=100.0)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert out.count() == 8 * 36
