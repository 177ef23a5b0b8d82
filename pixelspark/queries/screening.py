"""The three entries of the reference workflow, end to end."""

from pixelspark.plans import screening as plan
from pixelspark.queries import inputs as q
from pixelspark.queries.features import _STATS, _TENSOR_PARTS, _hessian_parts, wide_eigen
from pixelspark.queries.filters import local_sql, weights
from pixelspark.queries.illumination import _CYX, bright
from pixelspark.queries.inputs import r
from pixelspark.queries.objects import SHAPE_PARTS, SHAPE_TABLE, shape_sql
from pixelspark.queries.registry import query

_MOS = "CASE WHEN stddev_pop(value) > 0 THEN avg(value) / stddev_pop(value) END"
_SKEW = "CASE WHEN var_pop(value) > 0 THEN avg(pow(value - mu, 3)) / pow(var_pop(value), 1.5) END"
_QUALITY = f"""metric AS (SELECT image_id, channel, {_MOS} AS mean_over_std, {_SKEW} AS skew FROM
 (SELECT *, avg(value) OVER (PARTITION BY image_id, channel) AS mu FROM bright) GROUP BY image_id, channel),
 flagged AS (SELECT image_id, CASE WHEN bool_or(coalesce(mean_over_std <= 25 OR mean_over_std >= 75, false)
  OR coalesce(skew <= -1 OR skew >= 1, false)) THEN 1 ELSE 0 END AS flag FROM metric GROUP BY image_id)"""
_WIDE = ", ".join(f"{r(f'max({m}) FILTER (channel = {c})')} AS \"{m}-{c}\"" for m in ("mean_over_std", "skew") for c in range(3))
_BOUNDS = {"mean_over_std": (25.0, 75.0), "skew": (-1.0, 1.0)}


@query(q.sql("SELECT 1", "bright").replace(
    "\nSELECT 1", f",\n{_QUALITY}\nSELECT image_id, {_WIDE}, any_value(flag) AS flag FROM metric JOIN flagged USING (image_id) GROUP BY image_id"))
def quality_report(s, d):
    px = bright(s, d)
    fov = px.select("image_id").distinct()
    out = plan.quality_table(fov, px, [0, 1, 2], _BOUNDS)
    return q.rounded(out)


_MODEL = f"""{_QUALITY},
 good AS (SELECT bright.* FROM bright JOIN flagged USING (image_id) WHERE flag = 0),
 stack AS (SELECT {_CYX}, median(value) AS value FROM good GROUP BY {_CYX}),
 scaled AS (SELECT {_CYX}, (value - 400) / (max(value - 400) OVER (PARTITION BY channel) + 1e-8) AS bg FROM stack),
 corrected AS (SELECT image_id, channel, y, x, (value - 400) / (bg + 1e-8) AS value FROM bright JOIN scaled USING ({_CYX}))"""


@query(q.sql("SELECT 1", "bright").replace(
    "\nSELECT 1", f",\n{_MODEL}\nSELECT image_id, channel, y, x, {r('value')} AS value FROM corrected"))
def correction_report(s, d):
    px = bright(s, d)
    flagged = plan.quality_table(px.select("image_id").distinct(), px, [0, 1, 2], _BOUNDS)
    model = plan.background_model(px, flagged)
    return q.rounded(plan.correct(px, model, offset=400.0).select("image_id", "channel", "y", "x", "value"))


@query(q.sql("SELECT 1", "bright", "lab_b").replace("\nSELECT 1", f""",\n{_MODEL}
SELECT image_id, label, channel, flag, count(*) AS area, """ + ", ".join(f"{r(f'{fn}(value)')} AS {n}" for n, fn in _STATS)
    + " FROM corrected JOIN lab_b USING (image_id, y, x) JOIN flagged USING (image_id) GROUP BY image_id, label, channel, flag"))
def screening_report(s, d):
    """Flags, background from unflagged images, corrected pixels, intensity per object."""
    px = bright(s, d)
    flagged = plan.quality_table(px.select("image_id").distinct(), px, [0, 1, 2], _BOUNDS)
    model = plan.background_model(px, flagged)
    objects = plan.object_intensities(plan.correct(px, model, offset=400.0), q.lab_b(s, d))
    return q.rounded(objects.join(flagged.select("image_id", "flag"), "image_id"))


_CLEAN = "(SELECT * FROM lab_i WHERE label <> 6)"


@query(q.sql(f"""SELECT image_id, label, area, {r('cy')} AS "centroid-0", {r('cx')} AS "centroid-1", """ + ", ".join(
    f"{r(f'{a}{c}')} AS \"{n}-{c}\"" for c in range(3) for n, a in (("intensity_mean", "avg"), ("intensity_std", "std")))
    + f""" FROM (SELECT image_id, label, count(*) // 3 AS area, avg(y) AS cy, avg(x) AS cx, """ + ", ".join(
    f"avg(value) FILTER (channel = {c}) AS avg{c}, stddev_pop(value) FILTER (channel = {c}) AS std{c}" for c in range(3))
    + f" FROM {_CLEAN} JOIN multi USING (image_id, y, x) GROUP BY image_id, label)", "multi", "lab_i"))
def object_table(s, d):
    """Shape and intensity of objects off the edge, one row each."""
    out = plan.object_table(q.multi(s, d), q.lab_i(s, d), [0, 1, 2], sigma=None, hessian=None, tensor=None)
    keep = ["image_id", "label", "area", "centroid-0", "centroid-1",
            *[f"{n}-{c}" for c in range(3) for n in ("intensity_mean", "intensity_std")]]
    return q.rounded(out.select(*[f"`{c}`" for c in keep]))


_SMOOTHED = "source AS (" + local_sql(weights(0.6), "multi", 2, "nearest") + ")"
_INNER = "kept AS (SELECT * FROM lab_i WHERE label <> 6 AND y BETWEEN 3 AND 4 AND x BETWEEN 3 AND 4)"
_PX = "image_id, channel, y, x"
_FULL = f"""SELECT * FROM {SHAPE_TABLE}
 JOIN (SELECT image_id, label, {', '.join(f'{r(f"{fn}(v) FILTER (channel = {c})")} AS "{n}-{c}"' for n, fn in _STATS for c in range(3))}
  FROM lab JOIN source USING (image_id, y, x) GROUP BY image_id, label) USING (image_id, label)
 JOIN (SELECT image_id, label, {wide_eigen('hessian', 1, tuple(n for n, _ in _STATS))}
  FROM kept JOIN eig0 USING (image_id, y, x) GROUP BY image_id, label) USING (image_id, label)
 JOIN (SELECT image_id, label, {wide_eigen('str_tens', 1, tuple(n for n, _ in _STATS))},
  {', '.join(f'{r(f"{fn}(anisotropy_0) FILTER (channel = {c})")} AS "anisotropy_{n}_1_2-{c}"' for n, fn in _STATS for c in range(3))}
  FROM kept JOIN eig USING (image_id, y, x) GROUP BY image_id, label) USING (image_id, label)"""


@query(shape_sql("SELECT * FROM lab_i WHERE label <> 6", _FULL, *SHAPE_PARTS, _INNER, _SMOOTHED, _hessian_parts(1.0), _TENSOR_PARTS,
                 needs=("multi", "lab_i")))
def object_table_full(s, d):
    """All features of the workflow's last step, one row per object."""
    return q.rounded(plan.object_table(q.multi(s, d), q.lab_i(s, d), [0, 1, 2], sigma=0.6, erosion=1))
