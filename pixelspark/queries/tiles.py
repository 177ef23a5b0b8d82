"""Images that are cut: 16x16 images of events in tiles of 6, and all events as one wide image in tiles of 256."""

import math

from pyspark.sql import functions as F

from pixelspark.operators import qc, shape
from pixelspark.operators import stencil as st
from pixelspark.operators import tensors as tn
from pixelspark.operators import texture as tex
from pixelspark.queries import inputs as q
from pixelspark.queries.features import _EIGENVALUES, _STATS, _TENSOR_PARTS, _gauss
from pixelspark.queries.filters import _ball, weights
from pixelspark.queries.inputs import r
from pixelspark.queries.objects import _CODED, _PERIMETER
from pixelspark.queries.registry import query

BLOCK = 6
_PX = "image_id, channel, y, x"
_SIDE = {"cut": ("16", "16"), "wide": ("16", "(SELECT max(x) + 1 FROM wide)")}

q._cte("cut", "SELECT * FROM evt WHERE image_id IN (SELECT image_id FROM evt GROUP BY image_id HAVING count(*) = 256)", "evt")
q._cte("wide", "SELECT 0::BIGINT AS image_id, 0::INT AS channel, (event_id % 16)::INT AS y, (event_id // 16)::INT AS x, "
               "round(value * 100)::DOUBLE AS value FROM events WHERE event_id < 16 * ((SELECT count(*) FROM events) // 16)")
q._cte("spots", "SELECT image_id, y, x, (1 + (y // 5) * 4 + x // 5)::INT AS label FROM cut WHERE value >= 2000", "cut")
q._cte("stripes", "SELECT image_id, y, x, (1 + x // 300)::INT AS label FROM wide WHERE value >= 2000", "wide")


def full(s, d):
    """Whole images of 16x16."""
    px = q.evt(s, d)
    return px.join(px.groupBy("image_id").count().where("count = 256").select("image_id"), "image_id", "left_semi")


def wide(s, d):
    """One image of 16 rows."""
    e, events = F.col("event_id"), q.table(s, d, "events")
    whole = events.agg((F.floor(F.count(F.lit(1)) / 16) * 16).alias("n"))
    return events.join(whole, e < F.col("n")).select(
        F.lit(0).cast("long").alias("image_id"), F.lit(0).alias("channel"), (e % 16).cast("int").alias("y"),
        F.floor(e / 16).cast("int").alias("x"), F.round(F.col("value") * 100).cast("double").alias("value"))


def spots(s, d):
    """Objects that lie across tiles of 6."""
    label = F.floor(F.col("y") / 5) * 4 + F.floor(F.col("x") / 5) + 1
    return full(s, d).where("value >= 2000").select("image_id", "y", "x", label.cast("int").alias("label"))


def stripes(s, d):
    """Objects that lie across tiles of 256."""
    return wide(s, d).where("value >= 2000").select("image_id", "y", "x", (F.floor(F.col("x") / 300) + 1).cast("int").alias("label"))


def _size(px):
    return px.groupBy("image_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def _near(src: str, radius: int, mode: str) -> str:
    """Rows (image, channel, y, x, dy, dx, v): every pixel with its neighbours, the border read by ``mode``."""
    at = {"symmetric": "CASE WHEN {t} < 0 THEN -1 - {t} WHEN {t} >= {n} THEN 2 * {n} - 1 - {t} ELSE {t} END",
          "reflect": "CASE WHEN {t} < 0 THEN -{t} WHEN {t} >= {n} THEN 2 * {n} - 2 - {t} ELSE {t} END",
          "nearest": "least(greatest({t}, 0), {n} - 1)"}[mode]
    side, (h, w) = f"range(-{radius}, {radius + 1})", _SIDE[src]
    return f"""(SELECT c.image_id, c.channel, c.y, c.x, dy, dx, n.value AS v FROM
 (SELECT image_id, channel, y, x, dy, dx, {at.format(t='(y + dy)', n=h)} AS ny, {at.format(t='(x + dx)', n=w)} AS nx
  FROM {src}, {side} a(dy), {side} b(dx)) c
 JOIN {src} n ON n.image_id = c.image_id AND n.channel = c.channel AND n.y = c.ny AND n.x = c.nx)"""


def _local(agg: str, src: str, radius: int, mode: str) -> str:
    return f"SELECT {_PX}, {agg} AS value FROM {_near(src, radius, mode)} GROUP BY {_PX}"


@query(q.sql(_local("median(v)", "cut", 1, "symmetric"), "cut"))
def tiles_median(s, d):
    px = full(s, d)
    return st.median_filter(px, 3, block=BLOCK, size_of=_size(px))


@query(q.sql(_local("median(v)", "wide", 2, "symmetric"), "wide"))
def wide_median(s, d):
    return st.median_filter(wide(s, d), 5)


@query(q.sql(_local(r(weights(0.6)), "cut", 2, "nearest"), "cut"))
def tiles_gaussian(s, d):
    return q.rounded(st.gaussian_filter(full(s, d), 0.6, block=BLOCK))


def _wide_pass(name: str, src: str, sigma: float, axis: str, n: str) -> str:
    reach, other = int(4 * sigma + .5), "x" if axis == "y" else "y"
    total = sum(math.exp(-0.5 * (i / sigma) ** 2) for i in range(-reach, reach + 1))
    mirror = "CASE WHEN m < {n} THEN m ELSE 2 * {n} - 1 - m END".format(n=n)
    return f"""{name} AS (SELECT a.image_id, a.channel, a.y, a.x, sum(b.v * exp(-0.5 * k * k / {sigma * sigma}::DOUBLE) / {total!r}::DOUBLE) AS v
 FROM (SELECT image_id, channel, y, x, k, {mirror} AS p FROM (SELECT *, (({axis} + k) % (2 * {n}) + 2 * {n}) % (2 * {n}) AS m
  FROM {src}, range(-{reach}, {reach + 1}) t(k))) a
 JOIN {src} b ON b.image_id = a.image_id AND b.{other} = a.{other} AND b.{axis} = a.p GROUP BY a.image_id, a.channel, a.y, a.x)"""


@query(q.sql_with("source AS (SELECT image_id, channel, y, x, value AS v FROM cut), " + _wide_pass("gy", "source", 8.5, "y", "16") + ", "
                  + _wide_pass("gx", "gy", 8.5, "x", "16"), f"SELECT {_PX}, {r('v')} AS value FROM gx", "cut"))
def tiles_smooth_background(s, d):
    """A sigma that reaches beyond the image, so that the filter runs on strips; mirrored borders."""
    return q.rounded(st.smooth_background(full(s, d), 8.5))


@query(q.sql(f"""SELECT image_id, channel, {r('sqrt(var_pop(v))')} AS laplacian_sd FROM
 (SELECT {_PX}, sum(CASE WHEN dy = 0 AND dx = 0 THEN -4 * v WHEN dy = 0 OR dx = 0 THEN v ELSE 0 END) AS v
  FROM {_near('cut', 1, 'reflect')} GROUP BY {_PX}) GROUP BY image_id, channel""", "cut"))
def tiles_laplacian(s, d):
    out = qc.laplacian_variance(full(s, d), block=BLOCK)
    return q.rounded(out.select("image_id", "channel", F.sqrt("laplacian_var").alias("laplacian_sd")))


@query(q.sql(f"SELECT {_PX}, {r('value')} AS value FROM {_ball(5, 'cut')}", "cut"))
def tiles_rolling_ball(s, d):
    return q.rounded(st.rolling_ball(full(s, d), 5, block=BLOCK))


_ERODED = """kept AS (SELECT image_id, y, x, m AS label FROM (SELECT c.image_id, c.y, c.x, min(coalesce(n.label, 0))::INT AS m
 FROM (SELECT spots.*, dy, dx FROM spots, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS t(dy, dx)
 WHERE y + dy BETWEEN 0 AND 15 AND x + dx BETWEEN 0 AND 15) c
 LEFT JOIN spots n ON n.image_id = c.image_id AND n.y = c.y + c.dy AND n.x = c.x + c.dx GROUP BY c.image_id, c.y, c.x) WHERE m > 0)"""


@query(q.sql_with(_ERODED, "SELECT * FROM kept", "spots"))
def tiles_erode(s, d):
    return st.erode_labels(spots(s, d), _size(full(s, d)), 1, block=BLOCK)


@query(q.sql_with(f"lab AS (SELECT * FROM spots), {_CODED}", _PERIMETER, "spots"))
def tiles_perimeter(s, d):
    return q.rounded(shape.perimeter(spots(s, d), block=BLOCK))


@query(q.sql_with(f"lab AS (SELECT * FROM stripes), {_CODED}", _PERIMETER, "stripes"))
def wide_perimeter(s, d):
    return q.rounded(shape.perimeter(stripes(s, d)))


def _smooth(name: str, src: str, sigma: float, axis: str) -> str:
    n, other = int(4 * sigma + .5), "x" if axis == "y" else "y"
    return f"""{name} AS (SELECT a.image_id, a.channel, a.y, a.x, {_gauss(sigma, axis)} AS v FROM {src} a, range(-{n}, {n + 1}) t(k)
 JOIN {src} b ON b.image_id = a.image_id AND b.channel = a.channel AND b.{other} = a.{other} AND b.{axis} = least(greatest(a.{axis} + k, 0), 15)
 GROUP BY a.image_id, a.channel, a.y, a.x)"""


def _slope(name: str, src: str, axis: str) -> str:
    w = f"(PARTITION BY image_id, channel, {'x' if axis == 'y' else 'y'} ORDER BY {axis})"
    return f"""{name} AS (SELECT image_id, channel, y, x, CASE {axis} WHEN 0 THEN lead(v) OVER {w} - v WHEN 15 THEN v - lag(v) OVER {w}
 ELSE (lead(v) OVER {w} - lag(v) OVER {w}) / 2 END AS v FROM {src})"""


_SOURCE = "source AS (SELECT image_id, channel, y, x, value AS v FROM cut)"
_HESSIAN = ", ".join([_SOURCE, _smooth("sy", "source", 1.0, "y"), _smooth("sx", "sy", 1.0, "x"), _slope("gy", "sx", "y"), _slope("gx", "sx", "x"),
                      _slope("hyy", "gy", "y"), _slope("hyx", "gy", "x"), _slope("hxx", "gx", "x"),
                      f"eig0 AS (SELECT {_PX}, {_EIGENVALUES.format(k=0)} FROM (SELECT {_PX}, a.v AS a, b.v AS b, c.v AS c "
                      f"FROM hyy a JOIN hyx b USING ({_PX}) JOIN hxx c USING ({_PX})))"])


@query(q.sql_with(_HESSIAN, f"SELECT {_PX}, {r('eigv_1_0', 3)} AS eigv_1_0, {r('eigv_2_0', 3)} AS eigv_2_0 FROM eig0", "cut"))
def tiles_hessian(s, d):
    return q.rounded(tn.hessian_map(full(s, d), tn.hessian_sigmas(), block=BLOCK), digits=3)


def _long(src: str, features: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT image_id, label, channel, '{name}' AS feature, 0 AS sigma, '{n}' AS stat, {r(f'{fn}({c})', 2)} AS value "
        f"FROM {src} JOIN kept USING (image_id, y, x) GROUP BY image_id, label, channel" for c, name in features.items() for n, fn in _STATS)


@query(q.sql_with(f"{_ERODED}, {_HESSIAN}", _long("eig0", {"eigv_1_0": "hessian_eigv_1", "eigv_2_0": "hessian_eigv_2"}), "cut", "spots"))
def tiles_hessian_objects(s, d):
    """Objects across tiles: partial sums of tiles merged."""
    px = full(s, d)
    return q.rounded(tn.hessian_features(px, spots(s, d), tn.hessian_sigmas(), 1, _size(px), BLOCK), digits=2)


@query(q.sql_with(f"{_ERODED}, {_SOURCE}, {_TENSOR_PARTS}", _long("eig", {"eigv_1_0": "str_tens_eigv_1", "eigv_2_0": "str_tens_eigv_2"}), "cut", "spots"))
def tiles_tensor_objects(s, d):
    px = full(s, d)
    found = tn.structure_tensor_features(px, spots(s, d), tn.sigma_grid(), 1, _size(px), block=BLOCK)
    return q.rounded(found.where("feature <> 'anisotropy'"), digits=2)


q._cte("grey", "SELECT image_id, channel, y, x, (floor(value / 500) % 8)::INT AS level FROM cut", "cut")
q._cte("wide_grey", "SELECT image_id, channel, y, x, (floor(value / 500) % 8)::INT AS level FROM wide", "wide")
_STEPS = {(0, 0): (0, 1), (0, 1): (1, 1), (0, 2): (1, 0), (1, 0): (0, 2), (1, 1): (1, 1), (1, 2): (2, 0)}
_ANGLES = [0.0, math.pi / 4, math.pi / 2]


def _grey(px):
    return px.withColumn("level", (F.floor(F.col("value") / 500) % 8).cast("int")).drop("value")


def _glcm(src: str) -> str:
    one = (f"SELECT a.image_id, a.channel, a.level AS i, b.level AS j FROM {src} a JOIN {src} b ON b.image_id = a.image_id "
           "AND b.channel = a.channel AND b.y = a.y + {} AND b.x = a.x + {}")
    return " UNION ALL ".join(f"SELECT image_id, channel, {d}::INT AS d, {a}::INT AS a, i, j, count(*) AS n FROM (SELECT * FROM ({one.format(*o)}) "
                              f"UNION ALL SELECT image_id, channel, j, i FROM ({one.format(*o)})) GROUP BY ALL" for (d, a), o in _STEPS.items())


@query(q.sql(_glcm("grey"), "grey"))
def tiles_glcm(s, d):
    return tex.glcm(_grey(full(s, d)), [1, 2], _ANGLES, normed=False, block=BLOCK)


@query(q.sql(_glcm("wide_grey"), "wide_grey"))
def wide_glcm(s, d):
    return tex.glcm(_grey(wide(s, d)), [1, 2], _ANGLES, normed=False)


@query(q.sql("SELECT a.image_id, a.channel, a.y, a.x, a.level, b.level AS partner FROM grey a JOIN grey b "
             "ON b.image_id = a.image_id AND b.channel = a.channel AND b.y = a.y - 3 AND b.x = a.x + 5", "grey"))
def tiles_offset_pairs(s, d):
    return tex.offset_pairs(_grey(full(s, d)), -3, 5, block=BLOCK)
