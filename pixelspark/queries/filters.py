"""Neighbourhood operators on images."""

import math

import numpy as np

from pixelspark.functions import kernels as K
from pixelspark.operators import stencil as st
from pixelspark.operators.blocks import map_blocks
from pixelspark.queries import inputs as q
from pixelspark.queries.inputs import r
from pixelspark.queries.registry import query
from pixelspark.schema import IC
from pixelspark.sources.tables import fov_shape

# How a neighbour coordinate t beyond an image of length 8 is read.
_MODE = {"symmetric": "CASE WHEN {t} < 0 THEN -1 - {t} WHEN {t} > 7 THEN 15 - {t} ELSE {t} END",
         "reflect": "CASE WHEN {t} < 0 THEN -{t} WHEN {t} > 7 THEN 14 - {t} ELSE {t} END",
         "nearest": "least(greatest({t}, 0), 7)"}


def near(src: str, radius: int, mode: str) -> str:
    """Rows (image, channel, y, x, dy, dx, v): every pixel with its neighbours."""
    side = f"range(-{radius}, {radius + 1})"
    m = _MODE[mode]
    return f"""(SELECT c.image_id, c.channel, c.y, c.x, dy, dx, n.value AS v FROM
 (SELECT image_id, channel, y, x, dy, dx, {m.format(t='(y + dy)')} AS ny, {m.format(t='(x + dx)')} AS nx
  FROM {src}, {side} a(dy), {side} b(dx)) c
 JOIN {src} n ON n.image_id = c.image_id AND n.channel = c.channel AND n.y = c.ny AND n.x = c.nx)"""


_PX = "image_id, channel, y, x"


def _local(agg: str, src: str = "emb", radius: int = 1, mode: str = "symmetric", where: str = "true") -> str:
    return f"SELECT {_PX}, {agg} AS value FROM {near(src, radius, mode)} WHERE {where} GROUP BY {_PX}"


@query(q.sql(_local("median(v)", "multi"), "multi"))
def median_filter(s, d):
    return st.median_filter(q.multi(s, d))


def _weights(sigma: float) -> str:
    total = sum(math.exp(-0.5 * (i / sigma) ** 2) for i in range(-int(4 * sigma + .5), int(4 * sigma + .5) + 1))
    return f"exp(-0.5 * (dy * dy + dx * dx) / {sigma * sigma}) / {total * total!r}"


def weights(sigma: float) -> str:
    """Gaussian sum of the neighbours."""
    return f"sum(v * {_weights(sigma)})"


def local_sql(agg: str, src: str, radius: int, mode: str) -> str:
    """The neighbourhood aggregate as column ``v``."""
    return _local(agg, src, radius, mode).replace(" AS value FROM", " AS v FROM", 1)


@query(q.sql(_local(r(f"sum(v * {_weights(0.6)})"), "emb", 2, "nearest"), "emb"))
def gaussian_filter(s, d):
    return q.rounded(st.gaussian_filter(q.emb(s, d), 0.6))


@query(q.sql(f"SELECT * FROM ({_local(r('avg(v)'))}) JOIN (SELECT {_PX}, min(v) AS lowest, max(v) AS highest, "
             f"{r('stddev_pop(v)')} AS std FROM {near('emb', 1, 'symmetric')} GROUP BY {_PX}) USING ({_PX})", "emb"))
def local_map(s, d):
    px, out = q.emb(s, d), None
    for name, stat in (("value", "mean"), ("lowest", "min"), ("highest", "max"), ("std", "std")):
        one = st.local_map(px, stat, 3, out=name, size_of=q.sizes(s, d))
        out = one if out is None else out.join(one, [*IC, "y", "x"])
    return q.rounded(out)


@query(q.sql(_local("max(v)", where="dy = 0 OR dx = 0"), "emb"))
def local_map_footprint(s, d):
    return st.local_map(q.emb(s, d), "max", footprint=[[0, 1, 0], [1, 1, 1], [0, 1, 0]])


@query(q.sql(_local("max(v) - min(v)"), "emb"))
def local_map_function(s, d):
    return st.local_map(q.emb(s, d), lambda w: np.ptp(w, axis=-1))


@query(q.sql(f"SELECT image_id, max(value) AS top, {r('avg(value)')} AS mean FROM ({_local('median(v)', 'multi')}) "
             "GROUP BY image_id", "multi"))
def aggregate_local(s, d):
    return q.rounded(st.aggregate_local(q.multi(s, d), "median", {"top": "max", "mean": "mean"}))


@query(q.sql(f"SELECT image_id, channel, max(value) AS top, {r('avg(value)')} AS mean FROM ({_local('median(v)', 'multi')}) "
             "GROUP BY image_id, channel", "multi"))
def aggregate_local_axis(s, d):
    return q.rounded(st.aggregate_local(q.multi(s, d), "median", {"top": "max", "mean": "mean"}, by=IC))


@query(q.sql(f"SELECT image_id, channel, {r('avg(CASE WHEN sd > 0 THEN mu / sd END)')} AS local_mean_over_std FROM "
             f"(SELECT {_PX}, avg(v) AS mu, stddev_pop(v) AS sd FROM {near('emb', 1, 'symmetric')} GROUP BY {_PX}) "
             "GROUP BY image_id, channel", "emb"))
def local_mean_over_std(s, d):
    return q.rounded(st.local_mean_over_std(q.emb(s, d)))


@query(q.sql(_local("sum(v * ((1 - dy) * 3 + (1 - dx) + 1))"), "emb"))
def convolve(s, d):
    return st.convolve(q.emb(s, d), [[1, 2, 3], [4, 5, 6], [7, 8, 9]])


def _padded(width: int, mode: str) -> str:
    side = f"range(0, {8 + 2 * width})"
    m = _MODE[mode]
    return f"""SELECT c.image_id, c.channel, c.y::INT AS y, c.x::INT AS x, n.value FROM
 (SELECT DISTINCT image_id, channel, y, x, {m.format(t=f'(y - {width})')} AS ny, {m.format(t=f'(x - {width})')} AS nx
  FROM (SELECT DISTINCT image_id, channel FROM emb), {side} a(y), {side} b(x)) c
 JOIN emb n ON n.image_id = c.image_id AND n.channel = c.channel AND n.y = c.ny AND n.x = c.nx"""


@query(q.sql(_padded(2, "reflect"), "emb"))
def pad_reflect(s, d):
    px = q.emb(s, d)
    return st.pad(px, 2, fov_shape(px))


@query(q.sql(_padded(3, "symmetric"), "emb"))
def pad_symmetric(s, d):
    px = q.emb(s, d)
    return st.pad(px, 3, fov_shape(px), "symmetric")


@query(q.sql("""SELECT g.image_id, g.channel, g.y::INT AS y, g.x::INT AS x, coalesce(n.value, -5)::DOUBLE AS value FROM
 (SELECT * FROM (SELECT DISTINCT image_id, channel FROM emb), range(0, 10) a(y), range(0, 10) b(x)) g
 LEFT JOIN emb n ON n.image_id = g.image_id AND n.channel = g.channel AND n.y = g.y - 1 AND n.x = g.x - 1""", "emb"))
def pad_constant(s, d):
    px = q.emb(s, d)
    return st.pad(px, 1, fov_shape(px), "constant", -5.0)


@query(q.sql(_local("median(v)", "emb", 2, "symmetric"), "emb"))
def tile_with_halo(s, d):
    fp = np.ones((5, 5), bool)
    return map_blocks(q.emb(s, d), lambda a: K.LOCAL["median"](K.windows(a, fp, "symmetric")), ["value"],
                      halo=2, block=3)


@query(q.sql(f"SELECT image_id, channel, (y // 3)::INT AS y, (x // 3)::INT AS x, {r('avg(value)')} AS value FROM multi "
             "WHERE y < 6 AND x < 6 GROUP BY ALL", "multi"))
def downsample_mean(s, d):
    px = q.multi(s, d)
    return q.rounded(st.downsample_mean(px, 3, shape=fov_shape(px)))


@query(q.sql("""SELECT image_id, channel, ty::INT AS y, tx::INT AS x, value
 FROM emb, range(0, 12) a(ty), range(0, 20) b(tx) WHERE (ty * 8) // 12 = emb.y AND (tx * 8) // 20 = emb.x""", "emb"))
def upsample_nearest(s, d):
    return st.upsample_nearest(q.emb(s, d), (8, 8), (12, 20))


@query(q.sql("""SELECT g.image_id, g.channel, g.y::INT AS y, g.x::INT AS x, coalesce(n.value, 0)::DOUBLE AS value FROM
 (SELECT * FROM (SELECT DISTINCT image_id, channel FROM emb), range(0, 11) a(y), range(0, 5) b(x)) g
 LEFT JOIN emb n ON n.image_id = g.image_id AND n.channel = g.channel AND n.y = g.y - 1 AND n.x = g.x + 1""", "emb"))
def match_shape(s, d):
    return st.match_shape(q.emb(s, d), (8, 8), (11, 5))


@query(q.sql("""SELECT image_id, y, x, m AS label FROM (SELECT c.image_id, c.y, c.x, min(coalesce(n.label, 0))::INT AS m
 FROM (SELECT lab_b.*, dy, dx FROM lab_b, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS t(dy, dx)
 WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7) c
 LEFT JOIN lab_b n ON n.image_id = c.image_id AND n.y = c.y + c.dy AND n.x = c.x + c.dx
 GROUP BY c.image_id, c.y, c.x) WHERE m > 0""", "lab_b"))
def erode_labels(s, d):
    return st.erode_labels(q.lab_b(s, d), q.sizes(s, d), 1)


def _ball(radius: int, src: str = "emb", value: str = "value") -> str:
    side = f"range(-{radius}, {radius + 1})"
    return f"""(SELECT c.image_id, c.channel, c.y, c.x,
 min(n.{value} + {radius} - sqrt({radius * radius} - dy * dy - dx * dx)) AS value FROM {src} c, {side} a(dy), {side} b(dx)
 JOIN {src} n ON n.image_id = c.image_id AND n.channel = c.channel AND n.y = c.y + dy AND n.x = c.x + dx
 WHERE dy * dy + dx * dx <= {radius * radius} GROUP BY c.image_id, c.channel, c.y, c.x)"""


@query(q.sql(f"SELECT {_PX}, {r('value')} AS value FROM {_ball(3)}", "emb"))
def rolling_ball(s, d):
    return q.rounded(st.rolling_ball(q.emb(s, d), 3))


@query(q.sql(f"SELECT {_PX}, {r('65535 - value')} AS value FROM {_ball(2, '(SELECT image_id, channel, y, x, 65535 - value AS value FROM emb)')}", "emb"))
def rolling_ball_white(s, d):
    return q.rounded(st.rolling_ball(q.emb(s, d), 2, white_background=True))


@query(q.sql("SELECT 1", "emb").replace("\nSELECT 1", f",\nball AS {_ball(2)},\nsmooth AS (" + _local(
    f"sum(v * {_weights(0.5)})", "ball", 2, "symmetric") + f")\nSELECT {_PX}, {r('value')} AS value FROM smooth"))
def smooth_background(s, d):
    return q.rounded(st.rolling_ball(q.emb(s, d), 2, smooth=0.5))


@query(q.sql("SELECT 1", "multi").replace("\nSELECT 1", f""",\nmed AS ({_local('median(v)', 'multi', 1, 'nearest')}),
 lim AS (SELECT image_id, channel, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM med GROUP BY ALL)
SELECT image_id, channel, {r('avg(value) FILTER (value < lo)')} AS low_mean, {r('avg(value) FILTER (value > hi)')} AS high_mean
 FROM med JOIN lim USING (image_id, channel) GROUP BY image_id, channel"""))
def low_high_tail_channel(s, d):
    return q.rounded(st.low_high_tail_channel(q.multi(s, d), 10, 90, smooth=3))
