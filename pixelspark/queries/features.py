"""Texture, tensor and correlation features of objects."""

import math

from pyspark.sql import functions as F

from pixelspark.operators import correlation as co
from pixelspark.operators import measure as m
from pixelspark.operators import tensors as tn
from pixelspark.operators import texture as tex
from pixelspark.queries import inputs as q
from pixelspark.queries.inputs import r
from pixelspark.queries.registry import query

_IC = "image_id, channel"

# Labels eroded by one pixel, positions outside the image ignored.
ERODED = """kept AS (SELECT image_id, y, x, m AS label FROM (SELECT c.image_id, c.y, c.x, min(coalesce(n.label, 0))::INT AS m
 FROM (SELECT lab_b.*, dy, dx FROM lab_b, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS t(dy, dx)
 WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7) c
 LEFT JOIN lab_b n ON n.image_id = c.image_id AND n.y = c.y + c.dy AND n.x = c.x + c.dx
 GROUP BY c.image_id, c.y, c.x) WHERE m > 0)"""


# --- co-occurrence ------------------------------------------------------------------------

q._cte("levels", f"""SELECT image_id, channel, y, x,
 CASE WHEN hi > lo THEN floor(round((greatest(least(value, hi), lo) - lo) / (hi - lo) * 7, 9))::INT ELSE 0 END AS level
 FROM multi JOIN (SELECT {_IC}, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM multi GROUP BY {_IC})
 USING ({_IC})""", "multi")


def levels(s, d):
    return m.quantize(q.multi(s, d)).select("image_id", "channel", "y", "x", "level")


_OFFSETS = {(0, 0): (0, 1), (0, 1): (1, 1), (0, 2): (1, 0), (1, 0): (0, 2), (1, 1): (1, 1), (1, 2): (2, 0)}
_ANGLES = [0.0, math.pi / 4, math.pi / 2]


def _pairs(dr: int, dc: int) -> str:
    return (f"SELECT a.image_id, a.channel, a.y, a.x, a.level, b.level AS partner FROM levels a JOIN levels b "
            f"ON b.image_id = a.image_id AND b.channel = a.channel AND b.y = a.y + {dr} AND b.x = a.x + {dc}")


@query(q.sql(_pairs(-1, 2), "levels"))
def offset_pairs(s, d):
    return tex.offset_pairs(levels(s, d), -1, 2)


_GLCM = "(" + " UNION ALL ".join(
    f"SELECT {_IC}, {d}::INT AS d, {a}::INT AS a, i, j, count(*) AS n FROM (SELECT {_IC}, level AS i, partner AS j FROM ({_pairs(*o)}) "
    f"UNION ALL SELECT {_IC}, partner, level FROM ({_pairs(*o)})) GROUP BY ALL" for (d, a), o in _OFFSETS.items()) + ")"


@query(q.sql(f"SELECT *, round(n / sum(n) OVER (PARTITION BY {_IC}, d, a), 6) AS p FROM {_GLCM}", "levels"))
def glcm(s, d):
    return q.rounded(tex.glcm(levels(s, d), [1, 2], _ANGLES), digits=6)


_PROPS = f"""(SELECT *, n / sum(n) OVER w AS p, sum(i * n) OVER w / sum(n) OVER w AS mi, sum(j * n) OVER w / sum(n) OVER w AS mj
 FROM {_GLCM} WINDOW w AS (PARTITION BY {_IC}, d, a))"""
_VAR = "sum(p * (i - mi) * (i - mi))"


@query(q.sql(f"""SELECT {_IC}, d, a, {r('sum(p * (i - j) * (i - j))', 6)} AS contrast, {r('sum(p * abs(i - j))', 6)} AS dissimilarity,
 {r('sum(p / (1 + (i - j) * (i - j)))', 6)} AS homogeneity, {r('ln(sum(p * p))', 6)} AS log_asm, {r('sqrt(sum(p * p))', 6)} AS energy,
 {r(f'atan(CASE WHEN {_VAR} < 1e-15 THEN 1 ELSE sum(p * (i - mi) * (j - mj)) / sqrt({_VAR}) / sqrt(sum(p * (j - mj) * (j - mj))) END)', 6)} AS atan_correlation,
 {r('any_value(mi)', 6)} AS mean, {r(f'ln(1 + {_VAR})', 6)} AS log_variance, {r(f'sqrt({_VAR})', 6)} AS std, {r('-sum(p * ln(p))', 6)} AS entropy
 FROM {_PROPS} GROUP BY {_IC}, d, a""", "levels"))
def glcm_props(s, d):
    """Fractions of small powers of two are compared through a logarithm or arc tangent, which
    never meets a decimal tie."""
    out = tex.glcm_props(tex.glcm(levels(s, d), [1, 2], _ANGLES, normed=False))
    return q.rounded(out.withColumns({"log_asm": F.log("ASM"), "log_variance": F.log(F.col("variance") + 1),
                                      "atan_correlation": F.atan("correlation")})
                     .drop("ASM", "variance", "correlation"), digits=6)


def _when(expr: str, d: int, a: int) -> str:
    return r(f"max({expr}) FILTER (d = {d} AND a = {a})")


@query(q.sql(f"SELECT {_IC}, " + ", ".join(
    f'{_when("con", di, a)} AS contrast_{di}_{a}, {_when("ent", di, a)} AS entropy_{di}_{a}' for di, a in _OFFSETS)
    + f" FROM (SELECT {_IC}, d, a, sum(p * (i - j) * (i - j)) AS con, -sum(p * ln(p)) AS ent FROM {_PROPS} GROUP BY {_IC}, d, a) GROUP BY {_IC}",
    "levels"))
def haralick_image(s, d):
    return q.rounded(tex.haralick_image(levels(s, d), ["contrast", "entropy"], [1, 2], _ANGLES))


# Objects of the quadrant mask fill their box, so the crop has no outside pixels; window 3.
_CROP = """crop AS (SELECT image_id, label, channel, y, x, floor(round((greatest(least(value, hi), lo) - lo) / (hi - lo) * 7, 9))::INT AS level
 FROM (SELECT *, quantile_cont(value, 0.01) OVER w AS lo, quantile_cont(value, 0.99) OVER w AS hi FROM multi
 JOIN lab_a USING (image_id, y, x) WINDOW w AS (PARTITION BY image_id, label, channel))),
 win AS (SELECT c.image_id, c.label, c.channel, c.y, c.x, c.dy, c.dx, n.level FROM
 (SELECT image_id, label, channel, y, x, dy, dx,
  CASE WHEN y % 4 + dy < 0 THEN y - dy WHEN y % 4 + dy > 3 THEN y - dy ELSE y + dy END AS ny,
  CASE WHEN x % 4 + dx < 0 THEN x - dx WHEN x % 4 + dx > 3 THEN x - dx ELSE x + dx END AS nx
  FROM crop, range(-1, 2) a(dy), range(-1, 2) b(dx)) c
 JOIN crop n ON n.image_id = c.image_id AND n.label = c.label AND n.channel = c.channel AND n.y = c.ny AND n.x = c.nx),
 pair AS (SELECT a.image_id, a.label, a.channel, a.y, a.x, a.level AS i, b.level AS j FROM win a JOIN win b
 ON b.image_id = a.image_id AND b.label = a.label AND b.channel = a.channel AND b.y = a.y AND b.x = a.x
 AND b.dy = a.dy AND b.dx = a.dx + 1),
 both_ways AS (SELECT * FROM pair UNION ALL SELECT image_id, label, channel, y, x, j, i FROM pair),
 cells AS (SELECT image_id, label, channel, y, x, i, j, count(*) / 12 AS p FROM both_ways GROUP BY ALL),
 texture AS (SELECT image_id, label, channel, y, x, sum(p * (i - j) * (i - j)) AS contrast, -sum(p * ln(p)) AS entropy
 FROM cells GROUP BY ALL)"""
_TEXTURE = "SELECT image_id, label, channel, y, x, {c} AS contrast, {e} AS entropy FROM texture"


@query(q.sql("SELECT 1", "multi", "lab_a").replace(
    "\nSELECT 1", f",\n{_CROP}\n{_TEXTURE.format(c=r('contrast'), e=r('entropy'))}"))
def haralick_map(s, d):
    return q.rounded(tex.haralick_map(q.multi(s, d), q.lab_a(s, d), ["contrast", "entropy"], window=3))


_STATS = (("intensity_mean", "avg"), ("intensity_max", "max"), ("intensity_min", "min"), ("intensity_std", "stddev_pop"))


@query(q.sql("SELECT 1", "multi", "lab_a").replace("\nSELECT 1", f",\n{_CROP}\n" + " UNION ALL ".join(
    f"SELECT image_id, label, channel, '{f}' AS feature, '{n}' AS stat, {r(f'{fn}({f})')} AS value FROM texture GROUP BY ALL"
    for f in ("contrast", "entropy") for n, fn in _STATS)))
def haralick_objects(s, d):
    return q.rounded(tex.haralick_objects(q.multi(s, d), q.lab_a(s, d), ["contrast", "entropy"], window=3, erosion=0))


def _mirror(t: str, n: str) -> str:
    """Coordinate t reflected into [0, n) without repeating the border; 0 for n = 1."""
    m = f"(2 * ({n} - 1))"
    u = f"((({t}) % {m}) + {m}) % {m}"
    return f"CASE WHEN {n} = 1 THEN 0 WHEN {u} < {n} THEN {u} ELSE {m} - {u} END"


# Crop to the object box with zeros outside, levels per crop, an 11 x 11 window with mirrored borders.
_RAGGED = f"""box AS (SELECT image_id, label, min(y) AS y0, min(x) AS x0, max(y) - min(y) + 1 AS h, max(x) - min(x) + 1 AS w
  FROM lab_b GROUP BY ALL),
 crop AS (SELECT b.image_id, b.label, c.channel, h, w, u.y, v.x, l.label IS NOT NULL AS inside,
  CASE WHEN l.label IS NULL THEN 0 ELSE m.value END AS value FROM box b, (SELECT unnest([0, 1, 2])::INT AS channel) c,
  range(0, 8) u(y), range(0, 8) v(x)
  LEFT JOIN lab_b l ON l.image_id = b.image_id AND l.label = b.label AND l.y = u.y + y0 AND l.x = v.x + x0
  LEFT JOIN multi m ON m.image_id = b.image_id AND m.channel = c.channel AND m.y = u.y + y0 AND m.x = v.x + x0
  WHERE u.y < h AND v.x < w),
 lev AS (SELECT *, CASE WHEN hi > lo THEN floor(round((greatest(least(value, hi), lo) - lo) / (hi - lo) * 7, 9)) ELSE 0 END AS level FROM
  (SELECT *, quantile_cont(value, 0.01) OVER k AS lo, quantile_cont(value, 0.99) OVER k AS hi FROM crop
   WINDOW k AS (PARTITION BY image_id, label, channel))),
 step AS (SELECT a.image_id, a.label, a.channel, a.y, a.x, pow(n.level - t.level, 2) AS dd FROM
  (SELECT image_id, label, channel, y, x, {_mirror('y + dy', 'h')} AS ny, {_mirror('x + dx', 'w')} AS nx, {_mirror('x + dx + 1', 'w')} AS tx
   FROM lev, range(-5, 6) p(dy), range(-5, 5) q(dx) WHERE inside) a
  JOIN lev n ON n.image_id = a.image_id AND n.label = a.label AND n.channel = a.channel AND n.y = a.ny AND n.x = a.nx
  JOIN lev t ON t.image_id = a.image_id AND t.label = a.label AND t.channel = a.channel AND t.y = a.ny AND t.x = a.tx),
 ragged AS (SELECT s.image_id, s.channel, s.y + y0 AS y, s.x + x0 AS x, avg(dd) AS contrast FROM step s JOIN box USING (image_id, label)
  GROUP BY ALL)"""


@query(q.sql_with(f"{ERODED}, {_RAGGED}", " UNION ALL ".join(
    f"SELECT image_id, label, channel, 'contrast' AS feature, '{n}' AS stat, {r(f'{fn}(contrast)')} AS value "
    "FROM ragged JOIN kept USING (image_id, y, x) GROUP BY image_id, label, channel" for n, fn in _STATS), "multi", "lab_b"))
def haralick_objects_ragged(s, d):
    """Ragged objects, default window, eroded by one pixel."""
    return q.rounded(tex.haralick_objects(q.multi(s, d), q.lab_b(s, d), ["contrast"], erosion=1, size=q.sizes(s, d)))


# --- tensors ------------------------------------------------------------------------------


def _gauss(sigma: float, axis: str) -> str:
    n = int(4 * sigma + .5)
    total = sum(math.exp(-0.5 * (i / sigma) ** 2) for i in range(-n, n + 1))
    return f"sum(b.v * exp(-0.5 * k * k / {sigma * sigma}::DOUBLE) / {total!r}::DOUBLE)"


def _smooth(name: str, src: str, sigma: float, axis: str, nearest: bool) -> str:
    """One-dimensional Gaussian; beyond the border the nearest pixel, or nothing (zero)."""
    n = int(4 * sigma + .5)
    other = "x" if axis == "y" else "y"
    pos = f"least(greatest(a.{axis} + k, 0), 7)" if nearest else f"a.{axis} + k"
    return f"""{name} AS (SELECT a.image_id, a.channel, a.y, a.x, {_gauss(sigma, axis)} AS v FROM {src} a, range(-{n}, {n + 1}) t(k)
 JOIN {src} b ON b.image_id = a.image_id AND b.channel = a.channel AND b.{other} = a.{other} AND b.{axis} = {pos}
 GROUP BY a.image_id, a.channel, a.y, a.x)"""


def _slope(name: str, src: str, axis: str) -> str:
    """Central difference, one-sided at the border."""
    w = f"(PARTITION BY image_id, channel, {'x' if axis == 'y' else 'y'} ORDER BY {axis})"
    return f"""{name} AS (SELECT image_id, channel, y, x, CASE {axis} WHEN 0 THEN lead(v) OVER {w} - v WHEN 7 THEN v - lag(v) OVER {w}
 ELSE (lead(v) OVER {w} - lag(v) OVER {w}) / 2 END AS v FROM {src})"""


_PX = "image_id, channel, y, x"
_SOURCE = "source AS (SELECT image_id, channel, y, x, value AS v FROM multi)"
_EIGENVALUES = ("(a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS eigv_1_{k}, "
                "(a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS eigv_2_{k}")


def _hessian_parts(sigma: float, k: int = 0) -> str:
    """Relation ``eig{k}`` with both eigenvalues of the Hessian at one sigma."""
    return ", ".join([
        _smooth(f"s{k}", "source", sigma, "y", True), _smooth(f"t{k}", f"s{k}", sigma, "x", True),
        _slope(f"gy{k}", f"t{k}", "y"), _slope(f"gx{k}", f"t{k}", "x"), _slope(f"hyy{k}", f"gy{k}", "y"),
        _slope(f"hyx{k}", f"gy{k}", "x"), _slope(f"hxx{k}", f"gx{k}", "x"),
        f"eig{k} AS (SELECT {_PX}, {_EIGENVALUES.format(k=k)} FROM (SELECT {_PX}, a.v AS a, b.v AS b, c.v AS c "
        f"FROM hyy{k} a JOIN hyx{k} b USING ({_PX}) JOIN hxx{k} c USING ({_PX})))"])


_HESSIAN = f"{_SOURCE}, {_hessian_parts(1.0)}, eig AS (SELECT * FROM eig0)"


@query(q.sql("SELECT 1", "multi").replace(
    "\nSELECT 1", f",\n{_HESSIAN}\nSELECT {_PX}, {r('eigv_1_0')} AS eigv_1_0, {r('eigv_2_0')} AS eigv_2_0 FROM eig"))
def hessian_map(s, d):
    return q.rounded(tn.hessian_map(q.multi(s, d), tn.sigma_grid()))


def _long(features: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT image_id, label, channel, '{name}' AS feature, 0 AS sigma, '{n}' AS stat, {r(f'{fn}({c})')} AS value "
        f"FROM eig JOIN lab_b USING (image_id, y, x) GROUP BY image_id, label, channel"
        for c, name in features.items() for n, fn in _STATS)


_H = {"eigv_1_0": "hessian_eigv_1", "eigv_2_0": "hessian_eigv_2"}


@query(q.sql("SELECT 1", "multi", "lab_b").replace("\nSELECT 1", f",\n{_HESSIAN}\n{_long(_H)}"))
def hessian_features(s, d):
    return q.rounded(tn.hessian_features(q.multi(s, d), q.lab_b(s, d), tn.sigma_grid(), erosion=0))


_SOBEL = """deriv AS (SELECT c.image_id, c.channel, c.y, c.x,
 sum(dy * (2 - abs(dx)) * coalesce(n.v, 0)) AS gy, sum(dx * (2 - abs(dy)) * coalesce(n.v, 0)) AS gx
 FROM (SELECT * FROM source, range(-1, 2) t(dy), range(-1, 2) u(dx)) c
 LEFT JOIN source n ON n.image_id = c.image_id AND n.channel = c.channel AND n.y = c.y + dy AND n.x = c.x + dx
 GROUP BY c.image_id, c.channel, c.y, c.x)"""
_TENSOR_PARTS = ", ".join([
    _SOBEL,
    *[part for n, e in (("a", "gy * gy"), ("b", "gy * gx"), ("c", "gx * gx")) for part in (
        f"p{n} AS (SELECT {_PX}, {e} AS v FROM deriv)", _smooth(f"t{n}", f"p{n}", 1.0, "y", False),
        _smooth(f"m{n}", f"t{n}", 1.0, "x", False))],
    f"eig AS (SELECT *, eigv_1_0 / (eigv_2_0 + 1e-6) AS anisotropy_0 FROM (SELECT {_PX}, {_EIGENVALUES.format(k=0)} FROM "
    f"(SELECT {_PX}, a.v AS a, b.v AS b, c.v AS c FROM ma a JOIN mb b USING ({_PX}) JOIN mc c USING ({_PX}))))"])
_TENSOR = f"{_SOURCE}, {_TENSOR_PARTS}"


@query(q.sql("SELECT 1", "multi").replace("\nSELECT 1", f",\n{_TENSOR}\nSELECT {_PX}, {r('eigv_1_0', 2)} AS eigv_1_0, "
                                                         f"{r('eigv_2_0', 2)} AS eigv_2_0, {r('anisotropy_0')} AS anisotropy_0 FROM eig"))
def structure_tensor_map(s, d):
    out = tn.structure_tensor_map(q.multi(s, d), tn.sigma_grid())
    return q.rounded(q.rounded(out, "eigv_1_0", "eigv_2_0", digits=2), "anisotropy_0")


_T = {"eigv_1_0": "str_tens_eigv_1", "eigv_2_0": "str_tens_eigv_2", "anisotropy_0": "anisotropy"}


@query(q.sql("SELECT 1", "multi", "lab_b").replace("\nSELECT 1", f",\n{_TENSOR}\n{_long(_T)}".replace(", 4) + 0.0", ", 2) + 0.0")))
def structure_tensor_features(s, d):
    return q.rounded(tn.structure_tensor_features(q.multi(s, d), q.lab_b(s, d), tn.sigma_grid(), erosion=0), digits=2)


@query(q.sql("SELECT 1", "multi").replace(
    "\nSELECT 1", f",\n{_TENSOR}\nSELECT image_id, channel, {r('avg(anisotropy_0)')} AS mean_anisotropy FROM eig GROUP BY ALL"))
def image_mean_anisotropy(s, d):
    return q.rounded(tn.image_mean_anisotropy(q.multi(s, d)))


def wide_eigen(prefix: str, scales: int, stats: tuple[str, ...]) -> str:
    """Wide columns of eigenvalue statistics; the sigma index appears only with several scales."""
    fn = dict(_STATS)
    return ", ".join(
        f"{r(f'{fn[n]}(eigv_{e}_{k}) FILTER (channel = {c})')} AS \"{prefix}_eigv_{e}_{n}{f'_{k}' if scales > 1 else ''}-{c}\""
        for e in (1, 2) for k in range(scales) for c in range(3) for n in stats)


@query(q.sql_with(", ".join([ERODED, _SOURCE, *[_hessian_parts(v, k) for k, v in enumerate((0.5, 1.0, 1.5))]]),
                  f"""SELECT image_id, label, {wide_eigen('hessian', 3, ('intensity_mean', 'intensity_std'))}
 FROM kept JOIN eig0 USING (image_id, y, x) JOIN eig1 USING ({_PX}) JOIN eig2 USING ({_PX}) GROUP BY image_id, label""", "multi", "lab_b"))
def hessian_features_scales(s, d):
    """Three sigmas, eroded labels, one row per object."""
    long = tn.hessian_features(q.multi(s, d), q.lab_b(s, d), tn.sigma_grid(0.5, 1.5, 3), 1, q.sizes(s, d))
    return q.rounded(tn.wide_features(long, [("hessian_eigv_1", ""), ("hessian_eigv_2", "")], ["intensity_mean", "intensity_std"],
                                      3, [0, 1, 2]))


_GEO = "SELECT image_id, label, count(*) AS {a}, " + r("avg(y)") + " AS {b} FROM {t} GROUP BY image_id, label"


def _geometry(labels):
    return labels.groupBy("image_id", "label").agg(F.count(F.lit(1)).alias("area"), F.avg("y").alias("row"))


@query(q.sql(_GEO.format(a='"mask_area-1"', b='"mask_row-1"', t="lab_b"), "lab_b"))
def rename_features(s, d):
    return q.rounded(tn.rename_features(_geometry(q.lab_b(s, d)), ("image_id", "label"), "mask", "1", suffix_sep="-"))


def _merged(kind: str) -> str:
    return (f"SELECT * FROM ({_GEO.format(a='a_area', b='a_row', t='lab_b')}) {kind} JOIN "
            f"({_GEO.format(a='b_area', b='b_row', t='lab_i')}) USING (image_id, label)")


def _two_tables(s, d):
    return [tn.rename_features(_geometry(t), ("image_id", "label"), n)
            for n, t in (("a", q.lab_b(s, d)), ("b", q.lab_i(s, d)))]


@query(q.sql(_merged("FULL"), "lab_b", "lab_i"))
def align_by_label(s, d):
    return q.rounded(tn.merge_features(*_two_tables(s, d), how="full_outer"))


@query(q.sql(_merged("RIGHT"), "lab_b", "lab_i"))
def merge_features(s, d):
    return q.rounded(tn.merge_features(*_two_tables(s, d), how="right"))


# --- correlation --------------------------------------------------------------------------

_G = "image_id, label, channel_1, channel_2"
_CORR = """(SELECT l.image_id, l.label, a.channel AS channel_1, b.channel AS channel_2, a.value AS v1, b.value AS v2, l.y, l.x
 FROM lab l JOIN multi a USING (image_id, y, x) JOIN multi b USING (image_id, y, x) WHERE a.channel < b.channel)"""
# Label 0 is stored here: the correlation covers the background as well.
q._cte("lab", "SELECT e.image_id, e.y, e.x, coalesce(b.label, 0)::INT AS label FROM emb e LEFT JOIN lab_b b USING (image_id, y, x)",
       "emb", "lab_b")


def _dense_labels(s, d):
    return q.emb(s, d).select("image_id", "y", "x").join(q.lab_b(s, d), ["image_id", "y", "x"], "left").fillna(0, ["label"])


def _pearson(src: str, keys: str, a: str = "v1", b: str = "v2") -> str:
    return (f"SELECT {keys}, CASE WHEN max({a}) > min({a}) AND max({b}) > min({b}) THEN covar_pop({a}, {b}) / "
            f"(stddev_pop({a}) * stddev_pop({b})) END AS coeff, count(*) AS n FROM {src} GROUP BY {keys}")


def _ranked(src: str, keys: str) -> str:
    def mid(c: str) -> str:
        return (f"rank() OVER (PARTITION BY {keys} ORDER BY {c}) + (count(*) OVER (PARTITION BY {keys}, {c}) - 1) / 2.0::DOUBLE")
    return f"(SELECT *, {mid('v1')} AS r1, {mid('v2')} AS r2 FROM {src})"


def _final(text: str) -> str:
    return f"SELECT {_G}, {r('coeff')} AS coeff, n::BIGINT AS n FROM ({text})"


@query(q.sql(_final(_pearson(_CORR, _G)), "lab", "multi"))
def correlation_pearson(s, d):
    return q.rounded(co.channel_correlation(q.multi(s, d), _dense_labels(s, d), [0, 1, 2], "pearson"))


@query(q.sql(_final(_pearson(_ranked(_CORR, _G), _G, "r1", "r2")), "lab", "multi"))
def correlation_spearman(s, d):
    return q.rounded(co.channel_correlation(q.multi(s, d), _dense_labels(s, d), [0, 1, 2]))


@query(q.sql("SELECT 1", "lab", "multi").replace("\nSELECT 1", f""",\npx AS {_CORR},
 pairs AS (SELECT {', '.join('a.' + k.strip() for k in _G.split(','))}, sum(sign(a.v1 - b.v1) * sign(a.v2 - b.v2)) AS s,
 count_if(a.v1 <> b.v1) AS u1, count_if(a.v2 <> b.v2) AS u2 FROM px a JOIN px b USING ({_G}) WHERE (a.y, a.x) < (b.y, b.x) GROUP BY ALL),
 sizes AS (SELECT {_G}, count(*) AS n FROM px GROUP BY {_G})
SELECT {_G}, {r('CASE WHEN u1 > 0 AND u2 > 0 THEN s / (sqrt(u1) * sqrt(u2)) END')} AS coeff, n::BIGINT AS n FROM sizes LEFT JOIN pairs USING ({_G})"""))
def correlation_kendall(s, d):
    return q.rounded(co.channel_correlation(q.multi(s, d), _dense_labels(s, d), [0, 1, 2], "kendall"))


@query(q.sql("SELECT image_id, label, " + ", ".join(
    f"{r(f'max(coeff) FILTER (channel_1 = {i} AND channel_2 = {j})')} AS pearson_coeff_{i}_{j}" for i, j in ((0, 1), (0, 2), (1, 2)))
    + f" FROM ({_pearson(_CORR, _G)}) GROUP BY image_id, label", "lab", "multi"))
def correlation_wide(s, d):
    long = co.channel_correlation(q.multi(s, d), _dense_labels(s, d), [0, 1, 2], "pearson")
    return q.rounded(co.wide_correlation(long, [0, 1, 2], "pearson"))


_SHUFFLED = """(SELECT round, image_id, label, slot, max(value) FILTER (channel = 0) AS c0, max(value) FILTER (channel = 1) AS c1,
 max(value) FILTER (channel = 2) AS c2 FROM (SELECT round, image_id, label, channel, value, row_number() OVER (PARTITION BY
 round, image_id, label, channel ORDER BY md5(image_id || '|' || y || '|' || x || '|' || channel || '|' || round || '|42'), y, x) AS slot
 FROM multi JOIN lab_b USING (image_id, y, x), (SELECT unnest(range(N))::INT AS round)) GROUP BY ALL)"""


@query(q.sql(f"SELECT * FROM {_SHUFFLED.replace('range(N)', 'range(2)')}", "multi", "lab_b"))
def permute_within_label(s, d):
    return co.permute_within_label(q.multi(s, d), q.lab_b(s, d), [0, 1, 2], 2)


_DRAW = "('0x' || md5(image_id || '|' || label || '|' || slot || '|' || channel || '|0|42')[:12])::BIGINT"


@query(q.sql(f"""SELECT 0::INT AS round, image_id, label, slot, max(value) FILTER (channel = 0) AS c0,
 max(value) FILTER (channel = 1) AS c1, max(value) FILTER (channel = 2) AS c2 FROM
 (SELECT o.image_id, o.label, o.channel, o.slot, p.value FROM (SELECT *, {_DRAW} % total + 1 AS src FROM ranked) o
 JOIN ranked p ON p.image_id = o.image_id AND p.label = o.label AND p.channel = o.channel AND p.slot = o.src) GROUP BY ALL""".replace(
    "ranked", """(SELECT *, row_number() OVER (PARTITION BY image_id, label, channel ORDER BY y, x) AS slot,
 count(*) OVER (PARTITION BY image_id, label, channel) AS total FROM multi JOIN lab_b USING (image_id, y, x))"""), "multi", "lab_b"))
def permute_with_replacement(s, d):
    return co.permute_within_label(q.multi(s, d), q.lab_b(s, d), [0, 1, 2], replace=True)


_ROUNDS = "(SELECT round, image_id, label, 0::INT AS channel_1, 1::INT AS channel_2, c0 AS v1, c1 AS v2 FROM shuffled UNION ALL " \
          "SELECT round, image_id, label, 0, 2, c0, c2 FROM shuffled UNION ALL SELECT round, image_id, label, 1, 2, c1, c2 FROM shuffled)"


@query(q.sql("SELECT 1", "multi", "lab_b").replace("\nSELECT 1", f""",\nshuffled AS {_SHUFFLED.replace('range(N)', 'range(3)')},
 spread AS (SELECT {_G}, avg(coeff) AS permuted_mean, stddev_samp(coeff) AS permuted_std FROM
  ({_pearson(_ranked(_ROUNDS, 'round, ' + _G), 'round, ' + _G, 'r1', 'r2')}) GROUP BY {_G})
SELECT {_G}, {r('coeff')} AS coeff, n::BIGINT AS n, {r('permuted_mean')} AS permuted_mean, {r('permuted_std')} AS permuted_std
 FROM ({_pearson(_ranked(_CORR.replace('FROM lab l', 'FROM lab_b l'), _G), _G, 'r1', 'r2')}) LEFT JOIN spread USING ({_G})"""))
def permuted_correlation(s, d):
    return q.rounded(co.permuted_correlation(q.multi(s, d), q.lab_b(s, d), [0, 1, 2], 3))


@query(q.sql("SELECT 1", "multi", "lab_b").replace("\nSELECT 1", f""",\nshuffled AS {_SHUFFLED.replace('range(N)', 'range(2)')}
SELECT round, {_G}, {r('coeff')} AS coeff, n::BIGINT AS n FROM ({_pearson(_ranked(_ROUNDS, 'round, ' + _G), 'round, ' + _G, 'r1', 'r2')})"""))
def permutation_rounds(s, d):
    """Each round by itself."""
    return q.rounded(co.permutation_rounds(q.multi(s, d), q.lab_b(s, d), [0, 1, 2], 2))
