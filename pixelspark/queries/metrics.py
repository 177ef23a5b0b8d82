"""Image and object statistics, quality metrics and flags."""

from pyspark.sql import functions as F

from pixelspark.functions import pixel as fp
from pixelspark.operators import measure as m
from pixelspark.operators import qc
from pixelspark.operators.ranking import average_rank as rank_rows
from pixelspark.queries import inputs as q
from pixelspark.queries.inputs import r
from pixelspark.queries.registry import query
from pixelspark.schema import IC

_SKEW = "CASE WHEN var_pop(value) > 0 THEN avg(pow(value - mu, 3)) / pow(var_pop(value), 1.5) END"
_MOS = "CASE WHEN stddev_pop(value) > 0 THEN avg(value) / stddev_pop(value) END"


def _centred(src, keys):
    return f"(SELECT *, avg(value) OVER (PARTITION BY {keys}) AS mu FROM {src})"


@query(q.sql(f"SELECT image_id, channel, {r(_MOS)} AS mean_over_std FROM multi GROUP BY ALL", "multi"))
def mean_over_std(s, d):
    return q.rounded(m.image_stat(q.multi(s, d), {"mean_over_std": "mean_over_std"}, IC))


# Every 7th value is infinite, every 11th not a number; one image in five is constant.
_ODD = """(SELECT image_id, channel, CASE WHEN image_id % 5 = 0 THEN 3.0::DOUBLE WHEN (8 * y + x) % 11 = 0 THEN NULL
 WHEN (8 * y + x) % 7 = 0 THEN 500.0::DOUBLE ELSE value END AS value FROM emb)"""


@query(q.sql(f"SELECT image_id, channel, coalesce({r(_MOS)}, -1.0::DOUBLE) AS mean_over_std FROM {_ODD} GROUP BY ALL", "emb"))
def mean_over_std_replaced(s, d):
    """Infinite values replaced, others that are no numbers left out, a value for constant images."""
    at = F.col("y") * 8 + F.col("x")
    odd = (F.when(F.col("image_id") % 5 == 0, 3.0).when(at % 11 == 0, float("nan")).when(at % 7 == 0, float("-inf")).otherwise(F.col("value")))
    return q.rounded(m.mean_over_std(q.emb(s, d).withColumn("value", odd), IC, 500.0, -1.0))


@query(q.sql(f"SELECT image_id, channel, {r(_MOS)} AS mean_over_std, {r('quantile_cont(value, 0.5)')} AS median, "
             "max(value) AS max FROM bag GROUP BY ALL", "bag"))
def image_stat(s, d):
    return q.rounded(m.image_stat(q.bag(s, d), {"mean_over_std": "mean_over_std", "median": "median", "max": "max"}, IC))


@query(q.sql(f"SELECT image_id, {r('avg(value)')} AS mean, sum(value) AS total FROM multi JOIN lab_b USING (image_id, y, x) "
             "GROUP BY image_id", "multi", "lab_b"))
def masked_stat(s, d):
    return q.rounded(m.masked_stat(q.multi(s, d), q.lab_b(s, d), {"mean": "mean", "total": "sum"}))


@query(q.sql("""SELECT image_id, max(y) + 1 AS y_px, max(x) + 1 AS x_px, max(my) + 1 AS y_mask, max(mx) + 1 AS x_mask,
 min(label) AS lowest FROM emb LEFT JOIN (SELECT image_id, max(y) AS my, max(x) AS mx, min(label) AS label FROM lab_c
 GROUP BY image_id) USING (image_id) GROUP BY image_id
 HAVING min(label) < 0 OR max(y) IS DISTINCT FROM max(my) OR max(x) IS DISTINCT FROM max(mx)""", "emb", "lab_c"))
def mask_violations(s, d):
    return m.mask_violations(q.emb(s, d), q.lab_c(s, d))


@query(q.sql(f"SELECT image_id, y, {r('avg(value)')} AS mean, {r('stddev_pop(value)')} AS std FROM multi GROUP BY ALL", "multi"))
def axis_stat(s, d):
    return q.rounded(m.axis_stat(q.multi(s, d), "y", {"mean": "mean", "std": "std"}))


@query(q.sql(f"""SELECT image_id, channel, {r('avg(value)')} AS mean, max(value) AS max
 FROM multi JOIN lab_i USING (image_id, y, x) GROUP BY ALL""", "multi", "lab_i"))
def broadcast_mask_stat(s, d):
    return q.rounded(m.axis_stat(q.multi(s, d), "channel", {"mean": "mean", "max": "max"}, q.lab_i(s, d)))


@query(q.sql(f"""SELECT image_id, max(v) AS max, {r('avg(v)')} AS mean FROM
 (SELECT image_id, channel, max(value) AS v FROM multi GROUP BY ALL) GROUP BY image_id""", "multi"))
def agg_axis_stat(s, d):
    return q.rounded(m.agg_axis_stat(q.multi(s, d), "channel", "max", {"max": "max", "mean": "mean"}))


@query(q.sql(f"SELECT image_id, channel, {r(_SKEW)} AS skew FROM {_centred('bag', 'image_id, channel')} GROUP BY image_id, channel", "bag"))
def intensity_skew(s, d):
    return q.rounded(m.image_stat(q.bag(s, d), {"skew": "skew"}, IC))


_SCALED = """(SELECT image_id, channel, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE value END AS value FROM
 (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM multi WINDOW w AS (PARTITION BY image_id, channel)))"""


@query(q.sql(f"SELECT image_id, channel, {r(_SKEW)} AS skew FROM {_centred(_SCALED, 'image_id, channel')} GROUP BY image_id, channel", "multi"))
def normalized_skew(s, d):
    return q.rounded(m.normalized_skew(q.multi(s, d)))


@query(q.sql(f"""SELECT image_id, channel, y, x, {r('CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE value END')} AS value
 FROM (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM multi WINDOW w AS (PARTITION BY image_id, channel))""", "multi"))
def minmax_normalize(s, d):
    return q.rounded(m.minmax_normalize(q.multi(s, d)))


_BOUNDS = ("(SELECT image_id, channel, quantile_cont(value, {a}) AS lo, quantile_cont(value, {b}) AS hi "
           "FROM {src} GROUP BY image_id, channel)")


@query(q.sql(f"""SELECT image_id, channel, y, x,
 CASE WHEN hi > lo THEN floor(round((greatest(least(value, hi), lo) - lo) / (hi - lo) * 7, 9))::INT ELSE 0 END AS level
 FROM multi JOIN {_BOUNDS.format(a=0.01, b=0.99, src='multi')} USING (image_id, channel)""", "multi"))
def quantize(s, d):
    return m.quantize(q.multi(s, d)).drop("value")


def _fraction(src, a, b):
    return f"""SELECT image_id, channel, {r('avg((value <= lo)::INT)')} AS bottom_fraction,
 {r('avg((value >= hi)::INT)')} AS top_fraction, {r('any_value(lo)')} AS low_threshold, {r('any_value(hi)')} AS high_threshold,
 count(*) AS n_valid FROM {src} JOIN {_BOUNDS.format(a=a, b=b, src=src)} USING (image_id, channel) GROUP BY image_id, channel"""


@query(q.sql(_fraction("bag", 0.05, 0.95), "bag"))
def extreme_fraction(s, d):
    return q.rounded(m.extreme_fraction(q.bag(s, d), 5, 95))


@query(q.sql(_fraction("multi", 0.01, 0.99), "multi"))
def extreme_fraction_any_values(s, d):
    return q.rounded(m.extreme_fraction(q.multi(s, d), 1, 99))


_MASK0 = "(SELECT image_id, y, x, CASE WHEN value > 0 THEN 0 ELSE -1 END AS label FROM emb)"


def _sign_mask(s, d):
    return q.emb(s, d).select("image_id", "y", "x", F.when(F.col("value") > 0, 0).otherwise(-1).alias("label"))


@query(q.sql(f"""SELECT image_id, 'mean' AS stat, {r('avg(value)')} AS value FROM sel GROUP BY image_id
 UNION ALL SELECT image_id, 'median', {r('quantile_cont(value, 0.5)')} FROM sel GROUP BY image_id
 UNION ALL SELECT image_id, 'max', max(value) FROM sel GROUP BY image_id
 UNION ALL SELECT image_id, 'min', min(value) FROM sel GROUP BY image_id
 UNION ALL SELECT image_id, 'mode', value FROM (SELECT image_id, value, row_number() OVER (PARTITION BY image_id
 ORDER BY count(*) DESC, value) AS k FROM sel GROUP BY image_id, value) WHERE k = 1""".replace(
    "FROM sel", f"FROM (SELECT multi.image_id, multi.value FROM multi JOIN {_MASK0} k USING (image_id, y, x) WHERE label >= 0)"),
    "multi", "emb"))
def pixel_stat(s, d):
    parts = [m.pixel_stat(q.multi(s, d), _sign_mask(s, d), st, "value")
             .select("image_id", F.lit(st).alias("stat"), "value") for st in ("mean", "median", "max", "min", "mode")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return q.rounded(out)


def _tail(agg, a, b):
    return f"""SELECT image_id, channel, {agg.format(c='value < lo')} AS low, {agg.format(c='value > hi')} AS high
 FROM bag JOIN {_BOUNDS.format(a=a, b=b, src='bag')} USING (image_id, channel) GROUP BY image_id, channel"""


@query(q.sql(f"SELECT image_id, channel, {r('low')} AS low_mean, {r('high')} AS high_mean FROM ("
             + _tail("avg(value) FILTER ({c})", 0.1, 0.9) + ")", "bag"))
def low_high_tail(s, d):
    return q.rounded(m.low_high_tail(q.bag(s, d), 10, 90, "mean"))


@query(q.sql(f"SELECT image_id, channel, {r('low')} AS low_median, {r('high')} AS high_median FROM ("
             + _tail("quantile_cont(value, 0.5) FILTER ({c})", 0.2, 0.7) + ")", "bag"))
def low_high_tail_median(s, d):
    return q.rounded(m.low_high_tail(q.bag(s, d), 20, 70, "median"))


@query(q.sql(f"""SELECT image_id, channel, any_value(lo) AS threshold, max(value) FILTER (value < lo) AS max
 FROM bag JOIN {_BOUNDS.format(a=0.25, b=0.5, src='bag')} USING (image_id, channel) GROUP BY image_id, channel""", "bag"))
def tail_stat(s, d):
    return m.tail_stat(q.bag(s, d), 25, "max")


_OBJ = "(SELECT multi.image_id, label, channel, value FROM multi JOIN lab_b USING (image_id, y, x))"
_ILC = "image_id, label, channel"


@query(q.sql(f"""SELECT {_ILC}, {r('avg(value)')} AS intensity_mean, min(value) AS intensity_min, max(value) AS intensity_max,
 {r('stddev_pop(value)')} AS intensity_std, sum(value) AS intensity_sum, {r(_SKEW)} AS intensity_skew,
 {r('quantile_cont(value, 0.5)')} AS intensity_median, {r('quantile_cont(value, 0.25)')} AS intensity_q25,
 {r('quantile_cont(value, 0.75)')} AS intensity_q75, {r('quantile_cont(abs(value - med), 0.5)')} AS intensity_mad FROM
 (SELECT *, avg(value) OVER w AS mu, quantile_cont(value, 0.5) OVER w AS med FROM {_OBJ} WINDOW w AS (PARTITION BY {_ILC}))
 GROUP BY {_ILC}""", "multi", "lab_b"))
def object_intensity(s, d):
    px = m.label_pixels(q.multi(s, d), q.lab_b(s, d))
    return q.rounded(m.object_intensity(px))


@query(q.sql(f"SELECT {_ILC}, {r('quantile_cont(value, 0.9)')} AS q90 FROM {_OBJ} GROUP BY {_ILC}", "multi", "lab_b"))
def quantile_intensity(s, d):
    px = m.label_pixels(q.multi(s, d), q.lab_b(s, d))
    return q.rounded(m.quantile_intensity(px, 0.9, "q90"))


@query(q.sql(f"SELECT {_ILC}, value FROM {_OBJ}", "multi", "lab_b"))
def label_pixels(s, d):
    return m.label_pixels(q.multi(s, d), q.lab_b(s, d)).select("image_id", "label", "channel", "value")


@query(q.sql("""SELECT image_id, label, coalesce(v, -1)::DOUBLE AS spread FROM
 (SELECT DISTINCT image_id, l::INT AS label FROM emb, (VALUES (1), (2), (9)) AS t(l)) LEFT JOIN
 (SELECT image_id, label, max(value) - min(value) AS v FROM emb JOIN lab_b USING (image_id, y, x) GROUP BY ALL)
 USING (image_id, label)""", "emb", "lab_b"))
def label_measure(s, d):
    px = m.label_pixels(q.emb(s, d), q.lab_b(s, d))
    index = q.emb(s, d).select("image_id").distinct().select(
        "image_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(9))).alias("label"))
    return m.label_measure(px, lambda v: F.max(v) - F.min(v), "spread", index, -1.0)


@query(q.sql("""SELECT image_id, coalesce(label, 0)::INT AS label, value, count(*) AS n
 FROM emb LEFT JOIN lab_b USING (image_id, y, x) GROUP BY ALL""", "emb", "lab_b"))
def values_per_label(s, d):
    px = q.emb(s, d).join(q.lab_b(s, d), ["image_id", "y", "x"], "left").fillna(0, ["label"])
    return m.values_per_label(px)


@query(q.sql("SELECT image_id, channel, y, x, CASE WHEN value > 100 THEN 1 ELSE 0 END AS label FROM multi", "multi"))
def threshold_mask(s, d):
    return m.threshold_image(q.multi(s, d), 100.0)


@query(q.sql("SELECT image_id, y, x, avg(value) AS value FROM multi WHERE channel IN (0, 2) GROUP BY ALL", "multi"))
def merge_channels(s, d):
    return m.merge_channels(q.multi(s, d), [0, 2])


@query(q.sql("SELECT image_id, channel, y, x, CAST(least(greatest(value, 0), 255) AS SMALLINT) AS value FROM multi", "multi"))
def clip_cast(s, d):
    return q.multi(s, d).withColumn("value", fp.clip_cast(F.col("value"), 0, 255, "smallint"))


# --- quality ------------------------------------------------------------------------------


def _metric(s, d):
    return m.image_stat(q.bag(s, d), {"metric": "mean_over_std", "mean": "mean"}, IC)


_METRIC = f"(SELECT image_id, channel, {_MOS} AS metric, avg(value) AS mean FROM bag GROUP BY image_id, channel)"
_LOW, _HIGH = [26.0, 25.8, 25.9], [24.5, 24.8, None]


@query(q.sql(f"""SELECT fov.*, {', '.join(f'{r(f"max(CASE WHEN channel = {c} THEN mean END)")} AS "mean-{c}"' for c in range(3))}
 FROM fov LEFT JOIN {_METRIC} USING (image_id) GROUP BY ALL""", "fov", "bag"))
def qc_wide(s, d):
    return q.rounded(qc.qc_wide(q.fov(s, d), _metric(s, d), ["mean"], [0, 1, 2]), "mean-0", "mean-1", "mean-2")


@query(q.sql(f"""SELECT image_id, CASE WHEN bool_or(coalesce(mean <= hp, false) OR coalesce(mean >= lp, false)) THEN 1 ELSE 0 END
 AS flag FROM {_METRIC} JOIN (VALUES (0, 26.0, 24.5), (1, 25.8, 24.8), (2, 25.9, NULL)) AS t(channel, lp, hp)
 USING (channel) GROUP BY image_id""", "bag"))
def flag_rows(s, d):
    images = q.bag(s, d).select("image_id").distinct()
    wide = qc.qc_wide(images, _metric(s, d), ["mean"], [0, 1, 2])
    return qc.flag_rows(wide, ["mean-0", "mean-1", "mean-2"], _LOW, _HIGH).select("image_id", "flag")


@query(q.sql(f"""SELECT image_id, bool_or(coalesce(mean <= hp, false) OR coalesce(mean >= lp, false))::INT
 AS flag FROM {_METRIC} LEFT JOIN (SELECT channel, avg(mean) - 0.5 AS hp, avg(mean) + 0.5 AS lp FROM {_METRIC} GROUP BY channel)
 USING (channel) GROUP BY image_id""", "bag"))
def flag_long(s, d):
    metric = _metric(s, d)
    bounds = metric.groupBy("channel").agg((F.avg("mean") - 0.5).alias("high_pass"), (F.avg("mean") + 0.5).alias("low_pass"))
    long = qc.metrics_long(metric, ["mean"])
    return qc.flag_long(long, bounds.withColumn("metric", F.lit("mean")))


@query(q.sql(f"SELECT image_id, channel, {r('metric')} AS metric, {r('mean')} AS mean FROM {_METRIC} WHERE NOT (mean >= 25.6)", "bag"))
def unflagged(s, d):
    flagged = qc.flag_rows(_metric(s, d), ["mean"], [25.6], [None])
    return q.rounded(qc.unflagged(flagged).drop("flag"))


@query(q.sql(f"SELECT image_id, channel, {r('metric')} AS metric, {r('mean')} AS mean FROM {_METRIC} WHERE mean > 25.0 AND mean < 26.0", "bag"))
def qc_band(s, d):
    return q.rounded(qc.qc_band(_metric(s, d), "mean", 25.5, 0.5))


@query(q.sql(f"""SELECT channel, arg_min(image_id, (mean, image_id)) AS lowest_image, {r('min(mean)')} AS lowest,
 arg_min(image_id, (-mean, image_id)) AS highest_image, {r('max(mean)')} AS highest FROM {_METRIC} GROUP BY channel""", "bag"))
def qc_extremes(s, d):
    return q.rounded(qc.qc_extremes(_metric(s, d), "mean"))


@query(q.sql(f"""SELECT channel, experiment, count(mean) AS n, {r('min(mean)')} AS min, {r('max(mean)')} AS max,
 {r('avg(mean)')} AS mean, {r('stddev_samp(mean)')} AS sd, {r('quantile_cont(mean, 0.25)')} AS q1,
 {r('quantile_cont(mean, 0.5)')} AS median, {r('quantile_cont(mean, 0.75)')} AS q3
 FROM {_METRIC} JOIN fov USING (image_id) GROUP BY channel, experiment""", "bag", "fov"))
def qc_distribution(s, d):
    metric = _metric(s, d).join(q.fov(s, d).select("image_id", "experiment"), "image_id")
    return q.rounded(qc.qc_distribution(metric, "mean", ["channel", "experiment"]))




@query(q.sql(f"""SELECT image_id, channel, {r('sqrt(var_pop(v))')} AS laplacian_sd, var_pop(v) < 200000 AS blurry FROM
 (SELECT c.image_id, c.channel, u.value + b.value + l.value + t.value - 4 * c.value AS v FROM emb c
 JOIN emb u ON u.image_id = c.image_id AND u.x = c.x AND u.y = CASE WHEN c.y = 0 THEN 1 ELSE c.y - 1 END
 JOIN emb b ON b.image_id = c.image_id AND b.x = c.x AND b.y = CASE WHEN c.y = 7 THEN 6 ELSE c.y + 1 END
 JOIN emb l ON l.image_id = c.image_id AND l.y = c.y AND l.x = CASE WHEN c.x = 0 THEN 1 ELSE c.x - 1 END
 JOIN emb t ON t.image_id = c.image_id AND t.y = c.y AND t.x = CASE WHEN c.x = 7 THEN 6 ELSE c.x + 1 END)
 GROUP BY ALL""", "emb"))
def laplacian_variance(s, d):
    out = qc.laplacian_variance(q.emb(s, d), 200000.0)
    return q.rounded(out.withColumn("laplacian_sd", F.sqrt("laplacian_var")).drop("laplacian_var"))


_DFT = """rowft AS (SELECT image_id, channel, y, k AS kx, sum(value * cos(2 * pi() * k * x / 8)) AS re,
 sum(-value * sin(2 * pi() * k * x / 8)) AS im FROM multi, range(8) AS t(k) GROUP BY image_id, channel, y, k),
 power AS (SELECT image_id, channel, kx, k AS ky,
 pow(sum(re * cos(2 * pi() * k * y / 8) + im * sin(2 * pi() * k * y / 8)), 2) +
 pow(sum(im * cos(2 * pi() * k * y / 8) - re * sin(2 * pi() * k * y / 8)), 2) AS power
 FROM rowft, range(8) AS t(k) GROUP BY image_id, channel, kx, k),
 bins AS (SELECT image_id, channel, floor(sqrt(pow(least(kx, 8 - kx), 2) + pow(least(ky, 8 - ky), 2)))::INT AS radius,
 avg(power) AS power FROM power GROUP BY ALL)"""


@query(q.sql("SELECT 1", "multi").replace("\nSELECT 1", f",\n{_DFT}\nSELECT image_id, channel, radius, {r('power', 2)} AS power "
                                                         "FROM bins WHERE radius > 0 AND power > 0"))
def radial_power(s, d):
    return q.rounded(qc.radial_power(q.multi(s, d)), digits=2)


@query(q.sql("SELECT 1", "multi").replace("\nSELECT 1", f""",\n{_DFT}\nSELECT image_id, channel,
 {r('regr_slope(ln(power), ln(radius))')} AS slope, {r('regr_intercept(ln(power), ln(radius))')} AS intercept,
 count(*)::INT AS n_radii FROM bins WHERE radius > 0 AND power > 0 GROUP BY image_id, channel"""))
def plls(s, d):
    return q.rounded(qc.plls(q.multi(s, d)))


@query(q.sql("""SELECT image_id, channel, y, x, value, (rank() OVER w + (count(*) OVER (PARTITION BY image_id, channel, value) - 1) / 2.0)::DOUBLE
 AS rank FROM multi WINDOW w AS (PARTITION BY image_id, channel ORDER BY value)""", "multi"))
def average_rank(s, d):
    return rank_rows(q.multi(s, d), IC)
