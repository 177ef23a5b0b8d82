"""Background model and pixel correction."""

from pyspark.sql import functions as F

from pixelspark.operators import background as bg
from pixelspark.queries import inputs as q
from pixelspark.queries.inputs import r
from pixelspark.queries.registry import query

q._cte("bright", "SELECT multi.image_id, 'c' || (label % 4) AS condition, channel, y, x, value + 3000 + 100 * channel AS value "
                 "FROM multi JOIN embeddings ON image_id = vec_id", "multi")


def bright(s, d):
    """Positive pixels with an experimental condition per image."""
    cond = q.table(s, d, "embeddings").select(F.col("vec_id").alias("image_id"),
                                              F.concat(F.lit("c"), F.col("label") % 4).alias("condition"))
    return (q.multi(s, d).join(cond, "image_id")
            .withColumn("value", F.col("value") + 3000 + F.col("channel") * 100)
            .select("image_id", "condition", "channel", "y", "x", "value"))


_CYX = "channel, y, x"
_STACK = f"(SELECT {_CYX}, median(value) AS value FROM bright GROUP BY {_CYX})"
_BY_COND = f"(SELECT condition, {_CYX}, median(value) AS value FROM bright GROUP BY condition, {_CYX})"


def _stack(s, d, keys=()):
    return bg.background_stack(bright(s, d), "median", keys)


@query(q.sql(f"SELECT m.*, mean FROM {_STACK} m JOIN (SELECT {_CYX}, {r('avg(value)')} AS mean FROM bright GROUP BY {_CYX}) "
             f"USING ({_CYX})", "bright"))
def background_stack(s, d):
    mean = bg.background_stack(bright(s, d), "mean").withColumnRenamed("value", "mean")
    return q.rounded(_stack(s, d).join(mean, ["channel", "y", "x"]))


@query(q.sql(f"SELECT * FROM {_BY_COND}", "bright"))
def background_by_condition(s, d):
    return _stack(s, d, ["condition"])


@query(q.sql(f"""SELECT 'all' AS strategy, '' AS strategy_key, * FROM {_STACK}
 UNION ALL SELECT 'condition', condition, {_CYX}, value FROM {_BY_COND}
 UNION ALL SELECT 'position', CAST(image_id % 3 AS VARCHAR), {_CYX}, median(value) FROM bright GROUP BY image_id % 3, {_CYX}""", "bright"))
def background_all_strategies(s, d):
    px = bright(s, d).withColumn("position", (F.col("image_id") % 3).cast("string"))
    return bg.background_all_strategies(px, ["condition", "position"])


def _log(surface):
    """Logarithm of a surface: rounding never meets a decimal tie of the halves in the data."""
    return q.rounded(surface.withColumn("log_value", F.log("value")).drop("value"), digits=8)


# Orthogonal polynomials on 8 equally spaced points, degrees 0 to 3, and their squared norms.
_P = [[1] * 8, [-7, -5, -3, -1, 1, 3, 5, 7], [7, 1, -3, -5, -5, -3, 1, 7], [-7, 5, 7, 3, -3, -7, -5, 7]]


def _surface(src: str, keys: str, kx: int, ky: int, order: int | None = None) -> str:
    """Least-squares surface by projection on the orthogonal products."""
    def at(k: int, c: str) -> str:
        return f"({_P[k]})[{c} + 1]"
    terms = []
    for i in range(kx + 1):
        for j in range(ky + 1):
            if order is None or i + j <= order:
                norm = sum(v * v for v in _P[i]) * sum(v * v for v in _P[j])
                terms.append(f"sum(value * {at(i, 'x')} * {at(j, 'y')}) OVER w / {norm} * {at(i, 'x')} * {at(j, 'y')}")
    return f"SELECT {keys}, y, x, {' + '.join(terms)} AS value FROM {src} WINDOW w AS (PARTITION BY {keys})"


@query(q.sql(f"SELECT channel, y, x, {r('ln(value)', 8)} AS log_value FROM ({_surface(_STACK, 'channel', 3, 3)})", "bright"))
def polyfit_surface(s, d):
    return _log(bg.polyfit_surface(_stack(s, d)))


@query(q.sql(f"SELECT channel, y, x, {r('ln(value)', 8)} AS log_value FROM ({_surface(_STACK, 'channel', 2, 2, 2)})", "bright"))
def polyfit_surface_order(s, d):
    return _log(bg.polyfit_surface(_stack(s, d), 2, 2, 2))


@query(q.sql(" UNION ALL ".join(
    f"SELECT channel, y, x, {r('ln(value)', 8)} AS log_value FROM ({_surface(f'(SELECT * FROM {_STACK} WHERE channel = {c})', 'channel', *k)})"
    for c, k in enumerate(((1, 1), (3, 2), (2, 3, 3)))), "bright"))
def polyfit_surface_channel(s, d):
    return _log(bg.polyfit_surface(_stack(s, d), {0: 1, 1: 3, 2: 2}, {0: 1, 1: 2, 2: 3}, {0: None, 1: None, 2: 3}))



@query(q.sql(f"""SELECT channel, 8 AS height, 8 AS width, i::INT AS i, j::INT AS j, {r('c', 7)} AS coef FROM (
 SELECT channel, unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j,
 unnest([avg(value), sum(value * v) / sum(v * v), sum(value * u) / sum(u * u), sum(value * u * v) / sum(u * u * v * v)]) AS c
 FROM (SELECT *, x * 2.0::DOUBLE / 7 - 1 AS u, y * 2.0::DOUBLE / 7 - 1 AS v FROM {_STACK}) GROUP BY channel)""", "bright"))
def polyfit_coefficients(s, d):
    return q.rounded(bg.polyfit(_stack(s, d), 1, 1), digits=7)


@query(q.sql(f"SELECT condition, channel, y, x, {r('ln(value)', 8)} AS log_value FROM ({_surface(_BY_COND, 'condition, channel', 2, 2)})", "bright"))
def fit_background(s, d):
    return _log(bg.fit_background(_stack(s, d, ["condition"]), "polyfit", ["condition", "channel"], kx=2, ky=2))


@query(q.sql(f"""SELECT c.condition, c.channel, c.y, c.x, {r('min(n.value + 3 - sqrt(9 - dy * dy - dx * dx))')} AS value
 FROM {_BY_COND} c, range(-3, 4) a(dy), range(-3, 4) b(dx) JOIN {_BY_COND} n ON n.condition = c.condition
 AND n.channel = c.channel AND n.y = c.y + dy AND n.x = c.x + dx WHERE dy * dy + dx * dx <= 9 GROUP BY ALL""", "bright"))
def fit_background_rolling_ball(s, d):
    return q.rounded(bg.fit_background(_stack(s, d, ["condition"]), "simple", ["condition", "channel"], radius=3))


def _corrected(back: str, expr: str, on: str) -> str:
    return f"SELECT p.image_id, p.condition, p.channel, p.y, p.x, {r(expr)} AS value FROM bright p JOIN ({back}) b USING ({on})"


_MAXED = "SELECT *, max(value - 400) OVER (PARTITION BY {k}) AS top FROM {src}"


@query(q.sql(_corrected(_MAXED.format(k="channel", src=_STACK),
                        "(p.value - 400) / ((b.value - 400) / (top + 1e-8) + 1e-8)", _CYX), "bright"))
def correct_division(s, d):
    return q.rounded(bg.correct_pixels(bright(s, d), _stack(s, d), "division", 400, rescale="max", offset_background=True))


@query(q.sql(_corrected(f"SELECT * FROM {_STACK}", "least(greatest(p.value - b.value - 10, 0), 500)", _CYX), "bright"))
def correct_subtraction(s, d):
    return q.rounded(bg.correct_pixels(bright(s, d), _stack(s, d), "subtraction", 10, clip=True, clip_max=500))


@query(q.sql(_corrected("SELECT *, min(value) OVER (PARTITION BY channel) AS lo, max(value) OVER (PARTITION BY channel) AS hi "
                        f"FROM {_STACK}", "p.value - (b.value - lo) / (hi - lo + 1e-8)", _CYX), "bright"))
def correct_minmax(s, d):
    return q.rounded(bg.correct_pixels(bright(s, d), _stack(s, d), rescale="minmax"))


@query(q.sql(_corrected(f"SELECT *, max(value) OVER () AS top FROM {_STACK}",
                        "p.value / (b.value / (top + 1e-8) + 1e-8)", _CYX), "bright"))
def correct_whole_image(s, d):
    return q.rounded(bg.correct_pixels(bright(s, d), _stack(s, d), "division", rescale="max", per_channel=False))


@query(q.sql(_corrected(_MAXED.format(k="condition, channel", src=_BY_COND),
                        "(p.value - 400) / ((b.value - 400) / (top + 1e-8) + 1e-8)", f"condition, {_CYX}"), "bright"))
def correct_by_condition(s, d):
    return q.rounded(bg.correct_pixels(bright(s, d), _stack(s, d, ["condition"]), "division", 400, rescale="max",
                                       offset_background=True, condition=["condition"]))


@query(q.sql(f"""SELECT * FROM (SELECT p.image_id, p.channel, count_if(b.value IS NULL)::BIGINT AS no_background,
 count_if(p.value IS NULL)::BIGINT AS no_value, 0::BIGINT AS flat_background, 0::BIGINT AS offset_above_background,
 count_if(p.value <= 2500)::BIGINT AS offset_above_pixel FROM bright p
 LEFT JOIN (SELECT * FROM {_STACK} WHERE NOT (channel = 2 AND y = 7)) b USING ({_CYX})
 GROUP BY p.image_id, p.channel) WHERE no_background + no_value + offset_above_pixel > 0""", "bright"))
def correction_violations(s, d):
    partial = _stack(s, d).where("not (channel = 2 and y = 7)")
    return bg.correction_violations(bright(s, d), partial, "division", 2500.0)


@query(q.sql(f"""SELECT p.image_id, p.channel, p.y, p.x, p.value AS before, {r('p.value - b.value')} AS after,
 unnest(CASE WHEN y = x THEN ['main'] WHEN x = 7 - y THEN ['anti'] END) AS diagonal
 FROM bright p JOIN {_STACK} b USING ({_CYX}) WHERE y = x OR x = 7 - y""", "bright"))
def diagonal_profile(s, d):
    before = bright(s, d)
    after = bg.correct_pixels(before, _stack(s, d))
    return q.rounded(bg.diagonal_profile(before, after, 8))
