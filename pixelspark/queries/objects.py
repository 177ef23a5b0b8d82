"""Label overlap, relabelling, clean-up and object shape."""

import math

from pyspark.sql import functions as F

from pixelspark.operators import labels as lb
from pixelspark.operators import prep, shape
from pixelspark.operators import stencil as st
from pixelspark.queries import inputs as q
from pixelspark.queries.inputs import r
from pixelspark.queries.registry import query
from pixelspark.sources.tables import fov_shape

_OVERLAP = """(SELECT a.image_id, a.label AS label_1, coalesce(b.label, 0)::INT AS label_2, count(*) AS overlap
 FROM lab_b a LEFT JOIN lab_c b USING (image_id, y, x) GROUP BY ALL)"""


@query(q.sql(f"SELECT * FROM {_OVERLAP}", "lab_b", "lab_c"))
def label_overlap(s, d):
    return lb.label_overlap(q.lab_b(s, d), q.lab_c(s, d))


@query(q.sql("""SELECT image_id, coalesce(a.label, 0)::INT AS label_1, coalesce(b.label, 0)::INT AS label_2, count(*) AS overlap
 FROM lab_b a FULL JOIN lab_c b USING (image_id, y, x) GROUP BY ALL""", "lab_b", "lab_c"))
def label_overlap_background(s, d):
    return lb.label_overlap(q.lab_b(s, d), q.lab_c(s, d), include_background=True)


_PLANES = "(SELECT 0::INT AS plane, * FROM lab_a UNION ALL SELECT 1, * FROM lab_b UNION ALL SELECT 2, * FROM lab_c)"


def _stack(s, d):
    return prep.union_frames(*[df.withColumn("plane", F.lit(i)) for i, df in
                               enumerate((q.lab_a(s, d), q.lab_b(s, d), q.lab_c(s, d)))])


def _geo(side: int) -> str:
    return (f"(SELECT image_id, plane AS plane_{side}, label AS label_{side}, count(*) AS area_{side}, "
            f"{r('avg(y)')} AS \"centroid_{side}-0\", {r('avg(x)')} AS \"centroid_{side}-1\" FROM {_PLANES} GROUP BY ALL)")


_STACK_OVERLAP = f"""(SELECT a.image_id, a.plane AS plane_1, j.plane AS plane_2, a.label AS label_1,
 coalesce(b.label, 0)::INT AS label_2, count(*) AS overlap FROM {_PLANES} a
 JOIN (SELECT unnest([1, 2])::INT AS plane) j ON a.plane < j.plane
 LEFT JOIN {_PLANES} b ON b.image_id = a.image_id AND b.y = a.y AND b.x = a.x AND b.plane = j.plane GROUP BY ALL)"""


@query(q.sql(f"""SELECT * FROM {_STACK_OVERLAP} LEFT JOIN {_geo(1)} USING (image_id, plane_1, label_1)
 LEFT JOIN {_geo(2)} USING (image_id, plane_2, label_2)""", "lab_a", "lab_b", "lab_c"))
def label_stack_overlap(s, d):
    return q.rounded(lb.label_stack_overlap(_stack(s, d), [0, 1, 2]))


@query(q.sql(" UNION ALL ".join(
    "SELECT image_id, " + ", ".join(
        f"{('label_1' if p == i else 'label_2') if p in (i, j) else 'NULL::INT'} AS label_{p}" for p in range(3)) + ", "
    + ", ".join(f"{'overlap' if (a, b) == (i, j) else 'NULL::BIGINT'} AS overlap_{a}_{b}" for a, b in ((0, 1), (0, 2), (1, 2)))
    + f" FROM {_STACK_OVERLAP} WHERE plane_1 = {i} AND plane_2 = {j}" for i, j in ((0, 1), (0, 2), (1, 2))),
    "lab_a", "lab_b", "lab_c"))
def stack_overlap_wide(s, d):
    return lb.stack_overlap_wide(lb.label_stack_overlap(_stack(s, d), [0, 1, 2]), [0, 1, 2])


@query(q.sql(f"""SELECT image_id, label_b, area_b, area_overlap_b, {r('cy')} AS "centroid-0_b", {r('cx')} AS "centroid-1_b",
 {r('area_overlap_b / area_b')} AS area_fraction_b, label_c FROM (SELECT b.image_id, b.label AS label_b, count(*) AS area_b,
 count(c.label) AS area_overlap_b, avg(b.y) AS cy, avg(b.x) AS cx FROM lab_b b LEFT JOIN lab_c c USING (image_id, y, x) GROUP BY ALL)
 LEFT JOIN (SELECT image_id, min(label) AS label_c FROM lab_c GROUP BY image_id) USING (image_id)
 WHERE area_overlap_b / area_b > 0.7""", "lab_b", "lab_c"))
def secondary_objects(s, d):
    return q.rounded(lb.secondary_objects(q.lab_c(s, d), q.lab_b(s, d), 0.7, name="b", primary_name="c"))


_MAPPING = f"""(SELECT image_id, label, n_containers, container, CASE WHEN n_containers = 0 THEN 'outside'
 WHEN min(CASE WHEN n_containers > 0 THEN label END) OVER (PARTITION BY image_id, container) <> label THEN 'taken'
 WHEN n_containers > 1 THEN 'several' ELSE 'single' END AS status FROM
 (SELECT image_id, label_1 AS label, count_if(label_2 > 0)::BIGINT AS n_containers,
  arg_min(label_2, (-overlap, label_2)) FILTER (label_2 > 0) AS container FROM {_OVERLAP} GROUP BY ALL))"""


@query(q.sql(f"SELECT * FROM {_MAPPING}", "lab_b", "lab_c"))
def match_mapping(s, d):
    return lb.match_mapping(q.lab_c(s, d), q.lab_b(s, d))


@query(q.sql(f"SELECT * FROM {_MAPPING} WHERE status <> 'single'", "lab_b", "lab_c"))
def match_violations(s, d):
    return lb.match_violations(q.lab_c(s, d), q.lab_b(s, d))


@query(q.sql(f"""SELECT image_id, y, x, container AS label FROM lab_b JOIN {_MAPPING} USING (image_id, label)
 WHERE status IN ('single', 'several')""", "lab_b", "lab_c"))
def match_labels(s, d):
    return lb.match_labels(q.lab_c(s, d), q.lab_b(s, d))


@query(q.sql("SELECT * FROM lab_i WHERE label <> 6", "lab_i"))
def exclude_edge_labels(s, d):
    return lb.exclude_edge_labels(q.lab_i(s, d), fov_shape(q.emb(s, d)))


@query(q.sql("""SELECT DISTINCT image_id, label FROM lab_b WHERE y IN (0, 7) OR x IN (0, 7)""", "lab_b"))
def edge_labels(s, d):
    return lb.edge_labels(q.lab_b(s, d), fov_shape(q.emb(s, d)))


@query(q.sql("""SELECT lab_b.* FROM lab_b JOIN (SELECT image_id, label FROM lab_b GROUP BY ALL HAVING count(*) BETWEEN 7 AND 9)
 USING (image_id, label)""", "lab_b"))
def filter_area(s, d):
    return lb.filter_area(q.lab_b(s, d), 7, 9)


@query(q.sql("""SELECT 'cell' AS kind, a.* FROM lab_b a SEMI JOIN (SELECT * FROM lab_b JOIN lab_i i USING (image_id, y, x)) p
 ON p.image_id = a.image_id AND p.label = a.label
 UNION ALL SELECT 'nucleus', a.* FROM lab_i a SEMI JOIN (SELECT * FROM lab_i JOIN lab_b b USING (image_id, y, x)) p
 ON p.image_id = a.image_id AND p.label = a.label""", "lab_b", "lab_i"))
def drop_unpaired(s, d):
    cells, nuclei = lb.drop_unpaired(q.lab_b(s, d), q.lab_i(s, d))
    return cells.withColumn("kind", F.lit("cell")).unionByName(nuclei.withColumn("kind", F.lit("nucleus")))


@query(q.sql("SELECT image_id, y, x, b.label FROM lab_i JOIN lab_b b USING (image_id, y, x)", "lab_b", "lab_i"))
def confine_contained(s, d):
    return lb.confine_contained(q.lab_b(s, d), q.lab_i(s, d))


@query(q.sql("SELECT * FROM emb WHERE value NOT IN (0, 100)", "emb"))
def drop_saturated(s, d):
    return lb.drop_saturated(q.emb(s, d), 0, 100)


@query(q.sql("SELECT * FROM lab_b a ANTI JOIN lab_i i USING (image_id, y, x)", "lab_b", "lab_i"))
def subtract_mask(s, d):
    return lb.subtract_mask(q.lab_b(s, d), q.lab_i(s, d))


@query(q.sql("""SELECT image_id, channel, median(value) AS "offset" FROM multi ANTI JOIN lab_b USING (image_id, y, x) GROUP BY ALL""",
             "multi", "lab_b"))
def background_offset(s, d):
    return lb.background_offset(q.multi(s, d), q.lab_b(s, d))


@query(q.sql("SELECT image_id, count(DISTINCT label) AS n_labels FROM lab_b GROUP BY image_id", "lab_b"))
def distinct_labels(s, d):
    return lb.distinct_labels(q.lab_b(s, d))


# Labels eroded by one pixel, positions outside the image ignored.
_KEPT = """kept AS (SELECT image_id, y, x, m AS label FROM (SELECT c.image_id, c.y, c.x, min(coalesce(n.label, 0))::INT AS m
 FROM (SELECT lab_b.*, dy, dx FROM lab_b, (VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) AS t(dy, dx)
 WHERE y + dy BETWEEN 0 AND 7 AND x + dx BETWEEN 0 AND 7) c
 LEFT JOIN lab_b n ON n.image_id = c.image_id AND n.y = c.y + c.dy AND n.x = c.x + c.dx
 GROUP BY c.image_id, c.y, c.x) WHERE m > 0)"""


def _eroded(s, d):
    return st.erode_labels(q.lab_b(s, d), q.sizes(s, d), 1)


@query(q.sql_with(_KEPT, """SELECT image_id, count(DISTINCT b.label)::BIGINT AS n_before, count(DISTINCT a.label)::BIGINT AS n_after
 FROM lab_b b LEFT JOIN (SELECT DISTINCT image_id, label FROM kept) a USING (image_id, label) GROUP BY image_id""", "lab_b"))
def object_loss(s, d):
    return lb.object_loss(q.lab_b(s, d), _eroded(s, d))


@query(q.sql_with(_KEPT, "SELECT DISTINCT b.image_id, b.label FROM lab_b b ANTI JOIN kept a USING (image_id, label)", "lab_b"))
def lost_labels(s, d):
    return lb.lost_labels(q.lab_b(s, d), _eroded(s, d))


@query(q.sql(f"""SELECT image_id, label, count(*) AS area, {r('avg(y)')} AS "centroid-0", {r('avg(x)')} AS "centroid-1"
 FROM lab_b GROUP BY ALL""", "lab_b"))
def order_columns(s, d):
    out = lb.label_geometry(q.lab_b(s, d))
    return q.rounded(prep.order_columns(out.select("centroid-0", "centroid-1", "area", "label", "image_id")))


# --- shape --------------------------------------------------------------------------------
# Each part: relations to put in front, and the final select, for the label relation ``lab``.

_ROOT = "sqrt(pow((a - c) / 2, 2) + b * b)"
_MOMENTS = f"""SELECT image_id, label, area, {r('cy')} AS "centroid-0", {r('cx')} AS "centroid-1",
 y0 AS "bbox-0", x0 AS "bbox-1", y1 AS "bbox-2", x1 AS "bbox-3", ((y1 - y0) * (x1 - x0))::BIGINT AS area_bbox,
 {r('area / ((y1 - y0) * (x1 - x0))')} AS extent, {r('sqrt(area * 4 / pi())')} AS equivalent_diameter_area,
 {r(f'4 * sqrt((a + c) / 2 + {_ROOT})')} AS axis_major_length,
 {r(f'4 * sqrt(greatest((a + c) / 2 - {_ROOT}, 0))')} AS axis_minor_length,
 {r(f'sqrt(greatest(1 - ((a + c) / 2 - {_ROOT}) / ((a + c) / 2 + {_ROOT}), 0))')} AS eccentricity,
 {r('CASE WHEN abs(a - c) < 1e-12 THEN CASE WHEN b > 0 THEN pi() / 4 ELSE -pi() / 4 END ELSE atan2(2 * b, a - c) / 2 END')} AS orientation
 FROM (SELECT image_id, label, count(*) AS area, avg(y) AS cy, avg(x) AS cx, min(y) AS y0, min(x) AS x0,
 (max(y) + 1)::INT AS y1, (max(x) + 1)::INT AS x1, {r('var_pop(y)', 9)} + 1.0::DOUBLE / 12 AS a,
 {r('var_pop(x)', 9)} + 1.0::DOUBLE / 12 AS c, {r('covar_pop(y, x)', 9)} AS b FROM lab GROUP BY ALL)"""

_QUADS = """(SELECT image_id, label, qy, qx, sum(bit)::INT AS code FROM (SELECT image_id, label, y + dy AS qy, x + dx AS qx, bit
 FROM lab, (VALUES (0, 0, 1), (1, 0, 2), (0, 1, 4), (1, 1, 8)) AS t(dy, dx, bit)) GROUP BY ALL)"""
_CROFTON = f"({list(shape.CROFTON_4)!r})"
_TOPOLOGY = f"""SELECT image_id, label, (sum(CASE WHEN code IN (1, 2, 4, 8) THEN 1 WHEN code IN (7, 11, 13, 14) THEN -1
 WHEN code IN (6, 9) THEN -2 ELSE 0 END) / 4)::INT AS euler_number, {r(f'sum({_CROFTON}[code + 1])')} AS perimeter_crofton
 FROM {_QUADS} GROUP BY image_id, label"""


def _neighbours(name: str, src: str, offsets: str) -> str:
    """Neighbours of the same label: (image, label, y, x, dy, dx, hit)."""
    return f"""{name} AS (SELECT c.image_id, c.label, c.y, c.x, dy, dx, n.label IS NOT NULL AS hit FROM
 (SELECT * FROM {src}, (VALUES {offsets}) AS t(dy, dx)) c LEFT JOIN {src} n
 ON n.image_id = c.image_id AND n.label = c.label AND n.y = c.y + c.dy AND n.x = c.x + c.dx)"""


_FOUR = "(1, 0), (-1, 0), (0, 1), (0, -1)"
_EIGHT = _FOUR + ", (1, 1), (1, -1), (-1, 1), (-1, -1)"
_CODED = f"""{_neighbours('around', 'lab', _FOUR)},
 border AS (SELECT image_id, label, y, x FROM around GROUP BY ALL HAVING NOT bool_and(hit)),
 {_neighbours('line', 'border', _EIGHT)},
 coded AS (SELECT image_id, label, y, x, 1 + sum(CASE WHEN hit THEN CASE WHEN dy = 0 OR dx = 0 THEN 2 ELSE 10 END ELSE 0 END) AS code
  FROM line GROUP BY ALL)"""
_PERIMETER = f"""SELECT image_id, label, {r(f'sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1.0::DOUBLE WHEN code IN (21, 33) THEN {math.sqrt(2)}::DOUBLE WHEN code IN (13, 23) THEN {(1 + math.sqrt(2)) / 2}::DOUBLE ELSE 0 END)')} AS perimeter
 FROM coded GROUP BY ALL"""

# Hull edges are the point pairs with every other point on one side; a pixel is in the hull when it
# lies on that side of all edges.
_SIDE = "(e.by - e.ay) * ({p}.x - e.ax) - (e.bx - e.ax) * ({p}.y - e.ay) >= 0"
_EDGES = f"""ends AS (SELECT image_id, label, y, min(x) AS x0, max(x) AS x1 FROM lab GROUP BY ALL),
 pts AS (SELECT DISTINCT image_id, label, unnest([y - 0.5, y + 0.5, y, y - 0.5, y + 0.5, y])::DOUBLE AS y,
  unnest([x0, x0, x0 - 0.5, x1, x1, x1 + 0.5])::DOUBLE AS x FROM ends),
 edge AS (SELECT e.* FROM (SELECT a.image_id, a.label, a.y AS ay, a.x AS ax, b.y AS by, b.x AS bx FROM pts a JOIN pts b
  ON a.image_id = b.image_id AND a.label = b.label AND (a.y <> b.y OR a.x <> b.x)) e
  JOIN pts p ON p.image_id = e.image_id AND p.label = e.label GROUP BY ALL HAVING bool_and({_SIDE.format(p='p')})),
 hull_px AS (SELECT g.image_id, g.label, g.y, g.x FROM (SELECT image_id, label, u.y, v.x FROM
  (SELECT image_id, label, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM lab GROUP BY ALL), range(0, 8) u(y), range(0, 8) v(x)
  WHERE u.y BETWEEN y0 AND y1 AND v.x BETWEEN x0 AND x1) g JOIN edge e USING (image_id, label) GROUP BY ALL HAVING bool_and({_SIDE.format(p='g')})),
 far AS (SELECT a.image_id, a.label, sqrt(max(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))) AS feret FROM pts a JOIN pts b
  ON a.image_id = b.image_id AND a.label = b.label GROUP BY ALL)"""
_HULL = f"""SELECT image_id, label, any_value(n)::BIGINT AS area_convex, {r('count(*) / any_value(n)')} AS solidity, {r('any_value(feret)')} AS feret_diameter_max
 FROM lab JOIN (SELECT image_id, label, count(*) AS n FROM hull_px GROUP BY ALL) USING (image_id, label) JOIN far USING (image_id, label)
 GROUP BY image_id, label"""

# Background of an object box reaches the outside by 8-connected steps: a fixed point.
_REACH = """box AS (SELECT image_id, label, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1, count(*) AS area FROM lab GROUP BY ALL),
 hollow AS (SELECT b.image_id, b.label, u.y, v.x, u.y IN (y0, y1) OR v.x IN (x0, x1) AS edge FROM box b,
  range(0, 8) u(y), range(0, 8) v(x) WHERE u.y BETWEEN y0 AND y1 AND v.x BETWEEN x0 AND x1
  AND NOT EXISTS (SELECT 1 FROM lab p WHERE p.image_id = b.image_id AND p.label = b.label AND p.y = u.y AND p.x = v.x)),
 reach AS (SELECT image_id, label, y, x FROM hollow WHERE edge
  UNION SELECT h.image_id, h.label, h.y, h.x FROM reach r JOIN hollow h ON h.image_id = r.image_id AND h.label = r.label
  AND abs(h.y - r.y) <= 1 AND abs(h.x - r.x) <= 1)"""
_FILLED = """SELECT b.image_id, b.label, (any_value(area) + count(h.y) - count(q.y))::BIGINT AS area_filled FROM box b
 LEFT JOIN hollow h USING (image_id, label) LEFT JOIN reach q ON q.image_id = h.image_id AND q.label = h.label AND q.y = h.y AND q.x = h.x
 GROUP BY b.image_id, b.label"""


def shape_sql(lab: str, body: str, *parts: str, needs: tuple[str, ...] = ("lab_b",)) -> str:
    return q.sql_with(", ".join([f"lab AS ({lab})", *parts]), body, *needs, recursive=True)


_B = "SELECT * FROM lab_b"


@query(shape_sql(_B, _MOMENTS))
def shape_moments(s, d):
    return q.rounded(shape.shape_moments(q.lab_b(s, d)))


@query(shape_sql(_B, f"SELECT image_id, label, code, count(*) AS n FROM {_QUADS} GROUP BY ALL"))
def quad_counts(s, d):
    return shape.quad_counts(q.lab_b(s, d))


@query(shape_sql(_B, _TOPOLOGY))
def topology(s, d):
    return q.rounded(shape.topology(q.lab_b(s, d)))


@query(shape_sql(_B, _PERIMETER, _CODED))
def perimeter(s, d):
    return q.rounded(shape.perimeter(q.lab_b(s, d)))


@query(shape_sql(_B, _HULL, _EDGES))
def hull_features(s, d):
    return q.rounded(shape.hull_features(q.lab_b(s, d)))


@query(shape_sql(_B, _FILLED, _REACH))
def filled_area(s, d):
    return shape.filled_area(q.lab_b(s, d))


SHAPE_PARTS = (_CODED, _EDGES, _REACH)
SHAPE_TABLE = " JOIN ".join(f"({t})" + (" USING (image_id, label)" if i else "")
                            for i, t in enumerate((_MOMENTS, _TOPOLOGY, _PERIMETER, _HULL, _FILLED)))


@query(shape_sql("SELECT * FROM lab_c", f"SELECT * FROM {SHAPE_TABLE}", *SHAPE_PARTS, needs=("lab_c",)))
def object_shape(s, d):
    return q.rounded(shape.object_shape(q.lab_c(s, d)))
