"""File lists, names, plate layout, splits and set checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelspark.functions import text as tx
from pixelspark.operators import prep
from pixelspark.queries import inputs as q
from pixelspark.queries.registry import query
from pixelspark.sources import files as fs
from pixelspark.sources import tables as src

# --- sources ------------------------------------------------------------------------------


@query(q.sql("""SELECT name FROM files WHERE NOT starts_with(name, '.')
 AND (contains(name, '.csv') OR contains(name, '.xlsx')) AND NOT (contains(name, '1995') OR contains(name, '_run_12'))""",
             "files"))
def list_inputs(s, d):
    return fs.list_inputs(q.files(s, d), [".csv", ".xlsx"], ["1995", "_run_12"])


@query(q.sql("SELECT max_by(name, name[:8] || name) AS name FROM files WHERE NOT starts_with(name, '.')", "files"))
def latest_file(s, d):
    return fs.latest_file(fs.list_inputs(q.files(s, d)), fs.name_date(F.col("name")))


@query(q.sql("""SELECT name FROM files WHERE NOT starts_with(name, '.')
 AND name[:8] = (SELECT max(name[:8]) FROM files WHERE NOT starts_with(name, '.'))""", "files"))
def latest_files(s, d):
    return fs.latest_files(fs.list_inputs(q.files(s, d)), fs.name_date(F.col("name")))


@query(q.sql("""SELECT name FROM files WHERE NOT starts_with(name, '.')
 AND name[:8] = (SELECT min(name[:8]) FROM files WHERE NOT starts_with(name, '.'))""", "files"))
def oldest_files(s, d):
    return fs.latest_files(fs.list_inputs(q.files(s, d)), fs.name_date(F.col("name")), newest=False)


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def read_fov_table(s, d):
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                           T.StructField("s_nationkey", T.IntegerType())])
    return src.read_fov_table(s, f"{d}/supplier.parquet", schema, "parquet")


@query(q.sql("SELECT l_suppkey AS image_id, l_linenumber::INT AS channel, l_quantity::DOUBLE AS value FROM lineitem "
             "SEMI JOIN fov f ON l_suppkey = f.image_id AND f.experiment = 'ASIA' WHERE l_linenumber IN (1, 3)", "fov"))
def read_pixels(s, d):
    """Lines of the listed suppliers and numbers, read from the file by the operator and cast to its schema."""
    schema = T.StructType([T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()), T.StructField("l_quantity", T.DoubleType())])
    names = {"l_suppkey": "image_id", "l_linenumber": "channel", "l_quantity": "value"}
    return src.read_pixels(s, f"{d}/lineitem.parquet", q.fov(s, d).where("experiment = 'ASIA'"), [1, 3], schema, names)


@query(q.sql("""SELECT image_id, (max(channel) + 1)::INT AS channels, (max(y) + 1)::INT AS height,
 (max(x) + 1)::INT AS width,
 (SELECT count(DISTINCT (c, h, w)) = 1 FROM (SELECT max(channel) c, max(y) h, max(x) w FROM multi GROUP BY image_id))
 AS homogeneous FROM multi GROUP BY image_id""", "multi"))
def fov_shape(s, d):
    return src.fov_shape(q.multi(s, d))


_METRIC = "SELECT image_id, avg(value) AS m FROM bag GROUP BY image_id HAVING avg(value) > 25.5"


def _partial_metric(s, d):
    """A metric that some images do not have."""
    return q.bag(s, d).groupBy("image_id").agg(F.avg("value").alias("m")).where("m > 25.5")


@query(q.sql(f"SELECT fov.*, {q.r('m')} AS m FROM fov LEFT JOIN ({_METRIC}) USING (image_id)", "fov", "bag"))
def keep_missing_inputs(s, d):
    return q.rounded(src.keep_missing_inputs(q.fov(s, d), _partial_metric(s, d)), "m")


@query(q.sql(f"SELECT fov.*, {q.r('m')} AS m FROM fov JOIN ({_METRIC}) USING (image_id)", "fov", "bag"))
def skip_missing_inputs(s, d):
    return q.rounded(src.keep_missing_inputs(q.fov(s, d), _partial_metric(s, d), skip_missing=True), "m")


@query(q.sql("""SELECT *, 'division' AS method, 400 AS "offset", 3 AS "sigma-0", 5 AS "sigma-1" FROM fov""", "fov"))
def add_step_columns(s, d):
    return src.add_step_columns(q.fov(s, d), {"method": "division", "offset": 400}, {"sigma": {0: 3, 1: 5}})


# --- text ---------------------------------------------------------------------------------

_SYMBOLS = "".join(tx.SYMBOLS).replace("'", "''")
_FORMATTED = f"replace(translate(treatment, '{_SYMBOLS}', '{'_' * len(tx.SYMBOLS)}'), ' ', '')"


@query(q.sql(f"SELECT experiment, well, {_FORMATTED} AS treatment, lower({_FORMATTED}) AS lowered FROM plate", "plate"))
def normalize_text(s, d):
    t = F.col("treatment")
    return q.plate(s, d).select("experiment", "well", tx.normalize_text(t).alias("treatment"),
                                 tx.normalize_text(t, lower=True).alias("lowered"))


@query("""SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_brand, '(\\d+)$', 1), '') AS INT) AS brand_number,
 TRY_CAST(nullif(regexp_extract(p_name, '(\\d+)$', 1), '') AS INT) AS name_number FROM part""")
def trailing_number(s, d):
    return q.table(s, d, "part").select("p_partkey", tx.trailing_number(F.col("p_brand")).alias("brand_number"),
                                        tx.trailing_number(F.col("p_name")).alias("name_number"))


_SPLIT = r"'^(.*?)(\d+)$'"


@query(f"""SELECT s_suppkey, nullif(regexp_extract(s_name, {_SPLIT}, 1), '') AS prefix,
 TRY_CAST(nullif(regexp_extract(s_name, {_SPLIT}, 2), '') AS INT) AS number FROM supplier""")
def split_text_number(s, d):
    return q.table(s, d, "supplier").select("s_suppkey", tx.split_text_number(F.col("s_name"), "int").alias("p")).select(
        "s_suppkey", "p.prefix", "p.number")


@query(q.sql(f"""SELECT 'prefix' AS part, regexp_extract(well, {_SPLIT}, 1) AS text FROM fov
 UNION SELECT 'number', regexp_extract(well, {_SPLIT}, 2) FROM fov""", "fov"))
def layout_conditions(s, d):
    return prep.layout_conditions(q.fov(s, d), "well")


@query(q.sql("""SELECT image_id, 'screen' AS project, split_part(name, '_', 1) AS kind,
 CAST(TRY_CAST(split_part(name, '_', 2) AS BIGINT) AS VARCHAR) AS number, split_part(name, '_', 4) AS well,
 split_part(name, '_', 3) AS region, NULL::VARCHAR AS nothing FROM
 (SELECT image_id, replace(name, 'MIDDLE EAST', 'MIDDLE-EAST') AS name FROM fov)""", "fov"))
def parse_name(s, d):
    name = F.replace("name", F.lit("MIDDLE EAST"), F.lit("MIDDLE-EAST"))
    fields = {"project": "screen", "kind": (0, None, None, None), "number": (1, "#", 0, "try_int"),
              "well": (-1, None, None, None), "region": (2, "/", 7, None), "nothing": (9, None, None, None)}
    return q.fov(s, d).select("image_id", *tx.parse_name(name, fields))


@query(q.sql("""SELECT image_id, name || '_' || replace(experiment || '.1', '.', 'p') || '_' || well || '.ome.tif'
 AS file FROM fov""", "fov"))
def output_name(s, d):
    return q.fov(s, d).select("image_id", tx.output_name(
        F.col("name"), F.concat("experiment", F.lit(".1")), F.col("well")).alias("file"))


@query(q.sql("""SELECT image_id, 'custom_experiment' AS key, experiment AS value FROM fov
 UNION ALL SELECT image_id, 'custom_well', well FROM fov""", "fov"))
def prefix_keys(s, d):
    m = F.create_map(F.lit("experiment"), F.col("experiment"), F.lit("well"), F.col("well"))
    return q.fov(s, d).select("image_id", F.explode(tx.prefix_keys(m)))


_SIZES = """SELECT image_id, 1::BIGINT AS t, count(DISTINCT channel) AS c, (1 + image_id % 3)::BIGINT AS z,
 count(DISTINCT y) AS y, count(DISTINCT x) AS x FROM multi GROUP BY image_id"""


@query(q.sql(f"""SELECT image_id, CASE WHEN c > 1 THEN 'C' ELSE '' END || CASE WHEN z > 1 THEN 'Z' ELSE '' END ||
 CASE WHEN y > 1 THEN 'Y' ELSE '' END || CASE WHEN x > 1 THEN 'X' ELSE '' END AS dims_order,
 t AS size_t, c AS size_c, z AS size_z, y AS size_y, x AS size_x, CASE WHEN z > 1 THEN 1.5::DOUBLE END AS physical_size_z,
 0.325::DOUBLE AS physical_size_y, 0.325::DOUBLE AS physical_size_x, 'scope' AS microscope FROM ({_SIZES})""", "multi"))
def scene_record(s, d):
    sizes = q.multi(s, d).groupBy("image_id").agg(
        F.countDistinct("channel").alias("c"), F.countDistinct("y").alias("y"), F.countDistinct("x").alias("x"))
    dims = {"T": F.lit(1).cast("bigint"), "C": F.col("c"), "Z": F.col("image_id") % 3 + 1, "Y": F.col("y"), "X": F.col("x")}
    um = {"Z": F.lit(1.5), "Y": F.lit(0.325), "X": F.lit(0.325)}
    return sizes.select("image_id", *tx.scene_record(dims, um, microscope=F.lit("scope")))


@query(q.sql("SELECT image_id, '260202' AS processing_date_yymmdd FROM fov", "fov"))
def stamp_date(s, d):
    return q.fov(s, d).select("image_id", tx.stamp_date("2026-02-02 10:11:12").alias("processing_date_yymmdd"))


# --- layout and name joins ----------------------------------------------------------------

_INT_WELL = "CAST(regexp_extract(well, '(\\d+)$', 1) AS INT)"


@query(q.sql(f"""SELECT f.*, l.treatment FROM (SELECT *, {_INT_WELL} AS int_well FROM fov) f
 LEFT JOIN layout l ON f.experiment = l.experiment AND f.int_well = l.well""", "fov", "layout"))
def layout_lookup(s, d):
    return prep.layout_lookup(q.fov(s, d), q.layout(s, d))


@query(q.sql(f"""SELECT f.* FROM (SELECT *, {_INT_WELL} AS int_well FROM fov) f
 ANTI JOIN layout l ON f.experiment = l.experiment AND f.int_well = l.well""", "fov", "layout"))
def layout_missing(s, d):
    return prep.layout_missing(q.fov(s, d), q.layout(s, d))


_CONDITIONS = "SELECT DISTINCT experiment || '_' || well AS condition FROM fov"


def _conditions(s, d):
    return q.fov(s, d).select(F.concat_ws("_", "experiment", "well").alias("condition")).distinct()


@query(q.sql(f"SELECT condition, name FROM ({_CONDITIONS}) JOIN fov ON contains(name, condition)", "fov"))
def match_names(s, d):
    return prep.match_names(q.fov(s, d), _conditions(s, d))


@query(q.sql(f"""SELECT condition, count(name) AS n_files, count(name) = 4 AS ok
 FROM ({_CONDITIONS}) LEFT JOIN fov ON contains(name, condition) GROUP BY condition""", "fov"))
def match_report(s, d):
    return prep.match_report(q.fov(s, d), _conditions(s, d), 4)


@query(q.sql("""SELECT experiment, string_agg(treatment, ',' ORDER BY treatment) AS treatments
 FROM (SELECT DISTINCT experiment, treatment FROM plate) GROUP BY experiment""", "plate"))
def group_lists(s, d):
    return prep.group_lists(q.plate(s, d), ["experiment"], "treatment", "treatments")


# --- splits, samples, order ---------------------------------------------------------------

_ORDER = "row_number() OVER (ORDER BY md5(o_orderkey || '|42'), o_orderkey)"


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN {_ORDER} <= ceil(round(count(*) OVER () * 0.3::DOUBLE, 9))
 THEN 0 ELSE 1 END AS is_train FROM orders""")
def train_test_split(s, d):
    return prep.train_test_split(q.table(s, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query(f"""SELECT o_orderkey, o_custkey FROM orders
 QUALIFY {_ORDER} <= floor(count(*) OVER () * 0.5::DOUBLE + 0.5)""")
def sample_rows(s, d):
    return prep.sample_rows(q.table(s, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query(f"""SELECT o_orderkey FROM (SELECT o_orderkey, {_ORDER} <= ceil(round(count(*) OVER () * 0.3::DOUBLE, 9)) AS t
 FROM orders) WHERE NOT t""")
def train_only(s, d):
    split = prep.train_test_split(q.table(s, d, "orders").select("o_orderkey"), ["o_orderkey"])
    return prep.where_train(split).select("o_orderkey")


@query(q.sql("SELECT image_id, balance FROM fov ORDER BY balance, image_id", "fov"))
def sort_by_metric(s, d):
    return q.fov(s, d).select("image_id", "balance").orderBy("balance", "image_id")


@query(q.sql("SELECT image_id, balance FROM fov ORDER BY balance DESC, image_id LIMIT 5", "fov"))
def top_metric(s, d):
    return prep.top_rows(q.fov(s, d).select("image_id", "balance"), [F.desc("balance"), "image_id"], 5)


# --- set operations -----------------------------------------------------------------------


@query(q.sql("""SELECT image_id, experiment, NULL::VARCHAR AS well FROM fov
 UNION ALL SELECT image_id, NULL, well FROM fov""", "fov"))
def union_frames(s, d):
    f = q.fov(s, d)
    return prep.union_frames(f.select("image_id", "experiment"), f.select("image_id", "well"))


@query(f"""SELECT o_orderkey, NULL::VARCHAR AS side FROM orders WHERE false
 UNION ALL SELECT o_orderkey, 'right' FROM orders WHERE o_orderstatus = 'P'""")
def keys_differ(s, d):
    o = q.table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    return prep.keys_differ(o.where("o_orderstatus <> 'P'"), o, ["o_orderkey"])


@query("""SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def keep_in_both(s, d):
    return prep.keep_in_both(q.table(s, d, "customer").select(F.col("c_nationkey").alias("nation")),
                             q.table(s, d, "supplier").select(F.col("s_nationkey").alias("nation")), ["nation"])
