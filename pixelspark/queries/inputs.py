"""Pixels, labels, layouts and file lists derived from the given tables.

Every relation exists twice: as a DataFrame and as SQL text (``CTE``), so that a query and its
check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _cte(name: str, sql: str, *needs: str) -> None:
    CTE[name] = (sql, needs)


def sql(body: str, *names: str) -> str:
    """``body`` with the named relations, and those they need, in front."""
    order: list[str] = []

    def add(n: str) -> None:
        for m in CTE[n][1]:
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][0]})" for n in order) + "\n" + body


def sql_with(extra: str, body: str, *names: str, recursive: bool = False) -> str:
    """Like ``sql`` with further relations, written by the query, between inputs and body."""
    head, _, _ = sql("@", *names).rpartition("\n@")
    return (head.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else head) + f",\n{extra}\n{body}"


def r(expr: str, digits: int = 4) -> str:
    """SQL rounding without a negative zero."""
    return f"(round({expr}, {digits}) + 0.0::DOUBLE)"


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Doubles rounded so that two engines that add in another order agree."""
    columns = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(f"`{c}`", digits) for c in columns})


# --- pixels -------------------------------------------------------------------------------

_cte("raw", "SELECT vec_id AS image_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS p "
            "FROM embeddings")
_cte("emb", "SELECT image_id, 0::INT AS channel, (p // 8)::INT AS y, (p % 8)::INT AS x, "
            "floor(e::DOUBLE * 1000)::DOUBLE AS value FROM raw", "raw")


def emb(spark: SparkSession, d: str) -> DataFrame:
    """8x8 images, one channel, integer values of at most 2001 levels."""
    return (table(spark, d, "embeddings")
            .select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("p", "e"))
            .select("image_id", F.lit(0).alias("channel"), F.floor(F.col("p") / 8).cast("int").alias("y"),
                    (F.col("p") % 8).alias("x"),
                    F.floor(F.col("e").cast("double") * 1000).cast("double").alias("value")))


def sizes(spark: SparkSession, d: str) -> DataFrame:
    """Height and width of the 8x8 images, without a look at their pixels."""
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.lit(8).alias("height"), F.lit(8).alias("width"))



_cte("multi", "SELECT image_id, c::INT AS channel, y, x, CASE c WHEN 0 THEN value WHEN 1 THEN abs(value) "
              "ELSE value + 17 * x - 5 * y END AS value FROM emb, (VALUES (0), (1), (2)) AS t(c)", "emb")


def multi(spark: SparkSession, d: str) -> DataFrame:
    """The same images with three channels."""
    v = F.col("value")
    channels = F.array(*[F.struct(F.lit(c).alias("channel"), e.alias("value")) for c, e in enumerate(
        (v, F.abs(v), v + 17 * F.col("x") - 5 * F.col("y")))])
    return emb(spark, d).select("image_id", "y", "x", F.inline(channels)).select(
        "image_id", "channel", "y", "x", "value")


_cte("evt", "SELECT event_id // 256 AS image_id, 0::INT AS channel, ((event_id % 256) // 16)::INT AS y, "
            "(event_id % 16)::INT AS x, round(value * 100)::DOUBLE AS value FROM events")


def evt(spark: SparkSession, d: str) -> DataFrame:
    """16x16 images; the last one may be incomplete."""
    e = F.col("event_id")
    return table(spark, d, "events").select(
        F.floor(e / 256).alias("image_id"), F.lit(0).alias("channel"),
        F.floor((e % 256) / 16).cast("int").alias("y"), (e % 16).cast("int").alias("x"),
        F.round(F.col("value") * 100).cast("double").alias("value"))


_cte("bag", "SELECT l_suppkey AS image_id, (l_linenumber % 3)::INT AS channel, l_quantity::DOUBLE AS value "
            "FROM lineitem")


def bag(spark: SparkSession, d: str) -> DataFrame:
    """Values without coordinates; quantities of 1 to 50."""
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("image_id"), (F.col("l_linenumber") % 3).cast("int").alias("channel"),
        F.col("l_quantity").cast("double").alias("value"))



# --- labels -------------------------------------------------------------------------------

_cte("lab_a", "SELECT image_id, y, x, (1 + (y // 4) * 2 + x // 4)::INT AS label FROM emb", "emb")
_cte("lab_b", "SELECT image_id, y, x, (1 + (y // 4) * 2 + x // 4)::INT AS label FROM emb WHERE value > 0", "emb")
_cte("lab_c", "SELECT image_id, y, x, (1 + x // 3)::INT AS label FROM emb WHERE y BETWEEN 1 AND 6", "emb")
_cte("lab_i", "SELECT image_id, y, x, (CASE WHEN y = 0 THEN 6 ELSE 5 END)::INT AS label FROM emb "
              "WHERE y = 0 OR (y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5)", "emb")


def _quadrant():
    return (F.floor(F.col("y") / 4) * 2 + F.floor(F.col("x") / 4) + 1).cast("int").alias("label")


def lab_a(spark: SparkSession, d: str) -> DataFrame:
    """Four quadrants, all touching an edge."""
    return emb(spark, d).select("image_id", "y", "x", _quadrant())


def lab_b(spark: SparkSession, d: str) -> DataFrame:
    """Ragged objects: the positive pixels of each quadrant."""
    return emb(spark, d).where("value > 0").select("image_id", "y", "x", _quadrant())


def lab_c(spark: SparkSession, d: str) -> DataFrame:
    """Vertical strips that cross the quadrants."""
    return emb(spark, d).where("y between 1 and 6").select(
        "image_id", "y", "x", (F.floor(F.col("x") / 3) + 1).cast("int").alias("label"))


def lab_i(spark: SparkSession, d: str) -> DataFrame:
    """One interior object (5) and one on the edge (6)."""
    return (emb(spark, d).where("y = 0 or (y between 2 and 5 and x between 2 and 5)")
            .select("image_id", "y", "x", F.when(F.col("y") == 0, 6).otherwise(5).alias("label")))


# --- metadata -----------------------------------------------------------------------------

_cte("fov", "SELECT s_suppkey AS image_id, r_name AS experiment, 'well' || n_nationkey AS well, "
            "lower(replace(s_name, '#', '_')) || '_' || r_name || '_well' || n_nationkey AS name, s_acctbal AS balance "
            "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")


def fov(spark: SparkSession, d: str) -> DataFrame:
    n, reg = table(spark, d, "nation"), table(spark, d, "region")
    well = F.concat(F.lit("well"), F.col("n_nationkey"))
    return (table(spark, d, "supplier").join(n, F.col("s_nationkey") == n.n_nationkey)
            .join(reg, n.n_regionkey == reg.r_regionkey)
            .select(F.col("s_suppkey").alias("image_id"), F.col("r_name").alias("experiment"), well.alias("well"),
                    F.concat_ws("_", F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))), "r_name", well).alias("name"),
                    F.col("s_acctbal").alias("balance")))


_cte("plate", "SELECT r_name AS experiment, n_nationkey AS well, 'Drug-' || n_name || ' + (v' || n_regionkey || ')' "
              "AS treatment FROM nation JOIN region ON n_regionkey = r_regionkey")


def plate(spark: SparkSession, d: str) -> DataFrame:
    """The whole plate layout."""
    n, reg = table(spark, d, "nation"), table(spark, d, "region")
    return (n.join(reg, n.n_regionkey == reg.r_regionkey)
            .select(F.col("r_name").alias("experiment"), F.col("n_nationkey").alias("well"),
                    F.concat(F.lit("Drug-"), "n_name", F.lit(" + (v"), "n_regionkey", F.lit(")")).alias("treatment")))


_cte("layout", "SELECT r_name AS experiment, n_nationkey AS well, 'Drug-' || n_name || ' + (v' || n_regionkey || ')' "
               "AS treatment FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24")


def layout(spark: SparkSession, d: str) -> DataFrame:
    """Plate layout without well 24, so that the report of missing rows has something to say."""
    return plate(spark, d).where("well <> 24")


_cte("files", "SELECT CASE WHEN o_orderkey % 97 = 0 THEN '.' ELSE '' END || strftime(o_orderdate, '%Y%m%d') || '_run_' "
              "|| o_orderkey || CASE o_orderkey % 4 WHEN 1 THEN '.xlsx' WHEN 2 THEN '.ome.tif' ELSE '.csv' END AS name "
              "FROM orders")


def files(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    ending = F.when(k % 4 == 1, ".xlsx").when(k % 4 == 2, ".ome.tif").otherwise(".csv")
    return table(spark, d, "orders").select(F.concat(
        F.when(k % 97 == 0, ".").otherwise(""), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_run_"), k, ending)
        .alias("name"))
