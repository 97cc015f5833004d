"""Canonical tables and adapters from the supplied ones.

A matrix is long: (feature, pixel_id, intensity), null intensity or an absent row being a missing value; never NaN.
Pixels are named ``y<Y>x<X>``. Each adapter has the DuckDB text of the same table beside it for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATRIX = T.StructType([T.StructField("feature", T.StringType()), T.StructField("pixel_id", T.StringType()), T.StructField("intensity", T.DoubleType())])
PIXELS = T.StructType(
    [T.StructField("row_id", T.IntegerType()), T.StructField("pixel_id", T.StringType()), T.StructField("x_coord", T.IntegerType()), T.StructField("y_coord", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("hc_orig", "hc_manual", "mz_manual", "color")]
)
LIBRARY = T.StructType(
    [T.StructField("mol_id", T.StringType()), T.StructField("source", T.StringType()), T.StructField("mass", T.DoubleType()), T.StructField("charge", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("formula", "name", "inchi", "kegg", "cid", "hmdb")]
    + [T.StructField("ccs", T.MapType(T.StringType(), T.DoubleType()))]
)
WIDTH = 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixel_name(x: Column, y: Column) -> Column:
    return F.concat(F.lit("y"), y.cast("string"), F.lit("x"), x.cast("string"))


def pixel_x(name: Column) -> Column:
    """X of a pixel name, -1 if there is none."""
    return F.coalesce(F.regexp_extract(name, "x([0-9]+)", 1).try_cast("int"), F.lit(-1))


def pixel_y(name: Column) -> Column:
    return F.coalesce(F.regexp_extract(name, "y([0-9]+)", 1).try_cast("int"), F.lit(-1))


def feature_mz(name: Column) -> Column:
    """The number behind the first underscore of ``mz_153.0187``; null if there is none."""
    return F.regexp_replace(name, "^[^_]+_", "").try_cast("double")


def transpose(m: DataFrame) -> DataFrame:
    """Rows become columns: the two keys of the long table trade places."""
    return m.select(F.col("pixel_id").alias("feature"), F.col("feature").alias("pixel_id"), "intensity")


def sales_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive sparse matrix: supplier by order number modulo 200, total price."""
    k = F.col("l_orderkey") % 200
    cell = read(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("mz_"), F.col("l_suppkey").cast("string")).alias("feature"), k.alias("k"))
    total = cell.agg(F.round(F.sum("l_extendedprice"), 2).alias("intensity"))
    return total.select("feature", pixel_name(F.col("k") % WIDTH, F.floor(F.col("k") / WIDTH)).alias("pixel_id"), "intensity")


SALES_SQL = f"""m AS (
  SELECT 'mz_' || l_suppkey AS feature, 'y' || (l_orderkey % 200) // {WIDTH} || 'x' || (l_orderkey % 200) % {WIDTH} AS pixel_id, round(sum(l_extendedprice), 2) AS intensity
  FROM lineitem GROUP BY ALL)"""


def sales_pixels(spark: SparkSession) -> DataFrame:
    """The 200 pixels of the sales matrix with four domains by quadrant."""
    k = F.col("id")
    x, y = (k % WIDTH).cast("int"), F.floor(k / WIDTH).cast("int")
    domain = F.concat(F.lit("d"), (F.when(x < WIDTH / 2, 0).otherwise(1) + F.when(y < 5, 0).otherwise(2)).cast("string"))
    return spark.range(200).select((k + 1).cast("int").alias("row_id"), pixel_name(x, y).alias("pixel_id"), x.alias("x_coord"), y.alias("y_coord"), domain.alias("hc_orig"), domain.alias("hc_manual"), F.lit("Default").alias("mz_manual"), F.lit("#CCCCCC").alias("color"))


SALES_PIXELS_SQL = f"""p AS (
  SELECT (k + 1)::INT AS row_id, 'y' || k // {WIDTH} || 'x' || k % {WIDTH} AS pixel_id, (k % {WIDTH})::INT AS x_coord, (k // {WIDTH})::INT AS y_coord,
    'd' || (CASE WHEN k % {WIDTH} < {WIDTH // 2} THEN 0 ELSE 1 END + CASE WHEN k // {WIDTH} < 5 THEN 0 ELSE 2 END) AS hc_orig FROM range(200) AS r(k))"""


def vector_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense signed matrix of the embeddings: dimension by vector."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("d", "v"))
    return e.select(F.concat(F.lit("f"), F.col("d").cast("string")).alias("feature"), F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("pixel_id"), F.col("v").cast("double").alias("intensity"))


VECTOR_SQL = """v AS (SELECT 'f' || (d - 1) AS feature, 'p' || vec_id AS pixel_id, embedding[d]::DOUBLE AS intensity FROM embeddings, range(1, 65) AS r(d))"""


def vector_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors on a grid 25 wide, labels as domains."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id"), F.concat(F.lit("p"), F.col("vec_id").cast("string")).alias("pixel_id"), (F.col("vec_id") % 25).cast("int").alias("x_coord"), F.floor(F.col("vec_id") / 25).cast("int").alias("y_coord"), F.concat(F.lit("d"), F.col("label").cast("string")).alias("hc_manual"))


VECTOR_PIXELS_SQL = """q AS (SELECT vec_id, 'p' || vec_id AS pixel_id, (vec_id % 25)::INT AS x_coord, (vec_id // 25)::INT AS y_coord, 'd' || label AS hc_manual FROM embeddings)"""
