"""Queries over image measurements and numeric arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.catalog import query, table
from sheafline.functions import geometry as G
from sheafline.functions import imaging
from sheafline.operators import routing

_MEASURES = """m AS (SELECT l_orderkey, l_linenumber, l_quantity AS blur, l_discount * 100 AS sharpness, l_extendedprice / 1000 AS contrast,
  (l_partkey * 7 % 256)::DOUBLE AS brightness, l_tax * 100 AS noise, l_discount * 2 AS text_coverage, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity - 25 END AS skew FROM lineitem)"""
_POOR = "(blur < 5 OR sharpness < 1 OR contrast < 12 OR noise > 40 OR brightness < 20 OR brightness > 240)"


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as images, their numbers as measurements."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("blur"),
        (F.col("l_discount") * 100).alias("sharpness"),
        (F.col("l_extendedprice") / 1000).alias("contrast"),
        (F.col("l_partkey") * 7 % 256).cast("double").alias("brightness"),
        (F.col("l_tax") * 100).alias("noise"),
        (F.col("l_discount") * 2).alias("text_coverage"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity") - 25).alias("skew"),
    )


@query(f"""
WITH {_MEASURES}
SELECT CASE WHEN {_POOR} THEN 'LOW_QUALITY' WHEN text_coverage >= 0.15 THEN 'TEXT_IMAGE' WHEN text_coverage >= 0.02 THEN 'MIXED_IMAGE' ELSE 'VISUAL_IMAGE' END AS class,
       CASE WHEN noise >= 6 THEN 'noisy' WHEN brightness >= 190 AND contrast < 30 THEN 'washed_out'
            WHEN coalesce(abs(skew) BETWEEN 0.5 AND 15, false) OR contrast < 30 THEN 'uneven_or_skewed' ELSE 'clean' END AS profile,
       count(*) AS images, count(*) FILTER (brightness < 20) AS dark, CAST(coalesce(sum(CASE WHEN brightness < 20 THEN 130 - brightness END), 0) AS DOUBLE) AS shift
FROM m GROUP BY ALL
""")
def image_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images by class and profile of preparation, with the lift of the dark ones."""
    found = routing.classify_images(measures(spark, sf_dir))
    return found.groupBy("class", F.col("profile.name").alias("profile")).agg(
        F.count(F.lit(1)).alias("images"), F.count("shift").alias("dark"), F.coalesce(F.sum("shift"), F.lit(0.0)).alias("shift")
    )


@query(f"""
WITH {_MEASURES}, s AS (SELECT *, 8 + blur / 4 AS letter, 1000 + l_linenumber * 500 AS side,
  CASE WHEN noise >= 6 THEN 'noisy' WHEN brightness >= 190 AND contrast < 30 THEN 'washed_out'
       WHEN coalesce(abs(skew) BETWEEN 0.5 AND 15, false) OR contrast < 30 THEN 'uneven_or_skewed' ELSE 'clean' END AS profile FROM m),
f AS (SELECT *, CASE WHEN letter < 20 AND least(4.0, 30.0 / letter, 4000.0 / side) > 1.05 THEN least(4.0, 30.0 / letter, 4000.0 / side) END AS scale FROM s)
SELECT l_orderkey, l_linenumber, round(coalesce(scale, 0), 9) AS scale,
  'grayscale' || CASE WHEN scale IS NOT NULL THEN ',upscale' ELSE '' END || CASE WHEN profile = 'noisy' THEN ',denoise' ELSE '' END ||
  CASE WHEN profile IN ('noisy', 'washed_out') THEN ',equalize' ELSE '' END || CASE WHEN profile = 'uneven_or_skewed' THEN ',flatten' ELSE '' END ||
  CASE WHEN l_linenumber % 2 = 0 THEN ',orientation' ELSE '' END || CASE WHEN coalesce(abs(skew) BETWEEN 0.5 AND 15, false) THEN ',deskew' ELSE '' END ||
  CASE WHEN blur < 50 THEN ',sharpen' ELSE '' END || ',binarize' AS steps
FROM f
""")
def preparation_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kernels that prepare each image for OCR, in order, and its scale."""
    found = routing.classify_images(measures(spark, sf_dir))
    side = F.lit(1000) + F.col("l_linenumber") * 500
    scale = routing.upscale_factor(F.lit(8) + F.col("blur") / 4, side, side)
    turned = F.when(F.col("l_linenumber") % 2 == 0, 90).otherwise(0)
    steps = routing.ocr_steps(F.col("profile"), F.col("scale"), F.col("blur"), turned, F.col("skew"), F.lit(True), F.lit(True))
    return found.withColumn("scale", scale).select(
        "l_orderkey", "l_linenumber", F.round(F.coalesce("scale", F.lit(0.0)), 9).alias("scale"), F.array_join(steps, ",").alias("steps")
    )


@query("""
WITH h AS (SELECT l_orderkey, 5 + l_quantity AS h, l_linenumber * 10 AS l FROM lineitem WHERE l_linenumber * 10 > 2 AND 5 + l_quantity BETWEEN 5 AND 60)
SELECT l_orderkey, median(h) AS letter FROM h GROUP BY 1
""")
def glyph_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median height of regions of a letter's size, off the page's edge."""
    left = F.col("l_linenumber") * 10
    box = G.box(left, F.lit(100.0), left + 5, F.lit(105.0) + F.col("l_quantity"))
    pages = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(box).alias("boxes"))
    return pages.select("l_orderkey", routing.glyph_height(F.col("boxes"), F.lit(5000.0), F.lit(5000.0)).alias("letter"))


@query("""
SELECT vec_id, round(list_avg(embedding::DOUBLE[]), 9) AS brightness, round(list_stddev_pop(embedding::DOUBLE[]), 9) AS contrast, len(embedding) AS n FROM embeddings
""")
def numeric_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and spread of an array, as brightness and contrast are measured, in the JVM."""
    x, n = F.col("x"), F.size("x")
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
    spread = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - F.col("brightness")) * (v - F.col("brightness"))) / n)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x")).withColumn("brightness", mean)
    return rows.select("vec_id", F.round("brightness", 9).alias("brightness"), F.round(spread, 9).alias("contrast"), n.alias("n"))


@query()
def image_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw images, made of all bytes of pages, 64 to a row and the last row filled up, measured by the kernels in Arrow batches."""
    raw = F.col("html").cast("binary")
    height = F.greatest(F.ceil(F.octet_length("html") / 64), F.lit(1)).cast("int")
    images = table(spark, sf_dir, "pages").select(
        "page_id", F.rpad(raw, height * 64, F.lit(b"\xff")).alias("content"), F.lit(64).alias("width"), height.alias("height"), F.lit(1).alias("channels")
    )
    return imaging.measure(images, "page_id").drop("regions")
