"""Relations of boxes derived from the star-schema tables, and views of the page tables, for the core's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import geometry as G
from vellum.sources.tables import checkpoint, current_rows, table

_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"]


def detections(spark: SparkSession, d: str) -> DataFrame:
    """page_id, det_id, class_id, confidence, text_conf, box: one detection per line item, a page per order."""
    n = F.col("l_linenumber") % 4
    cls = F.when(n == 0, 0).when(n == 1, 1).when(n == 2, 2).otherwise(3)
    x0, y0 = ((F.col("l_partkey") % 40) * 20).cast("int"), ((F.col("l_suppkey") % 50) * 20).cast("int")
    wide = ((F.col("l_quantity") * 8 + 20) * F.when(cls == 1, 3).otherwise(1)).cast("int")
    w = Window.partitionBy("l_orderkey").orderBy(*_ORDER)
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("page_id"), (F.row_number().over(w) - 1).cast("int").alias("det_id"), cls.alias("class_id"), (1 - F.col("l_discount")).alias("confidence"),
        F.exp(-10 * F.col("l_tax")).alias("text_conf"), G.box(x0, y0, x0 + wide, y0 + F.when(cls == 1, 300).otherwise(30)).alias("box"),
    )


def pinned(spark: SparkSession, d: str) -> DataFrame:
    """The detections, numbered once: what is partitioned by page stays so, and later steps by page need no shuffle."""
    return checkpoint(detections(spark, d))


def lines(spark: SparkSession, d: str) -> DataFrame:
    return detections(spark, d).filter("class_id >= 2")


def line_boxes(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(detections(spark, d))


def lines_of(found: DataFrame) -> DataFrame:
    return found.filter("class_id >= 2").select("page_id", F.col("det_id").alias("line_id"), "box", "text_conf")


def order_boxes(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).select("page_id", F.col("det_id").alias("id"), "box")


def region_boxes(spark: SparkSession, d: str) -> DataFrame:
    """page_id, region_id, region_pos, box of the region detections."""
    return regions_of(detections(spark, d))


def regions_of(found: DataFrame) -> DataFrame:
    return found.filter("class_id = 1").select("page_id", F.col("det_id").cast("string").alias("region_id"), F.col("det_id").alias("region_pos"), "box", "confidence")


def staircase(spark: SparkSession, d: str) -> DataFrame:
    """page_id, id, box: boxes that descend to the left and overlap in height, so that many pages are cyclic."""
    k = F.col("det_id")
    return detections(spark, d).select("page_id", k.alias("id"), G.box((20 - k) * 10, 4 * k, (20 - k) * 10 + 50, 4 * k + 10).alias("box"))


def current_lines(spark: SparkSession, d: str) -> DataFrame:
    """The current recognition of each line."""
    return current_rows(table(spark, d, "line_texts").select("page_id", "line_pos", "recognised_at", "line_uid", "region_id", "polygon", "text", "conf", "text_conf", "row_length"), ["page_id", "line_pos"], ["recognised_at"])
