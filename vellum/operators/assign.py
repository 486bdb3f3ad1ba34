"""Lines to regions: best overlap first, the nearest region else.

lines: page_id, line_id, box; regions: page_id, region_id, region_pos, box.  Ties go to the region that comes first.
NULL boxes overlap nothing and are near nothing; a line of a page without regions gets none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import geometry as G

FAR = 1_000_000.0


def _pairs(lines: DataFrame, regions: DataFrame) -> DataFrame:
    a = lines.select("page_id", "line_id", F.col("box").alias("a"))
    b = regions.select("page_id", "region_id", "region_pos", F.col("box").alias("b"))
    return a.join(b, "page_id")


def best_region(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, line_id, region_id, iou of the region that overlaps a line most; only lines that one overlaps."""
    a, b = F.col("a"), F.col("b")
    # the bounding test is cheap and part of the join
    over = _pairs(lines, regions).filter(G.intersects(a, b)).withColumn("iou", G.box_iou(a, b)).filter("iou > 0")
    best = over.groupBy("page_id", "line_id").agg(F.max(F.struct("iou", (-F.col("region_pos")).alias("p"), "region_id")).alias("m"))
    return best.select("page_id", "line_id", "m.region_id", "m.iou")


def nearest_region(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, line_id, region_id, dist of the region nearest to a line, within FAR."""
    near = _pairs(lines, regions).withColumn("dist", G.box_distance(F.col("a"), F.col("b"))).filter(F.col("dist") < FAR)
    best = near.groupBy("page_id", "line_id").agg(F.min(F.struct("dist", "region_pos", "region_id")).alias("m"))
    return best.select("page_id", "line_id", "m.region_id", "m.dist")


def assign_regions(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, line_id, region_id, how (overlap, nearest, none) of every line; one join and one aggregation do both
    rules: a pair ranks by its IoU, then by its distance, then by the region's place."""
    a, b = F.col("a"), F.col("b")
    ranked = _pairs(lines, regions).select("page_id", "line_id", "region_id", "region_pos", F.coalesce(G.box_iou(a, b), F.lit(0.0)).alias("iou"), G.box_distance(a, b).alias("dist"))
    best = ranked.filter((F.col("iou") > 0) | (F.col("dist") < FAR)).groupBy("page_id", "line_id").agg(
        F.max(F.struct("iou", F.when(F.col("iou") > 0, 0.0).otherwise(-F.col("dist")).alias("d"), (-F.col("region_pos")).alias("p"), "region_id")).alias("m")
    )
    how = F.when(F.col("m").isNull(), "none").when(F.col("m.iou") > 0, "overlap").otherwise("nearest")
    return lines.select("page_id", "line_id").join(best, ["page_id", "line_id"], "left").select("page_id", "line_id", "m.region_id", how.alias("how"))


def default_regions(pages: DataFrame, regions: DataFrame, compat: bool = False) -> DataFrame:
    """A whole-page region, named paragraph, of confidence 0, for each page without one: page_id, region_id, name, conf, x0,
    y0, x1, y1.  ``compat`` has the axes exchanged."""
    x, y = ("height", "width") if compat else ("width", "height")
    return pages.join(regions.select("page_id"), "page_id", "left_anti").select("page_id", F.lit("0").alias("region_id"), F.lit("paragraph").alias("name"), F.lit(0.0).alias("conf"), F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.col(x).alias("x1"), F.col(y).alias("y1"))


def with_default_regions(lines: DataFrame, regions: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, region_id, region_pos, box: the regions, and a whole-page region for each page with lines but without one,
    so that its lines find it.  pages: page_id, width, height."""
    whole = default_regions(pages.join(lines.select("page_id"), "page_id", "left_semi"), regions)
    return regions.select("page_id", "region_id", "region_pos", "box").unionByName(whole.select("page_id", "region_id", F.lit(0).alias("region_pos"), G.box("x0", "y0", "x1", "y1").alias("box")))


def region_lines(assigned: DataFrame, regions: DataFrame) -> DataFrame:
    """Regions with their lines: page_id, region_id, region_pos, line_id; regions and lines without the other are out."""
    return regions.select("page_id", "region_id", "region_pos").join(assigned.filter("region_id is not null").select("page_id", "region_id", "line_id"), ["page_id", "region_id"])


def used_regions(assigned: DataFrame, regions: DataFrame) -> DataFrame:
    return regions.select("page_id", "region_id", "region_pos").join(assigned.select("page_id", "region_id"), ["page_id", "region_id"], "left_semi")
