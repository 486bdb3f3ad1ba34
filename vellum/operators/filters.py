"""Filters of detections and their outlines, by confidence, class, size and shape.

Rows: page_id, det_id, class_id, confidence, box; width and height are those of the row's page.  NULLs pass no filter;
a page without a size has no row in those that need one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import geometry as G
from vellum.operators.models import LINE_CLASS, REGION_CLASS


def confident(found: DataFrame, threshold: float) -> DataFrame:
    """Rows surer than ``threshold``."""
    return found.filter(F.col("confidence") > threshold)


def split_classes(found: DataFrame) -> DataFrame:
    """Adds kind: region for the region class, line for all above it; classes below are left out."""
    return found.filter(F.col("class_id") >= REGION_CLASS).withColumn("kind", F.when(F.col("class_id") >= LINE_CLASS, "line").otherwise("region"))


def large_enough(found: DataFrame, share: float) -> DataFrame:
    """Adds area_fraction, the box's share of the page; rows above ``share`` stay."""
    page = F.col("width").cast("double") * F.col("height")
    return found.withColumn("area_fraction", G.ratio(G.box_area(F.col("box")), page)).filter(F.col("area_fraction") > share)


def no_slivers(found: DataFrame, share: float = 0.01) -> DataFrame:
    """Rows whose box's shorter side is more than ``share`` of the page's shorter side."""
    box = F.col("box")
    return found.filter(F.least(G.width(box), G.height(box)) > share * F.least("width", "height"))


def enough_points(outlines: DataFrame, column: str = "pts", least: int = 3) -> DataFrame:
    """Rows whose outline has ``least`` points or more."""
    return outlines.filter(F.size(column) >= least)
