"""Geometry of boxes and polygons as column expressions.

A box is a struct column with x_min, y_min, x_max, y_max; a polygon an array of structs x, y.  NULL in, NULL out,
unless said otherwise; degenerate boxes have area 0 and ratios 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x_min, y_min, x_max, y_max) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in ((x_min, "x_min"), (y_min, "y_min"), (x_max, "x_max"), (y_max, "y_max"))])


def width(b: Column) -> Column:
    return b["x_max"] - b["x_min"]


def height(b: Column) -> Column:
    return b["y_max"] - b["y_min"]


def box_area(b: Column) -> Column:
    return width(b).cast("double") * height(b)


def intersects(a: Column, b: Column) -> Column:
    """Whether two boxes have a point in common; touching counts."""
    return (a["x_min"] <= b["x_max"]) & (b["x_min"] <= a["x_max"]) & (a["y_min"] <= b["y_max"]) & (b["y_min"] <= a["y_max"])


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["x_max"], b["x_max"]) - F.greatest(a["x_min"], b["x_min"])
    h = F.least(a["y_max"], b["y_max"]) - F.greatest(a["y_min"], b["y_min"])
    # greatest and least pass NULLs over
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(w, F.lit(0)).cast("double") * F.greatest(h, F.lit(0)))


def ratio(a: Column, b: Column) -> Column:
    """a / b; 0 where b isn't positive, NULL where it is NULL."""
    return F.when(b > 0, a / b).when(b.isNotNull(), F.lit(0.0))


def box_iou(a: Column, b: Column) -> Column:
    i = intersection_area(a, b)
    return ratio(i, box_area(a) + box_area(b) - i)


def box_ios(a: Column, b: Column) -> Column:
    """Intersection over the smaller area."""
    return ratio(intersection_area(a, b), F.least(box_area(a), box_area(b)))


def interval_iou(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Common length over the length of the hull of two intervals; 0 if the hull has none."""
    return ratio(F.greatest(F.least(a2, b2) - F.greatest(a1, b1), F.lit(0)).cast("double"), (F.greatest(a2, b2) - F.least(a1, b1)).cast("double"))


def iou_y(a: Column, b: Column) -> Column:
    """``interval_iou`` of the y extents; 0.5 if either box is NULL."""
    return F.when(a.isNull() | b.isNull(), F.lit(0.5)).otherwise(interval_iou(a["y_min"], a["y_max"], b["y_min"], b["y_max"]))


def iou_x(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), F.lit(0.5)).otherwise(interval_iou(a["x_min"], a["x_max"], b["x_min"], b["x_max"]))


def box_distance(a: Column, b: Column) -> Column:
    dx = F.greatest(F.lit(0), a["x_min"] - b["x_max"], b["x_min"] - a["x_max"]).cast("double")
    dy = F.greatest(F.lit(0), a["y_min"] - b["y_max"], b["y_min"] - a["y_max"]).cast("double")
    return F.when(a.isNotNull() & b.isNotNull(), F.sqrt(dx * dx + dy * dy))


def bbox(pts: Column) -> Column:
    """Bounding box of a polygon; NULL without points."""
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.when(F.size(pts) > 0, F.struct(F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max")))


def valid(pts: Column) -> Column:
    """The polygon, or NULL if it has under three points."""
    return F.when(F.size(pts) >= 3, pts)


def shoelace(pts: Column) -> Column:
    """Area of a simple polygon; 0 with under three points."""
    nxt = F.concat(F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, 1, 1))
    cross = F.transform(F.arrays_zip(pts.alias("a"), nxt.alias("b")), lambda e: e["a"]["x"].cast("double") * e["b"]["y"] - e["b"]["x"].cast("double") * e["a"]["y"])
    return F.when(pts.isNull(), None).when(F.size(pts) < 3, F.lit(0.0)).otherwise(0.5 * F.abs(F.aggregate(cross, F.lit(0.0), lambda s, c: s + c)))


def scale_points(pts: Column, sx: Column, sy: Column) -> Column:
    """Vertices scaled and rounded half to even."""
    return F.transform(pts, lambda p: F.struct(F.rint(p["x"] * sx).cast("int").alias("x"), F.rint(p["y"] * sy).cast("int").alias("y")))


def points_text(pts: Column, trailing: bool = False) -> Column:
    """'x,y x,y', coordinates truncated; with a trailing blank if asked for."""
    text = F.array_join(F.transform(pts, lambda p: F.concat(p["x"].cast("int").cast("string"), F.lit(","), p["y"].cast("int").cast("string"))), " ")
    return F.concat(text, F.lit(" ")) if trailing else text
