"""Overlap joins within a page and the merging of what overlaps.

Rows: page_id, det_id, box (and confidence).  Rows without a box take no part in edges; they are components of their
own in no result.  Joins are equi-joins on the page with the box test as residual; pages are the unit of work."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import geometry as G
from vellum.functions.arrow import groups, map_rows


def pairs(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """All pairs i < j of a page whose boxes meet: keys, i, j, a (box of i), b (box of j)."""
    a = boxes.filter("box is not null").select(*keys, F.col("det_id").alias("i"), F.col("box").alias("a"))
    b = a.select(*keys, F.col("i").alias("j"), F.col("a").alias("b"))
    return a.join(b, keys).filter((F.col("i") < F.col("j")) & G.intersects(F.col("a"), F.col("b")))


def overlap_edges(boxes: DataFrame, iou: float, overlap: float | None, vertical: bool = True, keys: list[str] | None = None) -> DataFrame:
    """keys, i, j, why: pairs to merge, by IoU, else by the share of the smaller box; both weighted by how far the y
    extents agree if ``vertical``."""
    keys = keys or ["page_id"]
    a, b = F.col("a"), F.col("b")
    weight = G.iou_y(a, b) if vertical else F.lit(1.0)
    by_iou = G.box_iou(a, b) * weight > iou
    by_share = (G.box_ios(a, b) * weight > overlap) if overlap else F.lit(False)
    return pairs(boxes, keys).filter(by_iou | by_share).select(*keys, "i", "j", F.when(by_iou, "iou").otherwise("share").alias("why"))


def components(boxes: DataFrame, edges: DataFrame) -> DataFrame:
    """page_id, det_id, root: the smallest det_id that a box is linked to.  A page's boxes and edges come together in
    one sorted stream, so that no page waits for another."""
    ddl = "page_id BIGINT, det_id INT, root INT"

    def rows(batches):
        for page, of in groups(batches, "page_id"):
            parent = {i: i for _, i, j in of if j is None}

            def find(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for _, i, j in of:
                if j is not None and i in parent and j in parent:
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
            for i in parent:
                yield page, i, find(i)

    nodes = boxes.filter("box is not null").select("page_id", F.col("det_id").alias("i"), F.lit(None).cast("int").alias("j"))
    both = nodes.unionByName(edges.select("page_id", "i", "j"))
    return both.repartition("page_id").sortWithinPartitions("page_id", "i", "j").mapInArrow(map_rows(rows, ddl), ddl)


def component_mapping(boxes: DataFrame, comps: DataFrame) -> DataFrame:
    """page_id, det_id, out_id: the position of each box's component among the page's outputs; -1 without a box."""
    w = Window.partitionBy("page_id").orderBy("root")
    ranked = comps.withColumn("out_id", F.dense_rank().over(w) - 1)
    return boxes.select("page_id", "det_id").join(ranked.select("page_id", "det_id", "out_id"), ["page_id", "det_id"], "left").select("page_id", "det_id", F.coalesce("out_id", F.lit(-1)).alias("out_id"))


def component_confidence(boxes: DataFrame, mapping: DataFrame, compat: bool = False) -> DataFrame:
    """Mean confidence of each output's members: page_id, out_id, confidence.  ``compat``: page_id, det_id, confidence,
    the value at input position out_id, as one of the pipelines in use computes it (-1 takes the last)."""
    both = boxes.select("page_id", "det_id", "confidence").join(mapping, ["page_id", "det_id"])
    if not compat:
        return both.filter("out_id >= 0").groupBy("page_id", "out_id").agg(F.avg("confidence").alias("confidence"))
    last = boxes.groupBy("page_id").agg(F.max("det_id").alias("last"))
    at = mapping.join(last, "page_id").select("page_id", "det_id", F.when(F.col("out_id") < 0, F.col("last")).otherwise(F.col("out_id")).alias("at"))
    return at.join(boxes.select("page_id", F.col("det_id").alias("at"), "confidence"), ["page_id", "at"]).select("page_id", "det_id", "confidence")


def dissolve_hull(boxes: DataFrame, comps: DataFrame) -> DataFrame:
    """page_id, root, x0, y0, x1, y1, members: the bounding box of each component."""
    both = boxes.select("page_id", "det_id", "box").join(comps, ["page_id", "det_id"])
    return both.groupBy("page_id", "root").agg(F.min("box.x_min").alias("x0"), F.min("box.y_min").alias("y0"), F.max("box.x_max").alias("x1"), F.max("box.y_max").alias("y1"), F.count("*").alias("members"))


def dissolve_polygon(boxes: DataFrame, comps: DataFrame) -> DataFrame:
    """page_id, root, part, points, area: the outer rings of the union of each component's boxes, holes dropped; points
    as 'x,y x,y', area that of the ring.  A single box keeps its corners."""
    from vellum.functions.raster import union_of_boxes

    ddl = "page_id BIGINT, root INT, part INT, points STRING, area DOUBLE"

    def rows(batches):
        for page, of in groups(batches, "page_id"):
            by: dict[int, list] = {}
            for _, root, *b in of:
                by.setdefault(root, []).append(tuple(b))
            for root, bs in by.items():
                for part, (ring, area) in enumerate(union_of_boxes(bs)):
                    yield page, root, part, " ".join(f"{x},{y}" for x, y in ring), area

    both = boxes.select("page_id", "det_id", "box").join(comps, ["page_id", "det_id"]).select("page_id", "root", "box.x_min", "box.y_min", "box.x_max", "box.y_max")
    return both.repartition("page_id").sortWithinPartitions("page_id", "root", "x_min", "y_min", "x_max", "y_max").mapInArrow(map_rows(rows, ddl), ddl)
