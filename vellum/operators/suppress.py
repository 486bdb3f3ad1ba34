"""Greedy suppression and merging of overlapping detections, page by page.

Rows: page_id, det_id, class_id, confidence, box.  Rows without a box or confidence are dropped.  Ties in
confidence keep the smaller det_id.  A page's detections are bounded by what a detector puts out for one image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import geometry as G
from vellum.functions.arrow import groups, map_rows


def nms(found: DataFrame, threshold: float, metric: str = "iou", agnostic: bool = False) -> DataFrame:
    """page_id, det_id, class_id, confidence of the detections that no kept, surer one overlaps by more than
    ``threshold``; per class unless ``agnostic``.  One shuffle, then a fold over the page's sorted detections."""
    overlap = G.box_iou if metric == "iou" else G.box_ios
    keys = ["page_id"] if agnostic else ["page_id", "class_id"]
    item = F.struct((-F.col("confidence")).alias("o"), "det_id", F.col("class_id").alias("c"), F.col("box").alias("b"))
    per = found.filter("box is not null and confidence is not null").groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("all"))
    none = F.slice("all", 1, 0)
    kept = F.aggregate("all", none, lambda acc, d: F.when(F.exists(acc, lambda k: overlap(k["b"], d["b"]) > threshold), acc).otherwise(F.concat(acc, F.array(d))))
    return per.select("page_id", F.explode(kept).alias("k")).select("page_id", "k.det_id", F.col("k.c").alias("class_id"), (-F.col("k.o")).alias("confidence"))


def _iou(a, b) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    i = max(0, w) * max(0, h)
    u = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i
    return i / u if u > 0 else 0.0


def nmm(found: DataFrame, threshold: float) -> DataFrame:
    """Non-maximum merge: instead of dropping a detection that a surer one overlaps, its box is joined to that one's.
    page_id, det_id, class_id, confidence, x0, y0, x1, y1, merged (how many went in)."""
    ddl = "page_id BIGINT, det_id INT, class_id INT, confidence DOUBLE, x0 INT, y0 INT, x1 INT, y1 INT, merged INT"

    def rows(batches):
        for page, of in groups(batches, "page_id"):
            left = sorted(of, key=lambda r: (-r[3], r[1]))
            while left:
                _, det, cls, conf, *box = left[0]
                merged, rest = 1, []
                for r in left[1:]:
                    if r[2] == cls and _iou(box, r[4:]) > threshold:
                        box = [min(box[0], r[4]), min(box[1], r[5]), max(box[2], r[6]), max(box[3], r[7])]
                        merged += 1
                    else:
                        rest.append(r)
                yield page, det, cls, conf, *box, merged
                left = rest

    flat = found.filter("box is not null and confidence is not null").select("page_id", "det_id", "class_id", "confidence", "box.x_min", "box.y_min", "box.x_max", "box.y_max")
    return flat.repartition("page_id").sortWithinPartitions("page_id", "det_id").mapInArrow(map_rows(rows, ddl), ddl)
