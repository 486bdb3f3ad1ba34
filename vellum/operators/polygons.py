"""Overlap, assignment and merging by the outlines themselves.

Rows: page_id, an id, pts (array of points), box (the outline's bounding box).  Pairs are found by an equi-join on the page
with the boxes as a first test; only pairs whose boxes meet reach Python, in Arrow batches.  Self-crossing outlines count by
the even-odd rule; outlines under three points take no part."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import geometry as G
from vellum.functions import raster
from vellum.functions.arrow import groups
from vellum.operators import assign


def _ring(points) -> list[tuple[int, int]]:
    return [(p["x"], p["y"]) for p in points]


def _measured(pairs: DataFrame, measure, names: list[str]) -> DataFrame:
    """``pairs`` with what ``measure`` gives for the outlines p and q, which are left out."""
    kept = [c for c in pairs.columns if c not in ("p", "q")]
    schema = T.StructType([*(pairs.schema[c] for c in kept), *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches):
        for batch in batches:
            values = [measure(_ring(p), _ring(q)) for p, q in zip(batch.column("p").to_pylist(), batch.column("q").to_pylist())]
            columns = zip(*values) if values else [()] * len(names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, type=pa.float64()) for c in columns)], names=[*kept, *names])

    return pairs.mapInArrow(run, schema)


def _overlap(p, q) -> tuple[float, float]:
    i, a, b = raster.intersection_area(p, q), raster.even_odd_area(p), raster.even_odd_area(q)
    return (i / (a + b - i) if a + b > i else 0.0, i / min(a, b) if min(a, b) > 0 else 0.0)


def boxed(outlines: DataFrame) -> DataFrame:
    """Outlines of three points or more with their box."""
    return outlines.filter(F.size("pts") >= 3).withColumn("box", G.bbox(F.col("pts")))


def overlap_edges(outlines: DataFrame, iou: float, share: float | None, vertical: bool = True) -> DataFrame:
    """page_id, i, j: pairs of ``boxed`` outlines (page_id, det_id, pts, box) to merge, by IoU, else by the share of the
    smaller one; both weighted by how far their heights agree if ``vertical``."""
    a = outlines.select("page_id", F.col("det_id").alias("i"), F.col("pts").alias("p"), F.col("box").alias("a"))
    b = outlines.select("page_id", F.col("det_id").alias("j"), F.col("pts").alias("q"), F.col("box").alias("b"))
    u, v = F.col("a"), F.col("b")
    near = a.join(b, "page_id").filter((F.col("i") < F.col("j")) & G.intersects(u, v))
    near = near.select("page_id", "i", "j", "p", "q", (G.iou_y(u, v) if vertical else F.lit(1.0)).alias("weight"))
    # no overlap passes a threshold that its weight alone stays under
    near = near.filter(F.col("weight") > min(iou, share or iou))
    found = _measured(near, _overlap, ["iou", "share"])
    by_share = F.col("share") * F.col("weight") > share if share else F.lit(False)
    return found.filter((F.col("iou") * F.col("weight") > iou) | by_share).select("page_id", "i", "j")


def assign_regions(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """page_id, line_id, region_id, how of every line: the region its outline overlaps most, else the nearest.

    lines: page_id, line_id, pts, box; regions: page_id, region_id, region_pos, pts, box.  The distance is measured only
    for lines that no region overlaps."""
    a = lines.select("page_id", "line_id", F.col("pts").alias("p"), F.col("box").alias("a"))
    b = regions.select("page_id", "region_id", "region_pos", F.col("pts").alias("q"), F.col("box").alias("b"))
    pairs = a.join(b, "page_id")
    meet = pairs.filter(G.intersects(F.col("a"), F.col("b"))).drop("a", "b")
    over = _measured(meet, _overlap, ["iou", "share"]).filter("iou > 0")
    best = over.groupBy("page_id", "line_id").agg(F.max(F.struct("iou", (-F.col("region_pos")).alias("p"), "region_id")).alias("m")).select("page_id", "line_id", "m.region_id", F.lit("overlap").alias("how"))
    rest = pairs.drop("a", "b").join(best, ["page_id", "line_id"], "left_anti")
    far = _measured(rest, lambda p, q: (raster.distance(p, q),), ["dist"]).filter(F.col("dist") < assign.FAR)
    near = far.groupBy("page_id", "line_id").agg(F.min(F.struct("dist", "region_pos", "region_id")).alias("m")).select("page_id", "line_id", "m.region_id", F.lit("nearest").alias("how"))
    found = best.unionByName(near)
    return lines.select("page_id", "line_id").join(found, ["page_id", "line_id"], "left").select("page_id", "line_id", "region_id", F.coalesce("how", F.lit("none")).alias("how"))


def union_rings(rings: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Outer rings of the union of outlines, to the pixel: the outlines are filled, rows through pixel centres, and the fill's
    outer contours followed."""
    flat = [p for r in rings for p in r]
    x0, y0 = min(x for x, _ in flat), min(y for _, y in flat)
    w, h = max(x for x, _ in flat) - x0 + 1, max(y for _, y in flat) - y0 + 1
    mask = np.zeros((h, w), dtype=bool)
    for ring in rings:
        low, high = min(y for _, y in ring), max(y for _, y in ring)
        for y, xs in zip(range(low, high), raster._cover(ring, np.arange(low, high) + 0.5)):
            for a, b in zip(xs[::2], xs[1::2]):
                mask[y - y0, int(np.ceil(a - 0.5)) - x0 : int(np.floor(b - 0.5)) + 1 - x0] = True
    return [[(x + x0, y + y0) for x, y in ring] for ring in raster.contours(mask)]


def dissolve(outlines: DataFrame, components: DataFrame) -> DataFrame:
    """page_id, out_id, pts, conf: each component's outline - the one outline as it is, or the rings of the union, each an
    output - and the mean confidence of its members, in the order of their first member.

    outlines: page_id, det_id, pts, conf; components: page_id, det_id, root."""
    ddl = "page_id BIGINT, out_id INT, pts ARRAY<STRUCT<x: INT, y: INT>>, conf DOUBLE"
    schema = pa.schema([("page_id", pa.int64()), ("out_id", pa.int32()), ("pts", pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32())]))), ("conf", pa.float64())])

    def run(batches):
        for page, rows in groups(batches, "page_id"):
            by: dict[int, list] = {}
            for _, root, _, pts, conf in rows:
                by.setdefault(root, []).append((_ring(pts), conf))
            out = []
            for members in by.values():
                known = [c for _, c in members if c is not None]
                for ring in [members[0][0]] if len(members) == 1 else union_rings([r for r, _ in members]):
                    out.append((page, len(out), [{"x": x, "y": y} for x, y in ring], sum(known) / len(known) if known else None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    both = outlines.join(components, ["page_id", "det_id"]).select("page_id", "root", "det_id", "pts", "conf")
    return both.repartition("page_id").sortWithinPartitions("page_id", "root", "det_id").mapInArrow(run, ddl)


