"""The places where models plug in: a detector and a recogniser, made once per Python worker.

A provider is a function without arguments that gives the model; it is called on the executor.  A detector takes
an image (height, width, 3) and a threshold and gives (class_id, confidence, mask) triples; a recogniser takes a list of
images and gives (text, log score) pairs.  A detections table can stand in for a detector."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from vellum.functions import raster

LINE_CLASS, REGION_CLASS = 2, 1
DETECTIONS = "page_id BIGINT, det_id INT, class_id INT, confidence DOUBLE, x0 INT, y0 INT, x1 INT, y1 INT, mask_h INT, mask_w INT, mask_runs ARRAY<STRUCT<y: INT, x0: INT, x1: INT>>, error STRING"
POLYGONS = "page_id BIGINT, det_id INT, poly_id INT, kind STRING, pts ARRAY<STRUCT<x: INT, y: INT>>, conf DOUBLE, area_fraction DOUBLE"


def detect(images: DataFrame, provider: Callable[[], Callable], threshold: float = 0.15, max_size: int = 768) -> DataFrame:
    """Detections of images (page_id, content): DETECTIONS; an image that fails is one row with an error."""
    import pandas as pd

    def run(batches):
        model = provider()
        for pdf in batches:
            out = []
            for page, content in zip(pdf["page_id"], pdf["content"]):
                try:
                    px = raster.decode(bytes(content))
                    h, w = px.shape[:2]
                    scale = min(1.0, max_size / max(h, w))
                    small = raster.resize(px, max(1, int(h * scale)), max(1, int(w * scale)))
                    for k, (cls, conf, mask) in enumerate(d for d in model(small, threshold) if d[1] >= threshold):
                        ys, xs = np.nonzero(mask)
                        box = (int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1) if len(xs) else (0, 0, 0, 0)
                        runs = [{"y": y, "x0": a, "x1": b} for y, a, b in raster.runs_of(mask)]
                        out.append((page, k, int(cls), float(conf), *box, mask.shape[0], mask.shape[1], runs, None))
                except Exception as e:  # noqa: BLE001 - the error is the row's result
                    out.append((page, *[None] * 10, str(e)[:200]))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ("page_id", "det_id", "class_id", "confidence", "x0", "y0", "x1", "y1", "mask_h", "mask_w", "mask_runs", "error")])

    return images.select("page_id", "content").mapInPandas(run, DETECTIONS)


def mask_polygons(detections: DataFrame) -> DataFrame:
    """POLYGONS of detections joined with their image's height and width: one row per outer contour of a mask, scaled to the
    image, with the share of the mask's area its contour encloses; class 2 and up are lines, 1 regions, 0 is left out."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                mask = raster.mask_of([(q["y"], q["x0"], q["x1"]) for q in r.mask_runs], r.mask_h, r.mask_w)
                scale = (r.width / r.mask_w, r.height / r.mask_h)
                for k, ring in enumerate(raster.contours(mask)):
                    pts = [{"x": int(np.rint(x * scale[0])), "y": int(np.rint(y * scale[1]))} for x, y in ring]
                    out.append((r.page_id, r.det_id, k, "line" if r.class_id >= LINE_CLASS else "region", pts, r.confidence, raster.area(ring) / (r.mask_h * r.mask_w)))
            yield pd.DataFrame(out, columns=["page_id", "det_id", "poly_id", "kind", "pts", "conf", "area_fraction"])

    return detections.filter("error is null and class_id >= 1 and mask_h > 0 and mask_w > 0").select("page_id", "det_id", "class_id", "confidence", "mask_h", "mask_w", "mask_runs", "height", "width").mapInPandas(run, POLYGONS)


def recognise(lines: DataFrame, provider: Callable[[], Callable], batch: int = 8) -> DataFrame:
    """page_id, line_pos, text, text_conf of lines (page_id, line_pos, polygon, content), ``batch`` crops at a time; a line
    without an outline of three points or with an unreadable image has a NULL text and confidence 0."""
    import pandas as pd

    def run(batches):
        model = provider()
        for pdf in batches:
            crops, at, out = [], [], [[p, i, None, 0.0] for p, i in zip(pdf["page_id"], pdf["line_pos"])]
            for k, (pts, content) in enumerate(zip(pdf["polygon"], pdf["content"])):
                try:
                    ring = [(p["x"], p["y"]) for p in pts]
                    if len(ring) >= 3:
                        crops.append(raster.crop_polygon(raster.decode(bytes(content)), ring))
                        at.append(k)
                except Exception:  # noqa: BLE001 - the line stays without a text
                    continue
            for a in range(0, len(crops), batch):
                for k, (text, score) in zip(at[a : a + batch], model(crops[a : a + batch])):
                    out[k][2:] = [text, math.exp(score)]
            yield pd.DataFrame(out, columns=["page_id", "line_pos", "text", "text_conf"])

    return lines.select("page_id", "line_pos", "polygon", "content").mapInPandas(run, "page_id BIGINT, line_pos INT, text STRING, text_conf DOUBLE")


def sizes(images: DataFrame) -> DataFrame:
    """page_id, height, width of images (page_id, content); NULL for one that can't be decoded."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            out = []
            for page, content in zip(pdf["page_id"], pdf["content"]):
                try:
                    out.append((page, *raster.decode(bytes(content)).shape[:2]))
                except Exception:  # noqa: BLE001 - the image has no size
                    out.append((page, None, None))
            yield pd.DataFrame(out, columns=["page_id", "height", "width"]).astype({"height": "Int32", "width": "Int32"})

    return images.select("page_id", "content").mapInPandas(run, "page_id BIGINT, height INT, width INT")


def recognise_pages(pages: DataFrame, provider: Callable[[], Callable], batch: int = 8) -> DataFrame:
    """As ``recognise``, of pages (page_id, content, lines: array of line_pos and polygon): an image is joined, sent and
    decoded once for all its lines."""
    import pandas as pd

    def run(batches):
        model = provider()
        for pdf in batches:
            for page, content, lines in zip(pdf["page_id"], pdf["content"], pdf["lines"]):
                out = [[page, x["line_pos"], None, 0.0] for x in lines]
                try:
                    image = raster.decode(bytes(content))
                except Exception:  # noqa: BLE001 - the lines stay without texts
                    image = None
                rings = [[(p["x"], p["y"]) for p in x["polygon"]] if x["polygon"] is not None else [] for x in lines]
                at = [k for k, ring in enumerate(rings) if image is not None and len(ring) >= 3]
                for a in range(0, len(at), batch):
                    some = at[a : a + batch]
                    for k, (text, score) in zip(some, model([raster.crop_polygon(image, rings[k]) for k in some])):
                        out[k][2:] = [text, math.exp(score)]
                yield pd.DataFrame(out, columns=["page_id", "line_pos", "text", "text_conf"])

    return pages.select("page_id", "content", "lines").mapInPandas(run, "page_id BIGINT, line_pos INT, text STRING, text_conf DOUBLE")
