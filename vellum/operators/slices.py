"""Detection in overlapping tiles of large images, and the merging of what the tiles found.

Each image is cut, searched and merged where it is decoded; only detections leave the worker.  A model takes a list of
images and a threshold and gives, for each image, a list of (class_id, confidence, mask)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from vellum.functions import raster
from vellum.operators.models import DETECTIONS
from vellum.operators.tiling import check_tiles

MASK_SIDE = 128  # masks are compared at this size
FILTERS = ("none", "nms", "nmm")


def starts(size: int, tile: int, overlap: int) -> list[int]:
    """Starts of the tiles along one axis, as ``tiling.axis_starts`` has them."""
    if size <= tile:
        return [0]
    step, last = tile - overlap, size - tile
    return list(range(0, size, step)) if not overlap else [*range(0, last, step), last]


def shrunk(mask: np.ndarray, side: int = MASK_SIDE) -> np.ndarray:
    """A mask at ``side`` x ``side``, by nearest pixels, flat."""
    h, w = mask.shape
    return mask[np.arange(side) * h // side][:, np.arange(side) * w // side].reshape(-1)


def overlaps(masks: np.ndarray, metric: str = "iou") -> np.ndarray:
    """Matrix of the overlaps of flat masks, by union (iou) or by the smaller one (ios); 0 for empty masks."""
    m = masks.astype(np.float64)
    common, size = m @ m.T, m.sum(axis=1)
    whole = np.add.outer(size, size) - common if metric == "iou" else np.minimum.outer(size, size)
    return np.divide(common, whole, out=np.zeros_like(common), where=whole > 0)


def merged(found: list[tuple[int, float, np.ndarray]], how: str, threshold: float, metric: str = "iou") -> list[tuple[int, float, np.ndarray]]:
    """Detections (class, confidence, mask) of one image after ``how``: none; nms, which drops what a kept, surer one of
    its class overlaps by more than ``threshold``; nmm, which joins it to that one.  Ties keep the earlier."""
    if how == "none" or not found:
        return found
    over = overlaps(np.array([shrunk(m) for _, _, m in found]), metric)
    left = sorted(range(len(found)), key=lambda k: (-found[k][1], k))
    out = []
    while left:
        k, cls = left[0], found[left[0]][0]
        same = [j for j in left[1:] if found[j][0] == cls and over[k, j] > threshold]
        mask = np.logical_or.reduce([found[j][2] for j in (k, *same)]) if how == "nmm" else found[k][2]
        out.append((cls, found[k][1], mask))
        gone = {k, *same}
        left = [j for j in left if j not in gone]
    return out


def search(image: np.ndarray, model: Callable, threshold: float, tile: int, overlap: int, batch: int, how: str, most: float, metric: str = "iou") -> list[tuple[int, float, np.ndarray]]:
    """Detections of one image: its tiles, ``batch`` at a time - the last batch filled up with its first tile -, moved to
    their place and merged."""
    h, w = image.shape[:2]
    grid = [(y, x) for y in starts(h, tile, overlap) for x in starts(w, tile, overlap)]
    found = []
    for a in range(0, len(grid), batch):
        crops = [image[y : y + tile, x : x + tile] for y, x in grid[a : a + batch]]
        answers = model([*crops, *[crops[0]] * (batch - len(crops))], threshold)
        for (y, x), crop, answer in zip(grid[a : a + batch], crops, answers):
            for cls, conf, mask in answer:
                whole = np.zeros((h, w), dtype=bool)
                whole[y : y + crop.shape[0], x : x + crop.shape[1]] = mask
                found.append((int(cls), float(conf), whole))
    return merged(found, how, most, metric)


def detect_sliced(images: DataFrame, provider: Callable[[], Callable], threshold: float, tile: int, overlap: int, across: int, batch: int = 6, how: str = "nms", most: float = 0.85, metric: str = "iou") -> DataFrame:
    """DETECTIONS of images (page_id, content), whose shorter side is brought down to ``across`` tiles first; an image that
    fails is one row with an error."""
    import pandas as pd

    check_tiles((tile, tile), (overlap, overlap), batch)
    if how not in FILTERS:
        raise ValueError(f"{how}: one of {', '.join(FILTERS)} is needed")
    side = tile * across - overlap

    def run(batches):
        model = provider()
        names = [x.split()[0] for x in ("page_id", "det_id", "class_id", "confidence", "x0", "y0", "x1", "y1", "mask_h", "mask_w", "mask_runs", "error")]
        for pdf in batches:
            for page, content in zip(pdf["page_id"], pdf["content"]):
                out = []
                try:
                    px = raster.decode(bytes(content))
                    scale = min(1.0, side / min(px.shape[:2]))
                    small = raster.resize(px, *(max(1, int(np.rint(n * scale))) for n in px.shape[:2]))
                    found = search(small, model, threshold, tile, overlap, batch, how, most, metric)
                    for k, (cls, conf, mask) in enumerate(d for d in found if d[1] >= threshold):
                        ys, xs = np.nonzero(mask)
                        box = (int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1) if len(xs) else (0, 0, 0, 0)
                        out.append((page, k, cls, conf, *box, *mask.shape, [{"y": y, "x0": a, "x1": b} for y, a, b in raster.runs_of(mask)], None))
                except Exception as e:  # noqa: BLE001 - the error is the row's result
                    out = [(page, *[None] * 10, str(e)[:200])]
                yield pd.DataFrame(out, columns=names)

    return images.select("page_id", "content").mapInPandas(run, DETECTIONS)
