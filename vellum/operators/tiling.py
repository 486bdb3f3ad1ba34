"""Tile grids over images, and detections moved from tiles to images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_tiles(slice_wh: tuple[int, int], overlap_wh: tuple[int, int], batch: int = 1) -> None:
    """ValueError unless slices are positive, overlaps are at least 0 and under the slice, and the batch holds one."""
    for s, o in zip(slice_wh, overlap_wh):
        if s <= 0 or o < 0 or o >= s:
            raise ValueError(f"tile of {s} with overlap {o}: 0 <= overlap < tile is needed")
    if batch < 1:
        raise ValueError("a batch holds at least one tile")


def axis_starts(size: Column, slice_: int, overlap: int) -> Column:
    """Starts of the tiles along one axis; with an overlap the last tile is moved inward, without one it is clipped."""
    step = slice_ - overlap
    if overlap == 0:
        return F.when(size <= slice_, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - 1, F.lit(step)))
    last = size - slice_
    before = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step)), lambda s: s < last)
    return F.when(size <= slice_, F.array(F.lit(0))).otherwise(F.concat(before, F.array(last)))


def tile_grid(images: DataFrame, slice_wh: tuple[int, int], overlap_wh: tuple[int, int]) -> DataFrame:
    """page_id, tile_id, x0, y0, x1, y1 of images (page_id, height, width), row by row; images without a size or of
    size 0 have no tile."""
    check_tiles(slice_wh, overlap_wh)
    sized = images.filter("width > 0 and height > 0")
    grid = sized.select("page_id", "width", "height", F.posexplode(axis_starts(F.col("height"), slice_wh[1], overlap_wh[1])).alias("iy", "y0"), axis_starts(F.col("width"), slice_wh[0], overlap_wh[0]).alias("xs"))
    tiles = grid.select("page_id", "width", "height", "iy", "y0", F.size("xs").alias("nx"), F.posexplode("xs").alias("ix", "x0"))
    return tiles.select("page_id", (F.col("iy") * F.col("nx") + F.col("ix")).cast("int").alias("tile_id"), "x0", "y0", F.least(F.col("x0") + slice_wh[0], "width").alias("x1"), F.least(F.col("y0") + slice_wh[1], "height").alias("y1"))


def move_detections(found: DataFrame, dx: str = "dx", dy: str = "dy", runs: str | None = None) -> DataFrame:
    """Boxes (x0, y0, x1, y1) and, if named, mask runs (y, x0, x1) moved by the tile's offset."""
    out = found.withColumns({c: F.col(c) + F.col(dx if c[0] == "x" else dy) for c in ("x0", "y0", "x1", "y1")})
    if runs:
        out = out.withColumn(runs, F.transform(runs, lambda r: F.struct((r["y"] + F.col(dy)).alias("y"), (r["x0"] + F.col(dx)).alias("x0"), (r["x1"] + F.col(dx)).alias("x1"))))
    return out


def resize_longer(h: Column, w: Column, most: int) -> tuple[Column, Column]:
    """Height and width after bringing the longer side down to ``most``; smaller images keep theirs."""
    scale = F.least(F.lit(float(most)) / h, F.lit(float(most)) / w)
    big = (h > most) | (w > most)
    return F.when(big, F.floor(h * scale).cast("int")).otherwise(h), F.when(big, F.floor(w * scale).cast("int")).otherwise(w)


def resize_shorter(h: Column, w: Column, most: int) -> tuple[Column, Column]:
    """Height and width after bringing the shorter side down to ``most``, rounded half to even."""
    scale = F.lit(float(most)) / F.least(h, w)
    big = F.least(h, w) > most
    return F.when(big, F.rint(h * scale).cast("int")).otherwise(h), F.when(big, F.rint(w * scale).cast("int")).otherwise(w)
