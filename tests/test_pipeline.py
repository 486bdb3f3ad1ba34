"""The whole pipeline with stand-in models, tiles, and outlines."""

import re

import numpy as np
import pytest

from vellum.config import Config
from vellum.functions import raster
from vellum.operators import polygons, slices
from vellum.pipeline import run

PTS = "ARRAY<STRUCT<x: INT, y: INT>>"


def pnm(image: np.ndarray) -> bytes:
    h, w = image.shape[:2]
    return f"P6 {w} {h} 255\n".encode() + image.astype(np.uint8).tobytes()


def box_mask(shape, x0, y0, x1, y1):
    m = np.zeros(shape, dtype=bool)
    m[y0:y1, x0:x1] = True
    return m


def stand_ins():
    """A detector and a recogniser, sent to the workers by value."""

    def detector():
        """Every patch of one grey is a thing: 100 a region, 200 a line."""

        def one(image, threshold):
            out = []
            for grey, cls in ((100, 1), (200, 2)):
                for a, b in ((0, image.shape[0] // 2), (image.shape[0] // 2, image.shape[0])):
                    m = np.zeros(image.shape[:2], dtype=bool)
                    m[a:b] = np.rint(image[a:b, :, 0] * 255) == grey
                    if m.any():
                        out.append((cls, 0.9, m))
            return out

        return lambda images, threshold: [one(x, threshold) for x in images] if isinstance(images, list) else one(images, threshold)

    def recogniser():
        return lambda crops: [(f"size{c.shape[1]}", -0.1) for c in crops]

    return detector, recogniser


@pytest.mark.parametrize("extra", [{"new_ordering": True}, {"tile_size": 60, "tile_overlap": 20, "tiles_across": 3}])
def test_images_to_documents(spark, tmp_path, extra):
    image = np.zeros((100, 120, 3), dtype=np.uint8)
    image[60:95, 5:110] = 100
    image[10:20, 10:60] = 200
    image[70:80, 10:90] = 200
    (tmp_path / "a.ppm.png").write_bytes(pnm(image))
    (tmp_path / "broken.png").write_bytes(b"x")
    plain = np.zeros((100, 120, 3), dtype=np.uint8)
    plain[10:20, 10:60] = 200
    (tmp_path / "b.png").write_bytes(pnm(plain))
    config = Config(input_folder=str(tmp_path), page_xml=True, alto_xml=True, xml_folder=str(tmp_path / "out"), line_percentage_threshold=0.0, region_percentage_threshold=0.0, **extra)
    assert run(spark, config, *stand_ins()) == 4
    page = (tmp_path / "out/page/a.ppm.xml").read_text()
    sizes = [int(x) for x in re.findall(r"size(\d+)", page)]
    # tiles cut the long line; its pieces overlap too little to be merged
    assert len(sizes) == 3 if extra.get("tile_size") else sizes == pytest.approx([50, 80], abs=2)
    assert page.count("<TextRegion ") >= 1
    other = (tmp_path / "out/alto/b.xml").read_text()
    assert "0,0 120,0 120,100 0,100" in other and 'PC="0.90"' in other and re.search(r"size(49|5\d)", other)


def test_flags_are_needed(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, Config(input_folder=str(tmp_path), page_xml=False, alto_xml=False), *stand_ins())


def test_tiles():
    assert slices.starts(100, 60, 20) == [0, 40] and slices.starts(50, 60, 20) == [0] and slices.starts(130, 60, 0) == [0, 60, 120]
    seen = []

    def model(images, threshold):
        seen.append(len(images))
        return [[(2, 0.5 + i / 100, np.ones(x.shape[:2], dtype=bool))] for i, x in enumerate(images)]

    found = slices.search(np.zeros((100, 140, 3)), model, 0.1, 60, 20, 4, "none", 0.5)
    assert seen == [4, 4] and len(found) == 6 and all(m.shape == (100, 140) and m.sum() == 3600 for *_, m in found)
    assert [m.any(axis=0).argmax() for *_, m in found] == [0, 40, 80] * 2


def test_masks_are_suppressed_and_merged():
    shape = (64, 64)
    items = [(1, 0.9, box_mask(shape, 0, 0, 32, 32)), (1, 0.8, box_mask(shape, 0, 0, 32, 28)), (2, 0.7, box_mask(shape, 0, 0, 32, 32)), (1, 0.6, box_mask(shape, 40, 40, 64, 64)), (1, 0.95, box_mask(shape, 0, 0, 0, 0))]
    assert [c for _, c, _ in slices.merged(items, "nms", 0.5)] == [0.95, 0.9, 0.7, 0.6]
    assert len(slices.merged(items, "none", 0.5)) == 5 and slices.merged([], "nms", 0.5) == []
    joined = slices.merged(items[:1] + [(1, 0.8, box_mask(shape, 0, 0, 32, 40))], "nmm", 0.5)
    assert len(joined) == 1 and joined[0][2].sum() == 32 * 40


def outline_rows(spark, rings, page=1):
    pts = lambda ring: [{"x": x, "y": y} for x, y in ring]
    return spark.createDataFrame([(page, i, pts(r), 0.5 + i / 10) for i, r in enumerate(rings)], f"page_id BIGINT, det_id INT, pts {PTS}, conf DOUBLE")


def test_outlines_not_boxes_decide(spark):
    # two triangles whose boxes are the same and which share a diagonal only, and a square on the first
    low, high, square = [(0, 0), (100, 100), (0, 100)], [(0, 0), (100, 0), (100, 100)], [(0, 20), (80, 100), (0, 100)]
    rows = polygons.boxed(outline_rows(spark, [low, high, square, [(0, 0), (1, 1)]]))
    assert {(r.i, r.j) for r in polygons.overlap_edges(rows, 0.3, 0.5).collect()} == {(0, 2)}
    comps = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 0)], "page_id BIGINT, det_id INT, root INT")
    out = {r.out_id: r for r in polygons.dissolve(rows, comps).collect()}
    assert out[1].conf == pytest.approx(0.6) and [(p.x, p.y) for p in out[1].pts] == high and out[0].conf == pytest.approx(0.6)
    assert raster.area([(p.x, p.y) for p in out[0].pts]) == pytest.approx(5000, rel=0.05)


def test_assignment_by_outline(spark):
    regions = polygons.boxed(outline_rows(spark, [[(0, 0), (100, 100), (0, 100)], [(0, 0), (100, 0), (100, 100)]])).selectExpr("page_id", "string(det_id) as region_id", "det_id as region_pos", "pts", "box")
    lines = polygons.boxed(outline_rows(spark, [[(60, 10), (90, 10), (90, 30), (60, 30)], [(5, 70), (20, 70), (20, 80), (5, 80)], [(150, 10), (170, 10), (170, 20), (150, 20)]])).withColumnRenamed("det_id", "line_id")
    got = {r.line_id: (r.region_id, r.how) for r in polygons.assign_regions(lines, regions).collect()}
    assert got == {0: ("1", "overlap"), 1: ("0", "overlap"), 2: ("1", "nearest")}
    assert {r.how for r in polygons.assign_regions(lines, regions.limit(0)).collect()} == {"none"}
