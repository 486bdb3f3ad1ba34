"""Boxes, order, tiles and rasters on cases worked out by hand, and properties."""

import math
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.functions import geometry as G
from vellum.functions import raster as R
from vellum.operators import assign, merge, nest, order, stats, suppress, tiling, xml

BOX = "STRUCT<x_min: INT, y_min: INT, x_max: INT, y_max: INT>"
GRID = [(50, 100, 250, 130), (300, 100, 500, 130), (50, 180, 250, 210), (300, 180, 500, 210)]
STAIRS = [(20, 0, 70, 10), (10, 4, 60, 14), (0, 8, 50, 18)]


def boxes(spark, bs, page=1):
    return spark.createDataFrame([(page, i, tuple(b) if b else None) for i, b in enumerate(bs)], f"page_id BIGINT, id INT, box {BOX}")


def ids(df):
    return [r.id for r in df.orderBy("ord").collect()]


def test_graph_order(spark):
    assert ids(order.order_lines(boxes(spark, GRID), ["page_id"])) == [0, 1, 2, 3]
    assert ids(order.order_lines(boxes(spark, GRID[:1] * 2), ["page_id"])) == [1, 0]
    assert ids(order.order_lines(boxes(spark, STAIRS), ["page_id"])) == [0, 2, 1]
    assert ids(order.order_lines(boxes(spark, [None, GRID[0]]), ["page_id"])) == [1]
    assert order.peel(np.array(STAIRS), compat=True) == [0, 2, 1, 0]


def test_partial_order(spark):
    assert ids(order.order_partial(boxes(spark, GRID), ["page_id"])) == [0, 2, 1, 3]  # two columns
    assert ids(order.order_partial(boxes(spark, GRID), ["page_id"], compat=True)) == [2, 0, 1, 3]


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 30), st.integers(1, 30)), min_size=1, max_size=9))
def test_peel_is_a_permutation(bs):
    bs = [(x, y, x + w, y + h) for x, y, w, h in bs]
    assert sorted(order.peel(np.array(bs).reshape(-1, 4))) == list(range(len(bs)))


def test_topsort_tolerates_cycles():
    assert order.topsort(3, [[2], [0], [1]]) == [1, 2, 0]
    assert order.topsort(4, [[3], [], [1], []]) == [3, 0, 1, 2]
    assert order.topsort(5000, [[i + 1] for i in range(4999)] + [[]]) == list(range(4999, -1, -1))


def test_order_regions_against_loop(spark, small):
    """Groups with cycles included, every group's order is that of a plain loop."""
    from vellum.plans import fixtures as fx

    rows = fx.staircase(spark, small).filter("page_id % 7 = 0")
    want = {}
    for r in rows.collect():
        want.setdefault(r.page_id, []).append((r.id, tuple(r.box)))
    got = {}
    for r in order.order_lines(rows, ["page_id"]).collect():
        got.setdefault(r.page_id, []).append((r.ord, r.id))
    for page, bs in want.items():
        bs.sort()
        assert [i for _, i in sorted(got[page])] == [bs[k][0] for k in order.peel(np.array([b for _, b in bs]))]


def test_tiles(spark):
    img = spark.createDataFrame([(1, 500, 768), (2, None, 5), (3, 0, 4)], "page_id BIGINT, height INT, width INT")
    got = tiling.tile_grid(img, (384, 384), (128, 128)).orderBy("tile_id").collect()
    assert [(r.x0, r.y0) for r in got] == [(x, y) for y in (0, 116) for x in (0, 256, 384)]
    img = spark.createDataFrame([(1, 384, 1000)], "page_id BIGINT, height INT, width INT")
    got = tiling.tile_grid(img, (384, 384), (0, 0)).orderBy("tile_id").collect()
    assert [(r.x0, r.x1) for r in got] == [(0, 384), (384, 768), (768, 1000)]
    for bad in ((0, 0, 1), (4, 4, 1), (4, -1, 1), (4, 1, 0)):
        with pytest.raises(ValueError):
            tiling.check_tiles((bad[0],) * 2, (bad[1],) * 2, bad[2])
    assert Config().max_size == 768 and Config(tile_size=384, tiles_across=3).max_size == 1024


def test_statistics(spark):
    df = spark.createDataFrame([(1, i, t, c) for i, (t, c) in enumerate([("a" * 101, 0.9), ("b", 0.1), (None, 0.4), ("", 0.35)])] + [(2, 0, None, None)], "page_id BIGINT, line_pos INT, text STRING, text_conf DOUBLE")
    a, b = stats.page_stats(df).orderBy("page_id").collect()
    assert [a.page_conf_25, a.page_conf_median, a.page_conf_75] == pytest.approx([0.2875, 0.375, 0.525])
    assert a.n_long_rowtext == 1 and (b.page_conf_mean, b.page_conf_median) == (0.0, 0.0)
    assert stats.format_2dp(spark.createDataFrame([(0.125,), (2.675,), (None,)], "v DOUBLE"), "v").toPandas().v_text.tolist() == ["0.12", "2.67", None]
    assert stats.language_summary(df).filter("language = 'unknown'").count() == 2


def test_default_region_and_ties(spark):
    pages = spark.createDataFrame([(1, 200, 100)], "page_id BIGINT, height INT, width INT")
    none = spark.createDataFrame([], "page_id BIGINT, region_id STRING")
    r = assign.default_regions(pages, none).first()
    assert (r.x1, r.y1) == (100, 200)
    r = assign.default_regions(pages, none, True).first()
    assert (r.x1, r.y1) == (200, 100)
    lines = spark.createDataFrame([(1, 0, (0, 0, 10, 10)), (1, 1, (100, 0, 110, 10)), (2, 0, (0, 0, 1, 1)), (1, 2, None)], f"page_id BIGINT, line_id INT, box {BOX}")
    regions = spark.createDataFrame([(1, "b", 1, (0, 0, 20, 20)), (1, "a", 0, (0, 0, 20, 20)), (1, "c", 2, (110, 0, 120, 10))], f"page_id BIGINT, region_id STRING, region_pos INT, box {BOX}")
    got = {(r.page_id, r.line_id): (r.region_id, r.how) for r in assign.assign_regions(lines, regions).collect()}
    assert got == {(1, 0): ("a", "overlap"), (1, 1): ("c", "nearest"), (2, 0): (None, "none"), (1, 2): (None, "none")}


def test_merge(spark):
    bs = [(0, 0, 100, 20), (10, 0, 110, 20), (300, 0, 400, 20), None]
    df = spark.createDataFrame([(1, i, tuple(b) if b else None, c) for i, (b, c) in enumerate(zip(bs, (0.5, 0.7, 0.9, 0.1)))], f"page_id BIGINT, det_id INT, box {BOX}, confidence DOUBLE")
    comps = merge.components(df, merge.overlap_edges(df, 0.3, 0.5))
    assert {(r.det_id, r.root) for r in comps.collect()} == {(0, 0), (1, 0), (2, 2)}
    mapping = merge.component_mapping(df, comps)
    assert [r.out_id for r in mapping.orderBy("det_id").collect()] == [0, 0, 1, -1]
    assert [r.confidence for r in merge.component_confidence(df, mapping).orderBy("out_id").collect()] == pytest.approx([0.6, 0.9])
    assert [r.confidence for r in merge.component_confidence(df, mapping, True).orderBy("det_id").collect()] == pytest.approx([0.5, 0.5, 0.7, 0.1])
    ring = merge.dissolve_polygon(df, comps).filter("root = 0").first()
    assert ring.area == 110 * 20 and ring.points.startswith("0,0") and ring.points.endswith("0,0")


def test_suppression(spark):
    bs = [(0, 0, 10, 10), (1, 0, 11, 10), (50, 0, 60, 10)]
    df = spark.createDataFrame([(1, i, k, c, tuple(b)) for i, (b, c, k) in enumerate(zip(bs, (0.5, 0.7, 0.9), (1, 2, 1)))] + [(1, 9, 1, None, None)], f"page_id BIGINT, det_id INT, class_id INT, confidence DOUBLE, box {BOX}")
    assert {r.det_id for r in suppress.nms(df, 0.5).collect()} == {0, 1, 2}
    assert {r.det_id for r in suppress.nms(df, 0.5, agnostic=True).collect()} == {1, 2}
    assert {r.det_id: r.merged for r in suppress.nmm(df.withColumn("class_id", F.lit(1)), 0.5).collect()} == {1: 2, 2: 1}


def test_geometry(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    b = lambda *v: G.box(*map(F.lit, v))
    assert one(G.interval_iou(*map(F.lit, (0, 10, 5, 15)))) == pytest.approx(1 / 3)
    assert one(G.box_iou(b(0, 0, 0, 0), b(0, 0, 0, 0))) == 0.0
    assert one(G.box_distance(b(0, 0, 1, 1), b(4, 5, 6, 6))) == 5.0
    assert one(G.iou_y(b(0, 0, 1, 1), F.lit(None).cast(BOX))) == 0.5
    pts = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    assert one(G.shoelace(pts)) == 12.0 and one(G.points_text(pts, True)) == "0,0 4,0 4,3 0,3 "
    assert one(G.valid(F.slice(pts, 1, 2))) is None and one(G.bbox(F.slice(pts, 1, 0))) is None


cell = st.tuples(st.integers(0, 12), st.integers(0, 12), st.integers(1, 6), st.integers(1, 6)).map(lambda t: (t[0], t[1], t[0] + t[2], t[1] + t[3]))


@settings(max_examples=60, deadline=None)
@given(st.lists(cell, min_size=1, max_size=5))
def test_union_covers_the_boxes(bs):
    mask = np.zeros((20, 20), dtype=bool)
    for x0, y0, x1, y1 in bs:
        mask[y0:y1, x0:x1] = True
    holes = sum(a for _, a in R.union_of_boxes(bs)) - mask.sum()
    assert holes >= 0 and R.runs_overlap(R.runs_of(mask), R.runs_of(mask)) == mask.sum()
    assert (R.mask_of(R.runs_of(mask), 20, 20) == mask).all()


@settings(max_examples=60, deadline=None)
@given(cell, cell)
def test_polygon_areas_equal_box_areas(a, b):
    ring = lambda q: [(q[0], q[1]), (q[2], q[1]), (q[2], q[3]), (q[0], q[3])]
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    assert R.intersection_area(ring(a), ring(b)) == pytest.approx(w * h)
    assert 0 <= R.polygon_iou(ring(a), ring(b)) == pytest.approx(R.polygon_iou(ring(b), ring(a)))
    dx, dy = max(0, a[0] - b[2], b[0] - a[2]), max(0, a[1] - b[3], b[1] - a[3])
    assert R.distance(ring(a), ring(b)) == pytest.approx(math.hypot(dx, dy))


def ious(pairs):
    """``polygon_ious`` of pairs of rings."""
    return R.polygon_ious(*(x for rings in zip(*pairs) for x in (np.array([p for r in rings for p in r]), np.array([len(r) for r in rings]))))


outline = st.lists(st.tuples(st.integers(-3, 9), st.integers(-3, 9)), min_size=1, max_size=9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(outline, outline), min_size=1, max_size=8))
def test_ious_of_many_polygons_equal_those_of_one(pairs):
    assert ious(pairs).tolist() == pytest.approx([R.polygon_iou(p, q) for p, q in pairs], abs=1e-12)


def test_ious_of_many_polygons_are_measured_together():
    rng = np.random.default_rng(1)
    corners = np.array([(0, 0), (800, 0), (800, 90), (0, 90)])
    pairs = [((corners + rng.integers(0, 900, 2) + rng.integers(-5, 6, (4, 2))).tolist(), [(0, 0), (1500, 5), (1490, 1000), (4, 990)]) for _ in range(4000)]
    began = time.process_time()
    got = ious(pairs)
    batch = time.process_time() - began
    some = [R.polygon_iou(p, q) for p, q in pairs[:400]]
    assert got[:400].tolist() == pytest.approx(some, abs=1e-12) and 0 < got.min()
    # ten times the pairs in less time
    assert batch < time.process_time() - began - batch


def test_ious_of_large_polygons(monkeypatch):
    turn = np.linspace(0, 2 * np.pi, 300, endpoint=False)
    star = [(int(5000 + 4000 * math.cos(3 * t)), int(5000 + (3000 + 900 * math.cos(7 * t)) * math.sin(t))) for t in turn]
    moved = [(x + 70, y + 100) for x, y in star]
    monkeypatch.setattr(R, "CELLS", 500)  # a few edges and heights at a time
    assert ious([(star, moved), (star[:3], star)]).tolist() == pytest.approx([R.polygon_iou(star, moved), R.polygon_iou(star[:3], star)], abs=1e-9)


def test_contours_and_crops():
    m = np.zeros((6, 7), dtype=bool)
    m[1:4, 2:6] = True
    m[5, 0] = True
    assert R.contours(m) == [[(2, 1), (5, 1), (5, 3), (2, 3)]]
    assert R.contours(m, (2.0, 2.0))[0][1] == (10, 2)
    bow = [(0, 0), (4, 4), (4, 0), (0, 4)]
    assert R.even_odd_area(bow) == pytest.approx(8.0)
    img = np.zeros((10, 10, 3), dtype=np.uint8)
    crop = R.crop_polygon(img, [(2, 2), (6, 2), (2, 6)])
    assert crop.shape == (5, 5, 3) and crop[0, 0, 0] == 0 and crop[4, 4, 0] == 255
    assert R.mean_chord([(0, 0), (10, 0), (10, 2), (0, 2)]) == pytest.approx(2.0)
    assert R.resize(img + 255, 4, 3).shape == (4, 3, 3)


def test_images_and_files(spark, tmp_path):
    from vellum.sources import images

    ppm = b"P6 4 3 255\n" + bytes(range(36))
    for n in ("_a.jpg", "b.jpg", ".c.jpg", "d.JPG", "e.png", "f.Jpg", "g.txt"):
        (tmp_path / n).write_bytes(ppm)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "h.jpg").write_bytes(ppm)
    (tmp_path / "bad.png").write_bytes(b"no image")
    found = images.scan_images(spark, str(tmp_path))
    assert sorted(p.path.rsplit("/", 1)[1] for p in found.collect()) == ["_a.jpg", "b.jpg", "bad.png", "d.JPG", "e.png"]
    sizes = images.decode_images(found).collect()
    assert {(r.height, r.width) for r in sizes if r.error is None} == {(3, 4)} and sum(r.error is not None for r in sizes) == 1
    docs = spark.createDataFrame([(f"{tmp_path}/out/page/x.xml", "<a>ä</a>")], "target STRING, xml STRING")
    assert xml.write_files(docs) == 1 and (tmp_path / "out/page/x.xml").read_text("utf-8") == "<a>ä</a>"


def test_models(spark):
    from vellum.operators import models

    ppm = b"P6 8 6 255\n" + bytes(8 * 6 * 3)
    images = spark.createDataFrame([(1, ppm), (2, b"bad")], "page_id BIGINT, content BINARY")

    def detector():
        def run(img, threshold):
            m = np.zeros(img.shape[:2], dtype=bool)
            m[1:4, 2:6] = True
            return [(2, 0.9, m), (1, 0.05, m)]

        return run

    found = models.detect(images, detector).collect()
    assert [r.error is None for r in sorted(found, key=lambda r: r.page_id)] == [True, False]
    sized = models.detect(images, detector).withColumn("height", F.lit(6)).withColumn("width", F.lit(8))
    poly = models.mask_polygons(sized).collect()
    assert [(p.kind, [(q.x, q.y) for q in p.pts]) for p in poly] == [("line", [(2, 1), (5, 1), (5, 3), (2, 3)])]
    lines = models.mask_polygons(sized).withColumnRenamed("poly_id", "line_pos").withColumnRenamed("pts", "polygon").join(images, "page_id")
    got = models.recognise(lines, lambda: lambda crops: [("text", math.log(0.5))] * len(crops)).first()
    assert got.text == "text" and got.text_conf == pytest.approx(0.5)


def test_xml_text_is_escaped(spark):
    pages = spark.createDataFrame([(1, "a&b.jpg", 10, 20)], "page_id BIGINT, img_name STRING, width INT, height INT")
    regions = spark.createDataFrame([(1, 0, "p", [(0, 0), (1, 1)], "p_0")], "page_id BIGINT, region_ord INT, name STRING, coords ARRAY<STRUCT<x: INT, y: INT>>, xml_id STRING")
    lines = spark.createDataFrame([(1, 0, 0, None, ' <"&>  '), (1, 0, 1, [(1, 2)], None)], "page_id BIGINT, region_ord INT, line_ord INT, polygon ARRAY<STRUCT<x: INT, y: INT>>, text STRING")
    from xml.etree import ElementTree

    doc = xml.page_xml(pages, regions, lines, F.lit("2024-01-01").cast("timestamp")).first().xml
    root = ElementTree.fromstring(doc.split("\n", 1)[1])
    assert [e.text for e in root.iter("{" + xml.PAGE_NS + "}Unicode")] == ['<"&>', None]


def test_streamed_folder(spark, tmp_path):
    from vellum.streaming.folder import process_folder, stream_images

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(b"P6 1 1 255\n" + bytes(3))
    seen = []
    q = process_folder(stream_images(spark, str(tmp_path / "in")), lambda df: seen.extend(r.path for r in df.select("path").collect()), str(tmp_path / "cp"))
    q.processAllAvailable()
    q.stop()
    assert len(seen) == 1


def test_round_robin(spark):
    df = spark.createDataFrame([(i, f"p{i:02d}") for i in range(11)], "page_id BIGINT, path STRING")
    assert [r["rank"] for r in nest.round_robin(df, 3).orderBy("path").collect()] == [i % 3 for i in range(11)]
