"""Queries of all lines, those without a region included."""

import datetime
import re

import pytest

from vellum.plans.queries import queries

QUERIES = queries()


def outline(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def line(page, pos, region, polygon):
    return {"line_uid": page * 1000 + pos, "page_id": page, "region_id": region, "line_pos": pos, "polygon": polygon, "text": f"text{page}{pos}", "text_conf": 0.83, "row_length": 6, "recognised_at": datetime.datetime(2024, 1, 1)}


@pytest.fixture(scope="module")
def d(write_tables):
    pages = [{"page_id": p, "img_name": f"{p}.jpg", "width": 1000, "height": 2000} for p in (1, 2, 3)]
    regions = [{"page_id": 1, "region_id": str(k), "name": "paragraph", "coords": outline(*b), "bbox": b} for k, b in enumerate([(0, 0, 500, 500), (0, 600, 500, 900)])]
    lines = [line(1, 0, "0", outline(10, 10, 90, 30)), line(1, 1, None, outline(10, 610, 90, 640)), line(1, 2, None, outline(10, 950, 90, 980)), line(1, 3, None, None), line(1, 4, "gone", outline(10, 510, 90, 530)), line(2, 0, None, outline(10, 10, 90, 30)), line(2, 1, None, None)]
    stats = [{"page_id": p, "page_conf_mean": m, "page_conf_median": 0.125, "page_conf_25": 0.985, "page_conf_75": 1.0, "n_long_rowtext": 0, "language": "fi", "computed_at": datetime.datetime(2024, 1, 1)} for p, m in ((1, 0.83), (2, 0.376))]
    return write_tables(pages=pages, regions=regions, line_texts=lines, page_stats=stats)


def test_lines_without_a_region_stay(spark, d):
    got = {(r.page_id, r.region_id, r.text) for r in QUERIES["xml_roundtrip"](spark, d).collect()}
    assert got == {(1, "r0", "text10"), (1, "r1", "text11"), (1, "r1", "text12"), (1, "r1", "text13"), (1, "r0", "text14"), (2, "r0", "text20"), (2, "r0", "text21")}
    for name in ("page_xml_whole", "alto_xml_whole"):
        docs = {r.page_id: r.xml for r in QUERIES[name](spark, d).collect()}
        assert {(p, t) for p, x in docs.items() for t in re.findall(r"text\d+", x)} == {(p, t) for p, _, t in got}
        assert "0,0 1000,0 1000,2000 0,2000" in docs[2]
    assert QUERIES["xml_ids_whole"](spark, d).count() == 7


def test_alto_has_the_real_confidences(spark, d):
    docs = {r.page_id: r.xml for r in QUERIES["alto_xml_whole"](spark, d).collect()}
    # two decimals of the binary value, as the reference prints them
    assert ' PC="0.83" PC50="0.12" PC25="0.98" PC75="1.00"' in docs[1] and ' PC="0.38"' in docs[2]


def test_pages_without_a_region_detection_are_ordered(spark, write_tables):
    item = lambda page, number, x, y: {"l_orderkey": page, "l_linenumber": number, "l_partkey": x, "l_suppkey": y, "l_quantity": 1.0, "l_discount": 0.0, "l_tax": 0.0}
    d = write_tables(lineitem=[item(1, 1, 0, 0), item(1, 2, 1, 1), item(2, 2, 1, 9), item(2, 3, 1, 1), item(3, 1, 0, 0)])
    got = {(r.page_id, r.region_id, r.line_id, r.region_ord, r.line_ord) for r in QUERIES["order_regions"](spark, d).collect()}
    assert got == {(1, "0", 1, 0, 0), (2, "0", 1, 0, 0), (2, "0", 0, 0, 1)}
    flat = {(r.page_id, r.region_ord, r.line_ord, r.line_id, r.line_pos) for r in QUERIES["flatten_lines_whole"](spark, d).collect()}
    assert flat == {(1, 0, 0, 1, 0), (2, 0, 0, 1, 0), (2, 0, 1, 0, 1)}
    assert QUERIES["renest_counts_whole"](spark, d).count() == 3
    assert {(r.page_id, r.n_lines, r.line_ids) for r in QUERIES["region_result_whole"](spark, d).collect()} == {(1, 1, "1"), (2, 2, "1 0")}


def test_ious_of_lines_with_their_regions(spark, write_tables):
    square = outline(0, 0, 10, 10)
    polygons = [outline(0, 0, 10, 5), outline(5, 5, 15, 15), outline(10, 0, 20, 10), [(0, 0), (10, 10), (10, 0), (0, 10)], [(0, 0), (10, 0), (0, 10)], [*square, square[0]], [(0, 0), (10, None), (0, 10)], [(0, 0), None, (0, 10)], [(0, 0), (10, 10)], None]
    lines = [line(1, k, "0", p) for k, p in enumerate(polygons)] + [line(2, 0, "0", square), line(1, 90, "1", square), line(1, 91, None, square)]
    d = write_tables(line_texts=lines, regions=[{"page_id": 1, "region_id": "0", "coords": square}, {"page_id": 1, "region_id": "1", "coords": square[:2]}, {"page_id": 2, "region_id": "0", "coords": None}])
    got = {(r.page_id, r.line_pos): r.iou for r in QUERIES["polygon_iou"](spark, d).collect()}
    # no value where a coordinate is missing
    assert got == {(1, 0): 0.5, (1, 1): 0.142857, (1, 2): 0.0, (1, 3): 0.5, (1, 4): 0.5, (1, 5): 1.0, (1, 6): None, (1, 7): None}
