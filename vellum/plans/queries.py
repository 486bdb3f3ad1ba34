"""All queries of the core, by name."""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import geometry as G
from vellum.operators import assign, filters, merge, nest, nested, order, stats, suppress, tiling, xml
from vellum.plans import fixtures as fx
from vellum.plans.oracles import oracle_sql  # noqa: F401
from vellum.sources.tables import current_rows, table

Query = Callable[[SparkSession, str], DataFrame]
CREATED = "2024-01-01 00:00:00"
TILE, OVERLAP = (640, 640), (100, 100)
PAGE = (2400, 3200)  # of the fixture's pages, which have no row in pages
_CONF = ("page_conf_mean", "page_conf_median", "page_conf_25", "page_conf_75")


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "box"], *[F.col(f"box.{a}").alias(b) for a, b in (("x_min", "x0"), ("y_min", "y0"), ("x_max", "x1"), ("y_max", "y1"))])


def _line_pairs(s, d) -> DataFrame:
    return merge.pairs(fx.lines(s, d), ["page_id"])


def _pair_value(value) -> Query:
    return lambda s, d: _line_pairs(s, d).select("page_id", "i", "j", F.round(value(F.col("a"), F.col("b")), 9).alias("value"))


def _all_pairs(value) -> Query:
    """Lines against the regions of their page."""

    def q(s, d):
        a = fx.line_boxes(s, d).select("page_id", "line_id", F.col("box").alias("a"))
        b = fx.region_boxes(s, d).select("page_id", "region_id", F.col("box").alias("b"))
        return a.join(b, "page_id").select("page_id", "line_id", "region_id", F.round(value(F.col("a"), F.col("b")), 9).alias("value"))

    return q


def _conf_filter(s, d):
    return filters.confident(fx.detections(s, d), 0.95).select("page_id", "det_id", "confidence")


def _class_split(s, d):
    return filters.split_classes(fx.detections(s, d)).select("page_id", "det_id", "kind")


def _area_filter(s, d):
    sized = fx.detections(s, d).withColumns({"width": F.lit(2400), "height": F.lit(1600)})
    return filters.large_enough(sized, 0.003).select("page_id", "det_id", F.round("area_fraction", 9).alias("area_fraction"))


def _sliver_filter(s, d):
    return filters.no_slivers(fx.lines(s, d).withColumns({"width": F.lit(3100), "height": F.lit(2400)})).select("page_id", "det_id")


def _box_features(s, d):
    b = F.col("box")
    return fx.lines(s, d).select("page_id", "det_id", ((b["x_min"] + b["x_max"]) / 2).alias("cx"), ((b["y_min"] + b["y_max"]) / 2).alias("cy"), G.width(b).alias("w"), G.height(b).alias("h"), F.least(G.width(b), G.height(b)).alias("thickness"))


def _bbox_of_polygon(s, d):
    b = G.bbox(F.col("coords"))
    return table(s, d, "regions").select("page_id", "region_id", *[b[n].alias(n) for n in ("x_min", "y_min", "x_max", "y_max")])


def _shoelace(s, d):
    return table(s, d, "regions").select("page_id", "region_id", G.shoelace(F.col("coords")).alias("area"))


def _valid_polygon(s, d):
    return table(s, d, "regions").select("page_id", "region_id", G.valid(F.col("coords")).isNotNull().alias("is_valid"))


def _scale_polygon(s, d):
    p = table(s, d, "regions").select("page_id", "region_id", F.posexplode(G.scale_points(F.col("coords"), F.lit(0.37), F.lit(0.61))).alias("at", "p"))
    return p.select("page_id", "region_id", "at", "p.x", "p.y")


def _points(trailing: bool) -> Query:
    return lambda s, d: table(s, d, "regions").select("page_id", "region_id", G.points_text(F.col("coords"), trailing).alias("points"))


def _resize(fn, most: int) -> Query:
    def q(s, d):
        h, w = fn(F.col("height"), F.col("width"), most)
        return table(s, d, "pages").select("page_id", h.alias("new_height"), w.alias("new_width"))

    return q


def _upscale(s, d):
    sx, sy = F.lit(2400.0) / 768, F.lit(3200.0) / 768
    to = lambda v, k, most: F.least(F.greatest(v * k, F.lit(0.0)), F.lit(float(most))).cast("int")
    b = F.col("box")
    return fx.lines(s, d).select("page_id", "det_id", to(b["x_min"], sx, 2400).alias("x0"), to(b["y_min"], sy, 3200).alias("y0"), to(b["x_max"], sx, 2400).alias("x1"), to(b["y_max"], sy, 3200).alias("y1"))


def _path_parts(s, d):
    p = F.col("path")
    return table(s, d, "pages").select("page_id", nest.file_name(p).alias("file_name"), nest.stem(p).alias("stem"), nest.folder(p).alias("folder"), F.upper(F.regexp_extract(p, r"\.([^./]+)$", 1)).alias("extension"))


def _tiles(overlap) -> Query:
    return lambda s, d: tiling.tile_grid(table(s, d, "pages"), TILE, overlap)


def _in_tiles(s, d) -> DataFrame:
    """Detections as found in tiles: each in one of four tiles of its page, in the tile's coordinates."""
    t = F.col("det_id") % 4
    return _flat(fx.detections(s, d)).withColumn("tile_id", t).withColumn("dx", (t % 2) * 284).withColumn("dy", F.floor(t / 2).cast("int") * 540)


def _move(s, d):
    return tiling.move_detections(_in_tiles(s, d)).select("page_id", "det_id", "tile_id", "x0", "y0", "x1", "y1")


def _tile_union(s, d):
    moved = tiling.move_detections(_in_tiles(s, d)).select("page_id", "tile_id", "det_id", "x0", "y0", "x1", "y1")
    w = Window.partitionBy("page_id").orderBy("tile_id", "det_id")
    return moved.withColumn("merged_id", F.row_number().over(w) - 1)


def _mask_runs(s, d):
    runs = F.transform(F.sequence(F.col("y0"), F.col("y1") - 1), lambda y: F.struct(y.alias("y"), F.col("x0").alias("x0"), F.col("x1").alias("x1")))
    return _flat(fx.lines(s, d)).select("page_id", "det_id", F.aggregate(runs, F.lit(0).cast("bigint"), lambda a, r: a + r["x1"] - r["x0"]).alias("pixels"))


def _edges(s, d):
    return merge.overlap_edges(fx.lines(s, d), 0.3, 0.5)


def _comps(s, d):
    b = fx.lines(s, d)
    return b, merge.components(b, merge.overlap_edges(b, 0.3, 0.5))


def _mapping(s, d):
    b, c = _comps(s, d)
    return b, merge.component_mapping(b, c)


def _conf(compat: bool) -> Query:
    def q(s, d):
        b, m = _mapping(s, d)
        if compat:
            # positions among lines, as the reference list has them
            w = Window.partitionBy("page_id").orderBy("det_id")
            at = b.select("page_id", "det_id", "confidence", (F.row_number().over(w) - 1).cast("int").alias("pos"))
            m = m.join(at.select("page_id", "det_id", "pos"), ["page_id", "det_id"]).select("page_id", F.col("pos").alias("det_id"), "out_id")
            b = at.select("page_id", F.col("pos").alias("det_id"), "confidence")
            return merge.component_confidence(b, m, True).select("page_id", "det_id", F.round("confidence", 6).alias("confidence"))
        return merge.component_confidence(b, m).select("page_id", "out_id", F.round("confidence", 6).alias("confidence"))

    return q


def _dissolve(fn) -> Query:
    return lambda s, d: fn(*_comps(s, d))


def _assigned(s, d):
    return assign.assign_regions(fx.line_boxes(s, d), fx.region_boxes(s, d))


def _with_default(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """Region boxes, and a whole-page region for each page with lines but no region detection."""
    return assign.with_default_regions(lines, regions, lines.select("page_id", F.lit(PAGE[0]).alias("width"), F.lit(PAGE[1]).alias("height")).distinct())


def _assigned_whole(s, d):
    lines = fx.line_boxes(s, d)
    return assign.assign_regions(lines, _with_default(lines, fx.region_boxes(s, d)))


def _best(s, d):
    return assign.best_region(fx.line_boxes(s, d), fx.region_boxes(s, d)).withColumn("iou", F.round("iou", 9))


def _nearest(s, d):
    lines, regions = fx.line_boxes(s, d), fx.region_boxes(s, d)
    rest = lines.join(assign.best_region(lines, regions), ["page_id", "line_id"], "left_anti")
    return assign.nearest_region(rest, regions).withColumn("dist", F.round("dist", 9))


def _default(compat: bool) -> Query:
    return lambda s, d: assign.default_regions(table(s, d, "pages"), table(s, d, "regions"), compat)


def _region_lines(s, d):
    return assign.region_lines(_assigned(s, d), fx.region_boxes(s, d))


def _used(s, d):
    return assign.used_regions(_assigned(s, d), fx.region_boxes(s, d))


def _graph(direction: str) -> Query:
    return lambda s, d: order.order_lines(fx.order_boxes(s, d), ["page_id"], direction)


def _order_regions(s, d, ordered=order.order_lines):
    """Regions of a page in order, and the lines of each region in order, numbered through."""
    found = fx.pinned(s, d)
    lines = fx.lines_of(found)
    regions = _with_default(lines, fx.regions_of(found))
    return order.regions_then_lines(lines, regions, assign.assign_regions(lines, regions), ordered)


def _partial(compat: bool) -> Query:
    return lambda s, d: order.partial_order(fx.order_boxes(s, d), ["page_id"], compat=compat)


def _page_stats(s, d):
    p = stats.page_stats(fx.current_lines(s, d))
    return p.select("page_id", *[F.round(c, 9).alias(c) for c in ("page_conf_mean", "page_conf_median", "page_conf_25", "page_conf_75")], "n_long_rowtext", "n_lines")


def _placed(s, d, assigned=_assigned):
    """Lines in their regions, by place: page_id, region_ord, line_ord, line_id."""
    inside = assigned(s, d).filter("region_id is not null").join(fx.line_boxes(s, d).select("page_id", "line_id", "box"), ["page_id", "line_id"])
    w = Window.partitionBy("page_id", "region_id").orderBy("box.y_min", "box.x_min", "line_id")
    return inside.select("page_id", F.col("region_id").cast("int").alias("region_ord"), (F.row_number().over(w) - 1).cast("int").alias("line_ord"), "line_id")


def _flatten_lines(s, d, assigned=_assigned):
    return nest.flatten(nest.nest(_placed(s, d, assigned), ["line_id"])).select("page_id", "region_ord", "line_ord", "line_id", "line_pos")


def _renest(s, d, assigned=_assigned):
    nested_ = nest.nest(_placed(s, d, assigned), ["line_id"])
    return nest.renest_by_counts(nested_.select("page_id", "region_ord", "n_lines"), nest.flatten(nested_))


def _region_result(s, d, assigned=_assigned):
    """Page statistics on every region with its lines' count and joined ids."""
    nested_ = nest.nest(_placed(s, d, assigned), ["line_id"])
    page = fx.lines(s, d).groupBy("page_id").agg(F.round(F.avg("text_conf"), 6).alias("page_conf_mean"))
    ids = F.array_join(F.transform("lines", lambda x: x["line_id"].cast("string")), " ")
    return nested_.select("page_id", "region_ord", "n_lines", ids.alias("line_ids")).join(page, "page_id").select("page_id", "region_ord", "n_lines", "line_ids", "page_conf_mean")


def _named_regions(s, d):
    w = Window.partitionBy("page_id").orderBy("region_id")
    regions = table(s, d, "regions").filter("page_id is not null")
    return nest.region_ids(regions.select("page_id", "region_id", "name", "coords", (F.row_number().over(w) - 1).cast("int").alias("region_ord")))


def _all_regions(s, d):
    """Named regions, and a whole-page region for each page without one."""
    known = table(s, d, "regions").filter("page_id is not null").select("page_id", "region_id", "name", "coords", "bbox")
    point = lambda x, y: F.struct(F.col(x).cast("int").alias("x"), F.col(y).cast("int").alias("y"))
    whole = assign.default_regions(table(s, d, "pages"), known).select("page_id", "region_id", "name", F.array(point("x0", "y0"), point("x1", "y0"), point("x1", "y1"), point("x0", "y1")).alias("coords"), G.box("x0", "y0", "x1", "y1").alias("bbox"))
    w = Window.partitionBy("page_id").orderBy("region_id")
    both = known.unionByName(whole).withColumn("region_ord", (F.row_number().over(w) - 1).cast("int"))
    return nest.region_ids(both)


def _whole_parts(s, d):
    """As ``_xml_parts``, with every current line of a page: one whose region is not on the page goes to the region it
    overlaps most or is nearest to, one without an outline as well to the region of the line before it, else the page's first."""
    regions = _all_regions(s, d)
    named = fx.current_lines(s, d).join(regions.select("page_id", "region_id", "region_ord"), ["page_id", "region_id"], "left")
    boxes = regions.select("page_id", F.col("region_ord").cast("string").alias("region_id"), F.col("region_ord").alias("region_pos"), F.coalesce(G.bbox(G.valid(F.col("coords"))), "bbox").alias("box"))
    stray = named.filter("region_ord is null").select("page_id", F.col("line_pos").alias("line_id"), G.bbox(F.col("polygon")).alias("box"))
    found = assign.assign_regions(stray, boxes).select("page_id", F.col("line_id").alias("line_pos"), F.col("region_id").cast("int").alias("found_ord"))
    before = Window.partitionBy("page_id").orderBy("line_pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = named.join(found, ["page_id", "line_pos"], "left").withColumn("region_ord", F.coalesce("region_ord", "found_ord")).drop("found_ord")
    lines = lines.withColumn("region_ord", F.coalesce(F.last("region_ord", ignorenulls=True).over(before), F.lit(0)))
    w = Window.partitionBy("page_id", "region_ord").orderBy("line_pos")
    return table(s, d, "pages"), regions, lines.withColumn("line_ord", (F.row_number().over(w) - 1).cast("int"))


def _xml_parts(s, d):
    regions = _named_regions(s, d)
    w = Window.partitionBy("page_id", "region_ord").orderBy("line_pos")
    lines = fx.current_lines(s, d).join(regions.select("page_id", "region_id", "region_ord"), ["page_id", "region_id"]).withColumn("line_ord", (F.row_number().over(w) - 1).cast("int"))
    return table(s, d, "pages"), regions, lines


def _page_xml(parts) -> Query:
    return lambda s, d: xml.page_xml(*parts(s, d), F.lit(CREATED).cast("timestamp"))


def _alto_xml(s, d):
    p, r, ls = _xml_parts(s, d)
    st = current_rows(table(s, d, "page_stats"), ["page_id"], ["computed_at"])
    st = st.select("page_id", *_CONF, "n_long_rowtext", "language")
    return xml.alto_xml(p.join(st, "page_id"), r, ls)


def _alto_xml_whole(s, d):
    p, r, ls = _whole_parts(s, d)
    st = current_rows(table(s, d, "page_stats"), ["page_id"], ["computed_at"]).select("page_id", *_CONF, "n_long_rowtext", "language")
    # pages without stored statistics have those of their lines
    own = stats.page_stats(ls).select("page_id", *[F.col(c).alias(f"own_{c}") for c in _CONF])
    both = p.join(st, "page_id", "left").join(own, "page_id", "left")
    return xml.alto_xml(both.withColumns({c: F.coalesce(c, f"own_{c}") for c in _CONF}), r, ls)


def _xml_ids(parts) -> Query:
    return lambda s, d: _line_ids(*parts(s, d)[1:])


def _line_ids(r, ls):
    both = ls.join(r.select("page_id", "region_ord", "xml_id"), ["page_id", "region_ord"])
    return both.select("page_id", "line_pos", F.format_string("r%dl%d", "region_ord", "line_ord").alias("page_line_id"), F.concat("xml_id", F.lit("_line_"), F.col("line_ord").cast("string")).alias("alto_line_id"), F.format_string("readingOrder {index:%d;}", "line_ord").alias("custom"))


def _roundtrip(parts) -> Query:
    """Texts read back from PAGE documents."""

    def q(s, d):
        labelled = nested.labelled_records(_page_xml(parts)(s, d).withColumn("at", F.lit(0)), ["page_id"], "at")
        lines = nested.node_table(labelled, ["page_id"], "line", "region").select("page_id", "pre", F.col("id").alias("line_id"), F.col("parent_id").alias("region_id"))
        texts = nested.node_table(labelled, ["page_id"], "text", "line").select("page_id", F.col("parent_pre").alias("pre"), F.coalesce("value", F.lit("")).alias("text"))
        return lines.join(texts, ["page_id", "pre"]).select("page_id", "line_id", "region_id", "text")

    return q


def _polygon_iou(s, d):
    """IoU of the lines' outlines with their region's, where both have one."""
    from vellum.functions import raster
    from vellum.functions.arrow import points

    def run(batches):
        for batch in batches:
            iou = raster.polygon_ious(*points(batch.column("polygon")), *points(batch.column("coords")))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("line_pos"), pa.array(iou, from_pandas=True)], names=["page_id", "line_pos", "iou"])

    a = fx.current_lines(s, d).filter("size(polygon) >= 3").select("page_id", "line_pos", "region_id", "polygon")
    b = table(s, d, "regions").filter("size(coords) >= 3").select("page_id", "region_id", "coords")
    pairs = a.join(b, ["page_id", "region_id"]).select("page_id", "line_pos", "polygon", "coords")
    schema = T.StructType([*(pairs.schema[c] for c in ("page_id", "line_pos")), T.StructField("iou", T.DoubleType())])
    return pairs.mapInArrow(run, schema).withColumn("iou", F.round("iou", 6))


def _zip_lists(s, d):
    """Parallel lists by position; what has no partner is left out."""
    per = fx.lines(s, d).groupBy("page_id").agg(F.array_sort(F.collect_list("det_id")).alias("a"), F.array_sort(F.collect_list(F.struct("det_id", "confidence"))).alias("b"))
    z = per.select("page_id", F.posexplode(F.arrays_zip("a", F.slice("b", 1, F.greatest(F.size("b") - 1, F.lit(0))).alias("b"))).alias("at", "z"))
    return z.filter("z.b is not null").select("page_id", "at", F.col("z.a").alias("det_id"), F.round("z.b.confidence", 6).alias("confidence"))


def _format(s, d):
    return stats.format_2dp(table(s, d, "page_stats").select("page_id", "computed_at", "page_conf_mean"), "page_conf_mean")


def _flagship(s, d):
    """Boxes to regions, lines in order by page, statistics by page."""
    found = fx.pinned(s, d)
    lines, regions = fx.lines_of(found), fx.regions_of(found)
    ranked = order.order_lines(lines.select("page_id", F.col("line_id").alias("id"), "box"), ["page_id"]).select("page_id", F.col("id").alias("line_id"), "ord")
    both = assign.assign_regions(lines, regions).join(ranked, ["page_id", "line_id"]).join(lines.select("page_id", "line_id", "text_conf"), ["page_id", "line_id"])
    return both.groupBy("page_id").agg(
        F.count("*").alias("n_lines"), F.count_if(F.col("how") == "overlap").alias("n_overlap"), F.count_if(F.col("how") == "nearest").alias("n_nearest"), F.min_by("line_id", "ord").alias("first_line"), F.round(F.avg("text_conf"), 6).alias("page_conf_mean")
    )


def _detections(s, d):
    return _flat(fx.detections(s, d)).withColumns({c: F.round(c, 6) for c in ("confidence", "text_conf")})


def queries() -> dict[str, Query]:
    line, cur = fx.current_lines, stats
    return {
        "flagship": _flagship,
        "fx_detections": _detections,
        "fx_lines": lambda s, d: _detections(s, d).filter("class_id >= 2"),
        "fx_regions": lambda s, d: _flat(fx.region_boxes(s, d).drop("confidence")),
        "conf_filter": _conf_filter, "class_split": _class_split, "area_filter": _area_filter, "sliver_filter": _sliver_filter,
        "box_features": _box_features, "bbox_of_polygon": _bbox_of_polygon, "shoelace_area": _shoelace, "valid_polygon": _valid_polygon, "scale_polygon": _scale_polygon,
        "points_page": _points(False), "points_alto": _points(True),
        "resize_dims_long": _resize(tiling.resize_longer, 768), "resize_dims_short": _resize(tiling.resize_shorter, 640), "upscale_bbox": _upscale, "path_parts": _path_parts,
        "interval_iou": _pair_value(lambda a, b: G.interval_iou(a["x_min"], a["x_max"], b["x_min"], b["x_max"])), "iou_x": _pair_value(G.iou_x), "iou_y": _pair_value(G.iou_y),
        "box_iou": _pair_value(G.box_iou), "box_ios": _pair_value(G.box_ios), "box_intersects": lambda s, d: _line_pairs(s, d).select("page_id", "i", "j"), "box_distance": _all_pairs(G.box_distance), "polygon_iou": _polygon_iou,
        "tile_grid": _tiles(OVERLAP), "tile_grid_no_overlap": _tiles((0, 0)), "move_detections": _move, "tile_union": _tile_union, "mask_runs_area": _mask_runs,
        "nms_class_aware": lambda s, d: _r6(suppress.nms(fx.detections(s, d), 0.2)), "nms_agnostic": lambda s, d: _r6(suppress.nms(fx.detections(s, d), 0.2, agnostic=True)),
        "nms_ios": lambda s, d: _r6(suppress.nms(fx.detections(s, d), 0.5, "ios")), "nmm": lambda s, d: suppress.nmm(fx.detections(s, d), 0.2),
        "overlap_edges": _edges, "components": lambda s, d: _comps(s, d)[1], "component_mapping": lambda s, d: _mapping(s, d)[1], "component_conf_mean": _conf(False), "component_conf_compat": _conf(True),
        "dissolve_hull": _dissolve(merge.dissolve_hull), "dissolve_polygon": _dissolve(merge.dissolve_polygon),
        "default_region": _default(False), "default_region_compat": _default(True), "best_region": _best, "nearest_region": _nearest, "assign_regions": _assigned, "region_line_join": _region_lines, "region_semi": _used,
        "order_graph_lr": _graph("lr"), "order_graph_rl": _graph("rl"), "order_graph_cyclic": lambda s, d: order.order_lines(fx.staircase(s, d), ["page_id"]),
        "order_center": lambda s, d: order.center_degrees(fx.order_boxes(s, d), ["page_id"]), "order_regions": _order_regions, "order_regions_partial": lambda s, d: _order_regions(s, d, order.order_partial),
        "partial_order_intended": _partial(False), "partial_order_compat": _partial(True), "partial_order_sorted": lambda s, d: order.order_partial(fx.order_boxes(s, d), ["page_id"]),
        "rec_batches": lambda s, d: stats.batches(line(s, d).select("page_id", "line_pos"), 8).groupBy("page_id", "batch").agg(F.count("*").alias("n"), F.min("line_pos").alias("first_pos")),
        "score_exp": lambda s, d: line(s, d).select("page_id", "line_pos", F.round(F.exp(-10 * (1 - F.col("text_conf"))), 9).alias("score")),
        "row_length": lambda s, d: line(s, d).select("page_id", "line_pos", F.length("text").alias("row_length")),
        "page_stats": _page_stats, "long_rows": lambda s, d: line(s, d).filter(F.length("text") > stats.LONG).groupBy("page_id").agg(F.count("*").alias("n_long_rowtext")),
        "page_text": lambda s, d: cur.page_text(line(s, d)), "language_id": lambda s, d: cur.language_summary(line(s, d)),
        "strip_text": lambda s, d: line(s, d).select("page_id", "line_pos", cur.strip(F.col("text")).alias("text")),
        "nonempty_pages": lambda s, d: table(s, d, "pages").select("page_id").join(line(s, d).filter("text is not null").select("page_id"), "page_id", "left_semi"),
        "flatten_lines": _flatten_lines, "renest_counts": _renest, "region_result": _region_result,
        **{f"{name}_whole": functools.partial(fn, assigned=_assigned_whole) for name, fn in (("flatten_lines", _flatten_lines), ("renest_counts", _renest), ("region_result", _region_result))}, "zip_lists": _zip_lists,
        "region_ids": lambda s, d: _named_regions(s, d).select("page_id", "region_id", "name", "region_ord", "xml_id"), "xml_ids": _xml_ids(_xml_parts),
        "page_xml": _page_xml(_xml_parts), "alto_xml": _alto_xml, "page_xml_whole": _page_xml(_whole_parts), "alto_xml_whole": _alto_xml_whole, "xml_ids_whole": _xml_ids(_whole_parts), "xml_roundtrip": _roundtrip(_whole_parts), "xml_roundtrip_named": _roundtrip(_xml_parts), "xml_targets": lambda s, d: nest.xml_targets(table(s, d, "pages"), "/out", ["page", "alto"]), "xml_timestamp": _stamps,
        "round_robin": lambda s, d: nest.round_robin(table(s, d, "pages").select("page_id", "path"), 4), "format_2dp": _format,
        "p3_found": nested.p3_found, "p3_pages": nested.p3_pages, "p3_regions": nested.p3_regions, "p3_lines": nested.p3_lines, "p3_texts": nested.p3_texts,
    }


def _r6(df: DataFrame) -> DataFrame:
    return df.withColumn("confidence", F.round("confidence", 6))


def _stamps(s, d):
    return table(s, d, "pages").select("page_id", xml.timestamp(F.col("scanned_at")).alias("stamp"))
