"""From an image folder to PAGE and ALTO files: detection, outlines, merging, regions, order, recognition, documents.

``documents`` is a plan: nothing is written and no image is read before an action.  Images are decoded where they are
searched and cropped; what travels between steps are outlines and texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.config import Config
from vellum.functions import geometry as G
from vellum.operators import assign, filters, merge, models, nest, order, polygons, slices, stats, xml
from vellum.sources.images import scan_images
from vellum.sources.tables import checkpoint


def images_of(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, path, img_name, content of a folder's images; page_id is a hash of the path."""
    found = scan_images(spark, folder)
    return found.select(F.xxhash64("path").alias("page_id"), "path", nest.file_name(F.col("path")).alias("img_name"), "content")


def outlines(images: DataFrame, config: Config, detector: Callable[[], Callable]) -> DataFrame:
    """page_id, kind, det_id, pts, conf, height, width: outlines of lines and regions above the thresholds, in order."""
    if config.tile_size:
        found = slices.detect_sliced(images, detector, config.confidence_threshold, config.tile_size, config.tile_overlap, config.tiles_across, config.tile_batch_size, "nms", config.tile_iou_threshold)
    else:
        found = models.detect(images, detector, config.confidence_threshold, config.max_size)
    sized = found.join(models.sizes(images), "page_id")
    pts = models.mask_polygons(sized).join(sized.select("page_id", "height", "width").distinct(), "page_id")
    least = F.when(F.col("kind") == "line", config.line_percentage_threshold).otherwise(config.region_percentage_threshold)
    kept = filters.enough_points(pts).filter(F.col("area_fraction") > least).withColumn("box", G.bbox(F.col("pts")))
    kept = kept.filter("kind = 'region'").unionByName(filters.no_slivers(kept.filter("kind = 'line'")))
    at = F.row_number().over(Window.partitionBy("page_id", "kind").orderBy("det_id", "poly_id")) - 1
    return kept.select("page_id", "kind", at.cast("int").alias("det_id"), "pts", "box", "conf", "height", "width")


def merged_outlines(found: DataFrame, iou: float, share: float | None) -> DataFrame:
    """page_id, out_id, pts, conf, box after merging what overlaps."""
    comps = merge.components(found, polygons.overlap_edges(found, iou, share))
    return polygons.boxed(polygons.dissolve(found, comps))


def documents(images: DataFrame, config: Config, detector: Callable[[], Callable], recogniser: Callable[[], Callable]) -> DataFrame:
    """page_id, xml_format, target, xml of every page with a line, in the formats that are asked for."""
    formats = [f for f, wanted in (("page", config.page_xml), ("alto", config.alto_xml)) if wanted]
    if not formats:
        raise ValueError("page_xml or alto_xml has to be asked for")
    # pinned: every later step reads the outlines, none of them the model again
    found = checkpoint(outlines(images, config, detector))
    lines = merged_outlines(found.filter("kind = 'line'"), config.line_iou, config.line_overlap_threshold).withColumnRenamed("out_id", "line_id")
    regions = merged_outlines(found.filter("kind = 'region'"), config.region_iou, config.region_overlap_threshold)
    regions = regions.select("page_id", F.col("out_id").cast("string").alias("region_id"), F.col("out_id").alias("region_pos"), F.lit("paragraph").alias("name"), "pts", "box")
    pages = images.select("page_id", "path", "img_name").join(found.select("page_id", "height", "width").distinct(), "page_id")
    point = lambda x, y: F.struct(F.col(x).cast("int").alias("x"), F.col(y).cast("int").alias("y"))
    whole = assign.default_regions(pages, regions, config.compat)
    whole = whole.select("page_id", "region_id", F.lit(0).alias("region_pos"), "name", F.array(point("x0", "y0"), point("x1", "y0"), point("x1", "y1"), point("x0", "y1")).alias("pts"), G.box("x0", "y0", "x1", "y1").alias("box"))
    regions = regions.unionByName(whole)
    ordered = lambda boxes, keys: (order.order_lines if config.new_ordering else order.order_partial)(boxes, keys, config.text_direction, config.compat)
    placed = order.regions_then_lines(lines, regions, polygons.assign_regions(lines, regions), ordered)
    # a line's place on the page: regions in order, then lines
    at = F.row_number().over(Window.partitionBy("page_id").orderBy("region_ord", "line_ord")) - 1
    placed = checkpoint(placed.withColumn("line_pos", at.cast("int")).join(lines.select("page_id", "line_id", F.col("pts").alias("polygon")), ["page_id", "line_id"]))
    crops = placed.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("line_pos", "polygon"))).alias("lines"))
    texts = models.recognise_pages(images.select("page_id", "content").join(crops, "page_id"), recogniser, config.line_threshold)
    full = checkpoint(placed.join(texts, ["page_id", "line_pos"]).withColumn("row_length", F.length("text")))
    used = regions.join(full.select("page_id", "region_id", "region_ord").distinct(), ["page_id", "region_id"]).withColumnRenamed("pts", "coords")
    named = nest.region_ids(used)
    summary = pages.join(stats.page_stats(full), "page_id").join(stats.language_summary(full), "page_id")
    out = []
    if "page" in formats:
        out.append(xml.page_xml(pages, named, full, F.current_timestamp()).withColumn("xml_format", F.lit("page")))
    if "alto" in formats:
        names = (config.segmentation_model_name, config.line_model_name, config.text_model_name)
        out.append(xml.alto_xml(summary, named, full, names).withColumn("xml_format", F.lit("alto")))
    both = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    targets = nest.xml_targets(pages, config.xml_folder, formats)
    return both.join(targets, ["page_id", "xml_format"]).select("page_id", "xml_format", "target", "xml")


def run(spark: SparkSession, config: Config, detector: Callable[[], Callable], recogniser: Callable[[], Callable]) -> int:
    """Reads ``config.input_folder``, writes the documents, and gives how many there are."""
    return xml.write_files(documents(images_of(spark, config.input_folder), config, detector, recogniser))
