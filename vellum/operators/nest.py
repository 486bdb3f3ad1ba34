"""Nesting lines under regions under pages, and flattening them again; ids and paths.

Rows carry their place (region_ord, line_ord): nothing depends on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nest(lines: DataFrame, columns: list[str]) -> DataFrame:
    """page_id, region_ord, n_lines, lines: the lines (page_id, region_ord, line_ord, columns) of each region in order."""
    item = F.struct("line_ord", *columns)
    return lines.groupBy("page_id", "region_ord").agg(F.count("*").alias("n_lines"), F.array_sort(F.collect_list(item)).alias("lines"))


def flatten(nested: DataFrame) -> DataFrame:
    """page_id, region_ord, line_ord, the line's columns, line_pos: all lines of a page, numbered through."""
    flat = nested.select("page_id", "region_ord", F.explode("lines").alias("l")).select("page_id", "region_ord", "l.*")
    w = Window.partitionBy("page_id").orderBy("region_ord", "line_ord")
    return flat.withColumn("line_pos", (F.row_number().over(w) - 1).cast("int"))


def renest_by_counts(counts: DataFrame, flat: DataFrame) -> DataFrame:
    """page_id, region_ord, line_pos: lines numbered through the page given back to regions by their line counts."""
    w = Window.partitionBy("page_id").orderBy("region_ord").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("end", F.sum("n_lines").over(w)).withColumn("start", F.col("end") - F.col("n_lines"))
    at = ends.filter("n_lines > 0").select("page_id", "region_ord", F.explode(F.sequence("start", F.col("end") - 1)).alias("line_pos"))
    return at.join(flat.select("page_id", F.col("line_pos").cast("bigint").alias("line_pos")), ["page_id", "line_pos"]).select("page_id", "region_ord", F.col("line_pos").cast("int").alias("line_pos"))


def region_ids(regions: DataFrame) -> DataFrame:
    """Adds xml_id: the region's name and its number among the page's regions of that name."""
    w = Window.partitionBy("page_id", "name").orderBy("region_ord")
    return regions.withColumn("xml_id", F.concat(F.coalesce("name", F.lit("region")), F.lit("_"), (F.row_number().over(w) - 1).cast("string")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its last extension; names with a leading dot or without a dot stay as they are."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]+$", "$1")


def folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def xml_targets(pages: DataFrame, base: str | None, formats: list[str]) -> DataFrame:
    """page_id, xml_format, target, collides: where each page's file goes, and whether another page's goes there too.
    Without a base the files go beside the images."""
    root = F.lit(base) if base else folder(F.col("path"))
    named = pages.filter("path is not null").select("page_id", F.explode(F.array(*map(F.lit, formats))).alias("xml_format"), root.alias("root"), stem(F.col("path")).alias("stem"))
    out = named.select("page_id", "xml_format", F.concat_ws("/", "root", "xml_format", F.concat("stem", F.lit(".xml"))).alias("target"))
    return out.withColumn("collides", F.count("*").over(Window.partitionBy("target")) > 1)


def round_robin(pages: DataFrame, n: int) -> DataFrame:
    """Adds rank: the share of work each page falls to, dealt in the order of paths.  Numbers are dealt within range
    partitions and shifted by the partitions before, so that no task orders all pages."""
    from vellum.sources.tables import checkpoint

    parts = checkpoint(pages.repartitionByRange("path", "page_id").sortWithinPartitions("path", "page_id").select("page_id", "path", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("i")))
    ends = parts.groupBy("part").agg((F.max("i") + 1).alias("n"))
    # a row per partition
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))
    return parts.join(F.broadcast(offsets), "part").select("page_id", "path", F.pmod(F.col("offset") + F.col("i"), F.lit(n)).cast("int").alias("rank"))
