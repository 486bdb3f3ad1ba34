"""XML documents of pages, as string columns, and their writer.

regions: page_id, region_ord, name, coords, xml_id; lines: page_id, region_ord, line_ord, polygon, text, row_length,
text_conf; pages: page_id, img_name, width, height and, for ALTO, the page statistics and language.  NULL
texts and polygons become empty; a page without a region with lines gives no document."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import geometry as G
from vellum.operators.stats import printed, rounded, strip

# Name spaces of the two formats.
PAGE_NS = "http://schema.primaresearch.org/PAGE/gts/pagecontent/2013-07-15"
ALTO_NS = "http://www.loc.gov/standards/alto/ns-v4#"
ALTO_XSD = "http://www.loc.gov/standards/alto/v4/alto-4-0.xsd"
XLINK_NS = "http://www.w3.org/1999/xlink"
XSI_NS = "http://www.w3.org/2001/XMLSchema-instance"
#: (id, what it does, software's creator, software's name) of the three steps.
SOFTWARE = (
    ("TEXT_REGION_SEGMENTATION", "Regions from masks", "plug-in", "detector"),
    ("TEXT_LINE_SEGMENTATION", "Lines from masks", "plug-in", "detector"),
    ("TEXT_RECOGNITION", "Texts from line images", "plug-in", "recogniser"),
)
DECLARATION = '<?xml version="1.0" encoding="UTF-8"?>\n'


def escape(c: Column) -> Column:
    c = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    # characters that XML can't hold
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def _points(c: str, trailing: bool = False) -> Column:
    return F.coalesce(G.points_text(F.col(c), trailing), F.lit(""))


def timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")


def _gather(lines: DataFrame, regions: DataFrame, line: Column, head: Column, foot: str) -> DataFrame:
    """page_id, body: regions in order, each of head, its lines in order, foot."""
    per = lines.select("page_id", "region_ord", F.struct("line_ord", line.alias("x")).alias("l")).groupBy("page_id", "region_ord").agg(F.array_sort(F.collect_list("l")).alias("ls"))
    both = regions.select("page_id", "region_ord", head.alias("h")).join(per, ["page_id", "region_ord"])
    one = F.concat(F.col("h"), F.array_join(F.col("ls.x"), ""), F.lit(foot))
    whole = both.select("page_id", F.struct("region_ord", one.alias("x")).alias("r")).groupBy("page_id").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    return whole.select("page_id", F.array_join(F.col("rs.x"), "").alias("body"))


def page_xml(pages: DataFrame, regions: DataFrame, lines: DataFrame, created: Column, creator: str = "vellum") -> DataFrame:
    """page_id, xml in the PAGE format: region and line ids by place, an empty base line, stripped texts."""
    rid = F.concat(F.lit("r"), F.col("region_ord").cast("string"))
    order = lambda c: F.concat(F.lit("readingOrder {index:"), F.col(c).cast("string"), F.lit(";}"))
    line = F.concat(
        F.lit('<TextLine id="'), rid, F.lit("l"), F.col("line_ord").cast("string"), F.lit('" custom="'), order("line_ord"), F.lit('"><Coords points="'), _points("polygon"),
        F.lit('"/><Baseline points=""/><TextEquiv><Unicode>'), escape(strip(F.col("text"))), F.lit("</Unicode></TextEquiv></TextLine>"),
    )
    head = F.concat(F.lit('<TextRegion id="'), rid, F.lit('" custom="'), order("region_ord"), F.lit('"><Coords points="'), _points("coords"), F.lit('"/>'))
    body = _gather(lines, regions, line, head, "</TextRegion>")
    at = timestamp(created)
    xml = F.concat(
        F.lit(f'{DECLARATION}<PcGts xmlns="{PAGE_NS}"><Metadata><Creator>'), escape(F.lit(creator)), F.lit("</Creator><Created>"), at, F.lit("</Created><LastChange>"), at, F.lit('</LastChange></Metadata><Page imageFilename="'),
        escape(F.col("img_name")), F.lit('" imageWidth="'), escape(F.col("width")), F.lit('" imageHeight="'), escape(F.col("height")), F.lit('">'), F.col("body"), F.lit("</Page></PcGts>"),
    )
    return pages.join(body, "page_id").select("page_id", xml.alias("xml"))


def two_decimals(c: Column) -> Column:
    return printed(F.coalesce(c, F.lit(0.0)))


def processing_steps(models: tuple[str, str, str], agency: str, software: tuple = SOFTWARE) -> str:
    """The header's elements on the three steps."""
    one = (
        '<Processing ID="{}"><processingAgency>{}</processingAgency><processingStepDescription>{}</processingStepDescription><processingSoftware>'
        "<softwareCreator>{}</softwareCreator><softwareName>{}</softwareName><softwareVersion>{}</softwareVersion></processingSoftware></Processing>"
    )
    return "".join(one.format(i, *map(html.escape, (agency, what, by, name, version))) for (i, what, by, name), version in zip(software, models))


def alto_xml(pages: DataFrame, regions: DataFrame, lines: DataFrame, models: tuple[str, str, str] = ("regions", "lines", "text"), agency: str = "vellum", software: tuple = SOFTWARE) -> DataFrame:
    """page_id, xml in the ALTO format: page confidences, a block per region (xml_id), a String per line with its length
    and confidence; a String has its line's id.  ``models``: the versions of the three models; ``software``: what
    each step does, and the creator and name of its software."""
    lid = F.concat(F.col("block_id"), F.lit("_line_"), F.col("line_ord").cast("string"))
    named = lines.join(regions.select("page_id", "region_ord", F.col("xml_id").alias("block_id")), ["page_id", "region_ord"])
    line = F.concat(
        F.lit('<TextLine ID="'), escape(lid), F.lit('"><Shape><Polygon POINTS="'), _points("polygon", True), F.lit('"/></Shape><String ID="'), escape(lid), F.lit('" CONTENT="'), escape(F.col("text")),
        F.lit('" RL="'), escape(F.col("row_length")), F.lit('" WC="'), escape(rounded(F.col("text_conf"))), F.lit('"/></TextLine>'),
    )
    head = F.concat(F.lit('<TextBlock ID="'), escape(F.col("xml_id")), F.lit('"><Shape><Polygon POINTS="'), _points("coords", True), F.lit('"/></Shape>'))
    body = _gather(named, regions, line, head, "</TextBlock>")
    steps = processing_steps(models, agency, software)
    attr = lambda name, c: F.concat(F.lit(f' {name}="'), c, F.lit('"'))
    xml = F.concat(
        F.lit(f'{DECLARATION}<alto xmlns="{ALTO_NS}" xmlns:xlink="{XLINK_NS}" xmlns:xsi="{XSI_NS}" xsi:schemaLocation="{ALTO_NS} {ALTO_XSD}"><Description><MeasurementUnit>mm10</MeasurementUnit><sourceImageInformation><fileName>'), escape(F.col("img_name")), F.lit(f"</fileName></sourceImageInformation>{steps}</Description><Styles/><Layout><Page"),
        attr("ID", escape(F.col("img_name"))), attr("WIDTH", escape(F.col("width"))), attr("HEIGHT", escape(F.col("height"))),
        *[attr(n, two_decimals(F.col(c))) for n, c in (("PC", "page_conf_mean"), ("PC50", "page_conf_median"), ("PC25", "page_conf_25"), ("PC75", "page_conf_75"))],
        attr("N_LONG_ROWTEXT", escape(F.col("n_long_rowtext"))), attr("LANGUAGE", escape(F.col("language"))), F.lit(' PHYSICAL_IMG_NR="0"><PrintSpace HPOS="0" VPOS="0"'),
        attr("WIDTH", escape(F.col("width"))), attr("HEIGHT", escape(F.col("height"))), F.lit(">"), F.col("body"), F.lit("</PrintSpace></Page></Layout></alto>"),
    )
    return pages.join(body, "page_id").select("page_id", xml.alias("xml"))


def write_files(documents: DataFrame) -> int:
    """Write documents (target, xml) to their files as UTF-8, folders made as needed, files replaced; the number written.

    A file is written beside its place and moved there, so a task that runs again leaves a whole file.  For local or
    mounted file systems; elsewhere, save the rows as a table."""
    import os

    def put(batches):
        import pandas as pd

        for pdf in batches:
            for target, xml in zip(pdf["target"], pdf["xml"]):
                os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
                part = f"{target}.{os.getpid()}.part"
                with open(part, "w", encoding="utf-8") as f:
                    f.write(xml)
                os.replace(part, target)
            yield pd.DataFrame({"n": [len(pdf)]})

    return documents.select("target", "xml").mapInPandas(put, "n BIGINT").agg(F.sum("n")).first()[0] or 0
