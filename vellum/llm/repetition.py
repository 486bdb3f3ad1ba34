"""Problem 1: repetition inside a page, by line frequency, removal and depletion.

Across documents, every line is hashed in its normalised form and distinct pages are counted per volume; lines above the
limits (``pages.HEADER_SHARE``, ``pages.HEADER_PAGES``) are the volume's, not the page's, and are removed wherever they
stand, misread running titles at the edges and page numbers with them.  Within a document, the unit is the passage
of PASSAGE words, as line breaks don't count: of a passage found TIMES times or more, the second and later copies are
removed.  A page that this depletes by a fifth of its words or more is rejected.

A page of frequent lines alone is left with no words: its share is 0, and it is marked as emptied.  NULL or empty texts
count as lines without words; repeated recognitions count once (the latest); an empty table gives no row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.functions.arrow import map_rows
from vellum.llm.pagelib import copies
from vellum.llm.pages import page_lines, pages_in, sorted_pages

DDL = "page_id BIGINT, n_lines INT, n_removed INT, n_words BIGINT, n_copied BIGINT, repeated_share DOUBLE, emptied BOOLEAN"
PASSAGE, TIMES = 4, 3
REPEATED = 0.2


def _rows(batches):
    for page_id, page in pages_in(batches, frequent=True):
        ws = page.words()
        again = len(copies(ws, PASSAGE, TIMES))
        yield page_id, len(page.lines), len(page.skip), len(ws), again, again / max(1, len(ws)), bool(page.skip) and not ws


def page_repetition(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, n_lines, n_removed (lines above the limits), n_words (left), n_copied (removed of them),
    repeated_share, emptied of every page with a line."""
    return sorted_pages(page_lines(spark, data_dir)).mapInArrow(map_rows(_rows, DDL), DDL)


def p1_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id of the pages depleted by a fifth of their words or more."""
    return page_repetition(spark, data_dir).filter(f"repeated_share >= {REPEATED}").select("page_id")
