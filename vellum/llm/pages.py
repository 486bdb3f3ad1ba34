"""Current lines by page, with the running titles of the page's volume."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.arrow import groups
from vellum.llm.pagelib import Page, header_key
from vellum.sources.tables import table

#: A letters-only form of a line is above the limit if it stands on this share of the volume's pages ...
HEADER_SHARE = 0.05
#: ... and on this many pages at least; it has two words or more.
HEADER_PAGES = 3
HEADER_ROW = -1_000_000  # line_pos of the row that carries a page's running titles


def line_frequency(lines: DataFrame) -> DataFrame:
    """volume_id, line_hash, pages: distinct pages of each normalised line of each volume, of all lines.

    A line is normalised to its letters, lower case, so that 'Title 12' and '14 Title 1801-1805' are one; lines under
    two words are left out.  Distinct (volume, hash, page) come first, so a title on a third of all rows is
    spread by page before it is counted."""
    hashed = lines.filter("volume_id is not null and page_id is not null").select("volume_id", "page_id", _masked("text").alias("key"))
    hashed = hashed.filter(F.col("key").contains(" ")).select("volume_id", "page_id", F.xxhash64("key").alias("line_hash"))
    return hashed.groupBy("volume_id", "line_hash", "page_id").agg(F.lit(1).alias("one")).groupBy("volume_id", "line_hash").agg(F.count("*").alias("pages"))


def frequent_lines(lines: DataFrame) -> DataFrame:
    """volume_id, key: the normalised lines above the limits, wherever on the page they stand.

    A page has so many lines, so at most lines / HEADER_SHARE of a page forms pass: a volume's list is bounded."""
    often = line_frequency(lines).filter(F.col("pages") >= HEADER_PAGES).join(table_pages(lines), "volume_id")
    often = often.filter(F.col("pages") >= HEADER_SHARE * F.col("volume_pages")).select("volume_id", "line_hash")
    texts = lines.select("volume_id", _masked("text").alias("key")).withColumn("line_hash", F.xxhash64("key"))
    return texts.join(often, ["volume_id", "line_hash"]).groupBy("volume_id", "line_hash").agg(F.min("key").alias("key")).select("volume_id", "key")


def running_titles(lines: DataFrame, volumes: DataFrame) -> DataFrame:
    """volume_id, headers: the volume's frequent lines and its title, letters only, joined by line feeds."""
    titles = volumes.select("volume_id", _masked("title").alias("key")).filter("volume_id is not null and key <> ''")
    return frequent_lines(lines).unionByName(titles).groupBy("volume_id").agg(F.array_join(F.array_sort(F.collect_set("key")), "\n").alias("headers"))


def table_pages(lines: DataFrame) -> DataFrame:
    """volume_id, volume_pages: how many pages of the volume have a line."""
    return lines.filter("volume_id is not null").groupBy("volume_id", "page_id").agg(F.lit(1).alias("one")).groupBy("volume_id").agg(F.count("*").alias("volume_pages"))


def _masked(column: str):
    return F.trim(F.regexp_replace(F.lower(F.col(column)), r"[^\p{L}\p{M}]+", " "))


def page_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, line_pos, recognised_at, line_uid, text of all recognitions, and one row per page with its running titles.

    The titles travel as a row of the page (line_pos HEADER_ROW): nothing is broadcast or held by a worker,
    whatever the number of volumes.  Rows without page_id or line_pos are dropped."""
    lines, pages = table(spark, data_dir, "line_texts"), table(spark, data_dir, "pages")
    titles = pages.select("page_id", "volume_id").join(running_titles(lines, table(spark, data_dir, "volumes")), "volume_id")
    head = titles.select("page_id", F.lit(HEADER_ROW).alias("line_pos"), F.lit(None).cast("timestamp").alias("recognised_at"), F.lit(None).cast("bigint").alias("line_uid"), F.col("headers").alias("text"))
    body = lines.filter("page_id is not null and line_pos is not null").select("page_id", "line_pos", "recognised_at", "line_uid", "text")
    return body.unionByName(head)


def sorted_pages(df: DataFrame) -> DataFrame:
    """Rows of ``page_lines`` with each page whole in one partition, in order; one shuffle, by page."""
    return df.repartition("page_id").sortWithinPartitions("page_id", "line_pos", "recognised_at", "line_uid", "text")


def page_of(rows: list[tuple]) -> tuple[list[tuple[int, str]], list[str], dict[int, int]]:
    """Current ``(line_pos, text)``, running titles and line_uid by line_pos of one page's sorted rows."""
    latest: dict[int, str] = {}
    uids: dict[int, int] = {}
    headers: list[str] = []
    for _, pos, _at, uid, text in rows:
        if pos == HEADER_ROW:
            headers = [header_key(x) for x in text.split("\n")] if text else []
        else:
            latest[pos] = text
            uids[pos] = uid
    return list(latest.items()), headers, uids


def pages_in(batches, frequent: bool = False) -> Iterator[tuple[int, Page]]:
    """(page_id, Page) of each page with a line in sorted batches of ``sorted_pages``; ``frequent`` as in ``Page``."""
    for page_id, rows in groups(batches, "page_id"):
        lines, headers, _ = page_of(rows)
        if lines:
            yield page_id, Page(lines, headers, frequent)
