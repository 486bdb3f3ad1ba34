"""Problem 4: per-page text quality statistics and the kind of a page.

Each page's statistics are ranked exactly within the pages of its language (as labelled; '' without a label) and within
all pages: distinct values are counted first, then range-partitioned and sorted, numbered within their
partition, and shifted by the counts of the partitions before.  Ranks count reference pages only: those with
running sentences (sentence ends inside REF_BOUNDARY of the lines or more, common words REF_COMMON or more), so that
a kind may be any share of the corpus without its pages lying in each other's tail.

A statistic's signed tail score is ln(p) / ln(FLOOR), 0 to 1, of the share p of reference pages that lie as far out on the
given side; FLOOR and beyond count as 1, so scores mean the same at every size.  The mean of the scores in the language
and in all pages is taken, and combined across the statistics that a kind shows in (``SIDES``).  A page whose best
combined score is OUTLIER or more is not prose.  Its kind is then the larger half of it: more than half of its tokens no
words, junk; else more than half of its lines rows of cells, table; else list.

A value shared by a third of all pages is one row per partition before any shuffle.  NULL and empty lines count
as no lines; furniture is left out; a page without text has statistics 0, no score, and is 'prose'; without a
reference page there is no score and every page is 'prose'."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.arrow import map_rows
from vellum.llm.langnames import language_of
from vellum.llm.pagelib import STATS, repeated_share
from vellum.llm.pages import page_lines, pages_in, sorted_pages
from vellum.llm.repetition import REPEATED
from vellum.sources.tables import checkpoint, table

_DDL = "page_id BIGINT, lines INT, repeated_share DOUBLE, n_lines DOUBLE, " + ", ".join(f"{s} DOUBLE" for s in STATS)
LEAST_LINES = 5
#: Least share of lines with a sentence end inside, and of common words, of a reference page.
REF_BOUNDARY, REF_COMMON = 0.1, 0.05
#: Tail share from which on a statistic is as far out as can be; combined score from which on a page isn't prose.
FLOOR, OUTLIER = 0.001, 0.85
#: Sides of the statistics that a kind shows in; of a tuple, the one farther out.
SIDES = {
    "junk": ("nonword_share+", "common_share-", "boundary_share-"),
    "table": ("row_share+", "digit_share+", "common_share-", "boundary_share-"),
    "list": ("boundary_share-", ("entry_share+", "common_share-")),
}


def _rows(batches):
    for page_id, page in pages_in(batches):
        st = page.statistics()
        yield page_id, len(page.lines), repeated_share(page.words()), st["n_lines"], *(round(st[s], 6) + 0.0 for s in STATS)


def page_statistics(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, lines, repeated_share, the statistics (rounded to six places) of every page with a line."""
    return sorted_pages(page_lines(spark, data_dir)).mapInArrow(map_rows(_rows, _DDL), _DDL)


def labelled_language(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, label: the language named by the page's current record; NULL if it names none."""
    latest = table(spark, data_dir, "page_stats").filter("page_id is not null").groupBy("page_id").agg(F.max(F.struct("computed_at", "language")).alias("r"))
    return latest.select("page_id", language_of(F.col("r.language")).alias("label"))


def _running(batches):
    """Running count of sorted (part, grp, stat, value, n) rows within a partition, grp and stat."""
    key, run = None, 0
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        out = []
        for g, s, n in zip(cols[1], cols[2], cols[4]):
            if (g, s) != key:
                key, run = (g, s), 0
            run += n
            out.append(run)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, type=pa.int64())], names=[*batch.schema.names, "run"])


def exact_ranks(values: DataFrame) -> DataFrame:
    """grp, stat, value, below, upto, total: how many reference rows of (grp, stat) lie below and up to each distinct
    value, of any row.

    ``values``: grp, stat, value and, optionally, ref (whether the row counts); NULL values have no rank."""
    one = F.col("ref").cast("int") if "ref" in values.columns else F.lit(1)
    counts = values.filter("value is not null").groupBy("grp", "stat", "value").agg(F.sum(one).alias("n"))
    ordered = counts.repartitionByRange("grp", "stat", "value").sortWithinPartitions("grp", "stat", "value").select(F.spark_partition_id().alias("part"), "grp", "stat", "value", "n")
    ddl = "part INT, grp STRING, stat STRING, value DOUBLE, n BIGINT, run BIGINT"
    # pinned: the partition numbers must mean the same rows in both passes
    ordered = checkpoint(ordered.mapInArrow(_running, ddl))
    # a (grp, stat) takes consecutive partitions: no more rows than partitions and groups
    w = Window.partitionBy("grp", "stat")
    before = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("grp", "stat", "part").agg(F.max("run").alias("in_part"))
    offsets = offsets.select("grp", "stat", "part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("offset"), F.sum("in_part").over(w).alias("total"))
    upto = F.col("offset") + F.col("run")
    return ordered.join(offsets, ["grp", "stat", "part"]).select("grp", "stat", "value", (upto - F.col("n")).alias("below"), upto.alias("upto"), "total")


#: The statistics that decide.
RANKED = sorted({x[:-1] for sides in SIDES.values() for s in sides for x in ((s,) if isinstance(s, str) else s)})


def tail_scores(stats: DataFrame) -> DataFrame:
    """page_id and, for each statistic of RANKED, its signed tail scores as <stat>_low and <stat>_high: the mean of those
    in the page's language and in all pages that have a reference."""
    ref = (F.col("boundary_share") >= REF_BOUNDARY) & (F.col("common_share") >= REF_COMMON)
    stack = f"stack({len(RANKED)}, " + ", ".join(f"'{s}', {s}" for s in RANKED) + ") as (stat, value)"
    long = stats.withColumn("ref", ref).select("page_id", "grp", "ref", F.expr(stack))
    both = long.unionByName(long.withColumn("grp", F.lit("*")))
    ranks = exact_ranks(both.select("grp", "stat", "value", "ref"))
    out = lambda n: F.log(F.greatest(n / F.col("total"), F.lit(FLOOR))) / math.log(FLOOR)
    tails = ranks.filter("total > 0").select("grp", "stat", "value", out(F.col("upto")).alias("low"), out(F.col("total") - F.col("below")).alias("high"))
    scored = both.select("page_id", "grp", "stat", "value").join(tails, ["grp", "stat", "value"])
    pick = lambda s, side: F.avg(F.when(F.col("stat") == s, F.col(side))).alias(f"{s}_{side}")
    return scored.groupBy("page_id").agg(*(pick(s, side) for s in RANKED for side in ("low", "high")))


def _combined(kind: str):
    """The mean tail score of a kind's sides; NULL where there is none."""
    one = lambda s: F.col(s[:-1] + ("_high" if s[-1] == "+" else "_low"))
    sides = [one(s) if isinstance(s, str) else F.greatest(*map(one, s)) for s in SIDES[kind]]
    return sum(sides[1:], sides[0]) / len(sides)


def page_kinds(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, lines, repeated_share, statistics, label, junk_score, table_score, list_score, page_kind of every page."""
    stats = page_statistics(spark, data_dir).join(labelled_language(spark, data_dir), "page_id", "left").withColumn("grp", F.coalesce("label", F.lit("")))
    stats = checkpoint(stats)
    kinds = stats.drop("grp").join(tail_scores(stats), "page_id", "left")
    scores = [F.when((F.col("word_count") > 0) | (F.col("nonword_share") > 0), _combined(k)).alias(f"{k}_score") for k in SIDES]
    kinds = kinds.select(*[c for c in stats.columns if c != "grp"], *scores)
    named = F.when(F.col("nonword_share") > 0.5, "junk").when(F.col("row_share") > 0.5, "table").otherwise("list")
    best = F.greatest(*(F.col(f"{k}_score") for k in SIDES))
    return kinds.withColumn("page_kind", F.when(best >= OUTLIER, named).otherwise("prose"))


def p4_statistics(spark: SparkSession, data_dir: str) -> DataFrame:
    """The statistics, scores and verdict of every page with a line."""
    return page_kinds(spark, data_dir).drop("label")


def p4_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, page_kind (list, table, junk) of pages that are not prose; repetitive pages and pages of under
    five lines are no cases."""
    return page_kinds(spark, data_dir).filter(f"page_kind <> 'prose' and lines >= {LEAST_LINES} and repeated_share < {REPEATED}").select("page_id", "page_kind")
