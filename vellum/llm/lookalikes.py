"""Problem 5: visually identical text with different characters.

Every text is brought to its confusables skeleton (decompose, prototype, decompose); texts with equal skeletons
look the same.  Originals are grouped by the skeleton's 128-bit hash, so that a shuffle carries 16 bytes a text.

Copies of one text form one class (skeleton, text); classes are pre-aggregated before anything is joined, so a skeleton held by
a third of all rows costs one row per distinct text and partition.  Lines of a skeleton with up to PAIRED lines are all
paired; in a larger one, each line is paired with the first line of one text, or that text's with another - a row a line, which
links them all - and ``p5_classes`` gives the membership.  NULL texts and texts under ``MIN_LENGTH`` characters give no
pair; repeated recognitions count once (the latest)."""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.arrow import groups, map_rows
from vellum.llm.textnorm import skeleton
from vellum.sources.tables import checkpoint, table

MIN_LENGTH = 20
#: Lines of one skeleton up to which they are paired with one another; beyond it, they are paired with a representative.
PAIRED = 64
_DDL = "line_uid BIGINT, skel BINARY, txt BINARY"


def _hash_lines(batches):
    for _, rows in groups(batches, "page_id"):
        latest = {}
        for _, pos, _at, uid, text in rows:
            latest[pos] = (uid, text)
        for uid, text in latest.values():
            if uid is not None and text is not None and len(text) >= MIN_LENGTH:
                yield uid, xxhash.xxh3_128_digest(skeleton(text).strip()), xxhash.xxh3_128_digest(text)


def hashed_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """line_uid, skel, txt of the current lines of MIN_LENGTH characters or more."""
    rows = table(spark, data_dir, "line_texts").select("page_id", "line_pos", "recognised_at", "line_uid", "text").filter("page_id is not null and line_pos is not null")
    return rows.repartition("page_id").sortWithinPartitions("page_id", "line_pos", "recognised_at", "line_uid", "text").mapInArrow(map_rows(_hash_lines, _DDL), _DDL)


def look_alike_classes(hashed: DataFrame) -> DataFrame:
    """skel, txt, rep, copies of every text that another text looks like, and of its skeleton: lines, n_texts, its first line
    (first_uid), one of its texts (one_txt), and the first lines of that (one_uid) and of another text (other_uid)."""
    classes = hashed.groupBy("skel", "txt").agg(F.min("line_uid").alias("rep"), F.count("*").alias("copies"))
    one, other = F.struct("txt", "rep"), F.count("*").alias("n_texts")
    whole = classes.groupBy("skel").agg(F.min(one).alias("one"), F.max(one).alias("other"), F.min("rep").alias("first_uid"), F.sum("copies").alias("lines"), other).filter("n_texts > 1")
    return classes.join(whole.select("skel", F.col("one.txt").alias("one_txt"), F.col("one.rep").alias("one_uid"), F.col("other.rep").alias("other_uid"), "first_uid", "lines", "n_texts"), "skel")


def p5_classes(spark: SparkSession, data_dir: str) -> DataFrame:
    """line_uid, class_uid, look_uid, n_texts: each line that another text looks like, the first line with its
    text, the first line that looks like it, and the number of differing texts that do."""
    hashed = checkpoint(hashed_lines(spark, data_dir))
    named = look_alike_classes(hashed).select("skel", "txt", F.col("rep").alias("class_uid"), F.col("first_uid").alias("look_uid"), "n_texts")
    return hashed.join(named, ["skel", "txt"]).select("line_uid", "class_uid", "look_uid", "n_texts")


def p5_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """uid_a, uid_b of lines that look the same but whose texts differ, the smaller first."""
    hashed = checkpoint(hashed_lines(spark, data_dir))
    classes = checkpoint(look_alike_classes(hashed))
    rows = hashed.join(classes, ["skel", "txt"]).select("skel", "txt", "line_uid", "lines", "one_txt", "one_uid", "other_uid")
    few = rows.filter(F.col("lines") <= PAIRED).select("skel", "txt", "line_uid")
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.skel") == F.col("b.skel")) & (F.col("a.txt") != F.col("b.txt")) & (F.col("a.line_uid") < F.col("b.line_uid")))
    pairs = pairs.select(F.col("a.line_uid").alias("uid_a"), F.col("b.line_uid").alias("uid_b"))
    mate = F.when(F.col("txt") == F.col("one_txt"), F.col("other_uid")).otherwise(F.col("one_uid"))
    many = rows.filter(F.col("lines") > PAIRED).select(F.least("line_uid", mate).alias("uid_a"), F.greatest("line_uid", mate).alias("uid_b"))
    return pairs.unionByName(many).distinct()


def _forms(batches):
    for batch in batches:
        for uid, text in zip(*(c.to_pylist() for c in batch.columns)):
            yield uid, skeleton(text) if text is not None else None


def p5_one_form(spark: SparkSession, data_dir: str) -> DataFrame:
    """line_uid, form: the consistent form of every row's text (NULL stays NULL)."""
    return table(spark, data_dir, "line_texts").select("line_uid", "text").mapInArrow(map_rows(_forms, "line_uid BIGINT, form STRING"), "line_uid BIGINT, form STRING")
