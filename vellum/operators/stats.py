"""Page statistics and the text functions around them.

Lines: page_id, line_pos, text, text_conf.  NULL confidences are left out of means and quantiles, which are 0 for a
page without any; a NULL text has length NULL and is left out of joined texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = 100


def page_stats(lines: DataFrame) -> DataFrame:
    """page_id, page_conf_mean, page_conf_median, page_conf_25, page_conf_75 (linear interpolation), n_long_rowtext, n_lines;
    one aggregation."""
    q = F.percentile("text_conf", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    per = lines.groupBy("page_id").agg(F.avg("text_conf").alias("m"), q.alias("q"), F.count_if(F.length("text") > LONG).alias("n_long_rowtext"), F.count("*").alias("n_lines"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return per.select("page_id", zero(F.col("m")).alias("page_conf_mean"), zero(F.col("q")[1]).alias("page_conf_median"), zero(F.col("q")[0]).alias("page_conf_25"), zero(F.col("q")[2]).alias("page_conf_75"), "n_long_rowtext", "n_lines")


def page_text(lines: DataFrame) -> DataFrame:
    """page_id, text: the page's lines in order, joined by blanks.  A page is bounded by what fits on a sheet."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_pos", "text"))), lambda x: x["text"]), " ")
    return lines.groupBy("page_id").agg(joined.alias("text"))


def batches(lines: DataFrame, size: int) -> DataFrame:
    """Lines with the number of the recognition batch they fall in: slices of ``size`` of the page's lines in order, all but
    the last full, whatever places are missing."""
    at = F.row_number().over(Window.partitionBy("page_id").orderBy("line_pos")) - 1
    return lines.withColumn("batch", F.floor(at / size).cast("int"))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


# Frequent words told apart by language, for the summary of a page.
_WORDS = {"en": "the and of to in that", "fi": "ja on ei se oli että", "sv": "och att det som den är", "de": "und der die das nicht den", "la": "et in non est cum ad", "ru": "и въ не что на съ"}


def _among(words: str):
    return lambda w: w.isin(words.split())


def language_summary(lines: DataFrame) -> DataFrame:
    """page_id, language: the language whose frequent words are met most on the page; unknown if none is."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    hits = [F.size(F.filter(words, _among(ws))).alias(k) for k, ws in _WORDS.items()]
    per = lines.select("page_id", *hits).groupBy("page_id").agg(*[F.sum(k).alias(k) for k in _WORDS])
    best = F.array_max(F.array(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("k")) for k in _WORDS]))
    return per.select("page_id", F.when(best["n"] > 0, best["k"]).otherwise("unknown").alias("language"))


def printed(c: Column) -> Column:
    """Two decimals of the exact binary value, half to even, as C's printf."""

    @F.pandas_udf("string")
    def fmt(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if pd.isna(x) else f"{x:.2f}")

    return fmt(c)


def rounded(c: Column) -> Column:
    """The value rounded to two decimals, correctly from its exact binary value, in its shortest notation ('0.3', '1.0')."""

    @F.pandas_udf("string")
    def fmt(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if pd.isna(x) else str(round(float(x), 2)))

    return fmt(c)


def format_2dp(values: DataFrame, column: str) -> DataFrame:
    """Adds ``column``_text: its two decimals as ``printed``."""
    return values.withColumn(f"{column}_text", printed(F.col(column)))
