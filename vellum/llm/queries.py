"""Queries of the training-text operators, and SQL equivalents where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import language, leakage, lookalikes, mixing, quality, repair, repetition, spam


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": repetition.p1_found,
        "p1_repetition": repetition.page_repetition,
        "p2_found": language.p2_found,
        "p2_segments": language.p2_segments,
        "p2_pages": language.p2_pages,
        "p4_found": quality.p4_found,
        "p4_statistics": quality.p4_statistics,
        "p5_found": lookalikes.p5_found,
        "p5_classes": lookalikes.p5_classes,
        "p5_one_form": lookalikes.p5_one_form,
        "p6_found": repair.p6_found,
        "p6_noise": repair.noise,
        "p6_paragraphs": repair.p6_paragraphs,
        "p7_found": leakage.p7_found,
        "p7_matches": leakage.p7_matches,
        "p7_clean": leakage.p7_clean,
        "p8_mix": mixing.p8_mix,
        "p8_blocks": mixing.p8_blocks,
        "p8_pointers": mixing.p8_pointers,
        "p8_shares": mixing.p8_shares,
        "p9_found": spam.p9_found,
        "p9_scores": spam.p9_scores,
    }


def oracle_sql() -> dict[str, str]:
    return {}
