"""Problem 2: the language of every page and of every stretch of lines in one language.

A bidirectional gated recurrent network over bytes (``bigru``) labels every position; position log-probabilities are
pooled by line; a Viterbi pass over the page's lines, in which a language lasts five lines or more, gives the
stretches; their confidence is the pooled probability.  The network is trained on the driver on a bounded
sample of lines of labelled pages (SAMPLE_LINES a language), then again without the lines whose label it doubts,
as some labels are wrong.

NULL and empty lines carry no evidence and join their neighbours; furniture is left out; a page without text has no
stretch; without any labelled page nothing can be trained and there are no rows."""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.arrow import map_rows
from vellum.llm.bigru import BiGRU
from vellum.llm.langnames import LANGUAGES
from vellum.llm.pages import page_lines, pages_in, sorted_pages
from vellum.llm.quality import labelled_language
from vellum.llm.textnorm import skeleton
from vellum.sources.tables import table

#: Bounds of the training sample: pages a label, lines a label.
SAMPLE_PAGES, SAMPLE_LINES = 120, 1200
HIDDEN, STEPS, AGAIN = 10, 400, 250
LEAST = 5  # lines of a stretch, unless it is the page
SWITCH = 6.0  # what a change of language costs, in units of a line's log-probability
SURE = 0.65  # confidence below which a stretch goes to its neighbour, and a label isn't called wrong
BUFFERED = 8192  # lines labelled at once
_TWO_LETTERS = re.compile(r"[^\W\d_]{2}")
_DDL = "page_id BIGINT, page_lines INT, page_kind STRING, first_pos INT, n_lines INT, lang STRING, confidence DOUBLE, n_stretches INT"


def training_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """label, text: at most SAMPLE_LINES lines a language, of at most SAMPLE_PAGES pages, chosen by hash."""
    pages = labelled_language(spark, data_dir).filter("label is not null")
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("page_id"), "page_id")
    pages = pages.withColumn("rn", F.row_number().over(by_hash)).filter(F.col("rn") <= SAMPLE_PAGES).select("page_id", "label")
    lines = table(spark, data_dir, "line_texts").select("page_id", "line_uid", "text").filter("length(text) > 20")
    # broadcast: len(LANGUAGES) * SAMPLE_PAGES rows at most
    lines = lines.join(F.broadcast(pages), "page_id")
    by_line = Window.partitionBy("label").orderBy(F.xxhash64("line_uid"), "line_uid", "text")
    return lines.withColumn("rn", F.row_number().over(by_line)).filter(F.col("rn") <= SAMPLE_LINES).select("label", "text")


def fold(text: str) -> str:
    """What the network reads of a line: look-alikes resolved, lower case, tokens without two letters in a row
    (figures, marks) left out, as they are of no language."""
    return " ".join(t for t in skeleton(text).lower().split() if _TWO_LETTERS.search(t))


@functools.lru_cache(maxsize=4)
def _trained(sample: tuple[tuple[str, str], ...]) -> BiGRU:
    return train([t for _, t in sample], [y for y, _ in sample])


def train(texts: list[str], labels: list[str], seed: int = 1) -> BiGRU:
    """The network of one training sample; the same sample in any order of rows gives the same network."""
    pairs = sorted(zip(labels, map(fold, texts)))
    y = np.array([LANGUAGES.index(a) for a, _ in pairs], dtype=np.int64)
    x = [b for _, b in pairs]
    net = BiGRU(len(LANGUAGES), hidden=HIDDEN, seed=seed)
    net.fit(x, y, steps=STEPS, seed=seed)
    sure = net.pooled(x)[np.arange(len(y)), y] > np.log(0.25)
    if sure.any():
        net.fit([a for a, s in zip(x, sure) if s], y[sure], steps=AGAIN, rate=0.01, seed=seed + 1)
    return net


def stretches(logp: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(first, end, language, confidence) of the stretches of a page's lines, from each line's pooled
    log-probabilities and its weight (0 for a line without text)."""
    n, k = logp.shape
    e = np.maximum(logp, -5.0) * weight[:, None]
    total = e.sum(axis=0)
    top = int(total.argmax())
    doubt = (e.max(axis=1) - e[:, top] > 1.0).sum()
    cuts = [(0, n, top)]
    if n >= 2 * LEAST and doubt >= 3:
        cuts = _viterbi(e)
    found = [_confident(logp, weight, *cut) for cut in cuts]
    while len(found) > 1 and min(c for *_, c in found) < SURE:
        found = _merged(logp, weight, found, min(range(len(found)), key=lambda k: found[k][3]))
    return found


def _merged(logp: np.ndarray, weight: np.ndarray, found: list[tuple[int, int, int, float]], k: int) -> list[tuple[int, int, int, float]]:
    """``found`` with the doubtful stretch ``k`` given to the neighbour whose language fits its lines better."""
    a, b, *_ = found[k]
    fit = (logp[a:b] * weight[a:b, None]).sum(axis=0)
    to = max((j for j in (k - 1, k + 1) if 0 <= j < len(found)), key=lambda j: fit[found[j][2]])
    out: list[tuple[int, int, int]] = []
    for j, (first, end, lang, _) in enumerate(found):
        lang = found[to][2] if j == k else lang
        if out and out[-1][2] == lang:
            out[-1] = (out[-1][0], end, lang)
        else:
            out.append((first, end, lang))
    return [_confident(logp, weight, *cut) for cut in out]


def _confident(logp: np.ndarray, weight: np.ndarray, a: int, b: int, lang: int) -> tuple[int, int, int, float]:
    w = weight[a:b].sum()
    pooled = (logp[a:b] * weight[a:b, None]).sum(axis=0) / w if w else np.zeros(logp.shape[1])
    p = np.exp(pooled - pooled.max())
    return a, b, lang, float(p[lang] / p.sum())


def _viterbi(e: np.ndarray) -> list[tuple[int, int, int]]:
    """Best languages of all lines, each lasting LEAST lines or more; states are (language, lines so far)."""
    n, k = e.shape
    v = np.full((k, LEAST), -np.inf)
    v[:, 0] = e[0]
    came = np.zeros((n, k), dtype=np.int64)  # language before a stretch that starts here
    grew = np.zeros((n, k), dtype=bool)  # whether the full-length state came from itself
    for t in range(1, n):
        full = v[:, -1]
        best = int(full.argmax())
        rest = full.copy()
        rest[best] = -np.inf
        second = int(rest.argmax())
        new = np.empty_like(v)
        came[t] = best
        came[t, best] = second
        new[:, 0] = full[came[t]] - SWITCH
        new[:, 1:-1] = v[:, : LEAST - 2]
        grew[t] = v[:, -1] >= v[:, -2]
        new[:, -1] = np.maximum(v[:, -1], v[:, -2])
        v = new + e[t][:, None]
    lang, length, cuts, end = int(v[:, -1].argmax()), LEAST - 1, [], n
    for t in range(n - 1, 0, -1):
        if length == LEAST - 1:
            length = LEAST - 1 if grew[t, lang] else LEAST - 2
        elif length > 0:
            length -= 1
        else:
            cuts.append((t, end, lang))
            end, lang, length = t, int(came[t, lang]), LEAST - 1
    cuts.append((0, end, lang))
    return cuts[::-1]


def _label(net: BiGRU):
    def flush(held):
        texts = [fold(t) for _, _, _, body in held for _, t in body]
        logp, at = net.pooled(texts), 0
        for page_id, n, kind, body in held:
            q = logp[at : at + len(body)]
            sizes = np.array([len(t) for t in texts[at : at + len(body)]], dtype=np.float64)
            at += len(body)
            if not len(body) or not sizes.any():
                continue
            cuts = stretches(q, np.minimum(sizes, 25.0) / 25.0)
            for a, b, lang, conf in cuts:
                yield page_id, n, kind, body[a][0], b - a, LANGUAGES[lang], conf, len(cuts)

    def rows(batches):
        held, lines = [], 0
        for page_id, page in pages_in(batches):
            body = [(pos, text or "") for i, (pos, text) in enumerate(page.lines) if i not in page.skip]
            held.append((page_id, len(page.lines), page.kind(), body))
            lines += len(body)
            if lines >= BUFFERED:
                yield from flush(held)
                held, lines = [], 0
        yield from flush(held)

    return rows


def p2_segments(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, page_lines, page_kind, first_pos, n_lines, lang, confidence, n_stretches: one row per stretch of
    consecutive lines in one language, of every page."""
    sample = training_lines(spark, data_dir).collect()  # bounded: SAMPLE_LINES a language
    if not sample:
        return spark.createDataFrame([], _DDL)
    net = _trained(tuple(sorted((r.label, r.text) for r in sample)))  # the same sample is trained on once
    return sorted_pages(page_lines(spark, data_dir)).mapInArrow(map_rows(_label(net), _DDL), _DDL)


def p2_pages(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, lang, confidence: each page's language, by the lines of its stretches, and its confidence."""
    by = p2_segments(spark, data_dir).groupBy("page_id", "lang").agg(F.sum("n_lines").alias("n"), F.sum(F.col("confidence") * F.col("n_lines")).alias("c"))
    best = by.groupBy("page_id").agg(F.max(F.struct("n", "c", "lang")).alias("b"))
    return best.select("page_id", "b.lang", (F.col("b.c") / F.col("b.n")).alias("confidence"))


def p2_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, first_pos, lang of the stretches of pages whose label is missing or wrong, or that hold more than
    one language; pages of under five lines, tables and junk are no cases."""
    found = p2_segments(spark, data_dir).filter(f"page_lines >= {LEAST} and page_kind not in ('table', 'junk')")
    labels = labelled_language(spark, data_dir)
    wrong = F.col("label").isNull() | (F.col("n_stretches") > 1) | ((F.col("label") != F.col("lang")) & (F.col("confidence") >= SURE))
    return found.join(labels, "page_id", "left").filter(wrong).select("page_id", "first_pos", "lang")
