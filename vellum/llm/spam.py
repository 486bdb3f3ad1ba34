"""Problem 9: keyword-stuffed and link-list pages.

Two kinds of evidence are joined.  Replication, across the corpus: every document is exploded into phrase shingles - five
content words, order and repeats aside, with names, figures, links and tags masked - and distinct hosts are counted for
every shingle; ``replicated`` is the share of a document's shingles that stand on HOSTS hosts or more.  A host is a source
and volume; a page of unknown volume is a host of its own, its copies with it.  Density, within a document: ``dense`` is the
share of its characters in lines of strung or repeated keywords, links with their captions, or tags.

A document is spam if dense + replicated / 2 >= EVIDENCE.  A page that is half dense has to be stitched from replicated
phrases by half, one that is a quarter dense entirely; a page of which three quarters are dense is spam whatever its
phrases.  Prose copied elsewhere is replicated but not dense; a list of names or references is dense in neither.

Documents are read in chunks.  A chunk sends each distinct shingle once, with its host or the mark of several, to the
shingle's bucket; the bucket answers the chunk with one bit a shingle; the chunk's documents add up their bits.  So a
phrase of a third of all documents costs one entry a chunk, nothing is kept by document on the way, and no
document or phrase is left out.

NULL or empty texts have no row; a document without a shingle has replicated 0; rows repeated under one doc_id give
one row, of the highest values."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.arrow import arrow_schema, batches_of, groups
from vellum.llm.pagelib import COMMON
from vellum.llm.textnorm import skeleton
from vellum.sources.tables import buckets_for, checkpoint, table

SHINGLE = 5
HOSTS = 2
EVIDENCE = 0.75
CHUNK_CHARS = 8_000_000
#: Bytes of text whose shingles make a bucket, and of a partition of buckets or chunks.
BUCKET_BYTES, PARTITION_BYTES = 2 << 20, 4 << 20
SEVERAL = 0xFFFFFFFF  # host of a shingle that stands on several hosts of a chunk
_PIECES = "chunk BIGINT, bucket BIGINT, n BIGINT, phrases BINARY, hosts BINARY, docs BINARY"
_BITS = "chunk BIGINT, bucket BIGINT, n BIGINT, bits BINARY"
_SCORES = "doc_id BIGINT, dense DOUBLE, shingles BIGINT, replicated DOUBLE"
_DOC = np.dtype([("doc", "<i8"), ("dense", "<f8"), ("at", "<i8"), ("end", "<i8")])

_LINK = re.compile(r"https?://|www\.|[a-z0-9-]+(?:\.[a-z0-9-]+)+/", re.I)
_URL = re.compile(r"(?:https?://|www\.)[^\s\"'<>)\]]+|[a-z0-9-]+(?:\.[a-z0-9-]+)+/[^\s\"'<>)\]]*", re.I)
_REFERENCE = re.compile(r"\s*[(\[]?\d+[)\].:]")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_LETTER = re.compile(r"[^\W\d_]")


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s)


_NAME, _FIGURE, _LINKED, _TAG = (_hash(f"§{x}") for x in ("name", "figure", "link", "tag"))


class _Words(dict):
    """raw token -> (folded content word or None, hash of what stands for it in a shingle, or 0)."""

    most = 300_000

    def __missing__(self, raw: str):
        if len(self) >= self.most:
            self.clear()
        s = _EDGE.sub("", skeleton(raw))
        w = s.lower()
        if not s or w in COMMON:
            out = (None, 0)
        elif not _LETTER.search(s):
            out = (None, _FIGURE)
        else:
            out = (w, _NAME if s[0].isupper() else _hash(w))
        self[raw] = out
        return out


_WORDS = _Words()


def read_document(text: str) -> tuple[float, np.ndarray]:
    """Dense share of a document's characters, and the hashes of its shingles with repeats."""
    get = _WORDS.__getitem__
    lines, count, marks = [], Counter(), []
    for line in text.split("\n"):
        if not line or line.isspace():
            continue
        tags = links = 0
        body = line
        if "/" in line and _LINK.search(line):
            body, links = _URL.subn(" ", line)
            body = body.replace("<a href=", " ").replace("</a>", " ")
            marks += [_LINKED] * links
        raw = body.split()
        if "#" in body:
            words = [t for t in raw if t[0] != "#" or len(t) < 2]
            tags = len(raw) - len(words)
            marks += [_TAG] * tags
            raw = words
        found = list(map(get, raw))
        content = [w for w, _ in found if w]
        count.update(content)
        marks += [h for _, h in found if h]
        lines.append((len(line), links, tags, len(raw), sum(map(len, content)), content, line))
    total = sum(x[0] for x in lines)
    often = max(3, 0.02 * count.total())
    dense = 0
    for size, links, tags, n, letters, content, line in lines:
        if tags >= 3 and tags >= n or links and letters < 60 and not _REFERENCE.match(line) or _strung(line, content):
            dense += size
        elif len(content) >= 4 and sum(count[w] >= often for w in content) >= 0.6 * len(content):
            dense += size
    h = np.array(marks, dtype=np.uint64)
    return (dense / total if total else 0.0), shingles(h)


_CELLS = re.compile(r" ?[»|·•;] ?| / ")


def _strung(line: str, content: list[str]) -> bool:
    """Whether a line is cells of one or two words between separators, without function words."""
    if not _CELLS.search(line):
        return False
    cells = len(_CELLS.split(line))
    words = len(line.split())
    return cells >= 3 and content and len(content) <= 2.5 * cells and words <= 4 * cells and not any(w.strip(".,").lower() in COMMON for w in line.split()) and sum(c.isdigit() for c in line) < 0.2 * len(line)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of each run of SHINGLE words as a set; of all words if there are fewer."""
    n = len(words)
    if not n:
        return words
    w = np.sort(np.lib.stride_tricks.sliding_window_view(words, min(SHINGLE, n)), axis=1)
    w[:, 1:][w[:, 1:] == w[:, :-1]] = 0
    w = (w ^ (w >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    s = w.sum(axis=1, dtype=np.uint64)
    return (s ^ (s >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _chunk(docs: list[tuple[int, float, np.ndarray, int]], buckets: int):
    """Pieces of a chunk of documents (doc, dense, shingle hashes, host): one a bucket, and the chunk's documents as
    indices into its distinct shingles, which are numbered by bucket, host and hash."""
    uniques, counts = [], []
    for _, _, h, _ in docs:
        u, n = np.unique(h, return_counts=True)
        uniques.append(u)
        counts.append(n)
    sizes = np.array([len(u) for u in uniques], dtype=np.int64)
    flat = np.concatenate([*uniques, np.zeros(0, dtype=np.uint64)])
    host = np.repeat(np.array([d[3] for d in docs], dtype=np.uint32), sizes)
    phrase, at = np.unique(flat, return_inverse=True)
    least, most = np.full(len(phrase), SEVERAL, dtype=np.uint32), np.zeros(len(phrase), dtype=np.uint32)
    np.minimum.at(least, at, host)
    np.maximum.at(most, at, host)
    least[least != most] = SEVERAL
    bucket = (phrase % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((phrase, least, bucket))
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    phrase, least, bucket = phrase[order], least[order], bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, dtype=np.int64)
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
        yield int(bucket[a]), b - a, phrase[a:b].tobytes(), least[a:b].tobytes(), None
    table_ = np.empty(len(docs), dtype=_DOC)
    end = np.cumsum(sizes)
    table_["doc"], table_["dense"], table_["at"], table_["end"] = [d[0] for d in docs], [d[1] for d in docs], end - sizes, end
    n = np.concatenate([*counts, np.zeros(0, dtype=np.int64)]).astype(np.uint32)
    yield -1, len(docs), place[at].tobytes(), n.tobytes(), table_.tobytes()


def _read(buckets: int):
    schema = arrow_schema(_PIECES)

    def rows(batches):
        from pyspark import TaskContext

        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for doc, text, host in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "host"))):
                if doc is None or not text:
                    continue
                dense, h = read_document(text)
                held.append((doc, dense, h, host & 0x7FFFFFFF))
                size += len(text)
                if size >= CHUNK_CHARS:
                    yield from (((part << 32) | number, *piece) for piece in _chunk(held, buckets))
                    held, size, number = [], 0, number + 1
        if held:
            yield from (((part << 32) | number, *piece) for piece in _chunk(held, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(rows(batches), schema, 64)

    return run


def _answer(batches):
    """A bit for each shingle of the pieces of sorted buckets: whether it stands on HOSTS hosts or more."""
    for bucket, rows in groups(batches, "bucket"):
        phrase = np.concatenate([np.frombuffer(r[3], dtype=np.uint64) for r in rows])
        host = np.concatenate([np.frombuffer(r[4], dtype=np.uint32) for r in rows])
        _, at = np.unique(phrase, return_inverse=True)
        least, most = np.full(len(phrase), SEVERAL, dtype=np.uint32), np.zeros(len(phrase), dtype=np.uint32)
        np.minimum.at(least, at, host)
        np.maximum.at(most, at, host)
        many = ((least != most) | (most == SEVERAL))[at]
        a = 0
        for chunk, _, n, *_ in rows:
            yield chunk, bucket, n, np.packbits(many[a : a + n]).tobytes()
            a += n


def _score(batches):
    """doc_id, dense, shingles, replicated of the chunks' documents; a chunk's documents come first (bucket -1)."""
    for _, rows in groups(batches, "chunk"):
        bits = [np.unpackbits(np.frombuffer(r[5], dtype=np.uint8), count=r[2]) for r in rows[1:]]
        many = np.concatenate([*bits, np.zeros(0, dtype=np.uint8)])
        _, _, _, place, n, _, docs = rows[0]
        n = np.frombuffer(n, dtype=np.uint32).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        found = np.concatenate([[0], np.cumsum(n * many[np.frombuffer(place, dtype=np.uint32)])])
        docs = np.frombuffer(docs, dtype=_DOC)
        t, f = total[docs["end"]] - total[docs["at"]], found[docs["end"]] - found[docs["at"]]
        yield from zip(docs["doc"].tolist(), docs["dense"].tolist(), t.tolist(), (f / np.maximum(t, 1)).tolist())


def document_scores(documents: DataFrame) -> DataFrame:
    """doc_id, dense, shingles, replicated of every document (doc_id, text, source, volume_id) with a text."""
    size = documents.select("doc_id", "text")
    unknown = F.xxhash64("text")
    host = F.when(F.col("volume_id").isNull(), unknown).otherwise(F.xxhash64(F.lower(F.trim(F.coalesce("source", F.lit("")))), "volume_id"))
    host = F.pmod(host, F.lit(1 << 31))
    buckets, parts = buckets_for(size, BUCKET_BYTES, 1), buckets_for(size, PARTITION_BYTES, 1)
    # pinned: a chunk's number must mean the same documents in both of its uses
    pieces = checkpoint(documents.select("doc_id", "text", host.alias("host")).mapInArrow(_read(buckets), _PIECES))
    asked = pieces.filter("bucket >= 0").select("chunk", "bucket", "n", "phrases", "hosts")
    # by range: a few buckets a partition, hashed, would fall unevenly
    bits = asked.repartitionByRange(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_mapped(_answer, _BITS), _BITS)
    none = F.lit(None).cast("binary")
    docs = pieces.filter("bucket < 0").select("chunk", "bucket", "n", F.col("phrases").alias("place"), F.col("hosts").alias("times"), none.alias("bits"), "docs")
    both = docs.unionByName(bits.select("chunk", "bucket", "n", none.alias("place"), none.alias("times"), "bits", none.alias("docs")))
    scores = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(_mapped(_score, _SCORES), _SCORES)
    return scores.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in ("dense", "shingles", "replicated")))


def _mapped(fn, ddl: str):
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(fn(batches), schema, 2000)

    return run


def p9_scores(spark: SparkSession, data_dir: str) -> DataFrame:
    """doc_id, dense, shingles, replicated: the evidence of every document with a text."""
    return document_scores(table(spark, data_dir, "documents").select("doc_id", "text", "source", "volume_id"))


def p9_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """doc_id of the spam documents."""
    return p9_scores(spark, data_dir).filter(F.col("dense") + F.col("replicated") / 2 >= EVIDENCE).select("doc_id")
