"""Problem 7: evaluation texts leaking into training text.

Texts are compared by their letters and digits alone, lower case, look-alikes resolved, so that punctuation, spacing,
line breaks and words cut at a line end make no difference on either side; where a word begins and ends is kept beside
them.  Documents are collected into shards.  A shard's letters become numbers, and its suffixes that begin a word a suffix
array, sorted by packed keys.  Every suffix of every item that begins a word with MATCH - 1 words after it is
binary-searched in every shard's array by the letters those words have at least; the matches are lengthened
to the longest, with their places, and count if MATCH or more whole words of the item lie in them.

The items are a stated query set read against all rows: they are made ready in parts of ITEM_LETTERS letters, each
part is broadcast, and every shard is searched for one part after the other, so the corpus is read and normalised once.

NULL or empty documents and items of under MATCH words match nothing; repeated documents and items each match."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.arrow import arrow_schema
from vellum.llm.textnorm import skeleton
from vellum.sources.tables import table

MATCH = 13
#: Characters of a shard.
SHARD_CHARS = 8_000_000
#: Letters of the items searched at once: what a broadcast part and a worker hold of them is bounded by it.
ITEM_LETTERS = 24_000_000
#: Pairs of matching suffixes looked at at once.
PAIRS = 2_000_000
_DDL = "doc_id BIGINT, item_id BIGINT, n_words INT, doc_at INT, item_at INT"
_PLAIN_LINES = re.compile(r"[\n -~åäöÅÄÖüÜßéÉ]*\Z")
_RUN = re.compile(r"[^\W_]+")


def plain(text: str) -> str:
    """A text in lower case with look-alikes resolved; line breaks stay."""
    if not _PLAIN_LINES.match(text):
        text = "\n".join(map(skeleton, text.split("\n")))
    return text.lower()


def runs(text: str) -> list[str]:
    """The runs of letters and digits of a text; joined, they are what is compared."""
    return _RUN.findall(plain(text))


def item_words(text: str) -> tuple[str, list[int], list[int]]:
    """Letters of an item, and where in them its words (non-space runs with a letter or digit) begin and end."""
    parts, begins, ends, at = [], [], [], 0
    for word in plain(text).split():
        w = "".join(_RUN.findall(word))
        if w:
            parts.append(w)
            begins.append(at)
            at += len(w)
            ends.append(at)
    return "".join(parts), begins, ends


def suffix_array(codes: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places``, suffixes of ``codes`` (padded by ``depth``), sorted by their first ``depth`` codes.

    Suffixes with a code under 1 in their first ``depth`` match nothing and are left out.  Codes are packed several
    to a 64-bit key; only ties are sorted by the next key."""
    bad = np.concatenate([[0], np.cumsum(codes < 1)])
    places = places[places + depth <= len(codes)]
    places = places[bad[places + depth] == bad[places]]
    if not len(places):
        return places
    each, bits = _packing(codes)
    group = packed(codes, places, each, bits, min(depth, each))
    order = np.argsort(group, kind="stable")
    places, group = places[order], group[order]
    for k in range(1, -(-depth // each)):
        same = group[1:] == group[:-1]
        at = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(at):
            break
        # tied groups keep their stretch of the array, so sorting them by (group, next key) sorts in place
        nxt = packed(codes, places[at] + k * each, each, bits, min(each, depth - k * each))
        o = np.lexsort((nxt, group[at]))
        was, nxt = group[at][o], nxt[o]
        places[at] = places[at][o]
        fresh = np.concatenate([[True], (was[1:] != was[:-1]) | (nxt[1:] != nxt[:-1])])
        # a group is named by its first place in the array: settled places are their own
        group = np.arange(len(group), dtype=np.int64)
        group[at] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
    return places


def _packing(codes: np.ndarray) -> tuple[int, int]:
    bits = max(1, int(codes.max(initial=1)).bit_length())
    return max(1, 62 // bits), bits


def packed(codes: np.ndarray, at: np.ndarray, each: int, bits: int, n: int) -> np.ndarray:
    """``n`` codes from each place in one number."""
    out = np.zeros(len(at), dtype=np.int64)
    for j in range(n):
        out = (out << bits) | codes[at + j]
    return out


def _compare(codes: np.ndarray, at: np.ndarray, items: np.ndarray, item_at: np.ndarray, depth: int) -> np.ndarray:
    """-1, 0, 1 for each pair: the suffix of ``codes`` against that of ``items``, by their first ``depth`` codes."""
    out = np.zeros(len(at), dtype=np.int8)
    live = np.arange(len(at))
    for k in range(depth):
        a, b = codes[at[live] + k], items[item_at[live] + k]
        differ = a != b
        out[live[differ]] = np.where(a[differ] < b[differ], -1, 1)
        live = live[~differ]
        if not len(live):
            break
    return out


def search(codes: np.ndarray, order: np.ndarray, items: np.ndarray, starts: np.ndarray, depth: int = MATCH) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last place in the suffix array of the suffixes that share ``depth`` codes with the
    items' suffixes at ``starts``; binary search of all of them at once.  ``codes`` and ``items`` are padded."""
    bounds = []
    for upper in (False, True):
        lo, hi = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), len(order), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            c = _compare(codes, order[mid], items, starts[open_], depth)
            right = (c <= 0) if upper else (c < 0)
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        bounds.append(lo)
    return bounds[0], bounds[1]


class Items:
    """A part of the query set: letters as codes end to end with -2 between items, words, and the suffixes searched."""

    def __init__(self, rows: list[tuple[int, str]]):
        letters, owner, begins, ends, first = [], [], [], [], []
        at = 0
        for i, text in rows:
            if i is None or not text:
                continue
            s, b, e = item_words(text)
            if len(b) < MATCH:
                continue
            letters += [s, "\x00"]
            first += [len(begins)] * len(b)
            owner += [i] * len(b)
            begins += [x + at for x in b]
            ends += [x + at for x in e]
            at += len(s) + 1
        chars = np.frombuffer("".join(letters).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        #: the items' letters, in order; a letter's code is its place here, from 1
        self.alphabet = np.unique(chars[chars > 0])
        codes = (np.searchsorted(self.alphabet, chars) + 1).astype(np.int32)
        codes[chars == 0] = -2
        self.begins, self.ends = np.array(begins, dtype=np.int64), np.array(ends, dtype=np.int64)
        self.owner, self.first = np.array(owner, dtype=np.int64), np.array(first, dtype=np.int64)
        k = np.arange(max(0, len(begins) - MATCH + 1))
        #: words (by number) that have MATCH - 1 words of their item after them
        self.words = k[self.first[k] == self.first[k + MATCH - 1]]
        #: letters that MATCH words have at least
        self.depth = int((self.ends[self.words + MATCH - 1] - self.begins[self.words]).min(initial=1 << 30))
        self.codes = np.concatenate([codes, np.full(min(self.depth, 4096) + 1, -2, dtype=np.int32)])
        if len(self.words):
            self.each, self.bits = _packing(np.array([len(self.alphabet)]))
            self.each = min(self.each, self.depth)
            self.keys = np.unique(packed(self.codes, self.begins[self.words], self.each, self.bits, self.each))
            self.sieve = np.zeros(1 << 20, dtype=bool)
            self.sieve[_slot(self.keys)] = True

    def matches(self, doc_ids: list[int], letters: list[str], lengths: list[np.ndarray]):
        """doc_id, item_id, whole words of the longest match, its first word's place in the document and in the item.

        ``letters``: each document's runs joined; ``lengths``: the lengths of the runs."""
        if not len(self.words) or not doc_ids:
            return
        chars = np.frombuffer(("\x00".join(letters) + "\x00").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(x) for x in letters], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # of the documents
        place = np.searchsorted(self.alphabet, chars)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == chars
        codes = np.concatenate([np.where(known, place + 1, -1), np.full(self.depth + 1, -1)]).astype(np.int32)
        flat = np.concatenate(lengths)
        many = np.array([len(x) for x in lengths], dtype=np.int64)
        # ends of the runs: lengths added up, and the gap of one after each document
        ends = np.cumsum(flat) + np.repeat(np.arange(len(many)), many)
        begins = ends - flat
        # only suffixes whose first letters some item suffix begins with can match
        key = packed(np.maximum(codes, 0), begins, self.each, self.bits, self.each)
        near = np.flatnonzero(self.sieve[_slot(key)])
        at = np.searchsorted(self.keys, key[near])
        places = begins[near[self.keys[np.minimum(at, len(self.keys) - 1)] == key[near]]]
        order = suffix_array(codes, places, self.depth)
        if not len(order):
            return
        lo, hi = search(codes, order, self.codes, self.begins[self.words], self.depth)
        hit = np.flatnonzero(hi > lo)
        counts = (hi - lo)[hit]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        cut = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, counts.sum() + PAIRS, PAIRS)) if len(hit) else []
        a = 0
        for b in [*np.minimum(np.array(cut, dtype=np.int64) + 1, len(hit)).tolist()]:
            if b > a:
                self._lengthen(codes, order, ends, starts, self.words[hit[a:b]], lo[hit[a:b]], counts[a:b], best)
            a = max(a, b)
        for (w, first), (n, doc_at, word) in best.items():
            run = int(np.searchsorted(begins, doc_at) - np.searchsorted(begins, starts[w]))
            yield doc_ids[w], int(self.owner[first]), n, run, word - first

    def _lengthen(self, codes, order, ends, starts, words, lo, counts, best) -> None:
        """The longest matches of some item suffixes, into ``best``: (document, item's first word) -> (words, place, word)."""
        word = np.repeat(words, counts)
        doc_at = order[np.repeat(lo - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())]
        item_at = self.begins[word]
        # a match that the word before is part of as well is a tail of that match
        back = item_at - np.where(self.first[word] == word, 0, self.begins[np.maximum(word - 1, 0)])
        longer = (self.first[word] < word) & (doc_at >= back)
        live = np.flatnonzero(longer)
        for k in range(1, int(back[live].max(initial=0)) + 1):
            within = back[live] >= k
            same = self.codes[item_at[live] - k] == codes[doc_at[live] - k]
            longer[live[within & ~same]] = False
            live = live[within & same]
        at_run = np.searchsorted(ends, doc_at - back, side="right")
        longer &= self._begins_run(ends, starts, doc_at - back, at_run)
        word, doc_at, item_at = word[~longer], doc_at[~longer], item_at[~longer]
        n = np.full(len(word), self.depth, dtype=np.int64)
        live = np.arange(len(n))
        while len(live):
            a, b = self.codes[item_at[live] + n[live]], codes[doc_at[live] + n[live]]
            live = live[(a == b) & (b > 0)]
            n[live] += 1
        # whole words: those that end in the match; the last has to end where a run of the document ends
        last = np.searchsorted(self.ends, item_at + n, side="right") - 1
        live = np.flatnonzero(last - word + 1 >= MATCH)
        while len(live):
            at = doc_at[live] + self.ends[last[live]] - item_at[live]
            inside = ends[np.minimum(np.searchsorted(ends, at), len(ends) - 1)] != at
            live = live[inside]
            last[live] -= 1
            live = live[last[live] - word[live] + 1 >= MATCH]
        whole = last - word + 1
        which = np.searchsorted(starts, doc_at, side="right") - 1
        for i in np.flatnonzero(whole >= MATCH).tolist():
            key = (int(which[i]), int(self.first[word[i]]))
            if key not in best or whole[i] > best[key][0]:
                best[key] = (int(whole[i]), int(doc_at[i]), int(word[i]))

    @staticmethod
    def _begins_run(ends, starts, at, run):
        """Whether a run of letters begins at ``at``: the run before ends there, or a document begins."""
        before = np.where(run > 0, ends[np.maximum(run - 1, 0)], -1)
        doc = starts[np.maximum(np.searchsorted(starts, at, side="right") - 1, 0)]
        return (before == at) | (doc == at)


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def _search_shards(parts: list):
    """``parts``: broadcast, pickled ``Items``."""
    schema = arrow_schema(_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = pickle.loads(parts[0].value) if len(parts) == 1 else None
        ids: list[int] = []
        letters: list[str] = []
        lengths: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if d is None or not t:
                    continue
                own = runs(t)
                if own:
                    ids.append(d)
                    letters.append("".join(own))
                    lengths.append(np.fromiter(map(len, own), dtype=np.int64, count=len(own)))
                    size += len(t)
                if size >= SHARD_CHARS:
                    yield from flush(only, ids, letters, lengths)
                    ids, letters, lengths, size = [], [], [], 0
        yield from flush(only, ids, letters, lengths)

    def flush(only, ids, letters, lengths):
        for part in parts if ids else []:
            items = only or pickle.loads(part.value)
            rows = list(items.matches(ids, letters, lengths))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def item_parts(rows: Iterator[tuple[int, str]]) -> Iterator[Items]:
    """The items in parts of about ITEM_LETTERS letters."""
    held, size = [], 0
    for i, t in rows:
        held.append((i, t))
        size += len(t or "")
        if size >= ITEM_LETTERS:
            yield Items(held)
            held, size = [], 0
    if held:
        yield Items(held)


def matches(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words, doc_at, item_at: every document and item that share MATCH words in a row or more,
    with the longest shared run in whole words and where it begins: the how-manieth run of letters of the document,
    word of the item."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null").sort("item_id", "text")
    sc = documents.sparkSession.sparkContext
    parts = [sc.broadcast(pickle.dumps(p)) for p in item_parts((r.item_id, r.text) for r in items.toLocalIterator())]
    slim = documents.select("doc_id", "text")
    if not parts:
        return slim.limit(0).selectExpr("doc_id", "doc_id as item_id", "0 as n_words", "0 as doc_at", "0 as item_at")
    return slim.mapInArrow(_search_shards(parts), _DDL)


def p7_matches(spark: SparkSession, data_dir: str) -> DataFrame:
    return matches(table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark"))


def p7_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """doc_id, item_id of documents that hold MATCH words in a row of the item."""
    return p7_matches(spark, data_dir).select("doc_id", "item_id")


def p7_clean(spark: SparkSession, data_dir: str) -> DataFrame:
    """doc_id, n_chars of the documents no item leaked into."""
    docs = table(spark, data_dir, "documents").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    return docs.join(p7_found(spark, data_dir).select("doc_id").distinct(), "doc_id", "left_anti")
