"""Problem 6: noise in text from scanned pages - furniture, words cut at line ends, misread words - and its repair.

One pass over the pages reads their tokens.  Pages are taken in chunks; a chunk gives its distinct words with their counts,
and its lines as numbers of those words (``_read``); both are pinned, so that the text is read once.  The corpus
vocabulary is the sum of the chunks' words.  Words are grouped by confusable-glyph skeleton; within a group, a rare form
that one listed confusion separates from a frequent form is a misreading of it if the form is far more
frequent, or, where it is a rare form and only twice as frequent, if the context supports it: most of its neighbours stand
beside the other somewhere, too (``contexts``: the neighbours of the forms in question alone are gathered).  What a chunk needs of the vocabulary
(corrections, and the counts of words at line ends) comes back by joins on the word, and chunk and words meet in a
sorted stream (``_find``).  No vocabulary is broadcast or held whole by any task.

NULL and empty lines have no words; pages of under five lines and junk pages are no cases; a misread word that
is cut at a line end counts in the line that holds the wrong character."""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.arrow import groups, map_rows
from vellum.llm.pagelib import COMMON, MARKS, Page, candidates, digit_word, glyph_skeleton, repaired, runs_on
from vellum.llm.pages import page_lines, page_of, pages_in, sorted_pages
from vellum.sources.tables import buckets_for, checkpoint, table

LEAST_LINES = 5
#: Tokens of a chunk, and bytes of text whose chunks make a partition.
CHUNK_TOKENS, PARTITION_BYTES = 200_000, 4 << 20
#: How many times as frequent as a misreading its form is, without and with the support of its context.
FAR, SUPPORTED = 25, 2
#: Share of a form's neighbours, function words aside, that have to stand beside its reading as well.
BESIDE = 0.6
#: Share of all tokens up to which a form is rare enough for its context to decide.
RARE = 1e-5
#: Count in a chunk, or in all, from which on a word's rows are spread over SALTS keys.
SALTED, SALTS = 20, 16
_READ = "chunk BIGINT, word STRING, n BIGINT, hung BIGINT, asked BOOLEAN, id INT, lines BINARY, ends BINARY, tape BINARY, names BINARY"
_VOCABULARY = "word STRING, n BIGINT, hung BIGINT, asked BOOLEAN, reading STRING, sure BOOLEAN, forms BIGINT"
_CONTEXT = "word STRING, side BIGINT, n BIGINT"
_FOUND = "page_id BIGINT, line_pos INT, noise STRING, at_token INT, word STRING, reading STRING"
#: A line of a chunk: its page and place, whether it is furniture, and its tokens' stretch of the tape.
_LINE = np.dtype([("page", "<i8"), ("pos", "<i4"), ("furniture", "<i4"), ("at", "<i8"), ("end", "<i8")])
#: A line end with a next line: their lines, the words' numbers (last, first, joined) and the mark's place in MARKS.
_END = np.dtype([("line", "<i4"), ("next", "<i4"), ("last", "<i4"), ("first", "<i4"), ("joined", "<i4"), ("mark", "<i4")])


class _Chunk:
    """Pages as numbers of their words."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.n, self.hung, self.asked = Counter(), Counter(), set()
        self.lines, self.ends, self.tape = [], [], []

    def number(self, word: str) -> int:
        return self.ids.setdefault(word, len(self.ids))

    def add(self, page_id: int, page) -> None:
        number, tape, base = self.number, self.tape, len(self.lines)
        # pages of under five lines are no cases, but their words count
        case = len(page.lines) >= LEAST_LINES
        for i, (ts, (pos, _)) in enumerate(zip(page.tokens, page.lines)):
            at = len(tape)
            for j, t in enumerate(ts):
                w = t[0]
                if not w:
                    tape.append(-1)
                    continue
                tape.append(number(w))
                if t[1] in MARKS:
                    if j < len(ts) - 1:
                        self.hung[w] += 1
                else:
                    self.n[w] += 1
            self.lines.append((page_id, pos, 2 * (not case) + (i in page.skip), at, len(tape)))
        last = None
        for i, ts in enumerate(page.tokens):
            if not ts:
                continue
            if last is not None:
                w, mark, first = page.tokens[last][-1][0], page.tokens[last][-1][1], ts[0][0]
                if mark != "." and w and first and w[-1].isalpha() and first[0].isalpha():
                    self.asked.update((w, first, w + first))
                    self.ends.append((base + last, base + i, number(w), number(first), number(w + first), MARKS.index(mark) if mark in MARKS else -1))
            last = i

    def rows(self, chunk: int):
        for w, i in self.ids.items():
            yield chunk, w, self.n[w], self.hung[w], w in self.asked or digit_word(w), i, None, None, None, None
        lines, ends = np.array(self.lines, dtype=_LINE), np.array(self.ends, dtype=_END)
        names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.ids), dtype=np.uint64, count=len(self.ids))
        yield chunk, None, None, None, None, -1, lines.tobytes(), ends.tobytes(), np.array(self.tape, dtype=np.int32).tobytes(), names.tobytes()


def _read(batches):
    from pyspark import TaskContext

    part, number, chunk = TaskContext.get().partitionId(), 0, _Chunk()
    for page_id, page in pages_in(batches):
        if page.kind() == "junk":
            continue
        chunk.add(page_id, page)
        if len(chunk.tape) >= CHUNK_TOKENS:
            yield from chunk.rows(part << 32 | number)
            number, chunk = number + 1, _Chunk()
    if chunk.lines:
        yield from chunk.rows(part << 32 | number)


def _key(batches):
    for batch in batches:
        for w, n, hung, asked in zip(*(c.to_pylist() for c in batch.columns)):
            yield glyph_skeleton(w), w, n, hung, asked


def _correct(batches):
    """Readings of the words of sorted glyph groups.  ``sure``: far more frequent; else the context decides."""
    for _, rows in groups(batches, "glyphs"):
        forms = {w: n + hung for _, w, n, hung, _ in rows}
        for _, w, n, hung, asked in rows:
            found = candidates(w, n + hung, forms, FAR, SUPPORTED) if len(w) > 2 or not w.isalpha() else []
            for reading, sure in found:
                yield w, n, hung, asked, reading, sure, forms[reading]
            if not found and asked:
                yield w, n, hung, asked, None, None, None


def vocabulary(words: DataFrame) -> DataFrame:
    """word, n, hung, asked, reading, sure, forms (how frequent the reading is): a row for each reading a word may have,
    and one for each word without that a chunk asked for.  ``words``: chunk, word, n, hung, asked."""
    total = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("hung").alias("hung"), F.max("asked").alias("asked"))
    ddl = "glyphs STRING, word STRING, n BIGINT, hung BIGINT, asked BOOLEAN"
    keyed = total.filter(F.col("word").rlike(r"\p{L}")).mapInArrow(map_rows(_key, ddl), ddl)
    return keyed.repartition("glyphs").sortWithinPartitions("glyphs", "word").mapInArrow(map_rows(_correct, _VOCABULARY), _VOCABULARY)


def _neighbours(batches):
    """Which words stand beside the words in question, of sorted chunks (the chunk itself first, then its words in
    question): hashes of the neighbour, told apart by its side."""
    for _, rows in groups(batches, "chunk"):
        _, _, _, lines, tape, names = rows[0]
        wanted = {i: w for _, i, w, *_ in rows[1:]}
        if not wanted:
            continue
        tape, names, lines = np.frombuffer(tape, dtype=np.int32), np.frombuffer(names, dtype=np.uint64), np.frombuffer(lines, dtype=_LINE)
        asked = np.zeros(len(names), dtype=bool)
        asked[list(wanted)] = True
        owner = np.repeat(np.arange(len(lines)), lines["end"] - lines["at"])
        seen = []
        for step in (-1, 1):
            at = np.flatnonzero(asked[tape] & (tape >= 0))
            at = at[(at + step >= 0) & (at + step < len(tape))]
            at = at[(owner[at + step] == owner[at]) & (tape[at + step] >= 0)]
            side = (names[tape[at + step]] ^ np.uint64(step + 1)) >> np.uint64(1)
            seen.append(np.stack([tape[at].astype(np.int64), side.astype(np.int64)], axis=1))
        pairs, n = np.unique(np.concatenate(seen), axis=0, return_counts=True)
        for (i, side), k in zip(pairs.tolist(), n.tolist()):
            yield wanted[i], side, k


def contexts(pinned: DataFrame, doubtful: DataFrame, parts: int) -> DataFrame:
    """word, side, n: how often each word of ``doubtful`` (word) stands beside each word, as a hash of side and word."""
    none = F.lit(None).cast("binary")
    mine = pinned.filter("id >= 0").select("chunk", "id", "word").join(doubtful, "word", "left_semi").select("chunk", "id", "word", none.alias("lines"), none.alias("tape"), none.alias("names"))
    both = mine.unionByName(pinned.filter("id < 0").select("chunk", "id", "word", "lines", "tape", "names"))
    sides = both.repartition(parts, "chunk").sortWithinPartitions("chunk", "id").mapInArrow(map_rows(_neighbours, _CONTEXT), _CONTEXT)
    return sides.groupBy("word", "side").agg(F.sum("n").alias("n"))


def resolved(words: DataFrame, pinned: DataFrame, parts: int) -> DataFrame:
    """word, n, hung, reading: ``vocabulary`` with the one reading of each word that is sure or supported by context."""
    found = checkpoint(vocabulary(words))
    tokens = words.agg(F.sum("n")).first()[0] or 0
    unsure = found.filter("not sure").filter(F.col("n") <= RARE * tokens)
    doubtful = unsure.select(F.explode(F.array("word", "reading")).alias("word")).distinct()
    common = [xxhash.xxh3_64_intdigest(w) for w in COMMON]
    common = [((h ^ side) >> 1) for h in common for side in (0, 2)]
    near = contexts(pinned, doubtful, parts).filter(~F.col("side").isin(common))
    own = unsure.select("word", "reading", "forms").join(near, "word")
    theirs = near.select(F.col("word").alias("reading"), "side", F.lit(1).alias("both"))
    share = F.sum(F.col("n") * F.coalesce("both", F.lit(0))) / F.sum("n")
    beside = own.join(theirs, ["reading", "side"], "left").groupBy("word", "reading").agg(share.alias("share"), F.max("forms").alias("forms")).filter(F.col("share") >= BESIDE)
    picked = beside.groupBy("word").agg(F.max_by("reading", F.struct("share", "forms", "reading")).alias("picked"))
    each = found.filter("not sure").groupBy("word").agg(F.max("n").alias("n"), F.max("hung").alias("hung"))
    return found.filter("sure or reading is null").select("word", "n", "hung", "reading").unionByName(each.join(picked, "word", "left").select("word", "n", "hung", F.col("picked").alias("reading")))


def _find(batches):
    """The noise of sorted chunks (the chunk itself first, then what it needs of the vocabulary)."""
    for _, rows in groups(batches, "chunk"):
        lines, ends, tape, names = (np.frombuffer(x, dtype=t) for x, t in zip(rows[0][6:], (_LINE, _END, np.int32, np.uint64)))
        word: dict[int, str] = {}
        reading: dict[int, str] = {}
        n, hung = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        wrong = np.zeros(len(names) + 1, dtype=bool)  # the last is that of tokens without a word
        for _, i, w, count, h, r, *_ in rows[1:]:
            word[i], n[i], hung[i] = w, count, h
            if r is not None:
                reading[i] = r
            wrong[i] = r is not None or digit_word(w)
        case = lines["furniture"] < 2
        pages, at = lines["page"].tolist(), lines["pos"].tolist()
        for i in np.flatnonzero(lines["furniture"] == 1).tolist():
            yield pages[i], at[i], "furniture", None, None, None
        cut_end, cut_start = np.zeros(len(lines), dtype=bool), np.zeros(len(lines), dtype=bool)
        for i, j, last, first, joined, mark in ends[case[ends["line"]]].tolist():
            a, b = word[last], word[first]
            if not runs_on(a, MARKS[mark] if mark >= 0 else "", b, n[last], n[first], n[joined], hung[last]):
                continue
            cut_end[i] = cut_start[j] = True
            yield pages[i], at[i], "hyphen", None, a, None
            whole = reading.get(joined)
            if whole:
                k = next((k for k, (x, y) in enumerate(zip(a + b, whole)) if x != y), len(a + b) - 1)
                yield pages[i], at[i] if k < len(a) else at[j], "misread", None, a + b, None
            else:
                for k, half in ((i, a), (j, b)):
                    if digit_word(half):
                        yield pages[k], at[k], "misread", None, half, None
        owner = np.repeat(np.arange(len(lines)), lines["end"] - lines["at"])
        for k in np.flatnonzero(wrong[tape]).tolist():
            i, t = int(owner[k]), int(tape[k])
            first, past = int(lines["at"][i]), int(lines["end"][i])
            if case[i] and not (k == past - 1 and cut_end[i]) and not (k == first and cut_start[i]):
                yield pages[i], at[i], "misread", k - first, word[t], reading.get(t)


def noise(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, line_pos, noise, at_token, word, reading: every piece of noise with the token's place in its line and the
    folded word as it stands and, where it is known, as it should; at_token is NULL for what isn't one token."""
    parts = buckets_for(table(spark, data_dir, "line_texts").select("page_id", "line_pos", "text"), PARTITION_BYTES, 1)
    pinned = checkpoint(sorted_pages(page_lines(spark, data_dir)).mapInArrow(map_rows(_read, _READ), _READ))
    words = pinned.filter("id >= 0").select("chunk", "word", "n", "hung", "asked", "id")
    found = resolved(words, pinned, parts)
    # a word that is frequent in its chunk may stand in every chunk: its rows are spread over salts
    mine = words.select("chunk", "id", "word", "asked", F.when(F.col("n") >= SALTED, 1 + F.pmod("chunk", F.lit(SALTS))).otherwise(0).alias("salt"))
    salts = F.when(F.col("n") >= SALTED, F.sequence(F.lit(0), F.lit(SALTS))).otherwise(F.array(F.lit(0)))
    found = found.withColumn("salt", F.explode(salts))
    needs = mine.join(found, ["word", "salt"]).filter("reading is not null or asked").select("chunk", "id", "word", "n", "hung", "reading")
    binary = ("lines", "ends", "tape", "names")
    none = F.lit(None).cast("binary")
    chunks = pinned.filter("id < 0").select("chunk", "id", "word", "n", "hung", F.lit(None).cast("string").alias("reading"), *binary)
    both = chunks.unionByName(needs.select("*", *(none.alias(c) for c in binary)))
    return both.repartition(parts, "chunk").sortWithinPartitions("chunk", "id").mapInArrow(map_rows(_find, _FOUND), _FOUND)


def p6_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, line_pos, noise (furniture, hyphen, misread), one row for each kind in each line."""
    return noise(spark, data_dir).select("page_id", "line_pos", "noise").distinct()


FIX_ROW = -2_000_000  # line_pos of the row that carries a page's noise


def _texts(batches):
    for page_id, rows in groups(batches, "page_id"):
        fixes = next((r[5] for r in rows if r[1] == FIX_ROW), None) or []
        lines, headers, _ = page_of([r[:5] for r in rows if r[1] != FIX_ROW])
        if not lines:
            continue
        skip = Page(lines, headers).skip
        cut, wrong = set(), {}
        for f in fixes:
            if f["noise"] == "hyphen":
                cut.add(f["line_pos"])
            elif f["reading"] is not None and f["at_token"] is not None:
                wrong.setdefault(f["line_pos"], []).append((f["at_token"], f["word"], f["reading"]))
        for i, (pos, text) in enumerate(lines):
            if i in skip or not text or not text.strip():
                continue
            if pos in wrong:
                tokens = text.split()
                for k, word, reading in wrong[pos]:
                    tokens[k] = repaired(tokens[k], word, reading)
                text = " ".join(tokens)
            yield page_id, pos, text.rstrip(), pos in cut


def p6_paragraphs(spark: SparkSession, data_dir: str) -> DataFrame:
    """page_id, para_no, text: each page's lines as continuous paragraphs - furniture out, misread words replaced
    by their reading, cut words joined.  A paragraph ends at a line that closes a sentence and is followed by a
    capital, or at the page's end.  Lines without text add nothing; a page of furniture only gives no row."""
    ddl = "page_id BIGINT, line_pos INT, t STRING, cut BOOLEAN"
    fixes = noise(spark, data_dir).filter("noise <> 'furniture'").groupBy("page_id").agg(F.collect_list(F.struct("line_pos", "noise", "at_token", "word", "reading")).alias("fixes"))
    fixes = fixes.select("page_id", F.lit(FIX_ROW).alias("line_pos"), F.lit(None).cast("timestamp").alias("recognised_at"), F.lit(None).cast("bigint").alias("line_uid"), F.lit(None).cast("string").alias("text"), "fixes")
    rows = page_lines(spark, data_dir).unionByName(fixes, allowMissingColumns=True)
    body = sorted_pages(rows).mapInArrow(map_rows(_texts, ddl), ddl)
    w = Window.partitionBy("page_id").orderBy("line_pos")
    body = body.withColumn("first", F.lead("t").over(w))
    body = body.withColumn("ends", F.expr(r"not cut and t rlike '[.!?]$' and coalesce(first rlike '^[^\\p{L}]*\\p{Lu}', true)"))
    body = body.withColumn("para_no", F.coalesce(F.sum(F.col("ends").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    piece = F.when(F.col("cut"), F.regexp_replace("t", r"[-¬=⸗\u00ad]$", "")).otherwise(F.concat("t", F.lit(" ")))
    parts = body.groupBy("page_id", "para_no").agg(F.array_sort(F.collect_list(F.struct("line_pos", piece.alias("s")))).alias("parts"))
    return parts.select("page_id", F.col("para_no").cast("int"), F.rtrim(F.array_join(F.col("parts.s"), "")).alias("text"))
