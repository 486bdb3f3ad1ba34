"""What one page of recognised lines holds: furniture, words, kind.  Plain functions on lists of lines.

A page is a list of ``(line_pos, text)`` in reading order, one entry for each current line."""

from __future__ import annotations

import re
from collections import Counter

from vellum.llm.textnorm import skeleton

# What may stand before a printed page or folio number.
_NUMBER_MARKS = "fol f s sid sida siv sivu p pag pagina page pg seite bl blatt л лист стр с lehti nr no n:o"
_MARK = "|".join(re.escape(skeleton(x)) for x in _NUMBER_MARKS.split())
PAGE_NUMBER = re.compile(rf"[\W_]*(?:(?:{_MARK})\b[\s.:]*)?[0-9oil]{{0,3}}[0-9][0-9oil]{{0,3}}\s*(?:[rv]|recto|verso)?[\W_]*")
_NOT_LETTER = re.compile(r"[\W\d_]+")
EDGE = 2  # by definition, furniture is one of this many lines at either end of a page: a title and a number


def header_key(text: str) -> str:
    """Letters of a line, digits and punctuation masked, look-alikes resolved, lower case."""
    return " ".join(_NOT_LETTER.sub(" ", skeleton(text).lower()).split())


def near(a: str, b: str) -> bool:
    """Whether two header keys differ by misread letters only: at most a fifth of the letters, two at least."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 4 or len(b) < 6:
        return False
    most = max(2, len(b) // 5)
    ca, cb = Counter(a), Counter(b)
    if max((ca - cb).total(), (cb - ca).total()) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= most


def furniture(lines: list[tuple[int, str]], headers: list[str]) -> set[int]:
    """Positions (in ``lines``) of running titles and printed page or folio numbers, at the page's edges."""
    out, n = set(), len(lines)
    for i in sorted({*range(min(EDGE, n)), *range(max(0, n - EDGE), n)}):
        text = lines[i][1]
        if not text:
            continue
        s = skeleton(text).lower()
        if "§" not in s and PAGE_NUMBER.fullmatch(s):
            out.add(i)
            continue
        key = header_key(text)
        if key and any(near(key, h) for h in headers):
            out.add(i)
    return out


_EDGE_PUNCT = re.compile(r"^[\W_]+|[\W_]+$")


def repeated_share(ws: list[str], n: int = 4, times: int = 3) -> float:
    """Share of words in a second or later copy of a passage of ``n`` or more words found ``times`` or more."""
    return len(copies(ws, n, times)) / len(ws) if ws else 0.0


def copies(ws: list[str], n: int = 4, times: int = 3) -> set[int]:
    """Places of the words in a second or later copy of a passage of ``n`` or more words found ``times`` or more."""
    if len(ws) < n + 1:
        return set()
    grams = list(zip(*(ws[k:] for k in range(n))))
    count = Counter(grams)
    if max(count.values()) < times:
        return set()
    seen, again = set(), set()
    for i, g in enumerate(grams):
        if count[g] >= times:
            if g in seen:
                again.update(range(i, i + n))
            seen.add(g)
    return again


_VOWEL = re.compile("[aeiouyåäöüéæøыэюяиѣ]")
_LETTERS = re.compile(r"[a-zåäöüßéæøœ’'Ѐ-џѢѣѲ-ѵ-]+")
_NUMERIC = re.compile(r"[\W_]*\d[\d.,/⁄½-]*[\W_]*|[–—-]+|[\W_]*[½¼¾][\W_]*")
_BULLET = re.compile(r"\s*(?:[-*•–—·§]\s|\(?\d{1,3}[.):]?\s|\w[.)]\s)")
_BOUND = re.compile(r"[^\W\d_]{2,}[.!?:;]\s+[A-ZÅÄÖÜА-ЯІѢЁ]")
_INNER_CAPS = re.compile(r"[a-zåäö][A-Z]")
# Frequent function words of the six languages (as printed in the old spelling).
COMMON_WORDS = {
    "fi": "ja on ei että se oli hän kun niin myös mutta joka tämä sitten vaan sekä vielä koska jos kuin ovat hänen heidän nyt sen tämän jälkeen siellä silloin mitä jonka näin ennen",
    "sv": "och den det att som för är af en i på med till icke men när så har hade hos efter då sig denne hans hennes från ännu eller äfven emedan blef därefter sedan ty samma",
    "de": "und der die das den dem daß als mit so ist nicht zu von aber wenn welcher dieser auch da nach noch wurde derselbe weil denn darauf dann ihre oder danach laut bei",
    "en": "the and of that a to in is was which but for with when were at by as because then so this his had not been if after before thereafter since said",
    "la": "et in ad est non cum ut de sed qui ab ex si per quod ac atque post ita tunc postea inter apud die suus idem",
    "ru": "и въ не что на съ онъ но по за отъ до было же какъ также ещё такъ или когда если у изъ ея его послѣ нынѣ потомъ затѣмъ который сей тогда ибо уже онъ так",
}
COMMON = {skeleton(w): lang for lang, ws in COMMON_WORDS.items() for w in ws.split()}


def is_word(token: str) -> bool:
    """Whether a token could be a word of some language: letters only, a vowel, no capitals inside."""
    w = _EDGE_PUNCT.sub("", token)
    return bool(w) and not _INNER_CAPS.search(w) and bool(_LETTERS.fullmatch(w.lower())) and (bool(_VOWEL.search(w.lower())) or len(w) < 3)


STATS = ("word_count", "mean_word_length", "symbol_ratio", "end_punct_share", "common_share", "digit_share", "entry_share", "nonword_share", "boundary_share", "row_share")
_CELL_MARKS = {"|", "....", "...", "–", "-", "*", "•", "—", "·"}
_SPLIT = re.compile(r"\s{2,}|\t")
END_MARK = re.compile(r"(?<=\w)[-¬=⸗]$")
_NUMBERED = re.compile(r"\(?\d{1,3}[.):]?|\w[.)]")


class _Tokens(dict):
    """raw token -> what the statistics need of it, kept for up to ``most`` tokens.

    (folded word or '', mark, body, could be a word or figure, is a figure, letters, is common, symbols, length,
    ends a sentence, starts with a capital, is a bullet or number)"""

    most = 300_000

    def __missing__(self, raw: str):
        if len(self) >= self.most:
            self.clear()
        s = skeleton(raw[:-1].rstrip("\u00ad") + "-" if raw.endswith("\u00ad") and len(raw) > 1 else raw)
        w = s if s.isalnum() else _EDGE_PUNCT.sub("", s)
        m = END_MARK.search(s)
        num, body = bool(_NUMERIC.fullmatch(s)), s not in _CELL_MARKS and bool(s)
        out = self[raw] = (
            w.lower(), m[0] if m else "" if s[-1:] == w[-1:] else ".", body, body and (num or is_word(s)), num, len(w), w.lower() in COMMON,
            sum(1 for c in s if not c.isalnum()), len(s), s[-1:] in tuple(".!?;:") and sum(c.isalpha() for c in w[-2:]) == 2, s[:1].isupper(),
            s in _CELL_MARKS and s != "|" or s == "§" or bool(_NUMBERED.fullmatch(s)),
        )
        return out


_TOKENS = _Tokens()


class Page:
    """Tokens, furniture, statistics and kind of one page; ``lines``: its current ``(line_pos, text)`` in order."""

    def __init__(self, lines: list[tuple[int, str]], headers: list[str], frequent: bool = False):
        """``frequent``: whether lines that equal a header are left out wherever they stand, not as furniture only."""
        self.lines = lines
        self.skip = furniture(lines, headers)
        if frequent and headers:
            known = set(headers)
            self.skip |= {i for i, (_, text) in enumerate(lines) if text and header_key(text) in known}
        get = _TOKENS.__getitem__
        self.tokens = [list(map(get, text.split())) if text and i not in self.skip else [] for i, (_, text) in enumerate(lines)]

    def words(self) -> list[str]:
        """Folded words, furniture aside, halves at marked line ends joined."""
        out, half = [], ""
        for ts in self.tokens:
            for t in ts:
                if t[0]:
                    out.append(half + t[0])
                    half = ""
            if ts and ts[-1][1] in ("-", "¬", "=") and out and ts[-1][0]:
                half = out.pop()
        return out + [half] * bool(half)

    def statistics(self) -> dict[str, float]:
        """Quality statistics, furniture aside; all 0 for a page without text."""
        n = tokens = wordlike = numeric = common = chars = symbols = letters = nwords = end = entries = bounds = rows = 0
        for (_, text), ts in zip(self.lines, self.tokens):
            if not ts:
                continue
            n += 1
            k = b = bars = 0
            stop = False
            chars += len(ts) - 1
            for word, _m, body, ok, num, length, com, sym, size, ends, cap, _b in ts:
                b += body
                k += num
                wordlike += ok
                nwords += word != ""
                letters += length
                common += com
                symbols += sym
                chars += size
                bounds += stop and cap
                stop = ends
            bars = sum(1 for t in ts if not t[0] and t[8] == 1 and t[7] == 1) if "|" in text else 0
            numeric += k
            tokens += b
            last = text.rstrip()[-1:]
            end += last in tuple(".!?;:")
            entries += ts[0][11] and len(ts) > 1
            rows += (k >= 2 and 2 * k >= b) or bars >= 2 or ("  " in text or "\t" in text) and len(_SPLIT.findall(text.strip())) >= 2
        d = max(1, n)
        return {
            "n_lines": float(n), "word_count": float(nwords), "mean_word_length": letters / max(1, nwords), "symbol_ratio": symbols / max(1, chars),
            "end_punct_share": end / d, "common_share": common / max(1, nwords), "digit_share": numeric / max(1, tokens, numeric), "entry_share": entries / d,
            "nonword_share": 1 - wordlike / tokens if tokens else 0.0, "boundary_share": bounds / d, "row_share": rows / d,
        }

    def kind(self) -> str:
        return page_kind(self.statistics())


def page_kind(st: dict[str, float]) -> str:
    """``prose``, ``list``, ``table`` or ``junk``; a page without text is ``prose``."""
    if not st["word_count"] and not st["nonword_share"]:
        return "prose"
    if st["nonword_share"] > 0.5:
        return "junk"
    if st["row_share"] > 0.5:
        return "table"
    if st["boundary_share"] < 0.1 and (st["entry_share"] > 0.5 or st["common_share"] < 0.05):
        return "list"
    return "prose"


# ---------------------------------------------------------------- misread words and words cut at line ends

# What a recogniser prints (left) for what stands on the page (right).
CONFUSIONS = [
    ("1", "i"), ("1", "l"), ("0", "o"), ("5", "s"), ("9", "g"), ("6", "b"), ("8", "в"), ("8", "b"),
    ("c", "e"), ("u", "n"), ("n", "u"), ("u", "a"), ("f", "t"), ("v", "r"), ("r", "v"), ("b", "h"),
    ("cl", "d"), ("lc", "k"), ("rn", "m"), ("m", "rn"), ("ii", "ä"), ("ii", "ü"), ("п", "и"), ("п", "н"), ("п", "л"),
    ("a", "ä"), ("a", "å"), ("o", "ö"), ("u", "ü"), ("e", "é"), ("и", "й"), ("e", "ё"),
]
_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _wrong, _right in CONFUSIONS:
    _wrong, _right = skeleton(_wrong), skeleton(_right)
    _BY_FIRST.setdefault(_wrong[0], []).append((_wrong, _right))

# One glyph class for all letters that are taken for one another, after the pairs are drawn together.
_GLYPH = str.maketrans({c: to for to, cs in {"a": "aäåunüйиhb6пнлв8", "o": "oö0", "c": "ceéëё", "l": "1il", "t": "tf", "r": "rv", "s": "s5", "g": "g9", "ъ": "ъь"}.items() for x in cs for c in (x, skeleton(x))})
_PAIRS = [("cl", "d"), ("lc", "k"), ("rn", "m"), ("vv", "w"), ("ii", "a")]


def glyph_skeleton(word: str) -> str:
    """Key shared by a word and its misreadings: accents off, glyph classes merged, pairs drawn together."""
    for wrong, right in _PAIRS:
        word = word.replace(wrong, right)
    return re.sub(r"(.)\1+", r"\1", word.translate(_GLYPH))


def readings(word: str):
    """Words that one wrong character could have turned into ``word``."""
    for i, c in enumerate(word):
        for wrong, right in _BY_FIRST.get(c, ()):
            if word.startswith(wrong, i):
                yield word[:i] + right + word[i + len(wrong) :]


def candidates(word: str, count: int, forms: dict[str, int], far: int = 25, supported: int = 2) -> list[tuple[str, bool]]:
    """The forms that ``word`` may be a misreading of, each with whether that is sure.

    Sure, and then the only one, is the most frequent form ``far`` times as frequent or more (a third of that for a word met
    once); a word with a digit among its letters needs a form that is as frequent at least, and may hold two wrong
    characters.  Else all forms ``supported`` times as frequent or more may be it."""
    digit = any(c.isdigit() for c in word)
    need = max(2, count) if digit else far // 3 if count <= 1 else far * count
    one = {r: forms[r] for r in readings(word) if r in forms and r != word}
    best = max((r for r in one if one[r] >= need), key=lambda r: (one[r], r), default=None)
    if best is None and digit:
        two = {q: forms[q] for r in readings(word) for q in readings(r) if q in forms and q != word}
        best = max((q for q in two if two[q] >= need), key=lambda q: (two[q], q), default=None)
    if best is not None:
        return [(best, True)]
    return [] if digit else sorted((r, False) for r in one if one[r] >= supported * max(1, count))


def correct(word: str, count: int, forms: dict[str, int]) -> str | None:
    """The form that ``word`` surely is a misreading of, or None."""
    return next((r for r, sure in candidates(word, count, forms) if sure), None)


_CYRILLIC = re.compile("[Ѐ-џѢ-ѵ]")
_TO_CYRILLIC = {skeleton(c): c for c in "абвгдежзиклмнопрстухфцчшщъыьэюяёйѣ"}


def repaired(raw: str, word: str, reading: str) -> str:
    """``raw``, whose folded form is ``word``, with what differs in ``reading`` put in its place."""
    least = min(len(word), len(reading))
    k = next((i for i in range(least) if word[i] != reading[i]), least)
    e = next((i for i in range(least - k) if word[-1 - i] != reading[-1 - i]), least - k)
    at = skeleton(raw).lower().find(word)
    if at < 0 or len(skeleton(raw)) != len(raw):
        return reading
    new = reading[k : len(reading) - e]
    if _CYRILLIC.search(raw):
        new = "".join(_TO_CYRILLIC.get(c, c) for c in new)
    old = raw[at + k : at + len(word) - e]
    return raw[: at + k] + (new.capitalize() if old[:1].isupper() else new) + raw[at + len(word) - e :]


_FOLIO = re.compile(r"\d+[rv]|[\d½¼¾⁄.,/-]+|n:o|\d+[-–.:]\w*")
#: Marks of a word cut at a line's end.
MARKS = ("-", "¬", "=")


def digit_word(w: str) -> bool:
    """Whether a word has a digit among its letters where none belongs."""
    return sum(c.isalpha() for c in w) >= 2 and any(c in "015689" for c in w) and not _FOLIO.fullmatch(w) and ":" not in w


def runs_on(last: str, mark: str, first: str, n_last: int, n_first: int, n_joined: int, n_hung: int) -> bool:
    """Whether ``last`` at a line's end runs on in ``first``.  The counts are of whole words in the corpus;
    ``n_hung``: how often ``last`` stands with a hyphen inside a line, as in 'winter- and summer'."""
    if mark in ("¬", "="):
        return True
    if mark == "-":
        return n_joined > n_hung if first in COMMON else True
    least = min(n_last, n_first)
    if n_joined < 3 or least > 3 * n_joined:
        return False
    return not (last in COMMON or first in COMMON) or 3 * least <= n_joined
