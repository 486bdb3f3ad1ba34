"""Bringing look-alike text to one form: confusables skeleton and word folding.

``skeleton`` decomposes a text (NFKD: width, ligature and styled forms, separate accents), drops
invisible characters, replaces every character by the prototype of its look-alike class, decomposes
again and stores the result composed (NFC), which is a unique name of the decomposed form.  Letter
case, digits and accents stay as they are: they are real differences.
"""

from __future__ import annotations

import re
import sys
import unicodedata

# Letters of other scripts, and phonetic ones, that print like a basic Latin letter.
_LATIN_PROTOTYPE = {
    "a": "аαɑ⍺", "c": "сϲⲥ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "іι", "j": "јϳ", "k": "κ", "l": "ӏ",
    "n": "ո", "o": "оοօⲟ", "p": "рρⲣ", "q": "ԛ", "s": "ѕꜱ", "u": "υս", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уγ", "æ": "ӕ",
    "A": "АΑᎪꓮ", "B": "ВΒᏴꓐ", "C": "СϹᏟꓚⲤ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "НΗᎻꓧⲎ", "I": "ІΙӀꓲ", "J": "ЈͿᎫꓙ",
    "K": "КΚᏦꓗⲔ", "L": "Ꮮꓡ", "M": "МΜϺᎷꓟⲘ", "N": "ΝꓠⲚ", "O": "ОΟՕꓳⲞ", "P": "РΡᏢꓑⲢ", "Q": "Ԛ", "R": "Ꭱꓣ", "S": "ЅՏᏚꓢ", "T": "ТΤᎢꓔⲦ",
    "U": "Սꓴ", "V": "ѴᏙꓦ", "W": "ԜᎳꓪ", "X": "ХΧꓫⲬ", "Y": "ҮΥꓬ", "Z": "ΖᏃꓜ", "Æ": "Ӕ",
}
_HYPHENS = "‐‑‒–−﹣－⁃˗"
_QUOTES = {"'": "’‘ʼʹ′", '"': "“”„″", "/": "∕", ":": "∶ː", "!": "ǃ"}


def _is_invisible(ch: str) -> bool:
    cp = ord(ch)
    return (
        (unicodedata.category(ch) in ("Cf", "Cc") and ch not in "\t\n\r")
        or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)
        or 0xFE00 <= cp <= 0xFE0F
    )


class _Prototypes(dict):
    """Look-alike table filled on demand, for ``str.translate``."""

    def __init__(self) -> None:
        super().__init__()
        for to, many in _LATIN_PROTOTYPE.items():
            self.update({ord(x): to for x in many})
        self.update({ord(x): "-" for x in _HYPHENS})
        for to, many in _QUOTES.items():
            self.update({ord(x): to for x in many})

    def __missing__(self, cp: int):
        ch = chr(cp)
        out = "" if _is_invisible(ch) else " " if unicodedata.category(ch) in ("Zs", "Zl", "Zp") or ch in "\t\n\r" else ch
        self[cp] = out
        return out


_PROTO = _Prototypes()
_PLAIN = re.compile(r"[ -~åäöÅÄÖüÜßéÉ]*\Z")


def skeleton(text: str) -> str:
    """The form shared by all texts that look like ``text``; '' stays ''."""
    if _PLAIN.match(text):
        return text
    text = unicodedata.normalize("NFKD", text).translate(_PROTO)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKD", text).translate(_PROTO))


def look(text: str) -> str:
    """``skeleton`` with blank runs collapsed and ends trimmed: what a reader of the print can tell."""
    s = skeleton(text)
    return " ".join(s.split(" ")) if "  " in s or s[:1] == " " or s[-1:] == " " else s


_ALNUM_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_LATIN_UNPROTO: dict[str, str] = {}


def fold_words(text: str) -> list[str]:
    """Words of a text, look-alikes resolved, lower case, outer punctuation dropped.

    A word is a run of non-space characters with a letter or digit."""
    out = []
    for w in skeleton(text).lower().split():
        w = w if w.isalnum() else _ALNUM_EDGE.sub("", w)
        if w:
            out.append(sys.intern(w))
    return out
