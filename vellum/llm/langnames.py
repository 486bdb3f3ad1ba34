"""Language labels in their various spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANGUAGES = ("fi", "sv", "de", "ru", "en", "la")
# ISO 639 codes and names of the six languages.
NAMES = {
    "fi": "fi fin finnish suomi finnisch finska", "sv": "sv swe swedish svenska ruotsi schwedisch", "de": "de deu ger german deutsch saksa tyska",
    "ru": "ru rus russian русский venäjä ryska", "en": "en eng english englanti engelska", "la": "la lat latin latina latein",
}


def language_of(label: str | Column) -> Column:
    """The two-letter code a label names ('fi-FI', ' Finnish', 'FIN' are 'fi'); NULL if it names none of the six."""
    word = F.regexp_extract(F.lower(F.trim(F.col(label) if isinstance(label, str) else label)), r"^[^\p{L}]*(\p{L}+)", 1)
    out = None
    for code, names in NAMES.items():
        hit = word.isin(names.split())
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out
