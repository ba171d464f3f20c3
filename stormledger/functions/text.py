"""Text cleaning for causes, names and labels."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from stormledger.config import CAUSE_SEPARATORS, SYNONYMS

# Every letter of the basic plane but Hangul, whose syllables decompose into letters, not marks.
_BASIC_PLANE = [*range(0x80, 0xAC00), *range(0xD7B0, 0xD800), *range(0xE000, 0x10000)]
# Code points that no text may hold; they stand in for letters while the case changes.
_STAND_INS = "".join(map(chr, range(0xFDD0, 0xFDF0)))


def _is_mark(letter: str) -> bool:
    return unicodedata.category(letter).startswith("M")


def _accent_table() -> tuple[str, str]:
    """Letters with accents and their base letters, by canonical decomposition; then all marks."""
    source, target, marks = [], [], []
    for letter in map(chr, _BASIC_PLANE):
        if _is_mark(letter):
            marks.append(letter)
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not _is_mark(c))
        base = unicodedata.normalize("NFC", base)
        if base != letter and len(base) == 1:
            source.append(letter)
            target.append(base)
    # translate() deletes what has no counterpart, so the marks come last.
    return "".join(source + marks), "".join(target)


_ACCENTED, _PLAIN = _accent_table()
_SHARP_S, _CAPITAL_SHARP_S = "ß", "ẞ"
# Letters whose upper case would be several letters stay as they are.
_KEPT = "".join(
    c for c in map(chr, _BASIC_PLANE) if len(c.upper()) > 1 and c not in _ACCENTED and c != _SHARP_S
)
_HIDDEN = _STAND_INS[: len(_KEPT)]


def _unless_ascii(c: Column, rewritten: Column) -> Column:
    """Skip the rewrite where every character is one byte, which is cheap to know."""
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(rewritten)


def strip_accents(c: Column) -> Column:
    return _unless_ascii(c, F.translate(c, _ACCENTED, _PLAIN))


def plain_upper(c: Column) -> Column:
    """Upper case without accents; no letter becomes two, and sharp s takes its capital form."""
    hidden = F.translate(c, _SHARP_S + _KEPT + _ACCENTED, _CAPITAL_SHARP_S + _HIDDEN + _PLAIN)
    return F.when(F.octet_length(c) == F.char_length(c), F.upper(c)).otherwise(
        F.translate(F.upper(hidden), _HIDDEN, _KEPT)
    )


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def canonical(c: Column, synonyms: dict[str, str] = SYNONYMS) -> Column:
    """Replace known spellings by the chosen one; keep anything else."""
    if not synonyms:
        return c
    pairs = [F.lit(word) for pair in synonyms.items() for word in pair]
    return F.coalesce(F.create_map(*pairs)[c], c)


def cause_parts(c: Column) -> Column:
    """Cause text as an array of levels, whichever separator was used."""
    return F.split(plain_upper(F.btrim(c, F.lit("* "))), CAUSE_SEPARATORS)


def cause_level(parts: Column, level: int) -> Column:
    return canonical(F.get(parts, F.lit(level - 1)))


def cause_detail(parts: Column) -> Column:
    """Everything from the fourth level on, since a detail may hold a separator."""
    rest = F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts), F.lit(1))), " - ")
    return canonical(F.when(F.size(parts) >= 4, rest))


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))
