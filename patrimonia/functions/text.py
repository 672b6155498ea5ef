"""Text normalisation as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Latin letters of U+00C0 to U+024F that are a plain letter with marks, and those plain letters."""
    accented, plain = [], []
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _accents()
#: Particles of names that stay in lower case.
PARTICLES = ("de", "del", "la", "las", "los", "i", "y")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_accents(c: Column | str) -> Column:
    """Without combining marks and without the accents of Latin letters; null stays null."""
    return F.translate(F.regexp_replace(_col(c), r"\p{Mn}+", ""), ACCENTED, PLAIN)


def norm_text(c: Column | str) -> Column:
    """Upper case without accents, only A-Z, 0-9 and single spaces; null gives an empty text."""
    upper = F.upper(strip_accents(F.coalesce(_col(c), F.lit(""))))
    return F.trim(F.regexp_replace(F.regexp_replace(upper, "[^A-Z0-9 ]+", " "), " +", " "))


def fold_text(c: Column | str) -> Column:
    """Lower case without accents, for search and sorting; null gives an empty text."""
    return F.lower(strip_accents(F.coalesce(_col(c), F.lit(""))))


def compact_norm(c: Column | str) -> Column:
    """``norm_text`` without spaces: what the similarity of two texts is measured on."""
    return F.replace(norm_text(c), F.lit(" "), F.lit(""))


def tidy(c: Column | str) -> Column:
    """Single spaces, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def title_case_name(c: Column | str) -> Column:
    """Names in all capitals or all small letters get initial capitals, but for particles; others stay as they are."""
    return let(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"^\s+|\s+$", ""), _titled)


def _titled(text: Column) -> Column:
    upper, lower = F.upper(text), F.lower(text)
    word = lambda w: F.when(F.lower(w).isin(*PARTICLES), F.lower(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**30))))
    titled = F.array_join(F.transform(F.split(text, r"\s+"), word), " ")
    return F.when(((text == upper) | (text == lower)) & (upper != lower), titled).otherwise(text)


def slug_id(surname: Column | str, name: Column | str, seal: Column | str) -> Column:
    """``ex-`` and the normalised name with hyphens, or the seal where there is no name."""
    both = F.concat_ws(" ", F.coalesce(_col(surname), F.lit("")), F.coalesce(_col(name), F.lit("")))
    slug = F.replace(F.lower(norm_text(both)), F.lit(" "), F.lit("-"))
    return F.concat(F.lit("ex-"), F.coalesce(F.nullif(slug, F.lit("")), _col(seal)))


#: Signs that a scan leaves at the edges of a box.
_TAIL_SIGNS = r"\s+[|\[\]()_—\-.,:;'`\"<>=~]+$"
_HEAD_SIGNS = r"^[|\[\]_—\-.,:;'`\"<>=~]+\s*"
_TAIL_NOISE = r"^(?=.*[A-ZÀ-Ý0-9]{2})(.*?)\s+(?:[a-zà-ÿñ]{1,2}|[ÑI|]{1,2})$"


def clean_ocr_edges(c: Column | str) -> Column:
    """Without loose signs at both ends, and without one or two stray letters after a text in capitals."""
    text = tidy(c)
    for _ in range(3):
        text = F.regexp_replace(text, _TAIL_SIGNS, "")
        text = F.regexp_replace(text, _TAIL_NOISE, "$1")
        text = F.regexp_replace(text, _HEAD_SIGNS, "")
    more = lambda x: F.regexp_count(x, F.lit(r"\(")) > F.regexp_count(x, F.lit(r"\)"))
    return let(text, lambda x: F.trim(F.when(more(x) & x.startswith("("), F.substring(x, 2, 2**30)).otherwise(x)))


def clean_income_cell(c: Column | str) -> Column:
    """Without undecoded glyph codes and plus signs at the end."""
    text = F.trim(F.regexp_replace(_col(c), r"\(cid:[0-9]+\)", ""))
    return F.trim(F.regexp_replace(text, r"\++$", ""))


def has_word(c: Column | str) -> Column:
    """Whether a run of three letters or more has two different letters, a vowel and a consonant."""
    letters = F.transform(F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit("([A-Za-zÀ-ÿ]{3,})"), F.lit(1)), norm_text)
    true = lambda w: (F.size(F.array_distinct(F.split(w, ""))) >= 2) & w.rlike("[AEIOU]") & w.rlike("[^AEIOU]")
    return F.exists(letters, true)
