"""Text rules: headers, table names, place names and comparison keys.

Value rules are single Column expressions built from Spark functions, so a projection of many
cleaned columns stays one projection inside generated code.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from epiweave.fixed import (
    ACCENTED_CAPITALS,
    HEADER_LETTERS,
    MANGLED_LETTERS,
    PLACE_PATTERNS,
    REGION_NAMES,
    UMLAUT_CAPITALS,
)


def header_name(name: str) -> str:
    """Column header → lower-case ASCII identifier."""
    plain = name.strip().lower().translate(str.maketrans(HEADER_LETTERS))
    return re.sub(r"[^a-z0-9_]", "", plain.replace(" ", "_"))


def landing_header_name(name: str) -> str:
    """Lighter rule used when a download is landed: separators become underscores."""
    return re.sub(r"[ :\-]", "_", name.strip())


def table_name(file_name: str) -> str:
    """CSV file name → table name."""
    return re.sub(r"[ ()\-]", "_", file_name.lower().replace(".csv", ""))


def _translate(col: Column, letters: dict[str, str]) -> Column:
    return F.translate(col, "".join(letters), "".join(letters.values()))


def normalize_text(col: Column | str, fold_small_accents: bool = True) -> Column:
    """Place or disease text in canonical form.

    With ``fold_small_accents`` the text is upper-cased between repairing mangled characters
    and removing accents, so ``Bogotá, D.C.`` and ``BOGOTÁ, D.C.`` agree. Without it accents are
    removed before upper-casing and accented small letters survive as accented capitals.
    Mangled characters always go first: upper-casing would turn a mangled ``ß`` into ``SS``.
    """
    text = F.col(col) if isinstance(col, str) else col
    if fold_small_accents:
        text = F.upper(F.trim(_translate(text, MANGLED_LETTERS)))
        text = _translate(text, {**ACCENTED_CAPITALS, **UMLAUT_CAPITALS})
    else:
        text = F.upper(F.trim(_translate(text, {**ACCENTED_CAPITALS, **MANGLED_LETTERS})))
    for pattern, replacement in PLACE_PATTERNS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)


def harmonize(col: Column | str, names: dict[str, str] = REGION_NAMES) -> Column:
    """Replace short names by official ones; other values pass through.

    For a handful of names. A large mapping belongs in a table and a left join.
    """
    value = F.col(col) if isinstance(col, str) else col
    if not names:
        return value
    first, *rest = names.items()
    chain = F.when(value == first[0], first[1])
    for short, full in rest:
        chain = chain.when(value == short, full)
    return chain.otherwise(value)


# Code points that can decompose: everything below the CJK ideographs, and the compatibility
# blocks above them. Ideographs and Hangul never decompose to Latin letters.
_DECOMPOSABLE = [(0x80, 0x3400), (0xA000, 0xAC00), (0xF900, 0x10000), (0x10000, 0x1FC00)]


@lru_cache(maxsize=1)
def _compatibility_tables() -> tuple[str, str, dict[str, str]]:
    """Tables for ``match_key`` by rule from the Unicode database.

    Returns the ``translate`` source and target strings (one-to-one letters first, then
    combining marks, which have no target and are deleted), and the characters that expand
    to several letters.
    """
    letters: dict[str, str] = {}
    marks: list[str] = []
    expansions: dict[str, str] = {}
    for start, stop in _DECOMPOSABLE:
        for ch in map(chr, range(start, stop)):
            parts = unicodedata.normalize("NFKD", ch)
            base = "".join(c for c in parts if not unicodedata.combining(c))
            if not base:
                marks.append(ch)
            elif base != ch and re.search("[A-Z0-9]", base.upper()):
                if len(base) == 1:
                    letters[ch] = base
                else:
                    expansions[ch] = re.sub("[^A-Z0-9]", " ", base.upper())
    return "".join(letters) + "".join(marks), "".join(letters.values()), expansions


def match_key_py(text: str | None) -> str:
    """``match_key`` of one driver-side literal such as a filter value."""
    parts = unicodedata.normalize("NFKD", text or "")
    base = "".join(c for c in parts if not unicodedata.combining(c))
    return re.sub("[^A-Z0-9]+", " ", base.upper()).strip()


def _ranges(chars: list[str], slack: int = 16) -> str:
    """Regular-expression class over a few ranges that cover the characters."""
    spans: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if spans and point - spans[-1][1] <= slack:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in spans) + "]"


def match_key(col: Column | str) -> Column:
    """Comparison key: compatibility decomposition without marks, upper case, words only."""
    text = F.col(col) if isinstance(col, str) else col
    source, target, expansions = _compatibility_tables()
    table = F.str_to_map(
        F.lit("|".join(f"{k}={v}" for k, v in expansions.items())), F.lit("\\|"), F.lit("=")
    )
    expanded = F.array_join(
        F.transform(
            F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1)),
            lambda ch: F.coalesce(F.try_element_at(table, ch), ch),
        ),
        "",
    )
    # Plain ASCII needs no table, and characters that expand, such as ligatures, are rare: the
    # pass over single characters runs only on rows that may have one.
    plain = (
        F.when(~text.rlike(r"[^\x00-\x7F]"), text)
        .when(~text.rlike(_ranges(list(expansions))), F.translate(text, source, target))
        .otherwise(F.translate(expanded, source, target))
    )
    return F.trim(F.regexp_replace(F.upper(plain), "[^A-Z0-9]+", " "))
