"""Text cleaning expressions (accent folding, keys, codes, lenient numbers).

Every function takes and returns a ``Column`` so that the work stays inside
Catalyst / whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fold_tables(ranges: Iterable[tuple[int, int]]) -> tuple[str, str, list[tuple[str, str]]]:
    """Build the accent-folding tables from ``unicodedata`` (NFKD, marks dropped).

    Characters folding to exactly one character go into a ``translate`` pair,
    the few that expand (ligatures, ``ŉ``) into explicit replacements.
    """
    src, dst, multi = [], [], []
    for lo, hi in ranges:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            folded = "".join(
                c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)
            )
            if folded == ch:
                continue
            if len(folded) == 1:
                src.append(ch)
                dst.append(folded)
            elif folded:
                multi.append((ch, folded))
    return "".join(src), "".join(dst), multi


# Latin-1 supplement, Latin Extended-A/B and Latin Extended Additional cover the
# accented letters of the languages handled; anything decomposed on input is
# caught by the \p{M} removal below.
_FOLD_FROM, _FOLD_TO, _FOLD_MULTI = _fold_tables(
    [(0x00A0, 0x024F), (0x1E00, 0x1EFF), (0xFB00, 0xFB06)]
)

# The characters Python's str.strip() removes (all of Unicode's whitespace).
_WS_CHARS = "".join(chr(i) for i in range(0x3000 + 1) if chr(i).isspace())
_NOT_ASCII = r"[^\x00-\x7F]"
_MULTI_CLASS = "[" + "".join(ch for ch, _ in _FOLD_MULTI) + "]"


def strip_ws(c: ColumnOrName) -> Column:
    """Trim leading/trailing whitespace like ``str.strip`` (no regex)."""
    return F.btrim(_col(c), F.lit(_WS_CHARS))


def fold_accents(c: ColumnOrName) -> Column:
    """NFKD-style accent removal without lower-casing. Plain ASCII text is its own
    folding, so the tables run on other values only."""
    col = _col(c)
    out = F.translate(col, _FOLD_FROM, _FOLD_TO)
    expanded = out
    for ch, rep in _FOLD_MULTI:
        expanded = F.replace(expanded, F.lit(ch), F.lit(rep))
    # the expanding replacements only run on the rare values that need them
    rest = F.regexp_replace(F.when(out.rlike(_MULTI_CLASS), expanded).otherwise(out), r"\p{M}", "")
    return F.when(col.rlike(_NOT_ASCII), F.when(out.rlike(_NOT_ASCII), rest).otherwise(out)).otherwise(col)


def normalize_text(c: ColumnOrName, trim: bool = True) -> Column:
    """STR1: null -> '', optional trim, accents folded, lower case."""
    out = F.coalesce(_col(c).cast("string"), F.lit(""))
    if trim:
        out = strip_ws(out)
    return F.lower(fold_accents(out))


def normalize_key(c: ColumnOrName) -> Column:
    """STR2: normalized text, runs of non ``[a-z0-9]`` -> '_', '_' trimmed."""
    out = F.regexp_replace(normalize_text(c), "[^a-z0-9]+", "_")
    return F.btrim(out, F.lit("_"))


def clean_code(c: ColumnOrName, data_type=None) -> Column:
    """STR3: trim, drop a trailing ``.0…``, drop non-alphanumerics.

    Null stays null (the reference's ``astype(str)`` would produce 'nan').
    For integer-typed codes (``data_type``) only the sign can be removed, so
    the text form is used directly.
    """
    if isinstance(data_type, IntegralType):
        v = _col(c)
        return F.when(v >= 0, v.cast("string")).otherwise(F.regexp_replace(v.cast("string"), "-", ""))
    out = strip_ws(_col(c).cast("string"))
    out = F.regexp_replace(out, r"\.0+$", "")
    return F.regexp_replace(out, r"[^\p{Nd}A-Za-z]", "")


def entity_columns(
    c: ColumnOrName, name_col: str = "municipio_name", key_col: str = "municipio_key"
) -> dict[str, Column]:
    """STR4: trimmed display name and its key, ready for ``withColumns``."""
    name = strip_ws(_col(c).cast("string"))
    return {name_col: name, key_col: normalize_key(name)}


def decimal_comma_double(c: ColumnOrName) -> Column:
    """STR5: ',' -> '.', keep only digits '.' '-', lenient cast to double."""
    out = F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))
    out = F.regexp_replace(out, r"[^\p{Nd}.\-]", "")
    return out.try_cast("double")


def lenient_double(c: ColumnOrName) -> Column:
    """STR6: any value -> double, unparsable -> null (ANSI-safe)."""
    return _col(c).try_cast("double")


def contains_any(c: ColumnOrName, keywords: Sequence[str]) -> Column:
    """FLT8: 1 if the normalized text contains any keyword, else 0."""
    text = normalize_text(c)
    hits = [text.contains(k) for k in keywords]
    if not hits:
        return F.lit(0)
    return reduce(lambda a, b: a | b, hits).cast("int")


def keyword_score(c: ColumnOrName, keywords: Sequence[str]) -> Column:
    """Number of keywords contained in ``c`` (already normalized)."""
    col = _col(c)
    terms = [col.contains(k).cast("int") for k in keywords]
    if not terms:
        return F.lit(0)
    return reduce(lambda a, b: a + b, terms)


def folded(value: object) -> str:
    """Driver-side twin of ``normalize_text`` for header names and keywords."""
    marks = unicodedata.normalize("NFKD", str(value).strip())
    return "".join(ch for ch in marks if not unicodedata.combining(ch)).lower()


def folded_key(value: object) -> str:
    """Driver-side twin of ``normalize_key``."""
    return "_".join(re.findall("[a-z0-9]+", folded(value)))
