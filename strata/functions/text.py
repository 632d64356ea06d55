"""Text helpers returning Columns.

All of them are native Spark expressions (``regexp_replace``, ``translate``,
``replace``) so they run inside whole-stage codegen; none is a Python UDF.
Header and column-name helpers work on driver metadata (names only).
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values.
# Letters that have no single-letter ASCII base under canonical
# decomposition, with the ASCII spelling used for them.
MULTI_CHAR_FOLDS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l",
    "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "ı": "i",
}
# The two literal mojibake repairs of the spending categories
# (UTF-8 bytes that were decoded as Windows-1250).
CATEGORY_REPAIRS = {
    "FĂ¶rderung": "Förderung",
    "Sport und auĂźerschulische Leibeserziehung": "Sport und außerschulische Leibeserziehung",
}
# --------------------------------------------------------------------------


LATIN = [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]
MARKS = range(0x0300, 0x0370)


def _translations() -> tuple[str, str]:
    """(from, to) strings for ``translate``, built by rule: a Latin letter
    whose canonical decomposition is one ASCII letter and combining marks
    maps to that letter; so do the fixed folds to one letter; combining
    marks have no counterpart and go."""
    to = {k: v for k, v in MULTI_CHAR_FOLDS.items() if len(v) == 1}
    for ch in map(chr, LATIN):
        base, *marks = unicodedata.normalize("NFD", ch)
        if ch not in MULTI_CHAR_FOLDS and base.isascii() and base.isalpha() and marks and all(map(unicodedata.combining, marks)):
            to[ch] = base
    return "".join(to) + "".join(map(chr, MARKS)), "".join(to.values())


FOLD_FROM, FOLD_TO = _translations()
LONG_FOLDS = {k: v for k, v in MULTI_CHAR_FOLDS.items() if len(v) > 1}


def _col(c) -> Column:
    """A string is a literal column name (dots and spaces allowed, SURVEY
    H12); pass a Column for nested fields."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def slug(c, trim: bool = True, pattern: str = r"\s+", sep: str = "-") -> Column:
    """Lower-case, optional trim, whitespace runs -> ``sep``.

    ``pattern=" "`` with ``trim=True`` is the single-space form, ``trim=False``
    the untrimmed form; the default collapses whitespace runs.
    """
    x = F.lower(_col(c))
    if trim:
        x = F.trim(x)
    return F.regexp_replace(x, pattern, sep)


def fold_ascii(c) -> Column:
    """Accent folding without a Python UDF, of precomposed and of
    decomposed Latin letters; other scripts stay.  Null stays null."""
    x = _col(c)
    for k, v in LONG_FOLDS.items():
        x = F.replace(x, F.lit(k), F.lit(v))
    return F.translate(x, FOLD_FROM, FOLD_TO)


def fold_key(c) -> Column:
    """Join key that ignores case and accents (C5 used for joins)."""
    return F.lower(fold_ascii(c))


def repair_text(c, mapping: dict[str, str] | None = None) -> Column:
    """C4: literal replacements, applied longest pattern first."""
    mapping = CATEGORY_REPAIRS if mapping is None else mapping
    x = _col(c)
    for bad in sorted(mapping, key=len, reverse=True):
        x = F.replace(x, F.lit(bad), F.lit(mapping[bad]))
    return x


def recode(c, wrong: str = "ISO-8859-1", right: str = "UTF-8") -> Column:
    """C4 for whole-charset damage: text whose bytes were decoded with the
    wrong single-byte charset is re-encoded with it and decoded with the
    right one - one linear JVM pass, no replacement table."""
    return F.decode(F.encode(_col(c), wrong), right)


# ---- names (driver metadata only) -----------------------------------------

def fold_name(name: str) -> str:
    """Python twin of ``fold_ascii`` for column names."""
    for k, v in LONG_FOLDS.items():
        name = name.replace(k, v)
    return name.translate({ord(k): FOLD_TO[i] if i < len(FOLD_TO) else None for i, k in enumerate(FOLD_FROM)})


def header(name: str, split: str = r"[^A-Za-z0-9]+", sep: str = "_", prefix: str = "") -> str:
    """A column name from a header or a category.  Accents are folded
    and every match of ``split`` becomes ``sep``: by default a run of other
    characters than ASCII letters and digits, for P2 each single space."""
    return prefix + re.sub(split, sep, fold_name(name.strip()))


def unique_names(names: list[str]) -> list[str]:
    """Raise on collisions (``toDF`` would silently accept duplicates)."""
    seen: dict[str, int] = {}
    for n in names:
        seen[n] = seen.get(n, 0) + 1
    dup = sorted(n for n, k in seen.items() if k > 1)
    if dup:
        raise ValueError(f"renaming produces duplicate columns: {dup}")
    return names

