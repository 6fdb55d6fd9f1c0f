"""Text standardisation as JVM-side column expressions (no Python UDF).

Semantics follow the SQL engine the warehouse models were written for:

* ``trim`` strips every Unicode space separator (category Zs), not only
  U+0020, and leaves tabs and line breaks alone.
* ``upper`` / ``lower`` use the simple one-to-one case mapping; Java's full
  mapping would expand a handful of letters (``ß`` -> ``SS``).
* ``strip_accents`` decomposes, drops every combining mark (categories Mn,
  Mc, Me) and recomposes.  Over the Basic Multilingual Plane every changed
  character maps to at most one character, so one ``translate`` call
  reproduces it.

The character maps are derived from :mod:`unicodedata` by rule at import
time, they are not stored tables.  A string as long in bytes as in characters is
plain ASCII, for which Java's own trim and case mapping give the same results at
a small part of the cost of the maps; only other strings go through them.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_BMP = [chr(i) for i in range(sys.maxunicode + 1) if i < 0x10000 and not 0xD800 <= i <= 0xDFFF]


@lru_cache(maxsize=None)
def space_separators() -> str:
    """All code points of Unicode category Zs (U+0020, U+00A0, U+3000, ...)."""
    return "".join(c for c in _BMP if unicodedata.category(c) == "Zs")


def _strip_marks(ch: str) -> str:
    d = unicodedata.normalize("NFD", ch)
    return unicodedata.normalize("NFC", "".join(x for x in d if not unicodedata.category(x).startswith("M")))


@lru_cache(maxsize=None)
def accent_map() -> tuple[str, str]:
    """(matching, replace) for ``F.translate``: characters that change when
    marks are stripped.  Characters that vanish (the marks themselves) come
    last in ``matching`` with no counterpart, which ``translate`` deletes."""
    keep_src, keep_dst, drop = [], [], []
    for c in _BMP:
        s = _strip_marks(c)
        if s == c:
            continue
        if s == "":
            drop.append(c)
        elif len(s) == 1:
            keep_src.append(c)
            keep_dst.append(s)
    return "".join(keep_src) + "".join(drop), "".join(keep_dst)


@lru_cache(maxsize=None)
def _full_case_expanders(kind: str) -> tuple[str, str]:
    """Characters whose full case mapping (what Java applies) has more than
    one character, paired with their simple one-to-one mapping.

    The simple upper case of ``c`` is the single character whose lower case
    is ``c`` (``ß`` <- ``ẞ``, ``ᾳ`` <- ``ᾼ``); without one, ``c`` stays.  The
    only such lower-case expander in the BMP is ``İ``, whose simple lower
    case is ``i``.
    """
    src, dst = [], []
    if kind == "upper":
        inverse = {}
        for u in _BMP:
            lo = u.lower()
            if len(lo) == 1 and lo != u:
                inverse.setdefault(lo, u)
        for c in _BMP:
            if len(c.upper()) > 1:
                src.append(c)
                dst.append(inverse.get(c, c))
    else:
        for c in _BMP:
            if len(c.lower()) > 1:
                src.append(c)
                dst.append("i" if c == "\u0130" else c)
    return "".join(src), "".join(dst)


def _placeholders(n: int) -> str:
    """Private-use code points that stand in for characters while Java
    changes case (case mapping leaves the private-use area untouched)."""
    return "".join(chr(0xF000 + i) for i in range(n))


def _by_script(c: Column, ascii_only: Column, any_script: Column) -> Column:
    """``ascii_only`` where ``c`` is plain ASCII, else ``any_script``."""
    return F.when(F.octet_length(c) == F.length(c), ascii_only).otherwise(any_script)


def _trim_any(c: Column) -> Column:
    return F.btrim(c, F.lit(space_separators()))


def _case_any(c: Column, kind: str) -> Column:
    src, dst = _full_case_expanders(kind)
    ph = _placeholders(len(src))
    return F.translate((F.upper if kind == "upper" else F.lower)(F.translate(c, src, ph)), ph, dst)


def trim_spaces(c: Column | str) -> Column:
    """``trim`` that removes leading/trailing Unicode space separators."""
    c = _col(c)
    return _by_script(c, F.trim(c), _trim_any(c))


def upper_simple(c: Column | str) -> Column:
    """``upper`` with one-to-one case mapping (``ß`` -> ``ẞ``, ligatures kept)."""
    c = _col(c)
    return _by_script(c, F.upper(c), _case_any(c, "upper"))


def lower_simple(c: Column | str) -> Column:
    """``lower`` with one-to-one case mapping (``İ`` -> ``i``)."""
    c = _col(c)
    return _by_script(c, F.lower(c), _case_any(c, "lower"))


def strip_accents(c: Column | str) -> Column:
    """Remove diacritics: ``'São Paulo'`` -> ``'Sao Paulo'``."""
    matching, replace = accent_map()
    return F.translate(_col(c), matching, replace)


def keep_upper_alnum(c: Column | str) -> Column:
    """Delete (not replace) every character outside ``[A-Z0-9 ]``."""
    return F.regexp_replace(_col(c), r"[^A-Z0-9 ]+", "")


_KEEP = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ")


def _simple_upper(c: str) -> str:
    u = c.upper()
    if len(u) == 1:
        return u
    src, dst = _full_case_expanders("upper")
    i = src.find(c)
    return dst[i] if i >= 0 else c


@lru_cache(maxsize=None)
def _fold_map(upper_first: bool) -> tuple[str, str]:
    """Characters outside ``[A-Z0-9 ]`` that standardisation turns INTO one
    of them (``É`` -> ``E``; with ``upper_first`` also ``é`` -> ``E``).

    Every other character outside the set ends up deleted, so the whole
    standardiser is this one ``translate`` followed by one regex delete —
    no case conversion or full accent map on the hot path.
    """
    src, dst = [], []
    for c in _BMP:
        if c in _KEEP:
            continue
        s = _strip_marks(_simple_upper(c) if upper_first else c)
        if len(s) == 1 and s in _KEEP:
            src.append(c)
            dst.append(s)
    return "".join(src), "".join(dst)


@lru_cache(maxsize=None)
def _fold_and_delete(upper_first: bool) -> tuple[str, str]:
    """``translate`` arguments that map (see :func:`_fold_map`) AND delete
    every other BMP character outside ``[A-Z0-9 ]`` in the same pass."""
    src, dst = _fold_map(upper_first)
    mapped = set(src)
    drop = "".join(c for c in _BMP if c not in _KEEP and c not in mapped)
    return src + drop, dst


def _standardise(c: Column, upper_first: bool) -> Column:
    # one translate maps and deletes every BMP character; what can remain
    # outside [A-Z0-9 ] are supplementary-plane characters, 4 bytes each in
    # UTF-8, so "bytes == characters" proves the string clean and the regex
    # runs only on the rare rows that still need it.
    matching, replace = _fold_and_delete(upper_first)
    y = F.translate(c, matching, replace)
    return _by_script(c, keep_upper_alnum(F.upper(c) if upper_first else c), _by_script(y, y, keep_upper_alnum(y)))


def normalize_name(c: Column | str) -> Column:
    """Name standardiser: strip accents, then keep only ``[A-Z0-9 ]``.

    Expects upper-cased input (the staging layer does ``upper(trim(x))``):
    ``D'OESTE`` -> ``DOESTE``, ``A-B`` -> ``AB``, ``SÃO`` -> ``SAO``.
    Same result as ``keep_upper_alnum(strip_accents(c))``, in one pass.
    """
    return _standardise(_col(c), upper_first=False)


def clean_upper(c: Column | str) -> Column:
    """``upper(trim(x))`` with the SQL engine's semantics."""
    c = _col(c)
    return _by_script(c, F.upper(F.trim(c)), _case_any(_trim_any(c), "upper"))


def clean_lower(c: Column | str) -> Column:
    """``lower(trim(x))`` with the SQL engine's semantics."""
    c = _col(c)
    return _by_script(c, F.lower(F.trim(c)), _case_any(_trim_any(c), "lower"))


def normalize_text(c: Column | str) -> Column:
    """Full standardisation ``keep[A-Z0-9 ](strip_accents(upper(trim(x))))``.

    Equal to :func:`normalize_name` of :func:`clean_upper`, computed as trim +
    one translate: the characters that upper-casing and accent stripping turn
    into ``[A-Z0-9 ]`` are mapped directly, all others deleted (``ß`` and
    ligatures included, as the SQL engine's simple case mapping leaves them
    outside the kept set).
    """
    c = _col(c)
    return _by_script(c, keep_upper_alnum(F.upper(F.trim(c))), _standardise(_trim_any(c), upper_first=True))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
