"""Title functions (T1..T4, T14) as Column expressions, no UDFs.

Python's ``str.strip``/``str.split`` treat every character with
``isspace()`` as whitespace.  Java's ``\\s`` and ``trim`` cover fewer, so the
set is derived here from Python itself and written out as an explicit
character class that both Java regex and RE2 (the SQL oracle) accept.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def whitespace_codepoints() -> tuple[int, ...]:
    """Code points Python considers whitespace (derived by rule)."""
    return tuple(c for c in range(0x110000) if chr(c).isspace())


def whitespace_chars() -> str:
    return "".join(chr(c) for c in whitespace_codepoints())


def whitespace_class(negate: bool = False) -> str:
    """Regex character class of the whitespace set, ``\\x{..}`` escaped, as ranges."""
    cps, parts, i = whitespace_codepoints(), [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        parts.append(f"\\x{{{cps[i]:x}}}" + (f"-\\x{{{cps[j]:x}}}" if j > i else ""))
        i = j + 1
    return f"[{'^' if negate else ''}{''.join(parts)}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.trim(_col(c), F.lit(whitespace_chars()))


def title_length(c) -> Column:
    """Length in code points."""
    return F.length(_col(c))


def word_count(c) -> Column:
    """``len(str.split())`` = number of maximal non-whitespace runs."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(whitespace_class(negate=True) + "+")), F.lit(0))


def ends_with_question(c) -> Column:
    """T4: ``re.search(r'\\?$')`` -- '$' also matches before one final newline.

    ``(?d)`` (UNIX_LINES) makes '\\n' the only line terminator, as in Python.
    """
    return _col(c).rlike(r"(?d)\?$").cast("int")
