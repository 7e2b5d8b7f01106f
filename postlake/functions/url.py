"""URL functions.

The domain rule follows ``urllib.parse.urlsplit(url).netloc.lower()
.split(':')[0]`` with ``'no_url'`` for empty or invalid input:

* leading C0 controls and spaces are stripped, tab/CR/LF removed anywhere;
* a scheme is ``letter (letter|digit|+|-|.)* ':'`` up to the first colon;
* the authority follows ``//`` and ends at the first ``/ ? #``;
* an authority with an unbalanced bracket, or a bracketed host that is not
  an IPv6 literal / IPvFuture (approximated by its character set), is
  invalid, so ``'no_url'``;
* an authority whose NFKC form holds one of ``/ ? # @ :`` that it didn't hold
  itself is invalid;
* user info is *not* removed: ``user:pw@h.com`` gives ``user``.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_URL = "no_url"
AUTHORITY_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
BRACKETED_HOST_PATTERN = r"^\[(v[0-9A-Fa-f]+\..+|[0-9A-Fa-f.]*:[0-9A-Fa-f:.]*(%[^\]]*)?)\](:.*)?$"


@functools.cache
def nfkc_delimiters() -> str:
    """Characters whose compatibility form holds one of / ? # @ : (found by rule over all of Unicode)."""
    return "".join(c for c in map(chr, range(128, 0x110000)) if not 0xD800 <= ord(c) < 0xE000
                   and set(unicodedata.normalize("NFKC", c)) & set("/?#@:"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_url(c) -> Column:
    """T5: any non-empty string (whitespace counts) is a URL."""
    return (F.length(F.coalesce(_col(c), F.lit(""))) > 0).cast("int")


def authority(c) -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return F.regexp_extract(cleaned, AUTHORITY_PATTERN, 1)


def domain(c) -> Column:
    """T6."""
    netloc = authority(c)
    host_part = F.regexp_extract(netloc, r"([^@]*)$", 1)
    has_open, has_close = netloc.contains("["), netloc.contains("]")
    bracket_ok = (~has_open & ~has_close) | (has_open & has_close & host_part.rlike(BRACKETED_HOST_PATTERN))
    first = F.split(F.lower(netloc), ":", 2).getItem(0)
    normal = ~netloc.rlike("[" + nfkc_delimiters() + "]")
    return F.when(bracket_ok & normal & (first != ""), first).otherwise(F.lit(NO_URL))
