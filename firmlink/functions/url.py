"""URL column builders: domain (network location), URL hash, row hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmlink.functions.text import _c

# Network location the way ``urllib.parse`` splits it: after an optional
# scheme, ``//`` up to the first of ``/ ? #``; userinfo and port are kept.
NETLOC_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


# A bracketed host must be an IPv6 address (hex groups, optional embedded
# IPv4 and zone) or an IPvFuture literal; anything else makes the parser raise.
BRACKETED_HOST = r"^[^\[\]]*\[(v[0-9A-Fa-f]+\.[^\[\]]+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(%[^\[\]]+)?)\](:[^\[\]]*)?$"


def url_domain(url: Column | str) -> Column:
    """Lower-cased network location; ``""`` without ``//``; NULL for NULL and
    where the URL parser raises (unbalanced or invalid bracketed host).

    As the parser does, tab/CR/LF are removed anywhere and leading C0 control
    characters and spaces are dropped first.
    """
    u = _c(url)
    cleaned = F.regexp_replace(F.regexp_replace(u, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")
    netloc = F.regexp_extract(cleaned, NETLOC_PATTERN, 1)
    has_open, has_close = netloc.contains("["), netloc.contains("]")
    bad = (has_open != has_close) | ((has_open | has_close) & ~netloc.rlike(BRACKETED_HOST))
    return F.when(u.isNull() | bad, F.lit(None).cast("string")).otherwise(F.lower(netloc))


def url_hash(url: Column | str) -> Column:
    """SHA-256 hex of the UTF-8 URL; NULL for NULL or empty."""
    u = _c(url)
    return F.when(u != "", F.sha2(u, 256))


def row_hash(*cols: Column | str) -> Column:
    """SHA-256 hex of the non-NULL values joined by ``|``."""
    return F.sha2(F.concat_ws("|", *[_c(c).cast("string") for c in cols]), 256)
