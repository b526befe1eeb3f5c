"""Text column builders: fallback chains, Python-style strip, company-name
normalisation, block keys and match precedence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space code points Python's ``str.strip()`` removes.
# Written as one regex character class that Java regex and RE2 both accept.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Corporate suffix words removed from company names (anywhere
# in the name, as whole words), in this order.
SUFFIX_WORDS = (
    "pty", "pvt", "ltd", "plc", "inc", "co", "company", "limited", "llc", "corporation", "corp",
)
SUFFIX_PATTERN = r"\b(" + "|".join(SUFFIX_WORDS) + r")\b"

# Match types and their precedence (higher wins).
MATCH_EXACT = "EXACT"
MATCH_FUZZY_LLM = "FUZZY_LLM"
MATCH_FUZZY_HIGH = "FUZZY_HIGH"
PRECEDENCE = {MATCH_EXACT: 3, MATCH_FUZZY_LLM: 2, MATCH_FUZZY_HIGH: 1}

# Name normalisation, as (pattern, replacement) steps after
# lower-casing (parenthesised text, suffix words, punctuation except '&',
# repeated spaces), plus two steps of our own that make them portable.
# Steps 2 and 3 make the string ASCII while keeping Python's Unicode word
# boundaries: non-ASCII characters that are not letters/digits are non-word
# characters (-> space); non-ASCII letters/digits are word characters
# (-> '_', which is a word character and is removed by the punctuation step).
# After them ``\b`` means the same in Java regex, RE2 and Python ``re``.
NORM_STEPS = (
    (r"\([^)]*\)", " "),                      # parenthesised content
    (r"[^\p{L}\p{N}_\x00-\x7F]", " "),        # non-ASCII non-word characters
    (r"[^\x00-\x7F]", "_"),                   # non-ASCII word characters
    (SUFFIX_PATTERN, " "),                    # corporate suffix words
    (r"[^a-z0-9& ]", " "),                    # punctuation except '&'
    (r" +", " "),                             # collapse spaces
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing Unicode white space."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(_c(col), rf"\A{ws}+|{ws}+\z", "")


def or_chain(*cols: Column | str) -> Column:
    """Python ``a or b or c`` over strings: the first non-empty value, else the
    last candidate as it is (which may be ``""`` or NULL)."""
    cs = [_c(c) for c in cols]
    if len(cs) == 1:
        return cs[0]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs[:-1]], cs[-1])


def norm_name(col: Column | str) -> Column:
    """Canonical company name; NULL for NULL, empty, or nothing left."""
    s = F.lower(_c(col))
    for pattern, repl in NORM_STEPS:
        s = F.regexp_replace(s, pattern, repl)
    return F.nullif(F.trim(s), F.lit(""))


def block_key(col: Column | str, n: int = 3) -> Column:
    """First ``n`` characters of a normalised name (NULL stays NULL)."""
    return F.substring(_c(col), 1, n)


def precedence(match_type: Column | str) -> Column:
    """EXACT 3 > FUZZY_LLM 2 > FUZZY_HIGH 1 > anything else 0."""
    mt = _c(match_type)
    out = F.lit(0)
    expr = None
    for name, rank in PRECEDENCE.items():
        expr = F.when(mt == name, F.lit(rank)) if expr is None else expr.when(mt == name, F.lit(rank))
    return expr.otherwise(out)
