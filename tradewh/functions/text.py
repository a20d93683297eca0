"""Text normalisers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tradewh.functions._util import col

# The Unicode space separators (category Zs) stripped from both
# ends by the reference engine's TRIM: U+0020, U+00A0, U+1680, U+2000..U+200A,
# U+202F, U+205F, U+3000. Tabs and newlines are kept, as that TRIM keeps them.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)

# The ISO-prefix pattern of dirty country names ("BR - BRASIL")
# and the channel code table of the reference.
ISO_PREFIX_MATCH = r"^[A-Z]{2} - .+"
ISO_PREFIX = r"^[A-Z]{2} - "
CHANNELS = {"V": "VERDE", "R": "ROJO", "N": "NARANJA"}
CHANNEL_UNKNOWN = "DESCONOCIDO"


def unicode_trim(c: Column | str) -> Column:
    """Strip space separators from both ends (``TRIM(BOTH chars FROM x)``).

    The argument is evaluated once. (A CASE that re-used it in several
    branches would re-evaluate it per branch: Spark does not share common
    subexpressions across conditional branches.)
    """
    return F.trim(col(c), F.lit(SPACE_SEPARATORS))


def norm_text(c: Column | str) -> Column:
    """``UPPER(TRIM(x))`` (P1); NULL stays NULL.

    TRIM looks its characters up one by one, so texts that begin and end with a
    visible ASCII character, as most do, go past it.
    """
    c = col(c)
    last = F.substring(c, -1, 1)
    bare = (c >= "!") & (c < "\u0080") & (last >= "!") & (last < "\u0080")
    return F.upper(F.when(bare, c).otherwise(unicode_trim(c)))


def repair_enye(c: Column | str) -> Column:
    """Corrupt backslash -> 'Ñ' (P7): ``ESPA\\A`` becomes ``ESPAÑA``."""
    return F.replace(col(c), F.lit("\\"), F.lit("Ñ"))


def normalize_country(c: Column | str, first_only: bool = False) -> Column:
    """Country clean-up.

    Upper/trim; if the value starts with a two-letter ISO code and `` - ``,
    drop that prefix; otherwise collapse whitespace runs to one space.
    ``first_only=True`` reproduces the observed reference behaviour of
    collapsing only the first run (its regex replace lacked the global flag).
    """
    u = norm_text(c)
    if first_only:
        collapsed = F.regexp_replace(u, r"^(.*?)\s+(.*)$", "$1 $2")
    else:
        collapsed = F.regexp_replace(u, r"\s+", " ")
    stripped = F.regexp_replace(u, ISO_PREFIX, "")
    # u is already upper case: trimming the replaced text is all that is left.
    return F.when(u.rlike(ISO_PREFIX_MATCH), unicode_trim(stripped)).otherwise(unicode_trim(collapsed))


def decode_canal(c: Column | str) -> Column:
    """V/R/N -> VERDE/ROJO/NARANJA; anything else, NULL included -> DESCONOCIDO."""
    c = col(c)
    expr = None
    for code, name in CHANNELS.items():
        expr = F.when(c == code, name) if expr is None else expr.when(c == code, name)
    return expr.otherwise(CHANNEL_UNKNOWN)


def left(c: Column | str, n: int) -> Column:
    """``LEFT(s, n)`` (P25)."""
    return F.substring(col(c), 1, n)
