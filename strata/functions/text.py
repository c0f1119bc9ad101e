"""Text cleaning for silver ``varchar`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that means "no value" (compared after trim + lower case).
NULL_TOKENS = ["", "na", "n/a", "null", "-"]

# Accented letters and the ASCII letter each one becomes.
ACCENTED = "ÁÀÂÃÄÅáàâãäåÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÕÖóòôõöÚÙÛÜúùûüÇçÑñ"
UNACCENTED = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCcNn"

# Whitespace as the reference engine's regex class ``\s`` knows it (no \v).
_WS = r"[\t\n\f\r ]"
# Replace only the first whitespace run: split the text around it.
_FIRST_RUN = r"(?s)^(.*?)" + _WS + r"+(.*)\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens_to_null(c: Column | str) -> Column:
    """NULL when the trimmed, lower-cased text is a null token, else the text."""
    x = _col(c)
    return F.when(~F.lower(F.trim(x)).isin(NULL_TOKENS), x)


def collapse_whitespace(c: Column | str, mode: str = "first") -> Column:
    """Replace a whitespace run with one space: the first run only (``first``,
    the reference behaviour) or every run (``all``)."""
    x = _col(c)
    if mode == "first":
        return F.regexp_replace(x, _FIRST_RUN, "$1 $2")
    if mode == "all":
        return F.regexp_replace(x, _WS + "+", " ")
    raise ValueError(f"collapse mode must be 'first' or 'all', got {mode!r}")


def clean_text(c: Column | str, collapse: str = "first") -> Column:
    """null tokens -> NULL, '' -> NULL, strip accents, collapse whitespace,
    trim spaces, lower-case.  Input is cast to string first."""
    x = _col(c).try_cast("string")
    x = F.nullif(null_tokens_to_null(x), F.lit(""))
    x = F.translate(x, ACCENTED, UNACCENTED)
    x = collapse_whitespace(x, collapse)
    return F.lower(F.trim(x))
