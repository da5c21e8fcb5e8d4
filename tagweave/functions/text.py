"""Text normalization as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.fixed import BRACKETED_SUFFIX, TRAILING_SUFFIX, VARIANT_KEYWORDS

# White space: the Unicode characters of that property, and the four ASCII separators
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITE_SPACE_RUN = rf"[{_SPACES}]+"
_WORD = r"[\p{L}\p{N}_]"

_BRACKETED = f"(?iU){BRACKETED_SUFFIX}"
_TRAILING = f"(?iU){TRAILING_SUFFIX}"
_WHOLE_WORD = rf"(?iU)(?<!{_WORD})(?:{VARIANT_KEYWORDS})(?!{_WORD})"


def strip(value: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(value, F.lit(_SPACES))


def collapse(value: Column) -> Column:
    """Turn each run of white space into one space, none at the ends."""
    return F.trim(F.regexp_replace(value, WHITE_SPACE_RUN, " "))


def norm(value: Column) -> Column:
    """Case- and space-insensitive form; null becomes the empty string."""
    return collapse(F.lower(F.coalesce(value, F.lit(""))))


def norm_title(value: Column) -> Column:
    """``norm`` without a trailing bracketed suffix that holds a keyword, then without
    one trailing bare keyword."""
    text = F.regexp_replace(norm(value), _BRACKETED, "")
    return collapse(F.regexp_replace(text, _TRAILING, ""))


def norm_query(value: Column) -> Column:
    """``norm`` without any whole-word keyword."""
    return collapse(F.regexp_replace(norm(value), _WHOLE_WORD, " "))


def is_variant_title(value: Column) -> Column:
    """1 when title normalization removed something, else 0."""
    return (norm_title(value) != norm(value)).cast("int")


def cache_key(artist: Column, title: Column) -> Column:
    return F.concat(F.coalesce(artist, F.lit("")), F.lit(" - "), F.coalesce(title, F.lit("")))


def clean_tag(value: Column) -> Column:
    """Lower-cased, stripped tag name."""
    return F.lower(strip(value))
