"""Text expressions: markup stripping, title from URL, the text "soup", slug lists.

All are chains of built-in regex functions, so they stay inside whole-stage
codegen.  ``(?d)`` makes Java's dot stop only at ``\\n`` as Python's does, so a
``\\r`` inside markup is treated the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MARKUP = r"(?d)<.*>"          # greedy, per line: first '<' to last '>' on a line
# "Every non-letter, non-space -> space, then runs of 2+ spaces -> one space" is the same as
# "every maximal run of non-letters (spaces included) -> one space": one regex pass, not two.
NON_LETTER_RUN = "[^a-zA-Z]+"
PUNCTUATION = r"\p{Punct}"   # the ASCII punctuation set !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~


def _letters_only(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, NON_LETTER_RUN, " ")))


def clean_text(c: Column) -> Column:
    """Strip markup, keep letters, squeeze spaces, trim, lower-case."""
    return _letters_only(F.regexp_replace(c, MARKUP, " "))


def title_from_url(c: Column, prefix_pattern: str) -> Column:
    """Drop the dated URL prefix (a regex parameter), then clean like ``clean_text``."""
    return _letters_only(F.regexp_replace(c, prefix_pattern, ""))


def soup(category_list: Column, title: Column, content: Column) -> Column:
    """Category slugs + title + cleaned content, one string."""
    return F.trim(F.concat_ws(" ", category_list, title, content))


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCTUATION, "")


def pipe_list(category_list: Column, store_list: Column) -> Column:
    """Space-separated slug lists -> one '|'-separated list without a leading or trailing pipe."""
    joined = F.concat(F.regexp_replace(category_list, " ", "|"), F.lit("|"), F.regexp_replace(store_list, " ", "|"))
    return F.regexp_replace(joined, r"(^\||\|$)", "")


def cdn_url(c: Column, marker: str, prefix: str) -> Column:
    """Replace scheme, host and path up to ``marker`` by ``prefix`` (greedy, like the original)."""
    return F.regexp_replace(c, "^.+" + marker, prefix)
