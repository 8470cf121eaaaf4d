"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token patterns (words of two characters and more), the value of missing tags, the
# separator of tag lists and the one between name and artist.
WORD_PATTERN = r"(?U)\b\w\w+\b"
ASCII_WORD_PATTERN = r"\w\w+"
MISSING_TAGS = "no_tags"
TAG_SEPARATOR = ","
DISPLAY_SEPARATOR = " — "


def words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def strip(text: Column) -> Column:
    """Without surrounding white space of any kind (``trim`` only removes blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tag_list(tags: Column) -> Column:
    return F.transform(F.split(F.lower(tags), TAG_SEPARATOR), strip)


def display(name: Column, artist: Column, separator: str = DISPLAY_SEPARATOR) -> Column:
    return F.concat(name, F.lit(separator), artist)


def title_case(text: Column) -> Column:
    """Every run of letters capitalised, as result lists show names (``initcap`` only splits at blanks)."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")
