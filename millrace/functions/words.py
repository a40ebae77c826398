"""Words and sentence segments of a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.  \w is ASCII in Spark's regular expressions, so an accented
# letter or a tab ends a segment, while a space or * only ends a word.
SEGMENT_BREAK = r"[^\w' *]+"
# A word starts and ends with a letter or digit; ' and _ survive inside it only.
WORD = r"[a-z0-9](?:[a-z0-9_']*[a-z0-9])?"


def segment_texts(line: Column) -> Column:
    """The lower-cased segments of a line, as an array of strings."""
    return F.split(F.lower(line), SEGMENT_BREAK)


def words_of(lowered: Column) -> Column:
    """The words of a lower-cased text, in order, as an array."""
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))
