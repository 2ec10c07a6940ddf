"""What all operators here call a word: a run of characters other than space and tab to return."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between words, and a word as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """The words in order; empty for null and for texts without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))
