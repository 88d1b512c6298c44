"""String helpers as built-in column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listing_analytics import fixed

# Whitespace as Python's str.strip() understands it, for patterns and for trim.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
SPACES = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
# Two or more word characters; plain \w is ASCII only on the JVM.
TOKEN = r"[\p{L}\p{N}_]{2,}"
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(col: Column) -> Column:
    """Remove any whitespace at both ends; looks at the ends only, unlike a pattern."""
    return F.trim(col, F.lit(SPACES))


def normalise_text(col: Column) -> Column:
    """Collapse runs of blanks and line breaks, lower, delete tabs and backslashes, strip."""
    # Single blanks stay as they are, so the pattern only stops at what has to change.
    spaced = F.trim(F.regexp_replace(col, r"\n[\n ]*| [\n ]+", " "))
    return strip(F.translate(F.lower(spaced), "\t\\", ""))


def tokens(col: Column) -> Column:
    """Lower-cased unigrams of at least two word characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN), 0)


def words(col: Column) -> Column:
    """Split on any run of whitespace, no empty parts."""
    return F.filter(F.split(col, rf"{SPACE}+"), lambda w: w != "")


def last_number(col: Column) -> Column:
    """Digits stay; otherwise the integer after the last ``|``."""
    return strip(F.element_at(F.split(col, r"\|"), -1)).try_cast("bigint")


def blank_placeholder(col: Column, text: str = fixed.ABOUT_PLACEHOLDER) -> Column:
    """The placeholder becomes an empty text, everything else stays."""
    return F.when(col == text, "").otherwise(col)


def star_to_sentiment(col: Column) -> Column:
    """Decided by the first character alone: below 3 is negative."""
    first = F.substring(strip(col), 1, 1).try_cast("int")
    return F.when(first < 3, "negative").when(first >= 3, "positive")


def first_integer(col: Column) -> Column:
    """First run of digits as a double; no run gives null."""
    return F.nullif(F.regexp_extract(col, r"([0-9]+)", 1), F.lit("")).try_cast("double")


def all_digits(col: Column) -> Column:
    """All digits joined into one integer, 0 when there are none."""
    digits = F.nullif(F.regexp_replace(col, r"[^0-9]", ""), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def digit_sum(col: Column) -> Column:
    """Sum of the single digits of a text."""
    return F.aggregate(
        F.regexp_extract_all(col, F.lit(r"[0-9]"), 0),
        F.lit(0).cast("bigint"),
        lambda total, digit: total + digit.cast("bigint"),
    )


def split_first(col: Column, sep: str) -> Column:
    """Part before the first separator; the whole text when there is none."""
    return F.substring_index(col, sep, 1)


def first_number_word(col: Column) -> Column:
    """First blank-separated word made of digits only."""
    return F.get(F.filter(F.split(strip(col), " "), lambda w: w.rlike(r"\A[0-9]+\z")), F.lit(0))


def title_case(col: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest (F1).

    ``initcap`` only looks at blanks and would give ``Ids/dls``.
    """
    runs = F.regexp_extract_all(F.lower(strip(col)), F.lit(_CASED_RUNS), 1)
    rest = lambda text: F.substring(text, 2, 1 << 30)

    def capital(run: Column) -> Column:
        # The upper case of one letter may be two letters, of which only the first is a capital.
        first = F.upper(F.substring(run, 1, 1))
        return F.concat(F.substring(first, 1, 1), F.lower(rest(first)), rest(run))

    return F.array_join(F.transform(runs, capital), "")


def listing_text(name: Column, description: Column) -> Column:
    """Name and description; one missing part makes the whole text the placeholder."""
    return F.coalesce(F.concat(name, F.lit(" "), description), F.lit(fixed.NO_TEXT))
