"""Text cleaning and text-to-number helpers (spreadsheet-shaped staging data)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and markers that must equal the source semantics.
#   leading word  : ^\w+           (Unicode word chars, so Cyrillic names work)
#   first token   : ^\S+
#   second token  : ^\S+\s+(\S+)   (first capture group)
#   blank chars   : [\xA0\s]+      (no-break space and ASCII white space)
LEADING_WORD = r"(?U)^\w+"
FIRST_TOKEN = r"^\S+"
SECOND_TOKEN = r"^\S+\s+(\S+)"
BLANKS = r"[\xA0\s]+"

# Decimal type for free-form money text: 24 digits before the point, 12 after it.
# Text with more digits fails the query instead of being rounded.
MONEY, MONEY_SCALE = "decimal(36,12)", 12


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def leading_word(c) -> Column:
    """First run of word characters; NULL when the text starts otherwise."""
    return F.regexp_substr(_c(c), F.lit(LEADING_WORD))


def first_token(c) -> Column:
    """Text up to the first blank; NULL for NULL or a leading blank."""
    return F.regexp_substr(_c(c), F.lit(FIRST_TOKEN))


def second_token(c) -> Column:
    """Second blank-separated token; NULL when there is none.

    ``regexp_extract`` yields '' for no match, which would join '' to ''; the
    NULLIF restores SQL's NULL.
    """
    return F.nullif(F.regexp_extract(_c(c), SECOND_TOKEN, 1), F.lit(""))


def blank_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def int_from_text(c) -> Column:
    """'' and NULL become 0; digits (blanks around them allowed) become int.

    Anything else fails the query, as the source database does, whether or not
    the session has ANSI mode on.
    """
    text = blank_to_null(c)
    return F.coalesce(_checked(text, text.try_cast("int"), "int"), F.lit(0))


def _checked(text: Column, value: Column, kind: str) -> Column:
    """``value``; fails where there is text but no value."""
    bad = F.raise_error(F.concat(F.lit(f"not a valid {kind}: "), text)).cast(kind)
    return F.when(text.isNotNull() & value.isNull(), bad).otherwise(value)


def strip_blanks(c) -> Column:
    """Remove every blank and no-break space (thousand separators)."""
    return F.regexp_replace(_c(c), BLANKS, "")


def decimal_from_text(c, already_stripped: bool = False) -> Column:
    """'1\xa0234,5' -> 1234.5; '' and NULL -> 0; garbage and
    numbers beyond ``MONEY`` fail."""
    s = _c(c) if already_stripped else strip_blanks(c)
    s = blank_to_null(F.replace(s, F.lit(","), F.lit(".")))
    exact = F.when(~s.rlike(rf"\.\d{{{MONEY_SCALE}}}\d*[1-9]"), s.try_cast(MONEY))
    return F.coalesce(_checked(s, exact, MONEY), F.lit(0).cast(MONEY))


def strip_word(c, word: str) -> Column:
    """Remove every occurrence of ``word`` (blanks around it stay)."""
    return F.replace(_c(c), F.lit(word), F.lit(""))
